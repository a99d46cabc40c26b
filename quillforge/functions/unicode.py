"""Unicode forms as column expressions, with tables built by rule from the Unicode database of the Python runtime.

Spark has no normalisation function.  Few texts hold characters that change,
so all others are told apart by one pattern and pass as they are.  Tables are
texts that are searched for a character, which plans carry cheaply.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillforge.functions.chars import fold_width

#: Characters that are the same in every form: ASCII, unified ideographs and the marks of Chinese text.
PLAIN = r"\x00-\x7F一-鿿、-〜“”‘’—·×"
# First values of the Hangul blocks, and how many vowels and final consonants (with none) there are.
L, V, T, S, NV, NT = 0x1100, 0x1161, 0x11A7, 0xAC00, 21, 28


#: Between the entries of a table.
MARK = "\x01"


@lru_cache(1)
def mark_classes() -> tuple[str, str]:
    """All marks with a combining class, and characters that stand in the order of their classes."""
    marks = [chr(cp) for cp in range(0x300, 0x1E945) if unicodedata.combining(chr(cp))]
    return "".join(marks), "".join(chr(0x100 + unicodedata.combining(m)) for m in marks)


@lru_cache(1)
def compositions() -> tuple[str, str]:
    """Canonical pairs of base and mark, each after a ``MARK``, and the character each composes to."""
    pairs, made = [], []
    for cp in range(0xC0, 0x1E945):
        ch = chr(cp)
        parts = unicodedata.decomposition(ch).split()
        if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", ch) == ch:
            pairs.append(MARK + "".join(chr(int(p, 16)) for p in parts))
            made.append(ch)
    return "".join(pairs), "".join(made)


@lru_cache(1)
def compatibility() -> tuple[str, str]:
    """Every character but Hangul syllables with a full compatibility decomposition, and the decompositions, joined."""
    found = {ch: to for cp in range(0xA0, 0x2FA1E) if not S <= cp <= 0xD7A3 and (to := unicodedata.normalize("NFKD", ch := chr(cp))) != ch}
    return "".join(found), MARK.join(found.values())


def _composed(pair: Column) -> Column:
    """What base and mark compose to, or null."""
    pairs, made = compositions()
    at = lambda p: F.position(F.concat(F.lit(MARK), p), F.lit(pairs))
    return let(at(pair), lambda i: F.when(i > 0, F.substr(F.lit(made), ((i - 1) / 3).cast("int") + 1, F.lit(1))))


def _class(mark: Column) -> Column:
    marks, kinds = mark_classes()
    return let(F.position(mark, F.lit(marks)), lambda i: F.when(i > 0, F.substr(F.lit(kinds), i, F.lit(1))).otherwise(chr(0x100)))


def let(value: Column, then) -> Column:
    """``then(x)`` with ``value`` computed, and written in the plan, once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _code(ch: Column) -> Column:
    return F.conv(F.hex(F.encode(ch, "UTF-16BE")), 16, 10).cast("int")


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 4, F.lit("0"))), "UTF-16BE")


def composed_hangul(text: Column) -> Column:
    """Conjoining letters to syllables, by arithmetic."""
    units = lambda t: F.regexp_extract_all(t, F.lit(r"(?s)([ᄀ-ᄒ][ᅡ-ᅵ][ᆨ-ᇂ]?|[가-힣][ᆨ-ᇂ]|.)"), F.lit(1))

    def whole(u: Column) -> Column:
        a, b = _code(F.substring(u, 1, 1)), _code(F.substring(u, 2, 1))
        last = F.when(F.length(u) == 3, _code(F.substring(u, 3, 1)) - T).otherwise(0)
        made = _char(((a - L) * NV + (b - V)) * NT + last + S)
        added = F.when((a - S) % NT == 0, _char(a + b - T)).otherwise(u)
        return F.when((F.length(u) >= 2) & u.rlike(r"^[ᄀ-ᄒ][ᅡ-ᅵ]"), made).when((F.length(u) == 2) & u.rlike("^[가-힣]"), added).otherwise(u)

    return let(text, lambda t: F.when(t.rlike(r"[ᅡ-ᇂ]"), F.array_join(F.transform(units(t), whole), "")).otherwise(t))


def recomposed(text: Column) -> Column:
    """Marks after each base ordered by class, then base and marks composed; letters of Hangul too."""
    def several(cluster: Column) -> Column:
        """Marks in the order of their classes, each composed unless one of its class or a higher one stays before it."""
        marks = F.filter(F.split(F.substr(cluster, F.lit(2)), ""), lambda m: m != "")
        keyed = F.array_sort(F.transform(marks, lambda m, i: F.struct(_class(m).alias("k"), i.alias("i"), m.alias("m"))))
        start = F.struct(F.substring(cluster, 1, 1).alias("base"), F.lit("").alias("rest"), F.lit("").alias("last"))

        def step(acc: Column, x: Column) -> Column:
            found = F.when(acc["last"] < x["k"], _composed(F.concat(acc["base"], x["m"])))
            return let(
                found,
                lambda made: F.struct(
                    F.coalesce(made, acc["base"]).alias("base"),
                    F.when(made.isNull(), F.concat(acc["rest"], x["m"])).otherwise(acc["rest"]).alias("rest"),
                    F.when(made.isNull(), x["k"]).otherwise(acc["last"]).alias("last"),
                ),
            )

        return F.aggregate(keyed, start, step, lambda acc: F.concat(acc["base"], acc["rest"]))

    def compose(cluster: Column) -> Column:
        at_start = cluster.rlike(r"^\p{M}")  # marks without a base get one, and lose it again
        whole = several(F.when(at_start, F.concat(F.lit(MARK), cluster)).otherwise(cluster))
        return F.when(F.length(cluster) == 1, cluster).otherwise(F.substr(whole, F.when(at_start, 2).otherwise(1)))

    clusters = lambda t: F.regexp_extract_all(t, F.lit(r"(?s)(\P{M}\p{M}*|\p{M}+)"), F.lit(1))
    return composed_hangul(let(text, lambda t: F.when(t.rlike(r"\p{M}"), F.array_join(F.transform(clusters(t), compose), "")).otherwise(t)))


def nfkc(text: Column) -> Column:
    """Compatibility composition (NFKC)."""
    chars, forms = compatibility()

    def apart(ch: Column) -> Column:
        known = (ch < "\xa0") | ch.between("一", "鿿")
        return F.when(known, ch).otherwise(let(F.position(ch, F.lit(chars)), lambda i: F.when(i > 0, F.split_part(F.lit(forms), F.lit(MARK), i)).otherwise(ch)))

    return let(fold_width(text), lambda w: F.when(w.rlike(f"[^{PLAIN}]"), recomposed(F.array_join(F.transform(F.split(w, ""), apart), ""))).otherwise(w))
