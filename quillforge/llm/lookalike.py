"""One consistent form for texts that look alike but differ in their characters.

Texts are exploded to positioned code points and joined to a broadcast mapping
table (decompositions, width variants, blanks, invisible characters,
look-alike letters).  Each code point gives its base characters, combining
marks are ordered by their class, base and marks are recomposed, and the text
is rebuilt.  The mapping table is built by rule from the Unicode database of
the Python runtime; only the look-alike letters are listed.  Its size depends
on Unicode alone, so it may be broadcast whatever the data.

Defined cases
  * null texts stay null; empty, blank and invisible-only texts become empty;
  * case, accents and punctuation other than width variants are kept;
  * texts are processed whole, whatever their length; equal texts are
    processed once; an empty table gives an empty result;
  * repeated option keys and repeated answers give one row per different pair.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.unicode import recomposed
from quillforge.session import durable

# Letters of other scripts with the shape of a Latin letter, each before its letter.
CYRILLIC = dict(["АA", "ВB", "ЕE", "ЅS", "ІI", "ЈJ", "КK", "МM", "НH", "ОO", "РP", "СC", "ТT", "УY", "ХX", "ҮY", "ԚQ", "ԜW", "ӀI", "ӏl", "аa", "еe", "ѕs", "іi", "јj", "оo", "рp", "сc", "уy", "хx", "ү" + "y", "һh", "ԁd", "ԛq", "ԝw", "ѵv"])
GREEK = dict(["ΑA", "ΒB", "ΕE", "ΖZ", "ΗH", "ΙI", "ΚK", "ΜM", "ΝN", "ΟO", "ΡP", "ΤT", "ΥY", "ΧX", "ϹC", "ϳj", "οo", "ϲc", "νv", "ρp", "ιi", "υu", "αa", "γy", "κk"])
ARMENIAN = dict(["ՕO", "ՍU", "Տ" + "S", "օo", "սu", "հh", "ոn", "գq", "զq", "ց" + "g"])
LATIN = dict(["ɑa", "ɡg", "ıi", "ɩi", "ǀl"])
LETTERS = CYRILLIC | GREEK | ARMENIAN | LATIN
DASHES = {"‐": "-", "‑": "-"}
#: Characters without any mark of their own besides category Cf.
INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x180E), *range(0xFE00, 0xFE10)}
#: Decompositions that keep the look: width variants, blanks, and whole-letter compatibility forms.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>")


def _looks_same_compat(ch: str) -> bool:
    """Radicals, ligatures, roman numerals, mathematical letters and squared signs drawn with the same letters."""
    cp = ord(ch)
    mathematical = 0x1D400 <= cp <= 0x1D7FF
    return 0x2E80 <= cp <= 0x2FDF or 0xFB00 <= cp <= 0xFB06 or 0x2160 <= cp <= 0x217F or mathematical or ch in "℃℉"


def _decompose(ch: str) -> str:
    """The characters ``ch`` looks like, fully decomposed."""
    if ch in LETTERS or ch in DASHES:
        return LETTERS.get(ch) or DASHES[ch]
    parts = unicodedata.decomposition(ch).split()
    if not parts:
        return ch
    if parts[0].startswith("<"):
        if parts[0] not in SAME_LOOK and not (parts[0] in ("<compat>", "<font>") and _looks_same_compat(ch)):
            return ch
        parts = parts[1:]
    return "".join(_decompose(chr(int(p, 16))) for p in parts)


@lru_cache(1)
def mapping() -> list[tuple[str, str]]:
    """(character, replacement) of every character that does not stand for itself, but for Hangul."""
    out = [(chr(cp), " ") for cp in (*range(0x09, 0x0E), *range(0x1C, 0x20))]
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind in ("Cn", "Co", "Cs") or 0xAC00 <= cp <= 0xD7A3:
            continue
        if kind == "Cf" or cp in INVISIBLE:
            out.append((ch, ""))
        elif kind[0] == "Z" or cp == 0x85:
            out.append((ch, " "))
        elif (to := _decompose(ch)) != ch:
            out.append((ch, to))
    return out


def mapping_table(spark: SparkSession) -> DataFrame:
    """Bounded by the Unicode repertoire: about four thousand rows."""
    return spark.createDataFrame(mapping(), "ch string, to string")


#: A text without any match stands for itself: visible ASCII, unified ideographs, two marks, single inner blanks.
NOT_PLAIN = r"[^\x20-\x7E\u4E00-\u9FFF\u3001\u3002]|^ | \z|  "


def text_key(text: Column) -> Column:
    """A 128-bit key of a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(77), text).alias("b"))


def consistent(texts: DataFrame) -> DataFrame:
    """``h, form, c`` for each different ``text`` with key ``h`` that does not stand for itself; ``c`` is the key of the form.

    One shuffle: the texts are partitioned by their key, and exploding, joining
    the broadcast mapping and rebuilding keep that partitioning.
    """
    distinct = texts.filter(F.col("text").isNotNull() & F.col("text").rlike(NOT_PLAIN)).groupBy("h").agg(F.first("text").alias("text"))
    points = distinct.select("h", F.posexplode(F.split("text", "")).alias("pos", "ch"))
    mapped = points.join(F.broadcast(mapping_table(texts.sparkSession)), "ch", "left").select("h", "pos", F.coalesce("to", "ch").alias("to"))
    rebuilt = mapped.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("pos", "to"))).alias("points"))
    text = F.array_join(F.transform("points", lambda p: p["to"]), "")
    blanks = rebuilt.select("h", F.trim(F.regexp_replace(text, " +", " ")).alias("t"))
    forms = blanks.select("h", recomposed(F.col("t")).alias("form"))
    return forms.select("h", "form", text_key(F.col("form")).alias("c"))


def question_texts(questions: DataFrame) -> DataFrame:
    """``id, role, key, text, h`` of all stems, options and answers."""
    q = questions.filter(F.col("id").isNotNull())
    none = F.lit("")
    stems = q.select("id", F.lit("stem").alias("role"), none.alias("key"), F.col("stem").alias("text"))
    options = q.select("id", F.explode("options").alias("o")).select("id", F.lit("option").alias("role"), F.coalesce("o.key", none).alias("key"), F.col("o.text").alias("text"))
    answers = q.select("id", F.explode("answers").alias("text")).select("id", F.lit("answer").alias("role"), none.alias("key"), "text")
    return stems.unionByName(options).unionByName(answers).filter(F.col("text").isNotNull()).withColumn("h", text_key(F.col("text")))


def consistent_questions(questions: DataFrame) -> DataFrame:
    """``id, role, key, text, form`` with the consistent form of every text."""
    texts = question_texts(questions)
    forms = consistent(texts.select("text", "h"))
    return texts.join(forms, "h", "left").select("id", "role", "key", "text", F.coalesce("form", "text").alias("form"))


def lookalikes(questions: DataFrame) -> DataFrame:
    """``field_name, id_a, id_b, key_a, key_b`` of texts that look the same but are not the same characters."""
    texts = question_texts(questions)
    forms = consistent(texts.select("text", "h")).select("h", "c")
    # Texts that stand for themselves ("A", "T", ...) need no join, however often they occur.
    rough = F.col("text").rlike(NOT_PLAIN)
    known = texts.filter(~rough).select("id", "role", "key", "h", F.col("h").alias("c"))
    rows = durable(known.unionByName(texts.filter(rough).drop("text").join(forms, "h").select("id", "role", "key", "h", "c")), "p6-rows")
    # Stems: pairs of different texts of one form, then the questions that have them.
    stems = rows.filter("role = 'stem'").select("id", "h", "c")
    # Numbers as the only buffers: hashed, not sorted.
    bounds = [F.min("h.a").alias("a0"), F.max("h.a").alias("a1"), F.min("h.b").alias("b0"), F.max("h.b").alias("b1")]
    several = stems.groupBy("c").agg(*bounds).filter("a0 < a1 or b0 < b1").select("c")
    stems = stems.join(several, "c")
    variants = stems.select("c", "h").distinct()
    va, vb = variants.select("c", F.col("h").alias("h_a")), variants.select("c", F.col("h").alias("h_b"))
    pairs = va.join(vb, "c").filter(F.col("h_a") < F.col("h_b")).select("h_a", "h_b")
    ids = stems.select("id", "h").distinct()
    stem_pairs = (
        pairs.join(ids.select(F.col("h").alias("h_a"), F.col("id").alias("x")), "h_a")
        .join(ids.select(F.col("h").alias("h_b"), F.col("id").alias("y")), "h_b")
        .filter(F.col("x") != F.col("y"))
        .select(F.lit("stem").alias("field_name"), F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), F.lit("").alias("key_a"), F.lit("").alias("key_b"))
    )
    # Within a question.
    options = rows.filter("role = 'option'").select("id", "c", F.col("key").alias("key_b"), F.col("h").alias("h_b"))
    others = rows.filter("role in ('option', 'answer')").select("id", "c", "role", F.col("key").alias("key_a"), F.col("h").alias("h_a"))
    inner = (
        others.join(options, ["id", "c"])
        .filter((F.col("h_a") != F.col("h_b")) & ((F.col("role") == "answer") | (F.col("key_a") < F.col("key_b"))))
        .select(F.col("role").alias("field_name"), F.col("id").alias("id_a"), F.col("id").alias("id_b"), "key_a", "key_b")
    )
    return stem_pairs.unionByName(inner).distinct()
