"""Character classes and folds shared by all operators (JVM side).

Regular expressions are Java ones.  "Blank" is any Unicode space or control
white space; "punctuation" is Unicode category P.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85]"
#: White space of the ECMAScript ``trim``/``\s``, wider than Java's.
JS_WS = r"[\s\x0B   -     　﻿]"

# Width variants, by rule: every code point whose decomposition is one
# <wide>/<narrow> character.
_WIDTH = {
    chr(cp): chr(int(parts[1], 16))
    for cp in [0x3000, *range(0xFF01, 0xFFEF)]
    if len(parts := unicodedata.decomposition(chr(cp)).split()) == 2 and parts[0] in ("<wide>", "<narrow>")
}
_FROM, _TO = "".join(_WIDTH), "".join(_WIDTH.values())


def wide_forms(ch: str) -> list[str]:
    """The width variants of an ordinary character."""
    return [w for w, to in _WIDTH.items() if to == ch]


def spellings(texts: list[str]) -> str:
    """A pattern that finds any text in any case and width, with other characters than letters and digits in between."""
    one = lambda ch: "[" + "".join(re.escape(x) for x in dict.fromkeys(v for c in (ch, ch.upper()) for v in (c, *wide_forms(c)))) + "]"
    return "|".join(r"[^\p{L}\p{N}]*".join(one(ch) for ch in t) for t in texts)


def fold_width(c: Column) -> Column:
    """Full- and half-width variants to their ordinary characters."""
    return F.translate(c, _FROM, _TO)


def trim_blank(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def js_trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{JS_WS}+|{JS_WS}+$", "")


def letters_digits(c: Column) -> Column:
    """Letters and digits only, in one case and width."""
    return F.regexp_replace(F.lower(fold_width(c)), r"[^\p{L}\p{N}]", "")


def bare_text(c: Column) -> Column:
    """Lower case, without blanks and punctuation."""
    return F.regexp_replace(F.lower(c), rf"{BLANK}|\p{{P}}", "")
