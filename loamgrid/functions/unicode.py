"""Unicode normal forms and full case folding without leaving the JVM, by the Unicode library that Spark brings along.

Texts of ASCII alone take the plain functions. The forms equal Python's for every assigned code point (tested); null stays null. Spark counts `reflect`
as not deterministic, so these stand in projections and filters, not in join conditions.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NORMALIZER, CHARACTER, ESCAPES = "com.ibm.icu.text.Normalizer", "com.ibm.icu.lang.UCharacter", "org.apache.commons.text.StringEscapeUtils"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _call(kind: str, method: str, *args: Column) -> Column:
    return F.call_function("reflect", F.lit(kind), F.lit(method), *args)


def _beyond_ascii(c: Column, plain: Column, full: Column) -> Column:
    return F.when(c.isNull() | (F.octet_length(c) == F.char_length(c)), plain).otherwise(full)


def casefold(c: Column | str) -> Column:
    """Full default case folding."""
    c = _col(c)
    return _beyond_ascii(c, F.lower(c), _call(CHARACTER, "foldCase", c, F.lit(True)))


def nfkc(c: Column | str) -> Column:
    c = _col(c)
    return _beyond_ascii(c, c, _call(NORMALIZER, "compose", c, F.lit(True)))


def nfkd(c: Column | str) -> Column:
    c = _col(c)
    return _beyond_ascii(c, c, _call(NORMALIZER, "decompose", c, F.lit(True)))


@cache
def combining() -> str:
    """A pattern of the marks that combine, as ranges; the general category is looked at first (newer marks have none in Java)."""
    marks = {i for i in range(0x110000) if unicodedata.combining(chr(i))}
    ranges = []
    for start in sorted(i for i in marks if i - 1 not in marks):
        end = next(i for i in range(start, 0x110001) if i + 1 not in marks)
        ranges.append(f"\\x{{{start:x}}}-\\x{{{end:x}}}")
    return f"[\\p{{M}}\\p{{Cn}}&&[{''.join(ranges)}]]+"


def without_marks(c: Column | str) -> Column:
    """Compatibility decomposition without the marks that combine."""
    c = _col(c)
    return _beyond_ascii(c, c, F.regexp_replace(_call(NORMALIZER, "decompose", c, F.lit(True)), combining(), ""))


def without_references(c: Column | str) -> Column:
    """Character references decoded: numbers, and the names of HTML 4 and &apos;, each with its semicolon."""
    c = _col(c)
    return F.when(F.contains(c, F.lit("&")), _call(ESCAPES, "unescapeHtml4", F.replace(c, F.lit("&apos;"), F.lit("'")))).otherwise(c)
