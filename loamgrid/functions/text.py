"""Text scalars as Column expressions, with Arrow variants where exact Unicode behaviour needs Python.

The normalizers differ on purpose and are not interchangeable. The Column forms stay in the JVM, with full case folding and normal forms (`unicode.py`); letters and
digits are those of Java's Unicode version, character references those of HTML 4. The `exact` forms take Python's tables, in Arrow batches.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .unicode import casefold, nfkc, nfkd, without_marks, without_references

Text = Column | str
DASHES = "‐‑‒–—"
QUOTES = "‘’“”`´"


def col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c: Text) -> Column:
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def non_empty(c: Text) -> Column:
    """The trimmed text, or null where nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def fold_accents(c: Text) -> Column:
    return without_marks(c)


def norm_strip(c: Text) -> Column:
    """Accents dropped, case folded, runs of anything but a-z and 0-9 as one space."""
    return F.trim(F.regexp_replace(casefold(fold_accents(c)), "[^a-z0-9]+", " "))


def norm_strip_decoded(c: Text) -> Column:
    """norm_strip after character references are decoded."""
    return norm_strip(without_references(c))


def norm_keep(c: Text) -> Column:
    """Like norm_strip, but an accent separates: the letter's base stays, its mark becomes a word break."""
    return F.trim(F.regexp_replace(casefold(nfkd(c)), "[^a-z0-9]+", " "))


def name_norm(c: Text) -> Column:
    """Accents dropped, case folded, letters and digits of any script stay."""
    return F.trim(F.regexp_replace(casefold(fold_accents(c)), r"[^\p{L}\p{N}]+", " "))


def overlap_normalize(c: Text) -> Column:
    """References decoded, tags dropped, compatibility composition, soft hyphens dropped, case folded, letters and digits of any script with accents kept."""
    out = nfkc(F.regexp_replace(without_references(c), "<[^>]*>", " "))
    out = F.replace(out, F.lit("\u00ad"), F.lit(""))
    return F.trim(F.regexp_replace(casefold(out), r"[^\p{L}\p{N}]+", " "))


def fingerprint_normalize(c: Text) -> Column:
    """Case kept: dashes unified, white space collapsed in each line, blank lines and bare page numbers dropped."""
    text = F.translate(F.replace(nfkc(c), F.lit("\u00ad"), F.lit("")), DASHES, "-" * len(DASHES))
    lines = F.transform(F.split(text, r"\r\n|[\n\r\u000B\u000C\u0085  ]"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~x.rlike("^[0-9]{1,3}$")), "\n")


def clean_short_label(c: Text, limit: int = 160) -> Column:
    """Control characters, replacement signs and bullets as spaces; collapsed; cut to `limit` characters."""
    out = F.regexp_replace(F.replace(nfkc(F.coalesce(col(c), F.lit(""))), F.lit("\u00ad"), F.lit("")), r"[�\p{C}•·⋅…]+", " ")
    return F.substring(collapse(out), 1, limit)


def slug(c: Text, limit: int = 80, default: str = "section", sign: str = "-") -> Column:
    out = F.regexp_replace(F.lower(fold_accents(c)), "[^a-z0-9]+", sign)
    out = F.substring(F.regexp_replace(out, f"^{sign}+|{sign}+$", ""), 1, limit)
    return F.when(out == "", default).otherwise(out)


def legacy_norm(c: Text) -> Column:
    """Quotes and dashes unified, white space collapsed, lower case."""
    return collapse(F.lower(F.translate(col(c), QUOTES[:2] + DASHES, "''" + "-" * len(DASHES))))


def quote_norm(c: Text) -> Column:
    return F.lower(F.translate(col(c), QUOTES[:2], "''"))


def token_count(c: Text) -> Column:
    return F.coalesce(F.regexp_count(col(c), F.lit(r"(?U)\S+")), F.lit(0)).cast("long")


def canonical_tokens(c: Text) -> Column:
    """Lower-case words of a-z and 0-9; an apostrophe inside a word stays."""
    return F.regexp_extract_all(F.translate(F.lower(fingerprint_normalize(c)), QUOTES[:2], "''"), F.lit("([a-z0-9]+(?:'[a-z0-9]+)?)"), F.lit(1))


def model_count(c: Text) -> Column:
    """The number before `model` or `models`; null if there is none."""
    return F.regexp_extract(F.lower(col(c)), r"(\d+)\s+models?\b", 1).try_cast("int")


def rule_refs(c: Text) -> Column:
    """All references of the form 00.00."""
    return F.regexp_extract_all(col(c), F.lit(r"\b(\d{2}\.\d{2})\b"), F.lit(1))


def mentions(text: Text, ref: Text) -> Column:
    """Whether a literal reference stands in the text with no digit at its sides."""
    return F.regexp_like(col(text), F.concat(F.lit(r"(?<![0-9])\Q"), F.replace(col(ref), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![0-9])")))


def date_near(text: Text, marker: str, window: int = 12000) -> Column:
    """The first date (day month year in letters, or ISO) within a window after a marker; null if the marker or a date is missing."""
    at = F.instr(col(text), marker)
    part = F.when(at > 0, F.substring(col(text), at, F.lit(window)))
    iso = F.regexp_extract(part, r"(\d{4}-\d{2}-\d{2})", 1)
    worded = F.regexp_extract(part, r"(\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4})", 1)
    return F.coalesce(F.try_to_date(F.nullif(worded, F.lit("")), "d MMMM yyyy"), F.try_to_date(F.nullif(iso, F.lit(""))))


def date_renderings(d: Text) -> Column:
    """A date as day/month/year in full, short and unpadded form."""
    return F.array(*[F.date_format(d, f) for f in ("dd/MM/yyyy", "dd/MM/yy", "d/M/yyyy")])


def utc_stamp() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def without_prefix(c: Text, prefix: str) -> Column:
    return F.regexp_replace(col(c), f"^{re.escape(prefix)}\\s+", "")


def composite_key(*parts: Text, blank: str = "_", sign: str = ":") -> Column:
    return F.concat_ws(sign, *[F.coalesce(F.nullif(col(p).cast("string"), F.lit("")), F.lit(blank)) for p in parts])


def text_hash(c: Text) -> Column:
    """SHA-256 of the trimmed text; null for a blank one."""
    return F.sha2(non_empty(c), 256)


def span(c: Text, start: Text, end: Text) -> Column:
    """Characters of a half-open range counted from 0."""
    return F.substring(col(c), col(start) + 1, col(end) - col(start))


def upper_ratio(c: Text) -> Column:
    return F.try_divide(F.regexp_count(col(c), F.lit(r"\p{Lu}")), F.regexp_count(col(c), F.lit(r"\p{L}")))


def shingles(c: Text, n: int = 6) -> Column:
    """All runs of n space-separated tokens. The token array is bound once, as the element of an array of its own."""
    words = F.filter(F.split(col(c), " "), lambda w: w != "")
    runs = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.array_join(F.slice(w, i + 1, n), " "))
    return F.transform(F.array(words), lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(F.array().cast("array<string>")))[0]


def canonical_json(struct: Column) -> Column:
    """Compact JSON; the struct's fields must stand in order of their names."""
    return F.to_json(struct)


def sorted_map(c: Text) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(col(c))))


def _strip(s: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", s) if not unicodedata.combining(x))


_EXACT = {
    "norm_strip": lambda s: " ".join(re.sub("[^a-z0-9]+", " ", _strip(html.unescape(s)).casefold()).split()),
    "norm_keep": lambda s: " ".join(re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKD", s).translate({ord(q): "'" for q in QUOTES[:2]}).casefold()).split()),
    "name_norm": lambda s: " ".join("".join(x if x.isalnum() else " " for x in _strip(s).casefold()).split()),
    "overlap_normalize": lambda s: " ".join("".join(x if x.isalnum() else " " for x in unicodedata.normalize("NFKC", re.sub("<[^>]*>", " ", html.unescape(s))).replace("­", "").casefold()).split()),
}


def exact(name: str):
    """An Arrow UDF of a normalizer with full Unicode semantics; null stays null."""
    rule = _EXACT[name]

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(rule, na_action="ignore")

    return run
