"""Tiered prices: a unit's running copy number chooses a band, band and size choose the cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval(c: str | Column) -> tuple[Column, Column]:
    """Lower and upper bound of `[lo,hi]` or `[lo,)`; an open upper bound is null, any other form fails."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.trim(c)
    good = text.rlike(r"^\[\d+,(\d+\]|\))$")
    lo = F.when(good, F.regexp_extract(text, r"^\[(\d+)", 1)).otherwise(F.raise_error(F.concat(F.lit("unsupported range: "), F.coalesce(text, F.lit("null")))))
    return lo.cast("int"), F.nullif(F.regexp_extract(text, r",(\d+)\]$", 1), F.lit("")).cast("int")


def parse_bands(bands: DataFrame, column: str = "range") -> DataFrame:
    lo, hi = interval(column)
    return bands.withColumns({"lo": lo, "hi": hi})


def price(rows: DataFrame, bands: DataFrame, unit: str, size: str | None = None) -> DataFrame:
    """Rows (with copy_no) and the points of the first band in order that holds their copy number, and of their size.

    A unit's bands are one ordered array, so one join on the unit prices a row where it stands: rows never multiply and need no key.
    Where the first band doesn't price the size, later bands are not looked at. A unit without bands has null points.
    """
    item = F.struct("band_no", "lo", "hi", *([F.col(size).alias("size")] if size else []), "points")
    lists = bands.filter(F.col(unit).isNotNull()).groupBy(F.col(unit).alias("_priced_unit")).agg(F.sort_array(F.collect_list(item)).alias("_priced_bands"))
    hits = F.filter("_priced_bands", lambda b: (b["lo"] <= F.col("copy_no")) & (b["hi"].isNull() | (F.col("copy_no") <= b["hi"])))
    if size:
        hits = F.filter(hits, lambda b: (b["band_no"] == F.get(hits, 0)["band_no"]) & (b["size"] == F.col(size)))
    priced = rows.join(F.broadcast(lists), F.col(unit) == F.col("_priced_unit"), "left")  # prices are rules; rows have few units
    return priced.select(*[F.col(c) for c in rows.columns], F.get(hits, 0)["points"].alias("points"))


def limit_check(priced: DataFrame, key: str, limit: Column | int) -> DataFrame:
    """Each key's total points (unpriced rows add nothing) against a limit."""
    total = F.coalesce(F.sum("points"), F.lit(0)).cast("long")
    bound = F.lit(limit) if isinstance(limit, int) else limit
    return priced.groupBy(key).agg(total.alias("points"), F.count_if(F.col("points").isNull()).alias("unpriced")).withColumn("status", F.when(F.col("points") <= bound, "PASS").otherwise("FAIL"))


def repricing(rows: DataFrame, old: DataFrame, new: DataFrame, unit: str, key: str) -> DataFrame:
    """Totals by key under two price lists and their difference."""
    a = price(rows, old, unit).groupBy(key).agg(F.coalesce(F.sum("points"), F.lit(0)).alias("old_points"))
    b = price(rows, new, unit).groupBy(key).agg(F.coalesce(F.sum("points"), F.lit(0)).alias("new_points"))
    return a.join(b, key).withColumn("delta", F.col("new_points") - F.col("old_points"))
