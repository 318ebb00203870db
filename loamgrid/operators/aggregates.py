"""Aggregations: roll-ups, guarded ratios, set-valued and argument aggregates, ordered hashes, evidence bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n"))


def with_totals(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts by both keys, by the outer key and in total; `level` says which (0 detail, 1 outer, 3 total)."""
    return df.rollup(outer, inner).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def nested_counts_map(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Each outer key with a map from inner key to count, in key order."""
    by = df.groupBy(outer, inner).agg(F.count("*").alias("n"))
    return by.groupBy(outer).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(inner, "n")))).alias("by_state"))


def count_if(**conditions: Column) -> list[Column]:
    return [F.count_if(c).alias(n) for n, c in conditions.items()]


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    """a / b rounded; null where b is 0."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def unique_or_null(c: str) -> Column:
    return F.when(F.count_distinct(c) == 1, F.min(c))


def set_list(c: str) -> Column:
    return F.sort_array(F.collect_set(c))


def page_coverage(ranges: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """How many different pages the ranges of each key cover."""
    pages = ranges.select(key, F.explode(F.sequence(start, end)).alias("page"))
    return pages.groupBy(key).agg(F.count_distinct("page").alias("pages"))


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's most frequent value, the smaller one at a tie."""
    by = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return by.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))).filter("_r = 1").drop("_r")


def contiguous(c: str) -> list[Column]:
    """Whether a column holds 1, 2, ... without gap or repetition."""
    return [((F.min(c) == 1) & (F.max(c) == F.count(c)) & (F.count_distinct(c) == F.count(c))).alias("contiguous")]


def weights_complete(weight: str, total: float = 100) -> Column:
    return F.sum(weight) == total


def signatures(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Each key's ordered set of column tuples."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(F.struct(*columns))).alias("signature"))


def signature_mismatch(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of both sides whose signatures differ."""
    both = left.join(right.withColumnRenamed("signature", "other"), key)
    return both.filter(F.col("signature") != F.col("other")).select(key)


def ordered_hash(df: DataFrame, key: str, order: str, text: str, sign: str = "\n\n") -> DataFrame:
    """SHA-256 of each key's texts in order, joined by a sign. A key's rows meet in one array, so a key must fit a task, as a document does."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t")))), lambda x: x["t"]), sign)
    return df.groupBy(key).agg(F.sha2(joined, 256).alias("sha256"), F.count("*").alias("parts"))


def range_hash(hashes: Column, start: Column, end: Column) -> Column:
    """SHA-256 of the hashes of pages start to end (from 1), joined by newlines."""
    return F.sha2(F.array_join(F.slice(hashes, start, end - start + 1), "\n"), 256)


def row_fingerprint(*columns: str) -> Column:
    """Hash of the compact JSON of the columns in name order."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def lineage_confidence(evidence: DataFrame, key: str, lineage: str, high: int = 3, medium: int = 2) -> DataFrame:
    """Sources that share an origin count once."""
    n = F.count_distinct(lineage)
    return evidence.groupBy(key).agg(n.alias("lineages"), F.when(n >= high, "HIGH").when(n >= medium, "MEDIUM").otherwise("LOW").alias("confidence"))


# Least numbers of a robust and a directional sample, and the weights of two scores (each sums to 100).
SAMPLES = {"faction_games": (100, 30), "matchup_games": (100, 30), "readable_winning_lists": (10, 5), "expert_consensus": (3, 2)}
COMPETITIVE = {"tournament_performance": 30, "winning_list_composition": 20, "matchup_and_disposition": 15, "mathematical_efficiency": 15, "expert_consensus": 10, "role_and_mission_fit": 10}
PERSONAL = {"owned_model_coverage": 35, "legal_loadout_and_bits_fit": 20, "role_coverage_in_roster": 20, "purchase_build_friction": 15, "explicit_user_preference_or_familiarity": 10}


def sample_band(kind: str, n: Column) -> Column:
    """How good a sample of one kind is."""
    robust, directional = SAMPLES[kind]
    return F.when(n >= robust, "ROBUST").when(n >= directional, "DIRECTIONAL").otherwise("WEAK")


def evidence_score(weights: dict[str, int]) -> Column:
    """Weighted sum of parts between 0 and 1; the weights sum to 100."""
    if sum(weights.values()) != 100:
        raise ValueError("weights must sum to 100")
    return F.round(reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) * w for c, w in weights.items()]), 4)


def table_hash(df: DataFrame) -> DataFrame:
    """One row: rows and a hash of all of them, whatever their order; repeated rows count, and nulls differ from other values."""
    nulls = [F.col(c).isNull() for c in df.columns]
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*nulls, *df.columns).cast("decimal(38,0)")), F.lit(0)).alias("hash"))


def earliest(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Each key's least row by `order` (nulls first), with the values that stand in it."""
    return df.groupBy(key).agg(F.min(F.struct(*order, *values)).alias("_x")).select(key, "_x.*")
