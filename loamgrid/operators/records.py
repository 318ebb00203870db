"""Flattening, lookups and upkeep of nested records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import last_by_key, only_one


def expected_hashes(docs: DataFrame, kinds: dict[str, tuple[str, list[str], list[str]]]) -> DataFrame:
    """(kind, identity, field, expected) of every stored hash of nested entities.

    kinds: name to (array column, identity fields, hash fields); identities are the fields' values joined by bars. Entities meet by their identity, before
    their hashes are told apart, so that a row is shuffled once.
    """
    parts = []
    for kind, (column, identity, hashes) in kinds.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(f"e.{i}").cast("string"), F.lit("")) for i in identity])
        rows = docs.select(F.explode(column).alias("e")).select(key.alias("identity"), *[F.col(f"e.{h}").alias(f"_{i}") for i, h in enumerate(hashes)]).repartition("identity")
        fields = F.explode(F.array(*[F.struct(F.lit(h).alias("field"), F.col(f"_{i}").alias("expected")) for i, h in enumerate(hashes)]))
        found = rows.select("identity", fields.alias("x")).select("identity", "x.field", "x.expected").filter("expected is not null").dropDuplicates(["identity", "field", "expected"])
        parts.append(found.select(F.lit(kind).alias("kind"), "identity", "field", "expected"))
    return reduce(DataFrame.union, parts)


def bag(*kinds: tuple[str, DataFrame, Column, Column]) -> DataFrame:
    """Units of several kinds in one schema: (name, rows, identity map, text) each."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), identity.alias("identity"), text.alias("text")) for k, df, identity, text in kinds])


def exactly_one(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """The one row that meets a condition; none or several fail when it is read."""
    found = df.filter(condition)
    n = found.agg(F.count("*").alias("_n")).select(F.when(F.col("_n") != 1, F.raise_error(F.concat(F.lit(f"{what}: rows="), F.col("_n").cast("string")))).otherwise(F.col("_n")).alias("_n"))
    return found.join(F.broadcast(n), F.col("_n") == 1).drop("_n")


def passed(documents: DataFrame, report: DataFrame, key: str, order: str) -> DataFrame:
    """Documents by key (of repeated ones the last in `order`), if the report they come from, one row with a status, is a PASS; else an error."""
    states = [r["status"] for r in report.select("status").take(2)]
    if states != ["PASS"]:
        raise ValueError(f"the report is not PASS: {states}")
    return last_by_key(documents, order, key)


def unique_names(df: DataFrame, key: str) -> DataFrame:
    return only_one(df, key)


def signal_map(pairs: str) -> Column:
    """A list of (id, count) as a map of the counts above 0."""
    return F.map_from_entries(F.transform(F.filter(pairs, lambda x: x["count"] > 0), lambda x: F.struct(x["id"], x["count"])))


def sum_of(counts: Column, ids: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.try_element_at(counts, F.lit(i)), F.lit(0)) for i in ids], F.lit(0))


def dimension_counts(df: DataFrame, coverage: str, dimensions: list[str]) -> DataFrame:
    """(dimension, complete, missing): rows at 100 and at 0 of every dimension of a coverage map."""
    row = df.agg(*[F.struct(F.lit(d).alias("dimension"), F.count_if(F.coalesce(F.col(coverage)[d], F.lit(0)) == 100).alias("complete"), F.count_if(F.coalesce(F.col(coverage)[d], F.lit(0)) == 0).alias("missing")).alias(d) for d in dimensions])
    return row.select(F.explode(F.array(*[F.col(d) for d in dimensions])).alias("x")).select("x.*")


def set_dimensions(df: DataFrame, coverage: str, complete: Column, dimensions: list[str]) -> DataFrame:
    """Sets the named dimensions of a coverage map to 100 or 0; others stay."""
    fresh = F.map_from_arrays(F.array(*[F.lit(d) for d in dimensions]), F.array_repeat(F.when(complete, 100).otherwise(0), len(dimensions)))
    return df.withColumn(coverage, F.map_concat(F.map_filter(coverage, lambda k, _: ~k.isin(*dimensions)), fresh))


def freshness(df: DataFrame, required: list[str], as_of: Column) -> DataFrame:
    """Problems of sources (id, version, updated, checked): missing ids and versions are errors, odd dates warnings."""
    want = df.sparkSession.createDataFrame([(r,) for r in required], "id string")
    gone = want.join(df, "id", "left_anti").select("id", F.lit("MISSING_SOURCE").alias("problem"), F.lit("ERROR").alias("severity"))
    version = df.filter("version is null or version = ''").select("id", F.lit("MISSING_VERSION").alias("problem"), F.lit("ERROR").alias("severity"))
    dates = df.filter((F.col("checked") < F.col("updated")) | (F.col("updated") > as_of)).select("id", F.lit("DATE_ORDER").alias("problem"), F.lit("WARNING").alias("severity"))
    return gone.union(version).union(dates)


def stamped(df: DataFrame, column: str, field: str, value: Column) -> DataFrame:
    """A nested struct with one field set."""
    return df.withColumn(column, F.col(column).withField(field, value))


def diagnostics(df: DataFrame, source: str, keyword: str, sample: int = 400) -> dict[str, DataFrame]:
    """Counts by keyword and by source and keyword, most frequent first, and a sample in order."""
    return {
        "keywords": df.groupBy(keyword).agg(F.count("*").alias("n")).orderBy(F.desc("n"), keyword),
        "pairs": df.groupBy(source, keyword).agg(F.count("*").alias("n")).orderBy(F.desc("n"), source, keyword),
        "sample": df.orderBy(source, keyword).limit(sample),
    }


def first_hit(requests: DataFrame, entities: DataFrame, keys: list[str], place: str, places: list[str], order: list[str]) -> DataFrame:
    """Each request with the first entity, by `order`, that shares its keys and stands at one of the request's `places`; one whose `kind` isn't null takes only that kind.

    Every place is an equality join of its own; requests without a hit are left out. A request is told from another by all its columns.
    """
    own = requests.columns
    found = entities.withColumnsRenamed({"kind": "_kind", place: "_place"})
    hits = [requests.join(found.withColumnRenamed("_place", p), [*keys, p]) for p in places]
    every = reduce(DataFrame.unionByName, [h.filter(F.col("kind").isNull() | (F.col("kind") == F.col("_kind"))) for h in hits])
    first = every.groupBy(*own).agg(F.min(F.struct(*order)).alias("_x"))
    return first.select(*own, "_x.*")
