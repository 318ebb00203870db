"""Mixing overlapping sources to target weights by minimum-cost flow.

Documents are aggregated by membership pattern (the set of sources a document belongs to). A small network then routes each
pattern's words to the quotas of its sources: the first use of a word is free, each further one dearer, so words are repeated
only where a quota cannot be met otherwise. What a pattern gives is then taken from its documents in a seeded order.

The order of a pattern's documents is never gathered in one place: the seeded hash deals them into SLICES slices, whose sums
give every slice its start; only within a slice are documents sorted. The driver holds one row for each pattern.

Edge cases: a null text has size 0 and takes nothing; a null source is a source of its own, last in order; repeated rows are documents
of their own; an empty table gives an empty result. Reruns give the same rows, whatever the partitioning.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.flow import Network
from .common import cut

WORD = r"[^\x20\x09-\x0D]+"
SLICES = 4096
WEIGHTS = (3, 1, 2)


def word_count(text: str | Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Each source's target: its weighted share of `share` times all sizes, at most `most` times its own size.

    Sources stand in code point order, null last, and take the weights in turn. What is above a limit goes to the others by weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, fixed, rest = list(names), {}, share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        part = {s: rest * weight[s] / total for s in open_}
        above = [s for s in open_ if part[s] > most * sizes[s]]
        if not above:
            return fixed | part
        for s in above:
            fixed[s] = most * sizes[s]
            rest -= fixed[s]
        open_ = [s for s in open_ if s not in fixed]
    return fixed


def route(patterns: dict[str, int], quotas: dict[str | None, float], repeats: int = 2) -> list[tuple[str, int, str | None, int]]:
    """(pattern, pass, source, words) of least repetition cost; a pattern is a JSON list of sources."""
    net = Network()
    uses, gives = {}, {}
    for pattern in sorted(patterns):
        for k in range(repeats):
            uses[pattern, k] = net.edge("all", ("pattern", pattern), patterns[pattern], k * k)
        for source in json.loads(pattern):
            gives[pattern, source] = net.edge(("pattern", pattern), ("source", source), repeats * patterns[pattern])
    for source in quotas:
        net.edge(("source", source), "mix", round(quotas[source]))
    net.solve("all", "mix")
    rows = []
    for pattern in sorted(patterns):
        room = [net.flow(uses[pattern, k]) for k in range(repeats)]
        for source in json.loads(pattern):
            left = net.flow(gives[pattern, source])
            for k in range(repeats):
                part = min(left, room[k])
                left, room[k] = left - part, room[k] - part
                rows.append((pattern, k, source, part))
    return rows


def mix(docs: DataFrame, sources: Column, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2, seed: int = 17) -> DataFrame:
    """doc_id, pattern, size, passes (how often the document is taken), taken, source_size and target (of its first source).

    `sources` is an array column: the sources that a document belongs to.
    """
    spark = docs.sparkSession
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.to_json(F.sort_array(F.array_distinct(sources), asc=True)).alias("pattern"),
        word_count("text").alias("size"),
    )
    slim = slim.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "pattern", "size"))
    slim = cut(slim.withColumn("slice", F.pmod("h", F.lit(SLICES)).cast("int")))
    by_slice = slim.groupBy("pattern", "slice").agg(F.sum("size").alias("words"))
    patterns = {r["pattern"]: r["words"] for r in by_slice.groupBy("pattern").agg(F.sum("words").alias("words")).collect()}
    sizes: dict[str | None, int] = {}
    for pattern, words in patterns.items():
        for source in json.loads(pattern):
            sizes[source] = sizes.get(source, 0) + words
    quotas = targets(sizes, weights, share, float(repeats))
    given: dict[tuple[str, int], int] = {}
    for pattern, k, _, words in route(patterns, quotas, repeats):
        given[pattern, k] = given.get((pattern, k), 0) + words
    plan = [(p, [int(given.get((p, k), 0)) for k in range(repeats)], int(sizes[json.loads(p)[0]]), float(quotas[json.loads(p)[0]])) for p in sorted(patterns) if json.loads(p)]
    plan_rows = spark.createDataFrame(plan, "pattern string, room array<long>, source_size long, target double")
    upto = Window.partitionBy("pattern").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_slice.withColumn("base", F.coalesce(F.sum("words").over(upto), F.lit(0).cast("long"))).drop("words")
    within = Window.partitionBy("pattern", "slice").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = slim.withColumn("through", F.sum("size").over(within)).join(starts, ["pattern", "slice"]).join(plan_rows, "pattern")
    middle = F.col("base") + F.col("through") - F.col("size") / 2
    passes = F.size(F.filter("room", lambda room: middle < room)).cast("long")
    return placed.select("doc_id", "pattern", "size", "source_size", "target", passes.alias("passes"), (passes * F.col("size")).alias("taken"))
