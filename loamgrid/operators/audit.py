"""Gap audits of coverage maps in one pass: gap rows are written while dimension counts and conjunctions are observed on the way."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources import paths


def gap_rows(rows: DataFrame, key: str, coverage: str, dimensions: list[str]) -> DataFrame:
    """(key, dimension, covered, state) of every dimension that isn't at 100: OPEN at 0 or where the map has none, else PARTIAL."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.try_element_at(F.col(coverage), F.lit(d)), F.lit(0)).alias("covered")) for d in dimensions])
    open_ = rows.select(key, F.explode(F.filter(pairs, lambda p: p["covered"] != 100)).alias("g")).select(key, "g.*")
    return open_.withColumn("state", F.when(F.col("covered") == 0, "OPEN").otherwise("PARTIAL"))


class Audit:
    """What a pass found: rows, (complete, missing) by dimension, whether each conjunction holds, and the gap rows as written."""

    def __init__(self, gaps: DataFrame, rows: int, dimensions: dict[str, tuple[int, int]], passed: dict[str, bool]):
        self.gaps, self.rows, self.dimensions, self.passed = gaps, rows, dimensions, passed

    def layers(self) -> dict[str, str]:
        """CLOSED, or PENDING where the conjunction of a layer doesn't hold."""
        return {n: "CLOSED" if ok else "PENDING" for n, ok in self.passed.items()}

    def next_milestone(self, milestones: dict[str, str], default: str) -> str:
        """The milestone of the first layer, in order, that is pending."""
        return next((m for n, m in milestones.items() if not self.passed.get(n, False)), default)

    def report(self) -> DataFrame:
        """(section, subject, dimension, state, n): gaps, dimension counts and conjunctions together."""
        spark = self.gaps.sparkSession
        key = self.gaps.columns[0]
        rows = self.gaps.select(F.lit("gap").alias("section"), F.col(key).cast("string").alias("subject"), "dimension", "state", F.col("covered").cast("long").alias("n"))
        facts = [("dimension", "", d, s, n) for d, (full, none) in self.dimensions.items() for s, n in (("COMPLETE", full), ("MISSING", none))] + [("layer", n, "", s, self.rows) for n, s in self.layers().items()]
        return rows.unionAll(spark.createDataFrame(facts, rows.schema))


def gap_audit(rows: DataFrame, key: str, coverage: str, dimensions: list[str], conditions: dict[str, Column], path: str) -> Audit:
    """Writes the gap rows to `path` and, in the same scan, counts each dimension's rows at 100 and at 0 (or missing) and takes each condition over all rows.

    A condition that is null for a row doesn't hold; over an empty table every conjunction holds.
    """
    seen = Observation()
    at = lambda d: F.coalesce(F.try_element_at(F.col(coverage), F.lit(d)), F.lit(0))
    counts = [c for i, d in enumerate(dimensions) for c in (F.count_if(at(d) == 100).alias(f"full{i}"), F.count_if(at(d) == 0).alias(f"none{i}"))]
    holds = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"bad{i}") for i, c in enumerate(conditions.values())]
    observed = rows.observe(seen, F.count("*").alias("rows"), *counts, *holds)
    gap_rows(observed, key, coverage, dimensions).write.mode("errorifexists").parquet(path)
    got = seen.get
    found = {d: (got[f"full{i}"], got[f"none{i}"]) for i, d in enumerate(dimensions)}
    return Audit(rows.sparkSession.read.parquet(path), got["rows"], found, {n: got[f"bad{i}"] == 0 for i, n in enumerate(conditions)})


def structural_promotion(rows: DataFrame, coverage: str, complete: Column, dimensions: list[str], want: tuple[int, int]) -> DataFrame:
    """Sets the dimensions to 100 for complete rows and to 0 for others, if just want[0] rows are complete and want[1] aren't; else reading fails."""
    from .records import set_dimensions

    ok = F.coalesce(complete, F.lit(False))
    n = rows.agg(F.count_if(ok).alias("a"), F.count_if(~ok).alias("b"))
    gate = n.select(F.when((F.col("a") == want[0]) & (F.col("b") == want[1]), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("complete="), "a", F.lit(" incomplete="), "b"))).alias("_ok"))
    return set_dimensions(rows, coverage, ok, dimensions).join(F.broadcast(gate), F.col("_ok")).drop("_ok")


def as_json(audit: Audit, path: str) -> None:
    """The counts and conjunctions as one indented document."""
    document = {"rows": audit.rows, "dimensions": {d: {"complete": a, "missing": b} for d, (a, b) in audit.dimensions.items()}, "layers": audit.layers()}
    paths.write_text(audit.gaps.sparkSession, path, json.dumps(document, ensure_ascii=False, indent=2) + "\n")
