"""Sinks: immutable snapshots, one file for each key, reports, merges and change inventories."""

from __future__ import annotations

import json

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import paths


def report_json(df: DataFrame, path: str) -> dict:
    """A one-row report as an indented JSON file with a trailing newline, non-ASCII kept; returns it."""
    row = df.limit(2).toJSON().collect()
    if len(row) != 1:
        raise ValueError(f"a report has one row, this has {len(row)}")
    report = json.loads(row[0])
    paths.write_text(df.sparkSession, path, json.dumps(report, ensure_ascii=False, indent=2) + "\n")
    return report


def by_key(df: DataFrame, path: str, key: str) -> DataFrame:
    """One folder for each key; returns the index (key, rows)."""
    df.write.mode("errorifexists").partitionBy(key).json(path)
    return df.groupBy(key).agg(F.count("*").alias("rows"))


def snapshot(df: DataFrame, path: str) -> None:
    """An immutable snapshot: an existing path is never overwritten."""
    df.write.mode("errorifexists").parquet(path)


def compact(df: DataFrame, *columns: str) -> DataFrame:
    """The promotable projection of a full report."""
    return df.select(*columns)


def or_failure(make, path: str, as_of: str) -> bool:
    """Write what `make()` returns; if the source fails, write a one-row failure record beside it instead. True if it went well.

    Failures are the engine's errors, values out of place and I/O errors; a mistake in the program itself is raised.
    """
    try:
        make().write.mode("errorifexists").json(path)
    except (PySparkException, Py4JError, OSError, ValueError, ArithmeticError) as e:
        record = {"as_of": as_of, "status": "SOURCE_DRIFT", "error": str(e)[:500]}
        paths.write_text(SparkSession.active(), f"{path}.failure.json", json.dumps(record, indent=2) + "\n")
        return False
    return True


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small result as a Markdown table; one of more than `most` rows is refused, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a Markdown table has at most {most} rows")
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return f"# {title}\n\n{head}\n" + "".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |\n" for r in rows)


def merge(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; where both have one, the new values that aren't null win."""
    columns = [c for c in old.columns if c != key]
    fresh = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns if c in new.columns])
    picked = [F.coalesce(f"_new_{c}", c).alias(c) if c in new.columns else F.col(c) for c in columns]
    return old.join(fresh, key, "full_outer").select(key, *picked)


def inventory_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files of two inventories (file, bytes, modified) that were added, removed or changed."""
    b = after.select("file", F.struct("bytes", "modified").alias("b"))
    both = before.select("file", F.struct("bytes", "modified").alias("a")).join(b, "file", "full_outer")
    change = F.when(F.col("a").isNull(), "ADDED").when(F.col("b").isNull(), "REMOVED").when(~F.col("a").eqNullSafe(F.col("b")), "CHANGED")
    return both.select("file", change.alias("change")).filter("change is not null")


def append_evidence(df: DataFrame, column: str, record: Column) -> DataFrame:
    """The same rows with one more record at the end of a nested list."""
    return df.withColumn(column, F.concat(F.coalesce(F.col(column), F.array()), F.array(record)))
