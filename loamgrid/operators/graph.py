"""Nested documents of unknown depth and catalogue links."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import nested


def walk_json(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, name, kind, value) of every scalar in a JSON text of any depth; text that is no JSON gives nothing."""
    return nested.scalars(df, key, column)


def typed_path(column: str, path: str, kind: str) -> Column:
    """A scalar at a path of dynamic JSON, without leaving the JVM."""
    return F.try_variant_get(F.try_parse_json(F.col(column)), path, kind)


def linked_entries(links: DataFrame, entries: DataFrame) -> DataFrame:
    """Links (catalog, link_id, target_id) with the entry they point to, in their own catalogue or an imported one."""
    return links.join(entries.select(F.col("id").alias("target_id"), F.col("catalog").alias("entry_catalog"), "name"), "target_id")


def costs_of(links: DataFrame, entries: DataFrame, name: str) -> DataFrame:
    """The cost of a named entry in each catalogue if it is unique there, over direct and linked entries."""
    direct = entries.filter(F.col("name") == name).select("catalog", "cost")
    through = links.join(entries.filter(F.col("name") == name).select(F.col("id").alias("target_id"), "cost"), "target_id").select("catalog", "cost")
    by = direct.union(through).groupBy("catalog").agg(F.collect_set("cost").alias("costs"))
    return by.select("catalog", F.when(F.size("costs") == 1, F.col("costs")[0]).alias("cost"), F.size("costs").alias("different"))


def flatten_outline(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, ordinal, depth, title, page) of nested outlines given as JSON lists of [title, page, children], depth first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, text in zip(pdf[key], pdf[column], strict=True):
                stack, n = [(0, x) for x in reversed(json.loads(text or "[]"))], 0
                while stack:
                    depth, (title, page, children) = stack.pop()
                    rows.append((k, n, depth, title, page))
                    n += 1
                    stack += [(depth + 1, c) for c in reversed(children)]
            yield pd.DataFrame(rows, columns=[key, "ordinal", "depth", "title", "page"])

    return df.select(key, column).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, ordinal int, depth int, title string, page int")
