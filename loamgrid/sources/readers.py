"""Sources: documents, pipe tables, page corpora, catalogues and pointers, always with declared schemas."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files
from .anchors import page_links  # noqa: F401

CORRUPT = "_corrupt_record"


def json_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One nested document for each file; a file that doesn't fit fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_directory(spark: SparkSession, glob: str, schema: T.StructType | str) -> DataFrame:
    """All documents that parse, with their file; others are left out."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(glob).withColumn("file", F.col("_metadata.file_path"))


def json_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Files under a folder that are no JSON; an empty one is none either."""
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder)
    broken = every.filter(F.try_parse_json(F.decode("content", "UTF-8")).isNull()).select(F.col("path").alias("file"))
    empty = files.names(spark, folder).filter((F.col("bytes") == 0) & F.col("file").endswith(".json"))
    return broken.union(empty.select("file"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def clean_strings(df: DataFrame) -> DataFrame:
    """Headers trimmed and lower-cased, unnamed trailing columns dropped, cells trimmed, rows without any content dropped."""
    names = [n.strip().lstrip("﻿").lower() for n in df.columns]
    keep = [(c, n) for c, n in zip(df.columns, names, strict=True) if n and not n.startswith("_c")]
    df = df.select(*[F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).alias(n) for c, n in keep])
    return df.filter(reduce(lambda a, b: a | b, [F.col(f"`{n}`") != "" for _, n in keep]))


def pipe_table(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """A pipe-delimited table of strings; missing headers fail."""
    df = clean_strings(spark.read.option("sep", "|").option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("quote", '"').option("escape", '"').csv(path))
    require_headers(df, required)
    return df


def missing_headers(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted({r.lower() for r in required} - {c.lower() for c in df.columns})


def require_headers(df: DataFrame, required: Iterable[str]) -> None:
    if missing := missing_headers(df, required):
        raise ValueError(f"missing headers: {', '.join(missing)}")


def volume_guard(df: DataFrame, **least: Column) -> DataFrame:
    """One row: each named aggregate condition, and whether all hold."""
    row = df.agg(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in least.items()])
    return row.withColumn("ok", reduce(lambda a, b: a & b, [F.col(n) for n in least]))


def with_retry(fetch: Callable[[], bytes], attempts: int = 4, most: int | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """What a driver-side fetch returns; waits 1, 2, 4 ... seconds between attempts; more than `most` bytes fail."""
    for n in range(attempts):
        try:
            body = fetch()
        except OSError:
            if n + 1 == attempts:
                raise
            sleep(2**n)
            continue
        if most is not None and len(body) > most:
            raise ValueError(f"more than {most} bytes")
        return body
    raise ValueError("no attempts")


def file_inventory(spark: SparkSession, path: str, magic: bytes | None = None, most: int | None = None) -> DataFrame:
    """file, bytes, modified, sha256, whether the content starts with `magic`, and what went wrong; files are streamed."""
    return files.digests(spark, path, magic or b"", most)


def yaml_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A YAML file as one row; dates become ISO strings. Needs the yaml package."""
    import datetime

    import yaml

    def plain(x):
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return x.isoformat() if isinstance(x, datetime.date | datetime.datetime) else x

    return spark.createDataFrame([plain(yaml.safe_load(Path(path).read_text(encoding="utf-8")))], schema)


def page_corpus(docs: DataFrame, lines_per_page: int = 4, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, page (from 1) and text: runs of so many lines."""
    lines = F.split(text, "\n")
    pages = F.transform(F.sequence(F.lit(0), F.size(lines) - 1, F.lit(lines_per_page)), lambda i: F.array_join(F.slice(lines, i + 1, lines_per_page), "\n"))
    return docs.filter(F.col(text).isNotNull()).select(F.col(doc).alias("doc_id"), F.posexplode(pages).alias("page", "text")).withColumn("page", F.col("page") + 1)


def plain_links(pages: DataFrame) -> DataFrame:
    """page_id, text and href of well-formed anchors without markup inside, without leaving generated code."""
    hits = F.explode(F.regexp_extract_all("html", F.lit(r'(<a href="[^"]*">[^<]*</a>)'), F.lit(1)))
    one = pages.select("page_id", hits.alias("a"))
    return one.select("page_id", F.regexp_extract("a", '>([^<]*)</a>', 1).alias("text"), F.regexp_extract("a", 'href="([^"]*)"', 1).alias("href"))


def link_map(links: DataFrame, norm: Callable[[str], Column], text: str = "text", url: str = "url") -> DataFrame:
    """Normalised anchor text and its distinct addresses in order."""
    return links.groupBy(norm(text).alias("name")).agg(F.sort_array(F.collect_set(url)).alias("urls"))


def current_snapshot(df: DataFrame, pointer: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows of the snapshot that the one-row pointer names."""
    return df.join(F.broadcast(pointer.select(column).limit(1)), column, "left_semi")


def source_list(sources: DataFrame, kind: str, edition: str, core: str) -> DataFrame:
    """Sources of one kind and edition, the core one first, then by title."""
    return sources.filter((F.col("type") == kind) & (F.col("edition") == edition)).orderBy(F.when(F.col("title") == core, 0).otherwise(1), "title")


def jdbc_counts(spark: SparkSession, url: str, tables: list[str], **options: str) -> DataFrame:
    """Row counts of tables behind JDBC."""
    parts = [spark.read.format("jdbc").options(url=url, query=f"SELECT COUNT(*) AS n FROM {t}", **options).load().select(F.lit(t).alias("table"), "n") for t in tables]
    return reduce(DataFrame.unionByName, parts)
