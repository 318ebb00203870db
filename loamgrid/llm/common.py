"""Shared parts of the text operators: Arrow batches, byte-level words, hashes, ordered neighbours, components.

Texts are handled as UTF-8 bytes in numpy. A word is a maximal run of bytes outside 0x20 and 0x09-0x0D,
so every byte of a multi-byte character belongs to a word. A null text counts as empty.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, shared_dir, ship  # noqa: F401  cut and shared_dir are for the operators

#: Bytes of text that a worker handles in one numpy step. A single longer text makes a step of its own.
CHUNK_BYTES = 1 << 18
CHUNK_ROWS = 512

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
PLACE = _rng.integers(1, 1 << 63, 64, dtype=U64) * U64(2) + U64(1)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Bound what one Arrow batch holds, so that a worker's memory doesn't follow the longest texts; send the package along.

    A smaller bound that the session has already stays: plans run later than they are made, under the setting of that time, and results don't
    depend on it.
    """
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for a fifth of the ids: crc32 of the id as text is divisible by 5 (null: false)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 5 == 0, F.lit(False))


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text", done: Callable[[], None] | None = None, limit: int = CHUNK_BYTES) -> DataFrame:
    """mapInArrow with a step that sees at most `limit` bytes of text at a time. `done` is called when a task ends: workers are used again, and what they keep stays in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in chunks(batch, text, limit):
                    out = step(part)
                    if out is not None and out.num_rows:
                        yield out
        finally:
            if done:
                done()

    return df.mapInArrow(run, schema)


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about `limit` bytes of text each."""
    if not batch.num_rows:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64)
    ends, start = np.cumsum(size), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = min(max(int(np.searchsorted(ends, base + limit, "right")), start + 1), start + rows)
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets into them; nulls are empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for document i its words [bounds[i], bounds[i+1]). Words never cross documents."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = IS_WORD[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class _Powers:
    """BASE**i and BASE**-i modulo 2**64, grown when a longer text comes."""

    up = down = np.ones(1, U64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 4096)
            cls.up = np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(size - 1, BASE, U64)]))
            cls.down = np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(size - 1, BASE_INVERSE, U64)]))
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the finalizer of splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes have equal hashes wherever they stand."""
    up, down = _Powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * PLACE[63])


def shingles(word_hash: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of k words (a shorter text: all its words as one), and the document of each."""
    counts = np.diff(bounds)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(counts)), made)
    first = np.repeat(bounds[:-1], made) + np.arange(len(doc)) - np.repeat(np.cumsum(made) - made, made)
    padded = np.concatenate([word_hash, np.zeros(k, U64)])
    total = np.zeros(len(doc), U64)
    length = np.minimum(counts, k)[doc] if len(doc) else np.zeros(0, np.int64)
    for j in range(k):
        total += np.where(length > j, padded[first + j] * PLACE[j], U64(0))
    return mix(total + length.astype(U64) * PLACE[62]), doc


def text_shingles(column: pa.Array, k: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    if lower:
        data = ASCII_LOWER[data]
    starts, ends, bounds = words(data, offsets)
    return shingles(range_hashes(data, starts, ends), bounds, k)


def distinct_pairs(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, value), ordered by both."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    if not len(doc):
        return doc, value
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def constant(values: list, kind: str) -> Column:
    """An array constant. As JSON it is one literal in the plan, folded once, however long it is."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def bucket_of(key: Column, firsts: list, kind: str) -> Column:
    """How many of the ascending `firsts` are at or below the key, less one (at least 0), by two short array scans."""
    if len(firsts) <= 1:
        return F.lit(0)
    width = max(2, int(len(firsts) ** 0.5))
    groups = [firsts[i : i + width] for i in range(0, len(firsts), width)]
    coarse, fine = constant([g[0] for g in groups], f"array<{kind}>"), constant(groups, f"array<array<{kind}>>")
    at = F.greatest(F.size(F.filter(coarse, lambda x: x <= key)), F.lit(1))
    return (at - 1) * width + F.greatest(F.size(F.filter(F.element_at(fine, at), lambda x: x <= key)), F.lit(1)) - 1


def ordered(df: DataFrame, key: str, ties: list[str], ring: bool, both: bool = False) -> DataFrame:
    """Rows dealt into runs of consecutive keys, each with the rows that stand next to its ends.

    Adds `_run` (int) and `_guest` (0 own row, 1 first row of the next run, -1 last key of the run before, if `both`);
    a partition holds whole runs, sorted by _run, _guest (-1 first, 1 last), key and ties. With `ring` the first run follows the last.
    The driver gets one key for every run and end, whatever the number of rows. Null keys must be filled before.
    """
    spark = df.sparkSession
    n = 3 * partitions(spark)
    runs = df.select(key).repartitionByRange(n, key).groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    found = sorted((r["lo"], r["hi"]) for r in runs.collect())
    firsts, lasts = [x[0] for x in found], [x[1] for x in found]
    if not found:
        return df.withColumns({"_run": F.lit(0), "_guest": F.lit(0)})
    last = len(firsts) - 1
    here = F.col("_run")
    kind = dict(df.dtypes)[key]
    tagged = df.withColumn("_run", bucket_of(F.col(key), firsts, kind))
    array = lambda values: constant(values, f"array<{kind}>")
    copies = [F.struct(here.alias("r"), F.lit(0).alias("g"))]
    is_first = F.col(key) == F.element_at(array(firsts), here + 1)
    before = F.when(here > 0, here - 1).otherwise(F.lit(last)) if ring else here - 1
    copies.append(F.when(is_first & (F.lit(ring) | (here > 0)), F.struct(before.alias("r"), F.lit(1).alias("g"))))
    if both:
        is_last = F.col(key) == F.element_at(array(lasts), here + 1)
        copies.append(F.when(is_last & (here < last), F.struct((here + 1).alias("r"), F.lit(-1).alias("g"))))
    spread = tagged.withColumn("_c", F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull())))
    spread = spread.withColumns({"_run": F.col("_c.r"), "_guest": F.col("_c.g")}).drop("_c")
    return spread.repartition(partitions(spark), "_run").sortWithinPartitions("_run", "_guest", key, *ties)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected edge table (a, b): component is the smallest reachable node. A node without an edge to another is left out.

    Alternates the large-star and small-star contractions, which keep every node's degree bounded by the edges it
    already has, until nothing changes (after `rounds` rounds that is an error); each round is cut in the shared folder. No node's neighbours are gathered
    in one row: both steps are grouped minima and joins.
    """
    current = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    seen = None
    for _ in range(rounds):
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = cut(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        current = cut(small)
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components: edges still changed in round {rounds}")
    found = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return found.union(found.select("component", "component").distinct())
