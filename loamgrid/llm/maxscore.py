"""Exact top-k by inner product with MaxScore over dimension postings.

Every dimension is a term; its postings are the dimension's values in a shard of vectors, its bounds for a query are the largest and the
smallest product it can add there. For one query the terms are ordered by how far these lie apart. The essential ones are summed
for all vectors of the shard; once the bounds of the rest (the non-essential ones) cannot lift a vector over the current k-th score,
only the vectors that are still competitive are probed in the remaining terms, in blocks. The shards' best are merged. All shards start
from a floor that a query block finds among its own queries, which are candidates too.

Arithmetic is exact: doubles while a bound on every sum lies below 2**53, else long integers, else Python's. A score that doesn't fit a long
is an error, as is a component from 2**63 / 256 on.

Queries are a stated set and meet all vectors block by block: vectors are packed into shards, queries into blocks of BLOCK, blocks stand in
lanes of LANE, and each pair of a shard and a block is one row of a merge join on (way, lane, length), which spills and broadcasts neither side.

Edge cases: vectors that are null or empty or hold null or non-finite components take no part; a query meets only vectors of its own
length; ties go to the smaller id; fewer than k other vectors give fewer rows; equal vectors and rows that repeat an id are candidates of each other. Every
query row has a ranking of its own, also where ids repeat. The search takes the k + 1 best of all rows and then leaves one out that is the query
as its result shows it (its id and its score with itself): whichever of several such rows goes, the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, small_batches

SHARD, BLOCK, LANE, STEP = 8192, 1024, 64, 8
FOUND = "query long, query_id long, vec_id long, score long, own boolean"
LONG = 1 << 63
#: Stands for a query's score with itself where no long holds it.
BEYOND = LONG - 1


def grid(vectors: DataFrame) -> DataFrame:
    """vec_id and floor(256 * x) of every component, of the vectors that take part."""
    whole = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    big = F.raise_error(F.lit("a component is too large for a long integer"))
    step = lambda x: F.when((x >= float(LONG)) | (x < -float(LONG)), big).otherwise(F.floor(x).cast("long"))
    steps = F.transform("embedding", lambda x: step(x.cast("double") * 256))
    return vectors.filter(whole & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), steps.alias("v"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into blobs of `size` vectors, the last ones of a partition fewer: dims, ids, values (int64, one vector after the other)."""

    def blob(dims: int, parts: list) -> pa.RecordBatch:
        ids, values = (b"".join(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([ids], pa.binary()), pa.array([values], pa.binary())], ["dims", "ids", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list] = {}
        held: dict[int, int] = {}
        for batch in batches:
            lists = batch.column("v")
            lengths = np.diff(np.asarray(lists.offsets))
            ids = np.asarray(batch.column("vec_id"))
            for dims in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dims)
                while len(own):
                    room = size - held.get(dims, 0)
                    part, own = own[:room], own[room:]
                    values = np.asarray(lists.take(pa.array(part)).flatten())
                    open_.setdefault(dims, []).append((ids[part].astype(np.int64).tobytes(), values.astype(np.int64).tobytes()))
                    held[dims] = held.get(dims, 0) + len(part)
                    if held[dims] == size:
                        yield blob(dims, open_.pop(dims))
                        del held[dims]
        for dims, parts in open_.items():
            yield blob(dims, parts)

    return rows.mapInArrow(run, "dims int, ids binary, values binary")


def _largest(rows: np.ndarray) -> list[int]:
    """The largest absolute value of every column, as Python integers."""
    return [max(abs(int(a)), abs(int(b))) for a, b in zip(rows.min(axis=0), rows.max(axis=0), strict=True)]


def kind_for(vectors: np.ndarray, queries: np.ndarray) -> type:
    """Numbers in which no sum of products of these rows loses anything, with room for the bounds."""
    most = sum(a * b for a, b in zip(_largest(vectors), _largest(queries), strict=True))
    return np.float64 if 4 * most < 1 << 53 else np.int64 if 4 * most < LONG else object


def first_floors(queries: np.ndarray, k: int) -> list[int | None]:
    """For each query of a block the k-th best score among the block's vectors: no worse vector is among its k best."""
    kind = kind_for(queries, queries)
    own = queries.astype(kind)
    return [int(np.sort(own @ query)[-k]) if len(own) >= k else None for query in own]


def search(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: list[int | None] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, vector, score, whether it is the query's own) of the k best of one shard for every query, less those below the query's floor. `matrix` is dimension by vector: its rows are the postings."""
    kind = kind_for(matrix.T, queries)
    low, high = matrix.min(axis=1).astype(kind), matrix.max(axis=1).astype(kind)
    dims, n = matrix.shape
    postings = matrix.astype(kind)
    zero = np.zeros(1, kind)
    found = []
    for at, (query_id, query, given) in enumerate(zip(query_ids, queries.astype(kind), floors or [None] * len(queries), strict=True)):
        top, bottom = np.maximum(query * low, query * high), np.minimum(query * low, query * high)
        order = np.argsort(bottom - top, kind="stable")
        rest, sure = (np.concatenate([np.cumsum(x[order][::-1])[::-1], zero]) for x in (top, bottom))
        if given is not None and given > int(rest[0]):
            continue  # the whole shard is below the floor
        weights = query[order]
        alive, score = np.arange(n), None
        floor = int(sure[0]) if given is None else max(given, int(sure[0]))
        for a in range(0, dims, STEP):
            b = min(a + STEP, dims)
            terms = order[a:b]
            if score is None:  # essential terms: all postings
                part = weights[a:b] @ postings[terms] if a == 0 else part + weights[a:b] @ postings[terms]
                here = part[alive]
            else:  # the others are probed where a vector is still competitive
                here = score = score + weights[a:b] @ postings[np.ix_(terms, alive)]
            if len(alive) > k:
                # k vectors reach at least this score in the end: the k-th partial score and the least the rest can add
                floor = max(floor, int(np.partition(here, len(here) - k)[len(here) - k] + sure[b]))
            keep = here + rest[b] >= floor
            if score is not None or b == dims or 2 * keep.sum() < n:
                alive, score = alive[keep], here[keep]
        best = np.lexsort((ids[alive], -score))[:k]
        vector, result = ids[alive[best]], score[best]
        own = (vector == query_id) & (result == sum(int(x) * int(x) for x in query) if kind is object else result == query @ query)
        if kind is object:
            if any(not -LONG <= x < LONG for x in result[~own].tolist()):
                raise OverflowError("a score is too large for a long integer")
            result = np.array([min(x, BEYOND) for x in result.tolist()], np.int64)
        found.append((np.full(len(best), at), vector, result.astype(np.int64), own))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate([x[i] for x in found]) for i in range(4))


def with_floors(blocks: DataFrame, k: int) -> DataFrame:
    """Query blocks (dims, ids, values) with a number for their first query and their first floors as text, empty where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            made, numbers = [], []
            for dims, values in zip(*(batch.column(c) for c in ("dims", "values")), strict=True):
                rows = np.frombuffer(values.as_buffer(), np.int64).reshape(-1, dims.as_py())
                made.append(",".join("" if x is None else str(x) for x in first_floors(rows, k)))
                numbers.append(number)
                number += len(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string()), pa.array(numbers, pa.int64())], ["q_dims", "q_ids", "q_values", "q_floors", "q_first"])

    return blocks.select("dims", "ids", "values").mapInArrow(run, "q_dims int, q_ids binary, q_values binary, q_floors string, q_first long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for every query row its k best among all other rows."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = grid(vectors)
    ways = partitions(spark)
    queries = rows.filter(is_query)
    blocks = max(1, -(-queries.count() // BLOCK))
    lanes = -(-blocks // LANE)
    shards = packed(rows, SHARD).withColumn("way", F.pmod(F.xxhash64("ids"), F.lit(ways)))
    shards = shards.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    # ordered to the last component: a query's number is the same whenever its block is made again
    queries = with_floors(packed(queries.sortWithinPartitions("block", "vec_id", "v").select("vec_id", "v"), BLOCK), k + 1)
    queries = queries.withColumn("q_lane", F.pmod(F.xxhash64("q_ids"), F.lit(lanes)).cast("int")).withColumn("q_way", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ways - 1).cast("long"))))
    on = (F.col("way") == F.col("q_way")) & (F.col("lane") == F.col("q_lane")) & (F.col("dims") == F.col("q_dims"))
    pairs = shards.hint("merge").join(queries, on).select("dims", "ids", "values", "q_ids", "q_values", "q_floors", "q_first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dims = batch.column("dims")[i].as_py()
                ids, q_ids = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("ids", "q_ids"))
                values, q_values = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64).reshape(-1, dims) for c in ("values", "q_values"))
                floors = [int(x) if x else None for x in batch.column("q_floors")[i].as_py().split(",")]
                at, v, score, own = search(ids, np.ascontiguousarray(values.T), q_ids, q_values, k + 1, floors)
                number = batch.column("q_first")[i].as_py() + at
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(q_ids[at], pa.int64()), pa.array(v, pa.int64()), pa.array(score, pa.int64()), pa.array(own, pa.bool_())], [c.split()[0] for c in FOUND.split(", ")])

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    best = pairs.mapInArrow(run, FOUND).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    others = best.withColumn("owns", F.count_if("own").over(upto)).filter(~(F.col("own") & (F.col("owns") == 1)))
    ranked = others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    score = F.when(F.col("own") & (F.col("score") == BEYOND), F.raise_error(F.lit("a score is too large for a long integer"))).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
