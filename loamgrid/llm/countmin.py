"""Substring dedup over words with a count-min prefilter.

A window is WINDOW words in a row. What counts is how many ids have it: windows of one id alone remove nothing.
1. Chunks of documents add each of their windows once an id to their own sketch, DEPTH rows of counters that stop at two; the sketch is split into shards by
   the window's hash and each chunk sends a shard the counters it touched. Shards add up and answer which of them reached two. A counter is never below the count of
   a window in it, so a window whose counters aren't all at two stands in one id only.
2. Chunks send the 128-bit BLAKE2 digests of the windows left, with the smallest id they have for each, to buckets; buckets find the smallest id of all.
   The digest is of the words joined by one space: equal words have equal digests, and no two different texts with one digest are known.
3. Chunks remove the words covered by windows that a smaller id has.
Shards and buckets are of about a fixed size, so their number follows the words; sketches never get denser. A window that every document has is one counter and one digest for each
chunk. Equal rows are counted before the shuffle. Texts move once: the steps read the same exchange.

Edge cases: a null text has no words; texts under WINDOW words are untouched; ids that repeat don't count as smaller than each other; rows with a null id are untouched and
remove nothing elsewhere; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, _Powers, mix, partitions, range_hashes, small_batches, utf8, words

WINDOW, DEPTH = 50, 2
#: Counters of a shard's row, by bits; a shard gets the windows of about SHARD_TEXT bytes, a sixth of its counters.
ROW_BITS = 23
CHUNK_TEXT, SHARD_TEXT = 4 << 20, 8 << 20
NO_ID = np.iinfo(np.int64).min
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def spread(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def gaps(slots: np.ndarray) -> np.ndarray:
    """Ascending numbers as 16-bit steps; 65535 steps on without a number."""
    step = np.diff(slots, prepend=0)
    far = step // 65535
    out = np.full(len(step) + int(far.sum()), 65535, np.uint16)
    out[np.cumsum(far + 1) - 1] = step % 65535
    return out


def slots_of(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int64)[steps != 65535]


class Chunk:
    """The documents of a chunk by id and text, their words, and the windows of rows that have an id."""

    def __init__(self, table: pa.Table, window: int):
        pa.default_memory_pool().release_unused()  # what the groups before have left
        rows = table.combine_chunks()
        ids = rows.column("doc_id").combine_chunks()
        id_of, null = np.asarray(ids.fill_null(NO_ID)).astype(np.int64), np.asarray(ids.is_null())
        order = np.lexsort((np.asarray(rows.column("order")), null, id_of))
        rows = rows.take(pa.array(order))
        self.ids, self.null, self.copies = id_of[order], null[order], np.asarray(rows.column("copies")).astype(np.int64)
        self.data, offsets = utf8(rows.column("text").combine_chunks())
        self.starts, self.ends, self.bounds = words(self.data, offsets)
        self.window = window
        made = np.where(self.null, 0, np.maximum(np.diff(self.bounds) - window + 1, 0))
        self.doc = np.repeat(np.arange(len(made)), made)
        self.at = np.arange(len(self.doc)) + np.repeat(self.bounds[:-1] - np.cumsum(made) + made, made)

    def hashes(self) -> np.ndarray:
        """Of every window, from its words' hashes; equal words have equal hashes."""
        n = len(self.starts)
        up, down = _Powers.upto(n + 1)
        total = np.zeros(n + 1, U64)
        np.cumsum(range_hashes(self.data, self.starts, self.ends) * up[:n], out=total[1:])
        return mix((total[self.at + self.window] - total[self.at]) * down[self.at])

    def spaced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words, each followed by one space, and their starts and ends there."""
        length = self.ends - self.starts
        end = np.cumsum(length + 1) - 1
        out = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
        if len(end):
            step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            out[step + np.repeat(end - length, length)] = self.data[step + np.repeat(self.starts, length)]
        return out, end - length, end

    def touched(self, h: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """For every shard with windows: their places, and for each row of the sketch the counters touched and whether twice or more by (window, id)."""
        ids = self.ids[self.doc]
        order = np.lexsort((ids, h))
        new = np.ones(len(h), bool)
        new[1:] = (np.diff(h[order]) != 0) | (np.diff(ids[order]) != 0)
        shard = ((h >> U64(40)) % U64(shards)).astype(np.int64)
        fresh = np.zeros(len(h), bool)
        fresh[order[new]] = True  # one place for each id of a window
        by = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.diff(shard[by], prepend=-1))
        for part in np.split(by, edges[1:]) if len(by) else []:
            own = part[fresh[part]]
            rows = [np.unique(counters(h[own], j), return_counts=True) for j in range(DEPTH)]
            yield int(shard[part[0]]), part, [(slots, counts > 1) for slots, counts in rows]


def counters(h: np.ndarray, row: int) -> np.ndarray:
    return (mix(h + U64(row)) >> U64(64 - ROW_BITS)).astype(np.int64)


def added(messages: list[tuple[list[np.ndarray], list[np.ndarray]]]) -> list[list[np.ndarray]]:
    """Sums partial sketches of a shard; for each, whether its counters reached two."""
    answers: list[list[np.ndarray]] = [[] for _ in messages]
    for j in range(DEPTH):
        sketch = np.zeros(1 << ROW_BITS, np.uint8)
        for slots, several in messages:
            sketch[slots[j]] = np.minimum(sketch[slots[j]] + 1 + several[j], 2)  # counters of a message are distinct
        for answer, (slots, _) in zip(answers, messages, strict=True):
            answer.append(sketch[slots[j]] > 1)
    return answers


def digests(chunk: Chunk, place: np.ndarray) -> np.ndarray:
    """(n, 2) numbers: 128 bits of BLAKE2 of each window's words, joined by one space."""
    text, begin, end = chunk.spaced()
    view, at = memoryview(text), chunk.at[place]
    made = b"".join([hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(begin[at].tolist(), end[at + chunk.window - 1].tolist(), strict=True)])
    return np.frombuffer(made, U64).reshape(-1, 2)


def _packed(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(fields)})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch become one with their number."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["doc_id", "text"]).aggregate([([], "count_all")])
        yield from table.select(["doc_id", "text"]).append_column("copies", table.column("count_all").cast(pa.int64())).combine_chunks().to_batches()


SENT = [("chunk", pa.int32()), ("bucket", pa.int32()), ("own", pa.bool_()), ("first", pa.binary()), ("second", pa.binary())]
SENT_SQL = "chunk int, bucket int, own boolean, first binary, second binary"


def removed(docs: DataFrame, schema: str, finish, window: int = WINDOW, chunk_text: int = CHUNK_TEXT, shard_text: int = SHARD_TEXT) -> DataFrame:
    """Rows that `finish(chunk, covered)` makes of every chunk; covered marks the words to remove. docs has doc_id and text."""
    spark = docs.sparkSession
    small_batches(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, shards = (max(partitions(spark), -(-total // size)) for size in (chunk_text, shard_text))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_counted, "doc_id long, text string, copies long")
    rows = rows.withColumn("order", F.xxhash64("text")).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "order"), F.lit(chunks)).cast("int"))

    def number(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    def send_sketches(table: pa.Table) -> pa.Table:
        chunk, out = Chunk(table, window), []
        for shard, _, parts in chunk.touched(chunk.hashes(), shards):
            steps = [gaps(slots) for slots, _ in parts]
            sizes = np.array([len(x) for x in steps], np.int64)
            out.append((number(table), shard, False, squeeze(sizes.tobytes() + b"".join(x.tobytes() for x in steps)), np.packbits(np.concatenate([several for _, several in parts])).tobytes()))
        return _packed(out, SENT)

    def add_up(table: pa.Table) -> pa.Table:
        messages = []
        for first, second in zip(table.column("first").to_pylist(), table.column("second").to_pylist(), strict=True):
            data = spread(first)
            sizes = np.frombuffer(data, np.int64, DEPTH)
            slots = [slots_of(x) for x in np.split(np.frombuffer(data, np.uint16, offset=8 * DEPTH), np.cumsum(sizes)[:-1])]
            several = np.unpackbits(np.frombuffer(second, np.uint8))[: sum(map(len, slots))]
            messages.append((slots, np.split(several, np.cumsum([len(x) for x in slots])[:-1])))
        bucket = table.column("bucket")[0].as_py()
        out = [(c, bucket, False, np.packbits(np.concatenate(x)).tobytes(), None) for c, x in zip(table.column("chunk").to_pylist(), added(messages), strict=True) if any(y.any() for y in x)]
        return _packed(out, SENT)

    def send_repeated(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _packed([], SENT)
        chunk = Chunk(left, window)
        h = chunk.hashes()
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("first").to_pylist(), strict=True))
        likely = np.zeros(len(h), bool)
        for shard, part, parts in chunk.touched(h, shards):
            if shard in answers:
                hit = np.split(np.unpackbits(np.frombuffer(answers[shard], np.uint8)).astype(bool)[: sum(len(s) for s, _ in parts)], np.cumsum([len(s) for s, _ in parts])[:-1])
                likely[part] = np.logical_and.reduce([hit[j][np.searchsorted(parts[j][0], counters(h[part], j))] for j in range(DEPTH)])
        place = np.flatnonzero(likely)
        if not len(place):
            return _packed([], SENT)
        digest = digests(chunk, place)
        bucket = (digest[:, 0] % U64(shards)).astype(np.int64)
        order = np.lexsort((digest[:, 1], digest[:, 0], bucket))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(digest[order], axis=0) != 0).any(axis=1)
        least = np.minimum.reduceat(chunk.ids[chunk.doc[place]][order], np.flatnonzero(new))
        which = np.empty(len(place), np.uint32)
        which[order] = np.cumsum(new) - 1
        some = order[new]
        edges = np.flatnonzero(np.diff(bucket[some], prepend=-1))
        me = number(left)
        out = [(me, int(bucket[some[a]]), False, digest[some[a:b]].tobytes(), least[a:b].tobytes()) for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(some)], strict=True)]
        out.append((me, me % shards, True, squeeze(np.packbits(likely).tobytes()), squeeze(which.tobytes())))
        return _packed(out, SENT)

    def smallest(table: pa.Table) -> pa.Table:
        """For every chunk's digests: whether a smaller id than the chunk's has them. What a chunk sent itself goes on."""
        sent = table.filter(pc.invert(table.column("own")))
        out = list(zip(*(table.filter(table.column("own")).column(n).to_pylist() for n, _ in SENT), strict=True))
        if sent.num_rows:
            digest, least = (np.frombuffer(b"".join(sent.column(c).to_pylist()), kind) for c, kind in (("first", U64), ("second", np.int64)))
            digest = digest.reshape(-1, 2)
            order = np.lexsort((digest[:, 1], digest[:, 0]))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(digest[order], axis=0) != 0).any(axis=1)
            low = np.minimum.reduceat(least[order], np.flatnonzero(new))
            below = np.empty(len(order), bool)
            below[order] = low[np.cumsum(new) - 1] < least[order]
            ends = np.cumsum([len(x) // 8 for x in sent.column("second").to_pylist()])
            bucket = sent.column("bucket")[0].as_py()
            out += [(c, bucket, False, np.packbits(x).tobytes(), np.int64(len(x)).tobytes()) for c, x in zip(sent.column("chunk").to_pylist(), np.split(below, ends[:-1]), strict=True)]
        return _packed(out, SENT)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("answers without their documents")
        chunk = Chunk(left, window)
        edges = np.zeros(len(chunk.starts) + 1, np.int64)
        if right.num_rows:
            likely = which = None
            bits = {}
            for bucket, own, first, second in zip(*(right.column(n).to_pylist() for n in ("bucket", "own", "first", "second")), strict=True):
                if own:
                    likely = np.unpackbits(np.frombuffer(spread(first), np.uint8))[: len(chunk.at)]
                    which = np.frombuffer(spread(second), np.uint32)
                else:
                    bits[bucket] = np.unpackbits(np.frombuffer(first, np.uint8))[: int(np.frombuffer(second, np.int64)[0])]
            elsewhere = np.concatenate([bits[b] for b in sorted(bits)]).astype(bool)
            place = np.flatnonzero(likely)
            ids = chunk.ids[chunk.doc[place]]
            least = np.full(len(elsewhere), np.iinfo(np.int64).max)
            np.minimum.at(least, which, ids)
            at = chunk.at[place[elsewhere[which] | (ids > least[which])]]
            edges[at] += 1  # one window starts at a word
            np.subtract.at(edges, at + window, 1)
        return finish(chunk, np.cumsum(edges[:-1]) > 0)

    by_chunk = rows.groupBy("chunk")
    estimated = by_chunk.applyInArrow(send_sketches, SENT_SQL).groupBy("bucket").applyInArrow(add_up, SENT_SQL)
    repeated = by_chunk.cogroup(estimated.groupBy("chunk")).applyInArrow(send_repeated, SENT_SQL)
    answers = repeated.groupBy("bucket").applyInArrow(smallest, SENT_SQL)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(apply, schema)


def kept(chunk: Chunk, covered: np.ndarray) -> list[bytes]:
    """The kept words of every document, joined by one space."""
    text, begin, end = chunk.spaced()
    left = text[np.repeat(~covered, end - begin + 1)].tobytes()
    sizes = np.concatenate([[0], np.cumsum(np.where(covered, 0, end - begin + 1))])[chunk.bounds]
    return [left[a : max(b - 1, a)] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True)]


def digest(docs: DataFrame, **limits) -> DataFrame:
    """RESULT for every document."""

    def finish(chunk: Chunk, covered: np.ndarray) -> pa.Table:
        gone = np.concatenate([[0], np.cumsum(covered)])[chunk.bounds]
        shas = [hashlib.sha256(x).hexdigest() for x in kept(chunk, covered)]
        again = np.repeat(np.arange(len(shas)), chunk.copies)
        table = pa.table({"doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.null), "n_words": np.diff(chunk.bounds).astype(np.int64), "n_removed": np.diff(gone).astype(np.int64), "kept_sha256": pa.array(shas, pa.string())})
        return table.take(pa.array(again))

    return removed(docs, RESULT, finish, **limits)


def kept_texts(docs: DataFrame, **limits) -> DataFrame:
    """doc_id and the words left, joined by one space."""

    def finish(chunk: Chunk, covered: np.ndarray) -> pa.Table:
        again = np.repeat(np.arange(len(chunk.ids)), chunk.copies)
        texts = pa.array([x.decode("utf-8", "surrogatepass") for x in kept(chunk, covered)], pa.string())
        return pa.table({"doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.null), "text": texts}).take(pa.array(again))

    return removed(docs, "doc_id long, text string", finish, **limits)
