"""Exact substring dedup: bytes covered by a LENGTH-byte string that also starts in a document with a smaller id are removed.

Suffixes that could repeat are found and sorted without moving all of them. Every LENGTH-byte string has an anchor, the least hash among
its GRAM-byte strings (the last of equal ones), which depends on its content alone; a run of neighbouring strings with one anchor is a context.
1. Chunks of documents send the hashes of their anchors to buckets; a bucket answers which of them some other document has too.
2. Chunks send the distinct contexts of those anchors, each with its smallest id. A bucket sorts them by deep-shallow sorting; where the
   contexts of an anchor differ it sorts the suffixes that start in them to LENGTH bytes, and answers with the smallest id that has each string.
3. Chunks remove what a smaller id has.
Hashes only choose candidates; equality is decided on bytes. A passage that very many documents share is one context for every chunk. Texts
move once: the three steps read the same exchange. Chunks and buckets have about a fixed size, so their number follows the input.

Edge cases: null text is empty; texts shorter than LENGTH bytes are untouched; ids that repeat don't count as smaller than each other; rows with a null id
are untouched and remove nothing elsewhere; an empty table gives an empty result; strings never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, U64, _Powers, mix, partitions, small_batches, utf8
from .deepshallow import sort

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1
CHUNK_TEXT, BUCKET_TEXT = 4 << 20, 8 << 20
#: Bits for a place inside a slice of text; longer texts are cut into overlapping slices.
PLACE_BITS = 24
PLACES = U64((1 << PLACE_BITS) - 1)
SLICE = 1 << 22
#: Text whose anchors are found in one numpy step, small enough to stay in a core's cache.
RUN_BYTES = 1 << 17
#: High bits of the shared hashes that are marked, so that most runs need no search.
FILTER_BITS = 20
NO_ID = np.iinfo(np.int64).min


def anchor_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every run: its document, first and last string start (in data), and the hash of its anchor."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, np.zeros(0, U64)
    up, down = _Powers.upto(n + 1)
    total = np.zeros(n + 1, U64)
    codes = BYTE_CODE[data]
    codes *= up[:n]
    np.cumsum(codes, out=total[1:])
    grams = total[GRAM:] - total[:-GRAM]
    grams *= down[: n - GRAM + 1]
    # the high bits of the sum choose well enough; only the anchors that are left are mixed
    low = grams & ~PLACES
    low |= PLACES - np.arange(len(grams), dtype=U64)
    width = 1
    while width * 2 <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < SPAN:
        low = np.minimum(low[: len(low) - (SPAN - width)], low[SPAN - width :])
    counts = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    full = np.flatnonzero(counts)
    edge = np.zeros(len(low) + 1, bool)
    np.not_equal(low[1:], low[:-1], out=edge[1:-1])
    edge[offsets[full]] = True
    edge[offsets[full] + counts[full]] = True
    edge[-1] = True
    first = np.flatnonzero(edge)
    first, last = first[:-1], first[1:] - 1
    doc = np.searchsorted(offsets, first, "right") - 1
    real = np.flatnonzero(first - offsets[doc] < counts[doc])
    doc, first, last = doc[real], first[real], last[real]
    anchor = (PLACES - (low[first] & PLACES)).astype(np.int64)
    return doc, first, last, mix(grams[anchor])


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a hash by its high bits: hashes in order are in order of their buckets."""
    return ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


class Chunk:
    """The documents of a chunk with their runs, in one order whenever it is built."""

    def __init__(self, table: pa.Table):
        pa.default_memory_pool().release_unused()  # what the groups before have left
        rows = table.combine_chunks()
        self.data, self.offsets = utf8(rows.column("text").combine_chunks())
        ids = rows.column("doc_id").combine_chunks()
        self.null = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(NO_ID)).astype(np.int64)
        order = np.lexsort((self._text_key(), self.ids))
        if len(order) and (order != np.arange(len(order))).any():
            rows = rows.take(pa.array(order))
            self.data, self.offsets = utf8(rows.column("text").combine_chunks())
            self.ids, self.null = self.ids[order], self.null[order]
        self.rows = rows
        parts = list(self._runs())
        self.doc, self.first, self.last, self.hash = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, U64 if i == 3 else np.int64) for i in range(4))
        use = ~self.null[self.doc] if len(self.doc) else np.zeros(0, bool)
        self.doc, self.first, self.last, self.hash = self.doc[use], self.first[use], self.last[use], self.hash[use]

    def _text_key(self) -> np.ndarray:
        """Orders rows with one id by content: length and a sum over the bytes suffice to be the same every time."""
        total = np.concatenate([[0], np.cumsum(self.data.astype(np.int64) * (np.arange(len(self.data)) % 251 + 1))]) if len(np.unique(self.ids)) < len(self.ids) else None
        return np.diff(self.offsets) if total is None else total[self.offsets[1:]] - total[self.offsets[:-1]]

    def _runs(self) -> Iterator[tuple[np.ndarray, ...]]:
        at, n = 0, len(self.offsets) - 1
        while at < n:
            stop = min(max(int(np.searchsorted(self.offsets, self.offsets[at] + RUN_BYTES, "right")) - 1, at + 1), n)
            a, b = int(self.offsets[at]), int(self.offsets[stop])
            if b - a > SLICE and stop == at + 1:
                for s in range(a, b, SLICE):
                    e = min(s + SLICE + LENGTH - 1, b)
                    doc, first, last, h = anchor_runs(self.data[s:e], np.array([0, e - s]))
                    yield doc + at, first + s, last + s, h
            else:
                doc, first, last, h = anchor_runs(self.data[a:b], self.offsets[at : stop + 1] - a)
                yield doc + at, first + a, last + a, h
            at = stop

    def anchors(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes by (bucket, hash), which bucket each has, and whether two ids of this chunk have it."""
        ids = self.ids[self.doc]
        order = np.argsort(self.hash)
        h, ids = self.hash[order], ids[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        several = np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at) if len(at) else np.zeros(0, bool)
        h = h[at]
        return h, bucket_of(h, buckets), several

    def candidates(self, shared: np.ndarray) -> "Contexts":
        """The runs whose anchor is shared (sorted hashes), with their distinct contexts."""
        some = np.zeros(1 << FILTER_BITS, bool)
        some[shared >> U64(64 - FILTER_BITS)] = True
        maybe = np.flatnonzero(some[self.hash >> U64(64 - FILTER_BITS)])
        hashes = self.hash[maybe]
        hit = maybe[np.append(shared, U64(0))[np.searchsorted(shared, hashes)] == hashes] if len(shared) else maybe
        return Contexts(self, hit)


class Contexts:
    """Distinct contexts of a chunk's runs, ordered by (hash, bytes)."""

    def __init__(self, chunk: Chunk, runs: np.ndarray):
        self.chunk, self.runs = chunk, runs
        self.start, self.length = chunk.first[runs], chunk.last[runs] - chunk.first[runs] + LENGTH
        self.lead = chunk.hash[runs]
        order, new = sort(np.append(chunk.data, np.zeros(8, np.uint8)), self.start, self.length, self.lead)
        self.own = np.zeros(len(runs), np.int64)
        self.own[order] = np.cumsum(new) - 1
        self.some = order[new]
        self.least = np.minimum.reduceat(chunk.ids[chunk.doc[runs]][order], np.flatnonzero(new)) if len(order) else np.zeros(0, np.int64)

    def split(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        """Distinct contexts of each bucket, in order."""
        bucket = bucket_of(self.lead[self.some], buckets)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        return [(int(bucket[part[0]]), part) for part in np.split(np.arange(len(bucket)), edges[1:])] if len(bucket) else []


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one after the other."""
    ends = np.cumsum(length)
    return data[np.arange(int(ends[-1])) + np.repeat(start - ends + length, length)] if len(start) else np.zeros(0, np.uint8)


def smallest_ids(lead: np.ndarray, data: np.ndarray, length: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every context: the smallest id that has each of the strings starting in it, one number if all have the same; how many numbers each has, and all of them."""
    buffer = np.append(data, np.zeros(8, np.uint8))
    start = np.cumsum(length) - length
    order, new = sort(buffer, start, length, lead)
    distinct = np.zeros(len(lead), np.int64)
    distinct[order] = np.cumsum(new) - 1
    some, heads = order[new], np.flatnonzero(new)
    lowest = np.minimum.reduceat(least[order], heads)
    # contexts of one anchor stand together; where there is only one, all its strings have its smallest id
    group = np.cumsum(np.concatenate([[True], lead[some][1:] != lead[some][:-1]])) - 1
    alone = np.bincount(group)[group] == 1
    mixed = np.flatnonzero(~alone)
    sizes, begin, values = np.ones(len(some), np.int64), np.arange(len(some)), lowest
    if len(mixed):
        counts = length[some[mixed]] - LENGTH + 1
        owner, edges = np.repeat(np.arange(len(mixed)), counts), np.cumsum(counts) - counts
        at = np.repeat(start[some[mixed]], counts) + np.arange(len(owner)) - np.repeat(edges, counts)
        by, fresh = sort(buffer, at, np.full(len(at), LENGTH), group[mixed][owner].astype(U64))
        lows = np.minimum.reduceat(lowest[mixed][owner][by], np.flatnonzero(fresh))
        found = np.empty(len(at), np.int64)
        found[by] = lows[np.cumsum(fresh) - 1]
        uniform = np.minimum.reduceat(found, edges) == np.maximum.reduceat(found, edges)
        sizes[mixed], begin[mixed], values = np.where(uniform, 1, counts), len(some) + edges, np.concatenate([lowest, found])
    sizes, begin = sizes[distinct], begin[distinct]
    ends = np.cumsum(sizes)
    return sizes, values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)]


def pack(data: bytes) -> bytes:
    """Contexts overlap and repeat words: packed here they shrink more than the shuffle's own compression makes them."""
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def removed(docs: DataFrame, output: str, finish) -> DataFrame:
    """Rows that `finish(chunk, covered)` makes of every chunk; covered marks the bytes to remove. docs has doc_id and text."""
    spark = docs.sparkSession
    small_batches(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(partitions(spark), -(-total // CHUNK_TEXT))
    buckets = max(partitions(spark), -(-total // BUCKET_TEXT))
    place = "_chunk"
    while place in docs.columns:
        place += "_"
    # by id and text: rows that share an id, or have none, spread too
    rows = docs.withColumn(place, F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    def send_anchors(table: pa.Table) -> pa.Table:
        h, bucket, several = Chunk(table).anchors(buckets)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = [(int(bucket[a]), h[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes(), np.packbits(several[a:b]).tobytes()) for a, b in zip(edges, [*edges[1:], len(h)][: len(edges)], strict=True)]
        return _table(table, out, [("bucket", pa.int32()), ("hashes", pa.binary()), ("several", pa.binary())])

    def find_shared(table: pa.Table) -> pa.Table:
        chunk, bits, codes = _column(table, "chunk"), [], []
        for hashes, several in zip(_column(table, "hashes"), _column(table, "several"), strict=True):
            raw = np.zeros((len(hashes) // 5, 8), np.uint8)
            raw[:, :5] = np.frombuffer(hashes, np.uint8).reshape(-1, 5)
            codes.append(raw.view("<u8").ravel())
            bits.append(np.unpackbits(np.frombuffer(several, np.uint8))[: len(raw)].astype(bool))
        every, many = np.concatenate(codes), np.concatenate(bits)
        order = np.argsort(every, kind="stable")
        here = every[order]
        same = here[1:] == here[:-1]
        twice = np.zeros(len(every), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.split(many | twice, np.cumsum([len(c) for c in codes])[:-1])
        out = [(c, int(table.column("bucket")[0].as_py()), np.packbits(x).tobytes()) for c, x in zip(chunk, hit, strict=True) if x.any()]
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int32()), "bucket": pa.array([x[1] for x in out], pa.int32()), "bits": pa.array([x[2] for x in out], pa.binary())})

    def shared_of(chunk: Chunk, table: pa.Table) -> np.ndarray:
        h, bucket, _ = chunk.anchors(buckets)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        spans = {int(bucket[a]): (a, b) for a, b in zip(edges, [*edges[1:], len(h)][: len(edges)], strict=True)}
        hit = np.zeros(len(h), bool)
        for b, bits in zip(_column(table, "bucket"), _column(table, "bits"), strict=True):
            a, e = spans[b]
            hit[a:e] = np.unpackbits(np.frombuffer(bits, np.uint8))[: e - a]
        return np.sort(h[hit])

    def send_contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            chunk = Chunk(left)
            made = chunk.candidates(shared_of(chunk, right))
            for bucket, part in made.split(buckets):
                runs = made.some[part]
                out.append((bucket, made.lead[runs].tobytes(), made.length[runs].astype(np.uint8).tobytes(), made.least[part].tobytes(), pack(gather(chunk.data, made.start[runs], made.length[runs]).tobytes())))
        return _table(left if left.num_rows else right, out, [("bucket", pa.int32()), ("lead", pa.binary()), ("length", pa.binary()), ("least", pa.binary()), ("data", pa.binary())])

    def answer(table: pa.Table) -> pa.Table:
        lead, length, least = (np.frombuffer(b"".join(_column(table, c)), k) for c, k in (("lead", U64), ("length", np.uint8), ("least", np.int64)))
        data = np.frombuffer(b"".join(map(unpack, _column(table, "data"))), np.uint8)
        sizes, found = smallest_ids(lead, data, length.astype(np.int64), least)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out, at = [], 0
        for chunk, own in zip(_column(table, "chunk"), _column(table, "lead"), strict=True):
            to = at + len(own) // 8
            out.append((chunk, sizes[at:to].astype(np.uint8).tobytes(), found[ends[at] : ends[to]].tobytes()))
            at = to
        bucket = int(table.column("bucket")[0].as_py())
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int32()), "bucket": pa.array([bucket] * len(out), pa.int32()), "sizes": pa.array([x[1] for x in out], pa.binary()), "ids": pa.array([x[2] for x in out], pa.binary())})

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left) if left.num_rows else None
        if chunk is None:
            raise ValueError("answers without their documents")
        repeated = np.zeros(len(chunk.data) + 1, np.int8)
        answers = {b: (np.frombuffer(s, np.uint8).astype(np.int64), np.frombuffer(i, np.int64)) for b, s, i in zip(_column(right, "bucket"), _column(right, "sizes"), _column(right, "ids"), strict=True)}
        if answers:
            # the anchors that were shared are those of the answered contexts, found again from the hashes in the answers' buckets
            made = chunk.candidates(np.sort(np.frombuffer(b"".join(_column(right, "lead")), U64)))
            sizes, begin, values, base = np.zeros(len(made.some), np.int64), np.zeros(len(made.some), np.int64), [], 0
            for bucket, part in made.split(buckets):
                size, ids = answers[bucket]
                sizes[part], begin[part] = size, base + np.cumsum(size) - size
                values.append(ids)
                base += len(ids)
            values = np.concatenate(values)
            first, last = chunk.first[made.runs], chunk.last[made.runs]
            own = chunk.ids[chunk.doc[made.runs]]
            one = sizes[made.own] == 1
            gone = np.flatnonzero(one & (values[begin[made.own]] < own))
            np.add.at(repeated, first[gone], 1)
            np.add.at(repeated, last[gone] + 1, -1)
            marks = np.cumsum(repeated[:-1]) > 0
            several = np.flatnonzero(~one)
            if len(several):
                count = last[several] - first[several] + 1
                owner = np.repeat(several, count)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                marks[(first[owner] + step)[values[begin[made.own[owner]] + step] < own[owner]]] = True
        else:
            marks = np.zeros(len(chunk.data), bool)
        sums = np.concatenate([[0], np.cumsum(marks)])
        at = np.arange(len(chunk.data))
        covered = sums[at + 1] > sums[np.maximum(at - LENGTH + 1, 0)]
        return finish(chunk, covered)

    def _table(table: pa.Table, out: list, fields: list) -> pa.Table:
        name = place if place in table.column_names else "chunk"
        chunk = table.column(name)[0].as_py() if table.num_rows else 0
        columns = {"chunk": pa.array([chunk] * len(out), pa.int32())}
        return pa.table(columns | {name: pa.array([x[i] for x in out], kind) for i, (name, kind) in enumerate(fields)})

    by_chunk = rows.groupBy(place)
    shared = by_chunk.applyInArrow(send_anchors, "chunk int, bucket int, hashes binary, several binary").groupBy("bucket").applyInArrow(find_shared, "chunk int, bucket int, bits binary")
    contexts = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(send_contexts, "chunk int, bucket int, lead binary, length binary, least binary, data binary")

    def answer_with_leads(table: pa.Table) -> pa.Table:
        return answer(table).append_column("lead", pa.array(_column(table, "lead"), pa.binary()))

    answers = contexts.groupBy("bucket").applyInArrow(answer_with_leads, "chunk int, bucket int, sizes binary, ids binary, lead binary")
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(apply, output)


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _spans(chunk: Chunk, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes removed and maximal removed runs of every document."""
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    edges = chunk.offsets[:-1][chunk.offsets[:-1] < len(covered)]
    begins[edges] = covered[edges]
    total, runs = np.concatenate([[0], np.cumsum(covered)]), np.concatenate([[0], np.cumsum(begins)])
    a, b = chunk.offsets[:-1], chunk.offsets[1:]
    return total[b] - total[a], runs[b] - runs[a]


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""

    def finish(chunk: Chunk, covered: np.ndarray) -> pa.Table:
        gone, spans = _spans(chunk, covered)
        kept = chunk.data[~covered].tobytes()
        ends = np.cumsum(np.diff(chunk.offsets) - gone).tolist()
        shas = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        ids = pa.array(chunk.ids, pa.int64(), mask=chunk.null)
        return pa.table({"doc_id": ids, "n_bytes": pa.array(np.diff(chunk.offsets)), "n_removed": pa.array(gone.astype(np.int64)), "n_spans": pa.array(spans.astype(np.int64)), "kept_sha256": pa.array(shas, pa.string())})

    return removed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), DIGEST, finish)


def kept_texts(docs: DataFrame) -> DataFrame:
    """The same rows and columns with the text that is left; bytes that no longer form a character are left out, n_chars follows the text."""
    names = docs.columns
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long"))

    def finish(chunk: Chunk, covered: np.ndarray) -> pa.Table:
        gone, _ = _spans(chunk, covered)
        kept = chunk.data[~covered].tobytes()
        ends = np.cumsum(np.diff(chunk.offsets) - gone).tolist()
        texts = [kept[a:b].decode("utf-8", "ignore") for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        empty = np.asarray(chunk.rows.column("text").combine_chunks().is_null())
        columns = {n: chunk.rows.column(n) for n in names}
        columns["text"] = pa.array(texts, pa.string(), mask=empty)
        if "n_chars" in names:
            columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
        return pa.table(columns)

    schema = ", ".join(f"`{f.name}` {'long' if f.name in ('doc_id', 'n_chars') else f.dataType.simpleString()}" for f in docs.schema)
    return removed(rows, schema, finish)
