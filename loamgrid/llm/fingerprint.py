"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range.

A shingle is five words in a row; a shorter text is one shingle; hashes have 64 bits. What a sketch keeps doesn't depend on
the size of the text, so the sketch of a union is the union of the sketches, and containment can be estimated between very unequal
documents. Where no hash lies below the threshold, the smallest one stands for the text, which merging keeps well defined.

A fingerprint is the ascending kept hashes as 16 hexadecimal digits each; a text without words has the empty one. Two empty
ones have likeness 1, an empty and another one 0. Equal texts have equal fingerprints. Nulls count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, distinct_pairs, ordered, small_batches, text_shingles

WIDTH = 5
#: A quarter of all hashes is kept.
THRESHOLD = U64(1 << 62)


def sketches(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the kept hashes, ordered and distinct."""
    value, doc = text_shingles(column, width)
    if not len(doc):
        return doc, value
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    least = np.zeros(int(doc[-1]) + 1, U64)
    least[doc[first]] = np.minimum.reduceat(value, first)
    keep = (value < THRESHOLD) | (value == least[doc])
    return distinct_pairs(doc[keep], value[keep])


def shared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """How many hashes document i has in both sketches, for i below n."""
    doc, value = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    same = (doc[1:] == doc[:-1]) & (value[1:] == value[:-1])
    return np.bincount(doc[1:][same], minlength=n)[:n]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Share of the common hashes among all hashes of two sketches, for each document."""
    both, na, nb = shared(a, b, n), np.bincount(a[0], minlength=n)[:n], np.bincount(b[0], minlength=n)[:n]
    whole = na + nb - both
    return np.where(whole == 0, 1.0, both / np.maximum(whole, 1))


def containment(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Share of a's hashes that b has too."""
    na = np.bincount(a[0], minlength=n)[:n]
    return np.where(na == 0, 1.0, shared(a, b, n) / np.maximum(na, 1))


def merge(fingerprints: list[str]) -> str:
    """The fingerprint of all the texts together."""
    kept = sorted({f[i : i + 16] for f in fingerprints for i in range(0, len(f), 16)})
    below = [x for x in kept if int(x, 16) < int(THRESHOLD)]
    return "".join(below or kept[:1])


def as_text(sketch: tuple[np.ndarray, np.ndarray], n: int) -> list[str]:
    digits = sketch[1].astype(">u8").tobytes().hex()
    ends = np.cumsum(np.bincount(sketch[0], minlength=n)[:n]) * 16
    return [digits[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(as_text(sketches(part.column("text")), part.num_rows), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


FOLLOWED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, held_edited double"


def followed(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint beside that of its edited text and of the next document by id.

    The edited text has the last half (rounded down) of the code points replaced by as many from the start of the next
    document, or all it has; after the last document comes the first. Repeated ids stand in the order of their texts; rows with a
    null id stand after all others, in the order of theirs. Texts move once, in runs of neighbouring ids.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"_key": F.coalesce("doc_id", F.lit((1 << 63) - 1)), "_none": F.col("doc_id").isNull()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            for part in chunks(batch, "text"):
                table = pa.Table.from_batches([part] if carried is None else [carried, part]).combine_chunks()
                whole = table.to_batches()[0]
                yield from step(whole, whole.num_rows - 1)
                carried = whole.slice(whole.num_rows - 1)
        if carried is not None:
            yield from step(carried, 1)

    def step(batch: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
        """Rows up to n, each with the row after it."""
        own = np.flatnonzero(np.asarray(batch.column("_guest"))[:n] == 0)
        if not len(own):
            return
        texts = batch.column("text").to_pylist()
        edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + (texts[i + 1] if i + 1 < len(texts) else "")[: len(texts[i]) // 2] for i in own]
        doc, value = sketches(batch.column("text"))
        m = len(own)
        place = np.full(batch.num_rows + 1, -1)
        place[own] = np.arange(m)
        mine = place[doc]
        following = place[np.maximum(doc - 1, -1)] if len(doc) else mine
        following = np.where(doc > 0, following, -1)
        base, after = (mine[mine >= 0], value[mine >= 0]), (following[following >= 0], value[following >= 0])
        changed = sketches(pa.array(edited, pa.string()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(own)),
                pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array(as_text(base, m), pa.string()),
                pa.array(as_text(changed, m), pa.string()),
                pa.array(likeness(base, changed, m)),
                pa.array(likeness(base, after, m)),
                pa.array(containment(base, changed, m)),
            ],
            [x.split()[0] for x in FOLLOWED.split(", ")],
        )

    return ordered(rows, "_key", ["_none", "text"], ring=True).mapInArrow(run, FOLLOWED)
