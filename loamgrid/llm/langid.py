"""Language identification by the nearest centroid.

A text is a vector of hashed letter n-grams (two and three bytes of the lower-cased text, everything in ASCII that
is no letter as a space), weighted by TF-IDF and normalised. Every language has a few centroids, found by spherical
k-means; the language of the centroid with the largest cosine wins, ties go to the first language in order.
A text further from every centroid than any training text was, with a margin, is rejected.

Fitting uses a bounded sample: at most `per_lang` labelled texts of each language, chosen by a hash of the id.
Prediction reads every text as a whole.

Edge cases: a null text or one without a letter is `und` with score 0 and rejected; equal texts get equal results; an
empty training set makes every text `und`, and `keep_known` keeps all rows; extra columns are ignored by `predict` and kept by `keep_known`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, small_batches, utf8

DIMS = 4096
_codes = np.random.Generator(np.random.PCG64(77)).integers(0, DIMS, (5, 256)).astype(np.uint16)
_letters = np.arange(256, dtype=np.uint8)
_letters[[b for b in range(128) if not chr(b).isalpha()]] = 0x20
#: A text in one of the learned languages does not come near this share of the least training cosine.
MARGIN = 0.5
#: Below so many n-grams a distance says nothing, and a text is not rejected by it.
LEAST_NGRAMS = 40


@dataclass
class Centroids:
    langs: list[str]
    owner: np.ndarray
    idf: np.ndarray
    matrix: np.ndarray
    least: float


def counts(column: pa.Array) -> np.ndarray:
    """Counts of hashed n-grams, one row of DIMS for each text."""
    data, offsets = utf8(pc.utf8_lower(column))
    data = _letters[data]
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64) * DIMS, np.diff(offsets))
    total = np.zeros(n * DIMS, np.int64)
    for width, rows in ((3, _codes[:3]), (2, _codes[3:])):
        if len(data) < width:
            continue
        stop = len(data) - width + 1
        code = rows[0][data[:stop]].copy()
        for j in range(1, width):
            code ^= rows[j][data[j : stop + j]]
        whole = doc[:stop] == doc[width - 1 :]
        blank = (data[:stop] == 0x20) & (data[1 : stop + 1] == 0x20)
        use = whole & ~blank
        total += np.bincount(doc[:stop][use] + code[use], minlength=n * DIMS)
    return total.reshape(n, DIMS)


def weigh(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(tf.astype(np.float32)) * idf
    norm = np.sqrt((vector * vector).sum(axis=1, keepdims=True))
    return vector / np.maximum(norm, 1e-12)


def _cluster(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; the same input gives the same centroids."""
    seeds = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[seeds[0]]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[seeds[-1]])
    centers = vectors[seeds]
    for _ in range(rounds):
        own = np.argmax(vectors @ centers.T, axis=1)
        centers = np.stack([vectors[own == j].sum(axis=0) if (own == j).any() else centers[j] for j in range(len(centers))])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    return centers


def fit(labelled: DataFrame, per_lang: int = 400, clusters: int = 4, most: int = 8000) -> Centroids:
    """Centroids from (doc_id, text, lang) rows. At most about per_lang texts of a language and about `most` in all are used."""
    small_batches(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    wanted = min(per_lang, max(1, most // max(1, len(have))))
    share = F.lit(0.0)
    for lang, n in have.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, wanted / n))).otherwise(share)
    chance = (F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) + F.lit(0.5)) / F.lit(float(1 << 20))
    sample = rows.filter(chance < share)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        tf = np.minimum(counts(batch.column("text")), 65535).astype(np.uint16)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([x.tobytes() for x in tf], pa.binary())], ["doc_id", "lang", "tf"])

    got = sorted((r["lang"], r["doc_id"], bytes(r["tf"])) for r in map_batches(sample, step, "doc_id long, lang string, tf binary").collect())
    if not got:
        return Centroids([], np.zeros(0, int), np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), 0.0)
    tf = np.stack([np.frombuffer(x[2], np.uint16) for x in got])
    names = np.array([x[0] for x in got])
    idf = np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))).astype(np.float32) + 1
    vectors, langs, owner, centers = weigh(tf, idf), sorted(have), [], []
    langs = [x for x in langs if (names == x).any()]
    for i, lang in enumerate(langs):
        found = _cluster(vectors[names == lang], clusters)
        centers.append(found)
        owner += [i] * len(found)
    matrix = np.concatenate(centers).astype(np.float32)
    filled = tf.sum(axis=1) >= LEAST_NGRAMS
    least = float((vectors @ matrix.T).max(axis=1)[filled].min()) * MARGIN if filled.any() else 0.0
    return Centroids(langs, np.array(owner), idf, matrix, least)


def label(model: Centroids, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether it is rejected, for each text."""
    letters = np.asarray(pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False))
    if not model.langs:
        return ["und"] * len(column), np.zeros(len(column)), np.ones(len(column), bool)
    tf = counts(column)
    cosine = weigh(tf, model.idf) @ model.matrix.T
    best = np.argmax(cosine, axis=1)
    score = np.where(letters, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0).astype(np.float64)
    names = [model.langs[model.owner[b]] if ok else "und" for b, ok in zip(best, letters, strict=True)]
    return names, score, ~letters | ((score < model.least) & (tf.sum(axis=1) >= LEAST_NGRAMS))


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score, rejected = label(shared.value, batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    return map_batches(rows, step, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows, with all their columns, whose language is not rejected. A model that has learned no language rejects none: all rows stay."""
    if not model.langs:
        return docs
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(~label(shared.value, batch.column("text"))[2]))

    return map_batches(docs, step, docs.schema)


def training(docs: DataFrame) -> DataFrame:
    """The rows from which languages may be learned."""
    return docs.filter(~held_out())
