"""Toxicity by class-conditional Kneser-Ney models.

Two models of letter sequences, of toxic and of ordinary texts, are learned from labelled rows. A letter is one of SYMBOLS classes of the bytes
of the lower-cased text (signs and white space are spaces), so that unseen words with a known stem count too. P(letter | the GRAM - 1 letters
before it, class) is the class's count of the run less an absolute discount, over the class's count of the history; what the discounts free
goes to a shorter context. The class is what a context drops first, so all shorter ones are shared by the classes. Their counts are
continuation counts: how many classes have the run, then after how many different letters a shorter run stands in either class, discounted
and interpolated in turn down to single letters and at last to all letters alike. Every distribution sums to 1. A run counts once for each text that has it, so that one text's repetitions don't count. What is rare or unknown in
both classes thus says nearly nothing, while what only one class uses says much.

A text's evidence is the difference of its length-normalised toxic and ordinary log-likelihoods: over the whole text, and the largest over windows
of WINDOWS letters, which find a few toxic words in a long text. A logistic curve over these and the length, fitted on labelled rows that
the counts haven't seen, turns them into a score from 0 to 1.

Fitting uses at most about `per_class` labelled ids of each class, chosen by a hash of the id. That sample alone, at whatever size of the input, bounds the model, which
has every run of the sample: what comes to the driver and is broadcast is 8 bytes for each run and each history, and as much again stands in a worker, beside 64 MB of places by history
(given up when a task ends). Scoring reads whole texts.

Edge cases: an empty or null text gets the score of no evidence; if a class has no labelled row every score is 0; repeated texts have equal
scores; extra columns are ignored; of several labels of one id the largest counts; texts of any length are read in bounded steps of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, chunks, cut, held_out, map_batches, small_batches, utf8

GRAM, BITS, WINDOWS, DISCOUNT = 5, 6, (12, 32, 128), 0.95
SYMBOLS = 1 << BITS
EVIDENCE = len(WINDOWS) + 2
#: Space 0, letters 1 to 26, digits 27, bytes of other characters 28 to 63.
LETTER = np.zeros(256, np.int32)
LETTER[97:123] = np.arange(1, 27)
LETTER[48:58] = 27
LETTER[128:] = 28 + np.arange(128) % 36
LETTER = LETTER[ASCII_LOWER]


@dataclass
class Models:
    """Log-probabilities of both classes: of every known run (sorted), and of what a known history leaves to shorter ones."""

    runs: np.ndarray
    ratio: np.ndarray
    histories: np.ndarray
    back: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.array([1.0, 1.0, *[0.0] * len(WINDOWS), -3.0]))


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of GRAM letters (a text starts after spaces; runs that end in two spaces are left out), and the bounds of every text."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    lead = np.repeat(GRAM * np.arange(1, n + 1), np.diff(offsets))
    padded = np.zeros(len(data) + GRAM * n, np.int32)
    at = np.arange(len(data)) + lead
    padded[at] = LETTER[data]
    run = np.zeros(max(len(padded) - GRAM + 1, 0), np.int32)
    for j in range(GRAM):
        run = run << BITS | padded[j : j + len(run)]
    at = at[(padded[at] != 0) | (padded[at - 1] != 0)] if len(at) else at
    return run[at - GRAM + 1], np.searchsorted(at, offsets + GRAM * np.arange(n + 1))


def _counts(labelled: DataFrame, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All runs (sorted), and how many texts of both classes have each; if asked for, at most `most` runs, those of the most texts. `fit` asks for all."""

    def total(pairs: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every, own = np.unique(np.concatenate(pairs), return_inverse=True)
        return every, np.bincount(own, np.concatenate(n)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = [], []
        for batch in batches:
            for part in chunks(batch, "text"):
                run, bounds = grams(part.column("text"))
                doc = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                own = np.unique(doc << (GRAM * BITS) | run)
                toxic = np.asarray(part.column("toxic")).astype(np.int64)[own >> (GRAM * BITS)]
                pairs.append(own & ((1 << GRAM * BITS) - 1) | toxic << (GRAM * BITS))
                n.append(np.ones(len(own), np.int64))
                if sum(map(len, pairs)) > 4_000_000:
                    pairs, n = ([x] for x in total(pairs, n))
        if pairs:
            pair, many = total(pairs, n)
            for i in range(0, len(pair), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (pair & ((1 << GRAM * BITS) - 1), pair >> (GRAM * BITS), many)], ["run", "toxic", "n"])

    parts = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(count, "run long, toxic long, n long")
    of = lambda c: F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}")
    counted = cut(parts.groupBy("run").agg(of(0), of(1)))
    texts = F.col("n0") + F.col("n1")
    if most is not None and counted.count() > most:
        sizes = sorted(((r["t"], r["runs"]) for r in counted.groupBy(texts.alias("t")).agg(F.count("*").alias("runs")).collect()), reverse=True)
        room, least = most, sizes[0][0] + 1
        for t, runs in sizes:
            room -= runs
            if room < 0:
                break
            least = t
        counted = counted.filter(texts >= least)
    got = counted.toArrow()
    runs = np.asarray(got["run"]).astype(np.int64)
    order = np.argsort(runs)
    return runs[order], np.stack([np.asarray(got[c]).astype(np.int64)[order] for c in ("n0", "n1")])


def shared_backoff(runs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """P(last letter | the letters before it) of every run, shared by the classes: Kneser-Ney over continuation counts. `classes` counts the classes that have a run."""
    levels, longer = [(runs, classes)], runs
    for length in range(GRAM - 1, 0, -1):
        longer, n = np.unique(longer & ((1 << BITS * length) - 1), return_counts=True)
        levels.append((longer, n))
    p, below = np.zeros(0), runs[:0]
    for length, (own, n) in enumerate(reversed(levels), 1):
        place = np.unique(own >> BITS, return_inverse=True)[1]
        mass, kinds = np.bincount(place, n), np.bincount(place)
        lower = p[np.searchsorted(below, own & ((1 << BITS * (length - 1)) - 1))] if length > 1 else 1 / SYMBOLS
        p, below = (n - DISCOUNT + DISCOUNT * kinds[place] * lower) / mass[place], own
    return p


def log_models(runs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For both classes (rows) the log-probability of every run's last letter, and by history the log of what an unseen letter's backoff is multiplied with."""
    histories, place = np.unique(runs >> BITS, return_inverse=True)
    lower = shared_backoff(runs, (counts > 0).sum(axis=0))
    logs, backs = [], []
    for n in counts:
        mass, kinds = np.bincount(place, n, len(histories)), np.bincount(place, n > 0, len(histories))
        free = np.where(mass > 0, DISCOUNT * kinds / np.maximum(mass, 1), 1.0)
        logs.append(np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(mass, 1)[place] + free[place] * lower))
        backs.append(np.log(free))
    return np.stack(logs), histories, np.stack(backs)


class _Lookup:
    """A worker's table of one model: the difference of the classes' log-probabilities by history and letter.

    A history has the place of its first run and a bit for each letter that follows it; a run's place is the first one's and the bits below its own.
    """

    last: tuple | None = None

    def __init__(self, model: Models):
        self.row = np.full(1 << BITS * (GRAM - 1), len(model.histories), np.int32)
        self.row[model.histories] = np.arange(len(model.histories))
        own = model.runs >> BITS
        self.first = np.append(np.searchsorted(own, model.histories), 0).astype(np.int32)
        self.letters = np.zeros(len(model.histories) + 1, np.uint64)
        np.bitwise_or.at(self.letters, self.row[own], np.uint64(1) << (model.runs & (SYMBOLS - 1)).astype(np.uint64))
        self.back, self.ratio = np.append(model.back, 0).astype(np.float32), np.append(model.ratio, 0).astype(np.float32)

    @classmethod
    def forget(cls) -> None:
        cls.last = None

    @classmethod
    def of(cls, model: Models) -> _Lookup:
        if cls.last is None or cls.last[0] is not model:
            cls.last = model, cls(model)
        return cls.last[1]

    def __getitem__(self, run: np.ndarray) -> np.ndarray:
        row, letter = self.row[run >> BITS], np.uint64(1) << (run & (SYMBOLS - 1)).astype(np.uint64)
        letters = self.letters[row]
        place = self.first[row] + np.bitwise_count(letters & (letter - np.uint64(1)))
        return np.where(letters & letter, self.ratio[np.minimum(place, len(self.ratio) - 1)], self.back[row])


def evidence(model: Models, column: pa.Array) -> np.ndarray:
    """Difference of the length-normalised log-likelihoods, its largest over windows of both widths, and the damped length, for each text."""
    run, bounds = grams(column)
    n = len(bounds) - 1
    out = np.zeros((n, EVIDENCE))
    if not len(run):
        return out
    total = np.concatenate([[0.0], np.cumsum(_Lookup.of(model)[run], dtype=np.float64)])
    size = np.diff(bounds)
    out[:, 0] = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(size, 1)
    doc = np.repeat(np.arange(n), size)
    filled = size > 0
    for i, width in enumerate(WINDOWS):
        ends = np.minimum(np.arange(len(run)) + width, bounds[1:][doc])
        starts = np.maximum(bounds[:-1][doc], ends - width)
        out[filled, 1 + i] = np.maximum.reduceat((total[ends] - total[starts]) / width, bounds[:-1][filled])
    out[:, -1] = np.log1p(size)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve by Newton's method, with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + 1e-2 * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        weights -= np.linalg.solve(hessian, gradient)
    return weights


def fit(labelled: DataFrame) -> Models | None:
    """Models from (doc_id, text, toxic) rows, which are read once and kept in the shared folder; None if a class has no row."""
    small_batches(labelled.sparkSession)
    unseen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 4, F.lit(False))
    rows = cut(labelled.filter("toxic in (0, 1) and text is not null").select("text", F.col("toxic").cast("int").alias("toxic"), unseen.alias("unseen")))
    if rows.select("toxic").distinct().count() < 2:
        return None
    runs, counts = _counts(rows.filter("not unseen"))
    logs, histories, backs = log_models(runs, counts)
    model = Models(runs.astype(np.int32), (logs[1] - logs[0]).astype(np.float32), histories.astype(np.int32), (backs[1] - backs[0]).astype(np.float32))
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = evidence(shared.value, batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(x[:, i]) for i in range(EVIDENCE)]], ["toxic", *names])

    names = [f"e{i}" for i in range(EVIDENCE)]
    got = map_batches(rows.filter("unseen").select("text", "toxic"), step, "toxic int, " + ", ".join(f"{x} double" for x in names), done=_Lookup.forget).toArrow()
    shared.destroy()
    x, y = np.column_stack([np.asarray(got[k]) for k in names]), np.asarray(got["toxic"]).astype(float)
    order = np.lexsort((*x.T, y))
    if 0 < y.sum() < len(y):
        model.weights = _logistic(x[order], y[order])
    return model


def scores(model: Models | None, column: pa.Array) -> np.ndarray:
    if model is None:
        return np.zeros(len(column))
    x = np.column_stack([evidence(model, column), np.ones(len(column))])
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


def score(docs: DataFrame, model: Models | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scores(shared.value, batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    return map_batches(rows, step, "doc_id long, held_out boolean, score double, predicted int", done=_Lookup.forget)


def training(docs: DataFrame, labels: DataFrame, per_class: int = 20_000) -> DataFrame:
    """Labelled texts of the rows from which may be learned, at most about per_class ids of each class.

    The ids are chosen among the labels alone, by a hash, so what is broadcast to the texts has at most about 2 * per_class rows.
    """
    marks = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out())
    have = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for toxic, n in have.items():
        share = F.when(F.col("toxic") == toxic, F.lit(min(1.0, per_class / n))).otherwise(share)
    chosen = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < share * (1 << 20))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
