"""Fill-in-middle transformation by a parallel automaton scan.

An automaton reads bytes, says where units (code points) end and where control strings end. Texts are cut into blocks; every block is read from every state
at once, which gives its transition function and, for each state, the units and control strings in it. Functions compose associatively: a doubling scan resolves
the state in which each block is entered, running sums of the then known counts say which block holds a cut, and only those blocks are read
again. After a few bytes the states of a block nearly always agree; from there one of them is read.

Texts of more than `whole_bytes` go through the same steps between machines: slices of bytes, wherever they fall, are summed up apart, composed by document
(at most 2 GB, so a few thousand small rows), and the slices that hold cuts are divided; pieces in output order make up the result.

Forms: plain is the text; psm is `<P>`prefix`<S>`suffix`<M>`middle; spm is `<S>`suffix`<P>`prefix`<M>`middle. A text that holds a control string stays plain, so
outputs can be read back. Choices follow from the hash of the id.

Edge cases: a null text is empty and plain; a null id counts as an empty one in the hash; repeated ids and rows each give a row; an empty table
gives none; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, partitions, small_batches, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Order of the parts in each form; a part is 0 prefix, 1 middle, 2 suffix.
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
MARK_OF = {0: PREFIX, 1: MIDDLE, 2: SUFFIX}
PLAIN_FROM, SPM_BELOW = 90, 20
BLOCK, HEAD, PAD = 64, 6, 256
WHOLE_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
NAMES = [c.split()[0] for c in RESULT.split(", ")]


class Automaton:
    """Ends of code points and of control strings in UTF-8. A state is (bytes that the code point still needs, start of a control string)."""

    def __init__(self, marks: tuple[bytes, ...] = MARKS):
        heads = {m[:i] for m in marks for i in range(len(m))} | {b""}
        self.states: list[tuple[int, bytes]] = [(0, b"")]
        after: list[list[int]] = []
        units: list[list[int]] = []
        found: list[list[int]] = []
        at = 0
        while at < len(self.states):
            need, seen = self.states[at]
            row, ends, hits = [], [], []
            for byte in range(256):
                if byte & 0xC0 == 0x80 and need:
                    left = need - 1
                else:
                    left = 1 if 0xC0 <= byte < 0xE0 else 2 if 0xE0 <= byte < 0xF0 else 3 if byte >= 0xF0 else 0
                said = seen + bytes([byte])
                hits.append(int(any(said.endswith(m) for m in marks)))
                while said not in heads:
                    said = said[1:]
                if (left, said) not in self.states:
                    self.states.append((left, said))
                row.append(self.states.index((left, said)))
                ends.append(int(left == 0))
            after.append([*row, at])  # padding changes nothing
            units.append([*ends, 0])
            found.append([*hits, 0])
            at += 1
        self.size = len(self.states)
        self.next = np.array(after, np.uint8).ravel()
        #: Units in the low, control strings in the high half.
        self.counts = np.array(units, np.int32).ravel() + (np.array(found, np.int32).ravel() << 16)

    def read(self, blocks: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states and counts of blocks (n, width), each read from the states entry (n, k)."""
        state, total = entry.astype(np.int32), np.zeros(entry.shape, np.int32)
        for j in range(blocks.shape[1]):
            place = state * 257 + blocks[:, j, None]
            total += self.counts[place]
            state = self.next[place].astype(np.int32)
        return state, total

    def functions(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every block and entry state: the last state and the counts."""
        n = len(blocks)
        every = np.broadcast_to(np.arange(self.size), (n, self.size))
        state, total = self.read(blocks[:, :HEAD], every)
        agree = (state == state[:, :1]).all(axis=1)
        one, rest = self.read(blocks[agree, HEAD:], state[agree, :1])
        state[agree], total[agree] = one, total[agree] + rest
        apart = np.flatnonzero(~agree)
        if len(apart):
            state[apart], rest = self.read(blocks[apart, HEAD:], state[apart])
            total[apart] += rest
        return state, total

    def entries(self, ends: np.ndarray, first: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The state in which every block is entered. Blocks of one text follow each other; first marks its first one, start its state there."""
        n = len(ends)
        if not n:
            return np.zeros(0, np.int64)
        whole, open_ = ends.copy(), ~first
        step = 1
        while open_.any():  # whole[i] covers the blocks from the text's first, or the last `step` of them
            at = np.flatnonzero(open_)
            joined = np.take_along_axis(whole[at], whole[at - step], axis=1)
            still = open_[at - step]
            whole[at], open_ = joined, _put(open_, at, still)
            step *= 2
        begin = np.flatnonzero(first)
        owner = np.cumsum(first) - 1
        entry = np.empty(n, np.int64)
        entry[begin] = start
        later = np.flatnonzero(~first)
        entry[later] = whole[later - 1, start[owner[later]]]
        return entry

    def select(self, blocks: np.ndarray, entry: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """For each block the number of bytes up to the end of its rank-th unit (from 1)."""
        state, seen, found = entry.astype(np.int32), np.zeros(len(blocks), np.int32), np.zeros(len(blocks), np.int64)
        for j in range(blocks.shape[1]):
            place = state * 257 + blocks[:, j]
            seen += self.counts[place] & 0xFFFF
            found[(seen == rank) & (found == 0)] = j + 1
            state = self.next[place].astype(np.int32)
        return found


def _put(flags: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = flags.copy()
    out[at] = values
    return out


class Scan:
    """Texts in blocks, each text from a block of its own, with states and counts of all blocks."""

    def __init__(self, machine: Automaton, data: np.ndarray, offsets: np.ndarray, start: np.ndarray | None = None):
        self.machine = machine
        size = np.diff(offsets)
        self.blocks_of = np.maximum(-(-size // BLOCK), 1)
        self.first = np.concatenate([[0], np.cumsum(self.blocks_of)])
        self.blocks = np.full(int(self.first[-1]) * BLOCK, PAD, np.int32)
        self.blocks[np.arange(len(data)) + np.repeat(self.first[:-1] * BLOCK - offsets[:-1], size)] = data
        self.blocks = self.blocks.reshape(-1, BLOCK)
        self.ends, self.counts = machine.functions(self.blocks)
        if start is not None:
            self.resolve(start)

    def resolve(self, start: np.ndarray) -> None:
        """Counts, now that the state at the start of every text is known."""
        begins = np.zeros(len(self.blocks), bool)
        begins[self.first[:-1]] = True
        self.entry = self.machine.entries(self.ends, begins, start)
        own = self.counts[np.arange(len(self.blocks)), self.entry]
        self.units = np.concatenate([[0], np.cumsum(own & 0xFFFF, dtype=np.int64)])
        marks = np.concatenate([[0], np.cumsum(own >> 16, dtype=np.int64)])
        self.n = self.units[self.first[1:]] - self.units[self.first[:-1]]
        self.marks = marks[self.first[1:]] - marks[self.first[:-1]]

    def functions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a single text: last state, units and control strings from every state, by composing neighbours."""
        ends, units, marks = self.ends, (self.counts & 0xFFFF).astype(np.int64), (self.counts >> 16).astype(np.int64)
        while len(ends) > 1:
            left, right = slice(0, len(ends) // 2 * 2, 2), slice(1, None, 2)
            way, odd = ends[left], slice(len(ends) // 2 * 2, None)
            units, marks = (np.concatenate([x[left] + np.take_along_axis(x[right], way, axis=1), x[odd]]) for x in (units, marks))
            ends = np.concatenate([np.take_along_axis(ends[right], way, axis=1), ends[odd]])
        return ends[0], units[0], marks[0]

    def after(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Bytes of each text up to the end of its rank-th unit (0: none)."""
        aim = self.units[self.first[text]] + rank
        block = np.maximum(np.searchsorted(self.units, aim) - 1, self.first[text])
        inside = self.machine.select(self.blocks[block], self.entry[block], (aim - self.units[block]).astype(np.int32))
        return np.where(rank == 0, 0, (block - self.first[text]) * BLOCK + inside)


def form_of(n: int, marks: int, h3: int, h4: int) -> str:
    return "plain" if not n or marks or h3 % 100 >= PLAIN_FROM else "spm" if h4 % 100 < SPM_BELOW else "psm"


def assembled(text: bytes, form: str, low: int, high: int) -> bytes:
    if form == "plain":
        return text
    parts = (text[:low], text[low:high], text[high:])
    return b"".join(MARK_OF[p] + parts[p] for p in ORDER[form])


def restored(output: bytes, form: str) -> bytes:
    """The text of an output, from the output and its form alone."""
    if form == "plain":
        return output
    starts = [output.index(MARK_OF[p]) for p in ORDER[form]]
    parts = {p: output[a + 3 : b] for p, a, b in zip(ORDER[form], starts, [*starts[1:], len(output)], strict=True)}
    return parts[0] + parts[1] + parts[2]


def choices(seed: str) -> dict[str, Column]:
    """h1 to h4: the first four 8-digit groups of the hex sha256 of seed, colon and id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return {f"h{i + 1}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}


def _whole(docs: DataFrame, texts: bool) -> DataFrame:
    machine = Automaton()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column("text"))
        count = batch.num_rows
        scan = Scan(machine, data, offsets, np.zeros(count, np.int64))
        h = [np.asarray(batch.column(f"h{i}")) for i in range(1, 5)]
        one, two = h[0] % (scan.n + 1), h[1] % (scan.n + 1)
        low, high = np.minimum(one, two), np.maximum(one, two)
        every = np.arange(count)
        at, to = scan.after(every, low).tolist(), scan.after(every, high).tolist()
        forms = [form_of(*x) for x in zip(scan.n.tolist(), scan.marks.tolist(), h[2].tolist(), h[3].tolist(), strict=True)]
        raw, edges = data.tobytes(), offsets.tolist()
        outputs, digests, back = [], [], []
        for i, form in enumerate(forms):
            output = assembled(raw[edges[i] : edges[i + 1]], form, at[i], to[i])
            digests.append(hashlib.sha256(output).hexdigest())
            back.append(hashlib.sha256(restored(output, form)).hexdigest())
            if texts:
                outputs.append(output.decode("utf-8", "surrogatepass"))
        plain = np.array([f == "plain" for f in forms], bool)
        columns = [batch.column("doc_id"), pa.array(scan.n), pa.array(forms, pa.string()), pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), pa.array(digests, pa.string()), pa.array(back, pa.string())]
        return pa.RecordBatch.from_arrays(columns + ([pa.array(outputs, pa.string())] if texts else []), NAMES + (["output"] if texts else []))

    return map_batches(docs, run, RESULT + (", output string" if texts else ""))


# --- giant documents ----------------------------------------------------------------------------------------------------------

FUNCTION = "key long, slice int, doc_id long, h1 long, h2 long, h3 long, h4 long, ends array<int>, units array<long>, marks array<long>"
ENTERED = "key long, slice int, entry int, base long, units long, n long, form string, low long, high long"
PIECE = "key long, doc_id long, n long, form string, low long, high long, place int, at long, bytes binary"


def _arrays(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def pieces(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """PIECE rows of every (doc_id, text, h1 to h4): ordered by key, place and at, the bytes of a key are its output."""
    machine = Automaton()
    data = F.col("text").cast("binary")
    number = F.greatest(F.ceil(F.octet_length("text") / slice_bytes), F.lit(1)).cast("int")
    keyed = docs.withColumn("key", F.monotonically_increasing_id()).withColumn("slice", F.explode(F.sequence(F.lit(0), number - 1)))
    body = F.substring(data, F.col("slice") * slice_bytes + 1, F.lit(slice_bytes))
    slices = cut(keyed.select("key", "slice", "doc_id", "h1", "h2", "h3", "h4", body.alias("bytes")).repartition(partitions(docs.sparkSession), "key", "slice"))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                scan = Scan(machine, np.frombuffer(r["bytes"], np.uint8), np.array([0, len(r["bytes"])]))
                yield _arrays([(*(r[c] for c in ("key", "slice", "doc_id", "h1", "h2", "h3", "h4")), *(x.tolist() for x in scan.functions()))], FUNCTION)

    def compose(table: pa.Table) -> pa.Table:
        """One document's functions in order: the state, and the units before, of every slice; then its cuts."""
        rows = table.sort_by("slice").to_pylist()
        state = n = marks = 0
        entered = []
        for r in rows:
            entered.append((r["key"], r["slice"], state, n, r["units"][state]))
            n, marks, state = n + r["units"][state], marks + r["marks"][state], r["ends"][state]
        one, two = rows[0]["h1"] % (n + 1), rows[0]["h2"] % (n + 1)
        form = form_of(n, marks, rows[0]["h3"], rows[0]["h4"])
        return pa.Table.from_batches([_arrays([(*e, n, form, min(one, two), max(one, two)) for e in entered], ENTERED)])

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                body, ends = r["bytes"], []
                for x in (r["low"] - r["base"], r["high"] - r["base"]):
                    if 0 < x <= r["units"]:  # bytes after the slice's last unit begin the next slice's first
                        scan = Scan(machine, np.frombuffer(body, np.uint8), np.array([0, len(body)]), np.array([r["entry"]]))
                        ends.append(int(scan.after(np.zeros(1, np.int64), np.array([x]))[0]))
                    else:
                        ends.append(0 if x <= 0 else len(body))
                head = (r["key"], r["doc_id"], r["n"], r["form"], r["low"], r["high"])
                if r["form"] == "plain":
                    yield _arrays([(*head, 0, r["slice"], body)], PIECE)
                    continue
                parts = (body[: ends[0]], body[ends[0] : ends[1]], body[ends[1] :])
                rows = [(*head, ORDER[r["form"]].index(p), r["slice"], part) for p, part in enumerate(parts) if part]
                if r["slice"] == 0:
                    rows += [(*head, ORDER[r["form"]].index(p), -1, mark) for p, mark in MARK_OF.items()]
                yield _arrays(rows, PIECE)

    functions = slices.mapInArrow(sum_up, FUNCTION)
    entered = functions.groupBy("key").applyInArrow(compose, ENTERED)
    joined = slices.select("key", "slice", "doc_id", "bytes").join(entered, ["key", "slice"])
    return joined.mapInArrow(divide, PIECE)


def _streamed(df: DataFrame, order: list[str], run, schema: str) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), "key").sortWithinPartitions("key", *order).mapInArrow(run, schema)


def read_pieces(parts: DataFrame) -> DataFrame:
    """RESULT of documents in pieces: outputs are hashed as they stream by, their parts are found by the control strings in them, put in the text's order and hashed again."""
    told = "key long, doc_id long, n long, form string, low long, high long"
    outputs = f"{told}, output_sha256 string, part int, at long, bytes binary"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, held, part, at = None, hashlib.sha256(), b"", 0, 0

        def close():
            return _arrays([(*head, digest.hexdigest(), part, at, held)], outputs)

        for batch in batches:
            for r in batch.to_pylist():
                own = tuple(r[c] for c in ("key", "doc_id", "n", "form", "low", "high"))
                if own != head:
                    if head is not None:
                        yield close()
                    head, digest, held, part, at = own, hashlib.sha256(), b"", 0, 0
                digest.update(r["bytes"])
                held += r["bytes"]
                found = []
                while own[3] != "plain" and (hits := [(held.index(m), p) for p, m in MARK_OF.items() if m in held]):
                    place, following = min(hits)
                    found.append((*own, None, part, at, held[:place]))
                    held, part, at = held[place + 3 :], following, at + 1
                keep = 2 if own[3] != "plain" else 0  # a control string may go on in the next piece
                found.append((*own, None, part, at, held[: len(held) - keep]))
                held, at = held[len(held) - keep :] if keep else b"", at + 1
                yield _arrays(found, outputs)
        if head is not None:
            yield close()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, digest = None, None, hashlib.sha256()

        def close():
            _, doc_id, n, form, low, high = head
            plain = form == "plain"
            return _arrays([(doc_id, n, form, None if plain else low, None if plain else high - low, sha, digest.hexdigest())], RESULT)

        for batch in batches:
            for r in batch.to_pylist():
                own = tuple(r[c] for c in ("key", "doc_id", "n", "form", "low", "high"))
                if own != head:
                    if head is not None:
                        yield close()
                    head, sha, digest = own, None, hashlib.sha256()
                sha = r["output_sha256"] or sha
                digest.update(r["bytes"])
        if head is not None:
            yield close()

    return _streamed(_streamed(parts, ["place", "at"], parse, outputs), ["part", "at"], again, RESULT)


def fill_in_middle(docs: DataFrame, seed: str = "1", whole_bytes: int = WHOLE_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """RESULT for every text. Texts up to whole_bytes stay where they are read; longer ones are cut between machines."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns(choices(seed))
    longest = rows.agg(F.max(F.octet_length("text"))).first()[0] or 0
    if longest <= whole_bytes:
        return _whole(rows, False)
    small, big = rows.filter(F.octet_length("text") <= whole_bytes), rows.filter(F.octet_length("text") > whole_bytes)
    return _whole(small, False).unionByName(read_pieces(pieces(big, slice_bytes)))


def outputs(docs: DataFrame, seed: str = "1") -> DataFrame:
    """RESULT and the output itself, for texts that fit a task."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return _whole(rows.withColumns(choices(seed)), True)
