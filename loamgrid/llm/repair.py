"""Conversation structure repair: the cheapest edits that make role initials follow `(s?(ua)+)?`, by a rank-compressed dynamic program.

A macro edit is a run of inserted turns and what is done with the next turn: I, II or nothing, then Delete, Keep or Rerole. Those nine
codes are prefix-free, so audits of equally many turns compare like their sequences of codes. A layer of the program holds for each state only
the least cost and the rank of its audit among the layer's audits, with pointers to the layer before; audits are written once, backwards, for the
path that wins. Ranks and relative costs take few values, so steps from layer to layer are kept and looked up.

Turns are dealt to partitions by ranges of (conversation, turn), so that a conversation of any size spreads out. One that lies inside a
partition and fits HELD_ROWS and HELD_BYTES is repaired there. The others go on as segments: a segment is summed up by the least cost and rank from each state to each, those
compose along the conversation, and each segment then writes its own part of the audit. Copies of a turn are counted before the shuffle.
Only the digest of the repaired text is sequential: it streams through one task in bounded memory; the audit is one string, as its column asks.

Edge cases: null roles and texts are one space; turns stand by turn (nulls first), ties by role and text; a null conv_id is one conversation; rows that
repeat are duplicates; an empty table gives no rows; other columns are left out; a conversation without turns has zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, small_batches

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: States: nothing said, system said, user said last, assistant said last. An inserted or reroled turn gets the role that each state wants.
WANTS, MOVES = "uuau", (2, 2, 3, 2)
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: What a conversation that ends in each state still needs.
TAIL = ("", "II", "I", "")
CODES = sorted("I" * n + edit for n in range(3) for edit in "DKR")
#: Faults of a turn.
GOOD, BLANK, DUPLICATE, CUT_OFF = range(4)
#: Larger conversations, and those at the ends of a partition, go on in segments of so many turns.
HELD_ROWS, HELD_BYTES, SEGMENT = 4096, 8 << 20, 4096
PARTITION_BYTES = 32 << 20
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _edges(initial: str, fault: int) -> list[list[tuple[int, int, int]]]:
    """For every state: (next state, cost, rank of the code) of each macro edit of such a turn."""
    found: list[list[tuple[int, int, int]]] = []
    for state in range(4):
        out = []
        for rank, code in enumerate(CODES):
            at, cost = state, INSERT * (len(code) - 1)
            for _ in code[1:]:
                at = MOVES[at]
            if code[-1] == "D":
                out.append((at, cost + DELETE, rank))
            elif fault not in (BLANK, DUPLICATE):
                cost += TRUNCATED * (fault == CUT_OFF)
                if code[-1] == "R":
                    out.append((MOVES[at], cost + REROLE, rank))
                elif (initial, at) in KEEPS:
                    out.append((KEEPS[initial, at], cost, rank))
        found.append(out)
    return found


EDGES = {(i, f): _edges(i, f) for i in ("s", "u", "a", "") for f in (GOOD, DUPLICATE, CUT_OFF)}
Layer = tuple  # of (cost, rank) or None at 4 * start + state
_steps: dict[tuple, tuple[Layer, int, tuple]] = {}


def kind_of(role: str, fault: int) -> tuple[str, int]:
    return role[:1] if role[:1] in ("s", "u", "a") else "", DUPLICATE if fault == BLANK else fault


def step(layer: Layer, kind: tuple[str, int]) -> tuple[Layer, int, tuple]:
    """The next layer with costs above its least one, that least cost, and (place in the layer before, code) of every place."""
    known = _steps.get((layer, kind))
    if known is None:
        best: dict[int, tuple] = {}
        for at, entry in enumerate(layer):
            if entry is not None:
                for to, cost, code in EDGES[kind][at % 4]:
                    slot, key = at - at % 4 + to, (entry[0] + cost, entry[1], code, at)
                    if slot not in best or key < best[slot]:
                        best[slot] = key
        base = min(k[0] for k in best.values())
        ranks = {x: i for i, x in enumerate(sorted({k[1:3] for k in best.values()}))}
        places = range(len(layer))
        known = (
            tuple((best[p][0] - base, ranks[best[p][1:3]]) if p in best else None for p in places),
            base,
            tuple((best[p][3], best[p][2]) if p in best else None for p in places),
        )
        if len(_steps) < 1 << 16:
            _steps[layer, kind] = known
    return known


def layers(kinds: Iterable[tuple[str, int]], starts: int) -> tuple[Layer, int, list[tuple]]:
    """Last layer from `starts` start states (0 onwards), the cost to add to it, and the pointers of all layers."""
    layer: Layer = tuple((0, 0) if p % 5 == 0 else None for p in range(4 * starts))
    total, pointers = 0, []
    for kind in kinds:
        layer, base, back = step(layer, kind)
        total += base
        pointers.append(back)
    return layer, total, pointers


def written(pointers: list[tuple], place: int) -> str:
    """The audit of the path that ends at a place of the last layer."""
    codes = []
    for back in reversed(pointers):
        place, code = back[place]
        codes.append(CODES[code])
    return "".join(reversed(codes))


def best_end(layer: Layer | list) -> tuple[int, int]:
    """(cost with the tail, state) of the best end among the first four places."""
    ends = [(x[0] + INSERT * len(TAIL[s]), x[1], TAIL[s], s) for s, x in enumerate(layer[:4]) if x is not None]
    least = min(ends)
    return least[0], least[3]


class Mender:
    """Says the repaired turns of one conversation, edit by edit."""

    def __init__(self):
        self.state, self.said, self.digest = 0, 0, hashlib.sha256()

    def say(self, role: str, text: str) -> None:
        self.digest.update((f"\n{role}:{text}" if self.said else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.said += 1

    def edit(self, mark: str, role: str = "", text: str = "") -> None:
        if mark == "K":
            self.state = KEEPS[role[:1], self.state]
            self.say(role, text)
        elif mark != "D":
            name = ROLES[WANTS[self.state]]
            self.state = MOVES[self.state]
            self.say(name, text if mark == "R" else "")


class Tally:
    """Faults, turn numbers and role pairs of turns in order; tallies of neighbouring segments add up."""

    FIELDS = ("rows", "blank", "duplicate", "truncated", "illegal", "numbers", "low", "high", "head", "last")

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.low = self.high = None  # turn numbers
        self.head = self.last = None  # role initials

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.rows += 1
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT_OFF
        if self.last is None:
            self.head = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        if turn is not None:
            self.numbers += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def follow(self, other: dict) -> None:
        """Add the tally of the next segment, as a mapping."""
        if not other["rows"]:
            return
        for name in ("rows", "blank", "duplicate", "truncated", "illegal", "numbers"):
            setattr(self, name, getattr(self, name) + other[name])
        if self.last is None:
            self.head = other["head"]
        else:
            self.illegal += self.last + other["head"] not in LEGAL
        self.last = other["last"]
        if other["low"] is not None:
            self.numbers -= self.high == other["low"]
            self.low, self.high = other["low"] if self.low is None else self.low, other["high"]

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.numbers

    def counts(self) -> list[int]:
        return [self.gaps(), self.blank, self.duplicate, self.truncated, self.illegal]


def own_fault(text: str) -> int:
    """The fault that a text has by itself."""
    bare = text.rstrip(SPACE)
    return BLANK if not bare else GOOD if bare.endswith(ENDS) else CUT_OFF


def solved(conv: int | None, turns: list[tuple]) -> tuple:
    """The result row of a conversation whose (turn, role, text, copies) are at hand."""
    tally, seen, rows, kinds = Tally(), set(), [], []
    for turn, role, text, copies in turns:
        fault = own_fault(text)
        for _ in range(copies):
            now = fault if fault == BLANK or (role, text) not in seen else DUPLICATE
            seen.add((role, text))
            tally.add(turn, role[:1], now)
            kinds.append(kind_of(role, now))
            rows.append((role, text))
    layer, total, pointers = layers(kinds, 1)
    cost, state = best_end(layer)
    audit = written(pointers, state) + TAIL[state]
    mender, at = Mender(), 0
    for mark in audit:
        role, text = rows[at] if mark != "I" else ("", "")
        mender.edit(mark, role, text)
        at += mark != "I"
    return (conv, *tally.counts(), total + cost, audit, mender.digest.hexdigest())


# --- on Spark -------------------------------------------------------------------------------------------------------------

ROWS = "conv_id long, turn long, role string, text string, copies int"
OPEN = "sid long, seq long, turn long, role string, text string, copies int, again boolean, fault int, digest binary"
SCANNED = f"{RESULT}, {OPEN}"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch become one with their number, so that a turn repeated very often moves as few rows."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["conv_id", "turn", "role", "text", "copies"]).aggregate([([], "count_all")])
        copies = np.asarray(table.column("copies")).astype(np.int32) * np.asarray(table.column("count_all")).astype(np.int32)
        yield from table.select(["conv_id", "turn", "role", "text"]).append_column("copies", pa.array(copies)).combine_chunks().to_batches()


def _scan(held_rows: int, held_bytes: int, segment: int):
    """Rows of a sorted partition: results of the conversations that lie inside it, and the numbered turns of the others."""

    class Scan:
        def __init__(self):
            self.part, self.seg, self.seq = TaskContext.get().partitionId(), -1, 0
            self.conv: object = Scan  # no conversation yet
            self.first, self.open = True, False
            self.turns: list[tuple] = []
            self.size = self.filled = 0
            self.seen: set[bytes] = set()
            self.out: list[tuple] = []

        def flush(self) -> None:
            """What is held goes on as segments."""
            for turn, role, text, copies in self.turns:
                if not self.open or self.filled >= segment:
                    self.seg, self.filled, self.open = self.seg + 1, 0, True
                digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
                again = copies > 0 and digest in self.seen
                if copies:
                    self.seen.add(digest)
                self.out.append((self.conv, *[None] * (len(NAMES) - 1), (self.part << 32) + self.seg, self.seq, turn, role, text, copies, again, own_fault(text), digest))
                self.seq += 1
                self.filled += max(copies, 1)
            self.turns, self.size = [], 0

        def close(self, last: bool) -> None:
            if self.conv is not Scan:
                if self.first or last or self.open:
                    self.flush()
                else:
                    self.out.append((*solved(self.conv, self.turns), *[None] * 9))
                self.first = False
            self.turns, self.size, self.open, self.seen = [], 0, False, set()

        def take(self, row: tuple) -> None:
            conv, turn, role, text, copies = row
            if conv != self.conv:
                self.close(False)
                self.conv = conv
            self.turns.append((turn, role, text, copies))
            self.size += 4 * len(text) + 64
            if self.open or len(self.turns) + copies > held_rows or self.size > held_bytes:
                self.flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                scan.take(row)
                if len(scan.out) >= 1024:
                    yield _batch(scan.out, SCANNED)
                    scan.out = []
        scan.close(True)
        if scan.out:
            yield _batch(scan.out, SCANNED)

    return run


def _faults(table: pa.Table) -> list[tuple]:
    """(turn, role, fault) of a segment's turns in order, copies one by one."""
    out = []
    for row in table.sort_by("seq").select(["turn", "role", "fault", "copies", "dup"]).to_pylist():
        for i in range(row["copies"]):
            out.append((row["turn"], row["role"], row["fault"] if row["fault"] == BLANK or not (row["dup"] or i) else DUPLICATE))
    return out


SUMMARY = "sid long, conv_id long, rows long, blank long, duplicate long, truncated long, illegal long, numbers long, low long, high long, head string, last string, costs array<long>, ranks array<long>"


def _summary(table: pa.Table) -> pa.Table:
    turns = _faults(table)
    tally = Tally()
    for turn, role, fault in turns:
        tally.add(turn, role[:1], fault)
    layer, total, _ = layers([kind_of(role, fault) for _, role, fault in turns], 4)
    costs = [None if x is None else x[0] + total for x in layer]
    row = (table.column("sid")[0].as_py(), table.column("conv_id")[0].as_py(), *(getattr(tally, f) for f in Tally.FIELDS), costs, [None if x is None else x[1] for x in layer])
    return pa.Table.from_batches([_batch([row], SUMMARY)])


CHOICE = "sid long, entry int, leave int, tail string, final boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries by conversation and segment to the states in which the best path enters and leaves every segment."""
    conv: object = _composed
    vector: list = []
    back: list[tuple] = []
    tally = Tally()

    def close() -> Iterator[pa.RecordBatch]:
        if not back:
            return
        cost, state = best_end(vector)
        rows, tail, final = [], TAIL[state], True
        for sid, entries in reversed(back):
            rows.append((sid, entries[state], state, tail, final, *(tally.counts() if final else [None] * 5), cost if final else None))
            state, tail, final = entries[state], "", False
            if len(rows) == 4096:
                yield _batch(rows, CHOICE)
                rows = []
        if rows:
            yield _batch(rows, CHOICE)

    for batch in batches:
        for row in batch.to_pylist():
            if row["conv_id"] != conv:
                yield from close()
                conv, vector, back, tally = row["conv_id"], [(0, 0), None, None, None], [], Tally()
            best: list = [None] * 4
            for m, x in enumerate(vector):
                for t in range(4):
                    if x is not None and row["costs"][4 * m + t] is not None:
                        key = (x[0] + row["costs"][4 * m + t], x[1], row["ranks"][4 * m + t], m)
                        best[t] = key if best[t] is None else min(best[t], key)
            order = sorted({k[1:3] for k in best if k})
            back.append((row["sid"], tuple(k[3] if k else None for k in best)))
            vector = [(k[0], order.index(k[1:3])) if k else None for k in best]
            tally.follow(row)
    yield from close()


def _written(table: pa.Table, choice: pa.Table) -> pa.Table:
    """The part of the audit that a segment has."""
    turns, chosen = _faults(table), choice.to_pylist()[0]
    _, _, pointers = layers([kind_of(role, fault) for _, role, fault in turns], 4)
    audit = written(pointers, 4 * chosen["entry"] + chosen["leave"]) + chosen["tail"]
    return pa.Table.from_batches([_batch([(table.column("conv_id")[0].as_py(), chosen["sid"], audit, chosen["final"], *(chosen[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")))], PART)])


PART = "conv_id long, sid long, audit string, final boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of audits, each before its turns, and the turns, in order, to result rows."""
    conv: object = _digested
    mender, audits, queue, at, totals = Mender(), [], "", 0, None

    def row() -> pa.RecordBatch:
        nonlocal at
        while at < len(queue):  # what is inserted at the end
            mender.edit(queue[at])
            at += 1
        return _batch([(conv, *totals, "".join(audits), mender.digest.hexdigest())], RESULT)

    for batch in batches:
        for r in batch.to_pylist():
            if r["conv_id"] != conv:
                if totals is not None:
                    yield row()
                conv, mender, audits, queue, at, totals = r["conv_id"], Mender(), [], "", 0, None
            if r["audit"] is not None:
                audits.append(r["audit"])
                queue, at = queue[at:] + r["audit"], 0
                if r["final"]:
                    totals = (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"])
                continue
            for _ in range(r["copies"]):
                while queue[at] == "I":
                    mender.edit("I")
                    at += 1
                mender.edit(queue[at], r["role"], r["text"])
                at += 1
    if totals is not None:
        yield row()


def repair(turns: DataFrame, held_rows: int = HELD_ROWS, held_bytes: int = HELD_BYTES, segment: int = SEGMENT, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """RESULT for every conversation of (conv_id, turn, role, text). Rows whose column `gone` is true are no turns, but their conversations are returned."""
    spark = turns.sparkSession
    small_batches(spark)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    here = lambda c, kind: F.when(~gone, c).otherwise(F.lit(None).cast(kind))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        here(F.col("turn").cast("long"), "long").alias("turn"),
        F.when(gone, "").otherwise(space("role")).alias("role"),
        F.when(gone, "").otherwise(space("text")).alias("text"),
        F.when(gone, 0).otherwise(1).alias("copies"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(spark), -(-total // partition_bytes))
    # heads of the texts stand for them in the ranges: what orders the rows is never sampled whole
    dealt = rows.mapInArrow(_counted, ROWS).repartitionByRange(n, "conv_id", "turn", F.substring("role", 1, 16), F.substring("text", 1, 32))
    scanned = cut(dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_scan(held_rows, held_bytes, segment), SCANNED))
    done = scanned.filter("sid IS NULL").select(*NAMES)
    rest = scanned.filter("sid IS NOT NULL").select("conv_id", *[c.split()[0] for c in OPEN.split(", ")])
    # of equal turns each partition has marked all but its first: at most one for each partition is compared
    light = rest.select("sid", "seq", "conv_id", "turn", "role", "copies", "fault", "again", "digest")
    earlier = F.col("sid") > F.min("sid").over(Window.partitionBy("conv_id", "digest"))
    firsts = light.filter("NOT again AND copies > 0").withColumn("dup", earlier)
    flagged = firsts.unionByName(light.filter("again OR copies = 0").withColumn("dup", F.col("again"))).drop("again", "digest")
    summaries = flagged.groupBy("sid").applyInArrow(_summary, SUMMARY)
    choices = summaries.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "sid").mapInArrow(_composed, CHOICE)
    parts = flagged.groupBy("sid").cogroup(choices.groupBy("sid")).applyInArrow(_written, PART)
    said = rest.select("conv_id", "sid", "seq", "role", "text", "copies").unionByName(parts.withColumn("seq", F.lit(-1).cast("long")), allowMissingColumns=True)
    order = said.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "sid", "seq")
    return done.unionByName(order.mapInArrow(_digested, RESULT))


def damage(turns: DataFrame) -> DataFrame:
    """Faults by crc32 of `conv_id:turn` (nulls: one space) modulo 20: 0 drops a turn (`gone`), 1 empties its text, 2 takes its `[.!?]`, 3 repeats it, 4 sets role user."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    hit: Column = F.crc32(F.concat(space(F.col("conv_id")), F.lit(":"), space(F.col("turn"))).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.translate(space(F.col("text")), ".!?", "")).otherwise(space(F.col("text")))
    role = F.when(hit == 4, "user").otherwise(space(F.col("role")))
    times = F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    made = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (hit == 0).alias("gone"), F.explode(times).alias("_copy"))
    return made.drop("_copy")
