"""Release states as a stream: events fold into a keyed state, and a timer at the scheduled date does what a date does, no more.

A row comes out whenever a key's state changes, with a number that counts its changes; the row of the highest number is the key's state now. What has
been seen is kept by kind, and of scheduled dates the one that was announced last, so events may come in any order; events behind the watermark
are dropped by Spark. The day of the watermark stands for "today". Null keys, kinds and times are left out before.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.gates import transition
from ..session import ship

EVENTS = "key string, ts timestamp, kind string, release date"
CHANGES = "key string, nth long, state string, candidate_eligible boolean"
KINDS = ("confirmed", "scoped", "applied", "upstream")
MEMORY = "confirmed boolean, scoped boolean, applied boolean, upstream boolean, announced long, release long, nth long, state string"
DAY = 86_400_000


def state_of(confirmed: bool, scoped: bool, applied: bool, upstream: bool, release: int | None, today: int) -> str:
    """The same order of cases as `gates.transition`, for one key; release and today are days."""
    if scoped and applied:
        return "CURRENT_SCOPED_RECONCILED"
    if confirmed:
        return "READY_FOR_GUARDED_REINGESTION" if upstream else "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION"
    if release is None:
        return "UPCOMING_HOLD_NO_RELEASE_DATE"
    return "PRE_RELEASE_HOLD" if today < release else "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS"


class Releases(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", MEMORY)

    def _said(self, key, memory: dict, watermark: int) -> Iterator[Row]:
        state = state_of(*(memory[k] for k in KINDS), memory["release"], watermark // DAY)
        if state != memory["state"]:
            memory["state"], memory["nth"] = state, memory["nth"] + 1
            yield Row(key=key[0], nth=memory["nth"], state=state, candidate_eligible=state == "READY_FOR_GUARDED_REINGESTION")
        self.memory.update(tuple(memory[c.split()[0]] for c in MEMORY.split(", ")))

    def _recalled(self) -> dict:
        names = [c.split()[0] for c in MEMORY.split(", ")]
        known = self.memory.get()
        return dict(zip(names, known, strict=True)) if known else dict(zip(names, (False, False, False, False, None, None, 0, None), strict=True))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        memory = self._recalled()
        before = memory["release"]
        for row in rows:
            if row.kind in KINDS:
                memory[row.kind] = True
            elif row.kind == "scheduled":
                at = int(row.ts.replace(tzinfo=row.ts.tzinfo or UTC).timestamp() * 1_000_000)
                day = None if row.release is None else (row.release - datetime(1970, 1, 1).date()).days
                if memory["announced"] is None or (at, day or 0) > (memory["announced"], memory["release"] or 0):
                    memory["announced"], memory["release"] = at, day
        if memory["release"] != before:
            if before is not None:
                self.handle.deleteTimer(before * DAY)
            if memory["release"] is not None and memory["release"] * DAY > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(memory["release"] * DAY)
        yield from self._said(key, memory, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._said(key, self._recalled(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def release_states(events: DataFrame, late: str = "1 day") -> DataFrame:
    """CHANGES of a stream of EVENTS. Needs the RocksDB state store."""
    ship(events.sparkSession)
    known = events.filter("key IS NOT NULL AND ts IS NOT NULL AND kind IS NOT NULL").withWatermark("ts", late)
    return known.groupBy("key").transformWithState(Releases(), CHANGES, "Append", "eventTime")


def batch_states(events: DataFrame, as_of: Column) -> DataFrame:
    """key, state and candidate_eligible of all events at once, by `gates.transition`."""
    seen = [F.bool_or(F.col("kind") == k).alias(k) for k in KINDS]
    scheduled = F.max(F.when(F.col("kind") == "scheduled", F.struct("ts", "release"))).alias("s")
    by = events.filter("key IS NOT NULL AND ts IS NOT NULL AND kind IS NOT NULL").groupBy("key").agg(*seen, scheduled)
    state, eligible = transition(F.col("confirmed"), F.col("scoped"), F.col("applied"), F.col("upstream"), F.col("s.release"), as_of)
    return by.select("key", state.alias("state"), eligible.alias("candidate_eligible"))
