"""Streams with state of their own shape: change detection that starts from the published index, and a queue of deferred work.

Both are processors for ``transformWithStateInPandas``; their state lies in RocksDB beside the query's checkpoint, so a restart
goes on where the last micro-batch ended. State is read and written by key, never as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INDEXED = "url string, consumed string, indexed boolean"
VERDICTS = "url string, probed_at timestamp, verdict string, sha256 string"


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, which these processors need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def _text(x: object) -> str | None:
    return x if isinstance(x, str) else None


class Detector(StatefulProcessor):
    """The verdict of each event of a URL. ``seen`` moves with every content, ``consumed`` only with a good parse.

    Both have a time of their own: a probe older than the last one and a consumption older than the last one are ignored.
    404 and 410 are final, or with ``forget_ms`` until the watermark has passed them by so much."""

    STATE = "seen string, consumed string, dead boolean, at long, consumed_at long, indexed boolean"
    FRESH = (None, None, False, -1, -1, False)

    def __init__(self, forget_ms: int | None = None) -> None:
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("url", self.STATE)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:  # noqa: N803
        for r in initialState.itertuples():
            self.state.update((None, _text(r.consumed), False, -1, -1, bool(r.indexed)))

    def step(self, s: tuple, kind: str, at: int, status: int, sha256: str | None) -> tuple[tuple, str]:
        seen, consumed, dead, last, used, indexed = s
        if kind == "consumed":
            return ((seen, sha256, dead, last, at, indexed), "consumed") if at >= used else (s, "ignored")
        if dead or at < last:
            return s, "ignored"
        if status in (404, 410):
            if self.forget_ms is not None:
                self.handle.registerTimer(at // 1000 + self.forget_ms)
            return (seen, consumed, True, at, used, indexed), "dead"
        if status == 304:
            return (seen, consumed, dead, at, used, indexed), "unchanged"
        if status != 200 or sha256 is None:
            return s, "error"
        verdict = "new" if not indexed else "baseline"
        if consumed is not None:
            verdict = "changed" if consumed != sha256 else "same"
        return (sha256, consumed, dead, at, used, indexed), verdict

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        now = tuple(self.state.get()) if self.state.exists() else self.FRESH
        events, out = pd.concat(list(rows)).sort_values(["probed_at", "kind", "sha256"], na_position="first"), []  # one URL's events of one micro-batch
        for r in events.itertuples():
            status = -1 if r.status is None or r.status != r.status else int(r.status)
            now, verdict = self.step(now, r.kind, r.probed_at.value // 1000, status, _text(r.sha256))
            out.append((key[0], r.probed_at, verdict, _text(r.sha256)))
        self.state.update(now)
        yield pd.DataFrame(out, columns=["url", "probed_at", "verdict", "sha256"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N803
        """A URL that died long ago is tried afresh; what was consumed of it stays known."""
        if self.state.exists():
            seen, consumed, _, last, used, indexed = self.state.get()
            self.state.update((seen, consumed, False, last, used, indexed))
        yield pd.DataFrame([], columns=["url", "probed_at", "verdict", "sha256"])


def detect_changes(events: DataFrame, index: DataFrame | None = None, forget_ms: int | None = None) -> DataFrame:
    """Verdicts of a stream of url, kind (probe or consumed), probed_at, status, sha256.

    ``index`` (url, consumed, indexed) is the state to begin with, read once, when the query is first started: a URL that it
    has is a baseline at first sight, or compared with what was consumed. ``forget_ms`` needs a watermark on ``probed_at``."""
    first = index.selectExpr("url", "consumed", "indexed").groupBy("url") if index is not None else None
    return events.groupBy("url").transformWithStateInPandas(Detector(forget_ms), VERDICTS, "Append", "None" if forget_ms is None else "EventTime", initialState=first)


class Queue(StatefulProcessor):
    """A lane's rows in the order of arrival; each wave lets at most ``most`` of them pass, those deferred before first.

    A wave is a micro-batch that brings the lane rows, or with ``timer_ms`` also the timer that is set while rows wait. A
    row is written to state only if it has to wait, and read once when its turn comes."""

    def __init__(self, most: int, columns: list[str], schema: str, order: list[str], timer_ms: int | None = None) -> None:
        self.most, self.columns, self.schema, self.order, self.timer_ms = most, columns, schema, order, timer_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ends = handle.getValueState("ends", "head long, tail long, wave long")
        self.waiting = handle.getMapState("waiting", "place long", self.schema)

    def wave(self, key: tuple, fresh: list[tuple], now_ms: int) -> pd.DataFrame:
        head, tail, wave = self.ends.get() if self.ends.exists() else (0, 0, 0)
        wave += 1
        passing = []
        while head < tail and len(passing) < self.most:
            passing.append((True, *self.waiting.getValue((head,))))
            self.waiting.removeKey((head,))
            head += 1
        room = self.most - len(passing)
        passing += [(False, *r) for r in fresh[:room]]
        for r in fresh[room:]:
            self.waiting.updateValue((tail,), r)
            tail += 1
        self.ends.update((head, tail, wave))
        if self.timer_ms is not None and head < tail:
            self.handle.registerTimer(now_ms + self.timer_ms)
        return pd.DataFrame([(key[0], wave, *r) for r in passing], columns=["lane", "wave", "deferred", *self.columns])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        df = pd.concat(list(rows)).sort_values(self.order)[self.columns].astype(object)
        fresh = [tuple(r) for r in df.itertuples(index=False)]
        yield self.wave(key, fresh, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N803
        yield self.wave(key, [], timerValues.getCurrentProcessingTimeInMs())


def bounded_waves(changed: DataFrame, most: int, lanes: int, order: list[str], lane: Column | None = None, timer_ms: int | None = None) -> DataFrame:
    """lane, wave, deferred and the columns of ``changed``: at most ``most`` rows of each lane pass in a wave, the rest waits its turn.

    A lane is a share of the keys (of ``url``, unless ``lane`` says otherwise), so that work is bounded and spread at once:
    ``lanes * most`` rows a wave."""
    columns = changed.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema.fields)
    number = lane if lane is not None else F.crc32(F.col("url").cast("string"))
    dealt = changed.withColumn("__lane", F.pmod(number, F.lit(lanes)).cast("int"))
    return dealt.groupBy("__lane").transformWithStateInPandas(Queue(most, columns, schema, order, timer_ms), f"lane int, wave long, deferred boolean, {schema}", "Append", "None" if timer_ms is None else "ProcessingTime")
