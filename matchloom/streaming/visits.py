"""Revisit state per source or player as keyed stream state, with a timer for the next visit.

Each key has one small value: counters, the last good capture, the last error, the due time. A batch of visits moves it on; nothing is
read again of earlier visits. A timer stands at the due time: when the stream's clock (the watermark over visit times) has passed it without a
new visit, a row ``due`` leaves the stream, once. State survives a restart in the stream's checkpoint, and ``visit_table``
reads it from there as a table.

A batch's visits of a key may come in any order; only its visits since the last success are held while it is worked on. Across batches a key's visits
come in the order of ``seq``, as the next is planned only when the last has reported; one that comes later counts in ``generation`` and
``late`` alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = (
    "generation bigint, failures bigint, zero_new_streak bigint, late bigint, seq bigint, at bigint, ok boolean, error string, "
    "fetched_at bigint, last_new bigint, html_sha256 string, due double")
NAMES = [x.split(" ")[0] for x in STATE.split(", ")]
BEFORE_ANY = (0, 0, 0, 0, None, None, None, None, None, None, None, None)
#: What leaves the stream: a state after each batch that moved it, and a row when a due time has passed.
OUTPUT = f"key string, kind string, {STATE}"


class Batch:
    """The visits of one key in one batch, in any order, by what is held of them."""

    def __init__(self, after: int | None):
        self.after, self.n, self.late = after, 0, 0
        self.last = self.good = self.new = None  # (seq, ...): the last visit, the last success, the last one with new items
        self.failed: list[int] = []  # seq of failures since the last success
        self.empty: list[int] = []  # and of successes since the last new items

    def add(self, seq, at, ok, new, error, digest) -> None:
        self.n += 1
        if self.after is not None and seq <= self.after:
            self.late += 1
            return
        if self.last is None or seq > self.last[0]:
            self.last = (seq, at, ok, error)
        if not ok:
            if self.good is None or seq > self.good[0]:
                self.failed.append(seq)
            return
        if self.good is None or seq > self.good[0]:
            self.good = (seq, at, new, digest)
            self.failed = [s for s in self.failed if s > seq]
        if new is not None and new > 0:
            if self.new is None or seq > self.new:
                self.new = seq
                self.empty = [s for s in self.empty if s > seq]
        elif self.new is None or seq > self.new:
            self.empty.append(seq)


def moved(state: tuple, batch: Batch, base: float, longest: float, failure_base: float) -> tuple:
    """The state after a batch."""
    s = dict(zip(NAMES, state))
    s["generation"] += batch.n
    s["late"] += batch.late
    if batch.last is None:
        return tuple(s[n] for n in NAMES)
    s["failures"] = len(batch.failed) + (s["failures"] if batch.good is None else 0)
    s["zero_new_streak"] = len(batch.empty) + (s["zero_new_streak"] if batch.new is None else 0)
    s["seq"], s["at"], s["ok"], s["error"] = batch.last
    if batch.good is not None:
        _, s["fetched_at"], s["last_new"], s["html_sha256"] = batch.good
    wait = base * 2.0 ** min(s["zero_new_streak"], 8) if s["ok"] else failure_base * 2.0 ** min(s["failures"] - 1, 8)
    s["due"] = s["at"] + min(longest, wait)
    return tuple(s[n] for n in NAMES)


def _plain(value):
    return None if value is None or value is pd.NaT or (isinstance(value, float) and value != value) else value.item() if hasattr(value, "item") else value


class Visits(StatefulProcessor):
    def __init__(self, base: float, longest: float, failure_base: float):
        self.base, self.longest, self.failure_base = base, longest, failure_base

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("visit", STATE)

    def _row(self, key, kind: str, state: tuple) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "kind": [kind]} | {n: pd.Series([v], dtype=object) for n, v in zip(NAMES, state)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(map(_plain, self.state.get())) if self.state.exists() else BEFORE_ANY
        batch = Batch(before[NAMES.index("seq")])
        for part in rows:
            for values in zip(*(part[c] for c in ("seq", "at", "ok", "new_count", "error", "html_sha256"))):
                batch.add(*map(_plain, values))
        state = moved(before, batch, self.base, self.longest, self.failure_base)
        self.state.update(state)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = state[NAMES.index("due")]
        if due is not None:
            self.handle.registerTimer(int(due * 1000))
        yield self._row(key, "state", state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key, "due", tuple(map(_plain, self.state.get())))

    def close(self) -> None:
        pass


def visit_stream(log: DataFrame, key: str, base: float, longest: float, failure_base: float = 300.0, lateness: str = "0 seconds") -> DataFrame:
    """Visits (``seq``, ``at`` in seconds, ``ok``, ``new_count``, ``error``, ``html_sha256``) to states and due rows. The clock runs a millisecond
    ahead of the visits, so that a time that is due exactly now has passed. The session's
    state store provider has to be RocksDB's."""
    timed = log.select(
        F.col(key).cast("string").alias("key"), "seq", F.col("at").cast("bigint").alias("at"), "ok", F.col("new_count").cast("bigint").alias("new_count"),
        "error", "html_sha256", F.timestamp_millis(F.col("at").cast("bigint") * 1000 + 1).alias("_time")).withWatermark("_time", lateness)
    return timed.groupBy("key").transformWithStateInPandas(
        Visits(base, longest, failure_base), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


def visit_table(spark: SparkSession, checkpoint: str, key: str, base: float) -> DataFrame:
    """The state of a stream as it stands in its checkpoint, in the columns of ``revisit.visit_state``."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "visit").load()
    s = held.select(F.col("key.key").alias(key), "value.*")
    return s.select(
        key, "generation", "failures", "zero_new_streak", "fetched_at", (F.col("fetched_at") + base).alias("cache_expires_at"), "last_new", "html_sha256",
        F.when(~F.col("ok"), F.coalesce("error", F.lit(""))).alias("last_error"), "due")
