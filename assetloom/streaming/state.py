"""Per-key state over streams: stable files and progress throttling.

The rows of a key are handled one at a time in time order, whatever the micro-batches. They wait in
the state, by slots of time, until the watermark has passed their slot; a timer at its end then steps
through them. So rows may arrive in any order within ``late_by``, and a task holds one slot of one key. The
state of a key is one small record, kept in RocksDB, and is forgotten after a silence.

Every look at the state is a call from Python to Spark. With very many keys of few rows each these calls are most of the
work; ``buckets`` then keeps the state by buckets of keys, so that their number goes with the buckets and micro-batches. A
task then holds one slot of one bucket.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle,
                                                      TimerValues)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Rows of a key that are gathered before they go to the state.
GATHERED = 10_000

#: A good number of buckets for millions of keys, and parts in which a bucket keeps the records of its keys.
BUCKETS, SHARDS = 512, 16

TOLD = Row("key", "micros", "place", "value", "told")


class InOrder(StatefulProcessor):
    """Steps through the rows of a key in the order of time and tie-break."""

    #: Schema of the record kept per key; its first column is ``at``, the time of the row it tells of.
    LAST = "at bigint"

    def __init__(self, slot_ms: int, forget_ms: int | None):
        self.slot_ms, self.forget_ms = slot_ms, forget_ms

    def step(self, last: tuple | None, at: int, value: float | None) -> tuple[tuple, bool | None]:
        """The new record, and what is told of the row: nothing if None."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "slot bigint", "rows array<struct<at:bigint,place:bigint,value:double>>")
        self.last = handle.getValueState("last", self.LAST)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        if key[0] is not None:
            slots: dict[int, list[tuple]] = {}
            for n, row in enumerate(rows, 1):
                slots.setdefault(row["micros"] // (1000 * self.slot_ms), []).append((row["micros"], row["place"], row["value"]))
                if n % GATHERED == 0:
                    self._hold(slots)
            self._hold(slots)
        return iter(())

    def _hold(self, slots: dict[int, list[tuple]]) -> None:
        for slot, own in slots.items():
            held = self.held.getValue((slot,))
            self.held.updateValue((slot,), ([*map(tuple, held[0]), *own] if held else own,))
            self.handle.registerTimer((slot + 1) * self.slot_ms)
        slots.clear()

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        slot = (now // self.slot_ms - 1,)
        held = self.held.getValue(slot) if now % self.slot_ms == 0 else None
        last = self.last.get()
        if held:
            for at, place, value in sorted(held[0], key=lambda r: (r[0], r[1] is not None, r[1])):
                if last and self.forget_ms and at - last[0] >= 1000 * self.forget_ms:
                    last = None
                last, told = self.step(last, at, value)
                if told is not None:
                    yield Row(key=key[0], micros=at, place=place, value=value, told=told)
            self.held.removeKey(slot)
            if last:
                self.last.update(last)
                if self.forget_ms:
                    self.handle.registerTimer(last[0] // 1000 + self.forget_ms + 1)
        elif last and self.forget_ms and last[0] // 1000 + self.forget_ms < now:
            self.last.clear()


class Stability(InOrder):
    """For how many rows the size has been the same."""

    LAST = "at bigint, size double, same bigint"

    def __init__(self, slot_ms: int, forget_ms: int | None, checks: int):
        super().__init__(slot_ms, forget_ms)
        self.checks = checks

    def step(self, last, at, value):
        same = last[2] + 1 if last and value is not None and last[1] == value else 0
        return (at, value, same), bool(value) and value > 0 and same >= self.checks


class Throttle(InOrder):
    """The last row let through."""

    LAST = "at bigint, percent double"

    def __init__(self, slot_ms: int, forget_ms: int | None, min_seconds: float, min_points: float):
        super().__init__(slot_ms, forget_ms)
        self.least, self.min_points = round(min_seconds * 1_000_000), min_points

    def step(self, last, at, value):
        if value is None:
            return last, None
        if last and at - last[0] < self.least and abs(value - last[1]) < self.min_points and value < 99:
            return last, None
        return (at, value), True


class InBuckets(StatefulProcessor):
    """Steps through the rows of a bucket of keys, those of each key as ``InOrder`` does. Rows wait packed, by slots."""

    def __init__(self, rule: InOrder):
        self.rule, self.slot_ms, self.forget_ms = rule, rule.slot_ms, rule.forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "slot bigint", "n bigint")
        self.held = handle.getMapState("held", "slot bigint, part bigint", "rows binary")
        self.last = handle.getMapState("last", "shard bigint", "records binary")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        slots: dict[int, list[tuple]] = {}
        at = None
        for n, row in enumerate(rows, 1):
            at = at or [row.__fields__.index(c) for c in ("shard", "key", "micros", "place", "value")]
            told = tuple(row[i] for i in at)
            if told[1] is not None:
                slots.setdefault(told[2] // (1000 * self.slot_ms), []).append(told)
            if n % GATHERED == 0:
                self._hold(slots)
        self._hold(slots)
        return iter(())

    def _hold(self, slots: dict[int, list[tuple]]) -> None:
        for slot, own in slots.items():
            n = self.parts.getValue((slot,))
            part = n[0] if n else 0
            self.held.updateValue((slot, part), (pickle.dumps(own),))
            self.parts.updateValue((slot,), (part + 1,))
            if not part:
                self.handle.registerTimer((slot + 1) * self.slot_ms)
        slots.clear()

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        slot = now // self.slot_ms - 1
        n = self.parts.getValue((slot,)) if now % self.slot_ms == 0 else None
        if n:
            rows = [row for i in range(n[0]) for row in pickle.loads(self.held.getValue((slot, i))[0])]
            rows.sort(key=lambda r: (r[2], r[3] is not None, r[3]))
            yield from self._stepped(rows, now)
            for i in range(n[0]):
                self.held.removeKey((slot, i))
            self.parts.removeKey((slot,))
            if self.forget_ms:
                self.handle.registerTimer(rows[-1][2] // 1000 + self.forget_ms + 1)
        elif self.forget_ms:
            for (shard,), (records,) in list(self.last.iterator()):
                self._keep(shard, pickle.loads(records), now)

    def _stepped(self, rows: list[tuple], now: int) -> Iterator[Row]:
        shards: dict[int, dict] = {}
        for shard, key, at, place, value in rows:
            if shard not in shards:
                records = self.last.getValue((shard,))
                shards[shard] = pickle.loads(records[0]) if records else {}
            last = shards[shard].get(key)
            if last and self.forget_ms and at - last[0] >= 1000 * self.forget_ms:
                last = None
            shards[shard][key], told = self.rule.step(last, at, value)
            if told is not None:
                yield TOLD(key, at, place, value, told)
        for shard, records in shards.items():
            self._keep(shard, records, now)

    def _keep(self, shard: int, records: dict[Any, tuple | None], now: int) -> None:
        """Keep the records of keys that have not been silent for too long."""
        kept = {k: r for k, r in records.items() if r and not (self.forget_ms and r[0] // 1000 + self.forget_ms < now)}
        if kept:
            self.last.updateValue((shard,), (pickle.dumps(kept),))
        elif self.last.containsKey((shard,)):
            self.last.removeKey((shard,))


def _ms(span: str | None) -> int | None:
    return None if span is None else int(pd.Timedelta(span).total_seconds() * 1000)


def _in_order(rows: DataFrame, key: str, ts: str, place: str | None, value: str, late_by: str, processor: InOrder,
              buckets: int | None) -> DataFrame:
    """key, micros, place, value and what the processor tells of each row."""
    rows.sparkSession.conf.set(PROVIDER, ROCKSDB)
    at = F.col(ts).cast("timestamp")
    plain = rows.select(
        F.col(key).alias("key"), at.alias("at"), F.unix_micros(at).alias("micros"),
        (F.col(place) if place else F.lit(0)).cast("bigint").alias("place"), F.col(value).cast("double").alias("value"))
    kind = plain.schema["key"].dataType.simpleString()
    schema = f"key {kind}, micros bigint, place bigint, value double, told boolean"
    if buckets is None:
        return plain.withWatermark("at", late_by).groupBy("key").transformWithState(processor, schema, "Append", "EventTime")
    mixed = F.xxhash64("key")
    dealt = plain.select(F.pmod(mixed, F.lit(buckets)).alias("bucket"),
                         F.pmod(F.shiftright(mixed, 32), F.lit(SHARDS)).alias("shard"), "*")
    return dealt.withWatermark("at", late_by).groupBy("bucket").transformWithState(
        InBuckets(processor), schema, "Append", "EventTime")


def stable_files(snapshots: DataFrame, checks: int = 4, forget_after: str | None = "1 hour", *,
                 late_by: str = "1 minute", slot: str = "1 minute", tie: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """Per snapshot row (path, snapshot_ts, length): has the size been the same for ``checks`` checks by now?

    Rows of equal time go by the whole number ``tie``, which is told too. A row without length starts anew. A path not
    seen for ``forget_after`` is forgotten; rows without path are left out. ``buckets``: keep the state by so many
    buckets of paths, for very many paths.
    """
    told = _in_order(snapshots, "path", "snapshot_ts", tie, "length", late_by,
                     Stability(_ms(slot), _ms(forget_after), checks), buckets)
    ties = [F.col("place").alias(tie)] if tie else []
    return told.select(F.col("key").alias("path"), F.timestamp_micros("micros").alias("snapshot_ts"), *ties,
                       F.col("value").cast("bigint").alias("length"), F.col("told").alias("stable"))


def throttle_progress(progress: DataFrame, min_seconds: float = 0.5, min_points: float = 0.5,
                      forget_after: str | None = "1 hour", *, late_by: str = "10 seconds", slot: str = "10 seconds",
                      tie: str | None = None, buckets: int | None = None) -> DataFrame:
    """Rows (asset_id, ts, percent) that differ enough from the last row let through: ``min_seconds`` or
    ``min_points`` away, or at 99 % and above. Without percent a row is left out; ``tie``, ``forget_after`` and
    ``buckets`` as in ``stable_files``."""
    told = _in_order(progress, "asset_id", "ts", tie, "percent", late_by,
                     Throttle(_ms(slot), _ms(forget_after), min_seconds, min_points), buckets)
    ties = [F.col("place").alias(tie)] if tie else []
    return told.select(F.col("key").alias("asset_id"), F.timestamp_micros("micros").alias("ts"), *ties,
                       F.col("value").alias("percent"))
