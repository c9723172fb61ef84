"""Structured Streaming variants of the batch metrics.

Every builder takes a streaming (or batch) DataFrame and returns one; `run_to_table` runs a stream to the end
of its input and hands back the written table. State is bounded by the watermark: windows, sessions and seen
ids are dropped once the event time has passed them by the allowed lateness.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.operators.layout import is_complete
from tidewell.operators.snapshots import SnapshotStore
from tidewell.session import scratch_path

LATENESS = "1 hour"


def file_stream(spark: SparkSession, folder: str, schema: str | T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream, with a declared schema."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_to_table(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available, append to Parquet with exactly-once commits, return the table."""
    spark = stream.sparkSession
    target = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-progress"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def run_per_batch(stream: DataFrame, name: str, work: Callable[[DataFrame, int], DataFrame], schema: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Apply batch work to every micro-batch; a batch that is run again overwrites its own folder."""
    spark = stream.sparkSession
    target = path or scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        work(batch, batch_id).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-progress")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(f"{schema}, batch_id long").parquet(target)


def abnormal_windows(transactions: DataFrame, min_count: int = 3, lateness: str = LATENESS, window: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Accounts with many transactions in a sliding window, with the share of failed ones."""
    failed = F.count_if(F.col("txn_status") == "FAILED")
    n = F.count(F.lit(1))
    windows = _timed(transactions, "txn_time", lateness).groupBy(F.window("txn_time", window, slide), "account_id")
    counted = windows.agg(n.alias("txn_cnt"), failed.alias("failed_cnt"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount_sum"))
    return counted.where(F.col("txn_cnt") >= min_count).select(*_bounds(), "account_id", "txn_cnt", "failed_cnt", "amount_sum")


#: A pane of a station: its start, orders, orders with energy, hundredths of energy above and below 2^32, latest start of an order.
PANE = ("pane", "n", "filled", "high", "low", "last")
STATUS_COLUMNS = "{0}, window_end long, order_cnt long, filled long, high long, low long, last_start long"


def combined(places: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(place, sums of its rows, maximum of their last column) of each distinct place, in order."""
    order = np.argsort(places, kind="stable")
    places, rows = places[order], rows[order]
    first = np.flatnonzero(np.diff(places, prepend=places[:1] - 1))
    return np.column_stack([places[first], np.add.reduceat(rows[:, :-1], first, axis=0), np.maximum.reduceat(rows[:, -1], first)])


def packed(panes: np.ndarray) -> bytes:
    """Panes in order in a few bytes each: steps from the pane before and from the pane's start, byte by byte, compressed. State messages beyond a socket's buffer wait for it."""
    steps = np.column_stack([np.diff(panes[:, 0], prepend=0), panes[:, 1:5], panes[:, 5] - panes[:, 0]])
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(steps.view(np.uint8).T).tobytes(), asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros((0, len(PANE)), dtype=np.int64)
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=8 * len(PANE) * n, asbytes=True), dtype=np.uint8).reshape(-1, n)
    steps = np.ascontiguousarray(raw.T).view(np.int64)
    place = np.cumsum(steps[:, 0])
    return np.column_stack([place, steps[:, 1:5], steps[:, 5] + place])


class WindowProcessor(StatefulProcessor):
    """Keeps a key's open panes in one value and a timer for its next window to end: state grows with panes, not with the windows that share them."""

    def __init__(self, window: int, slide: int, names: list[str]):
        self.window, self.slide, self.names = window, slide, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getValueState("panes", "done long, n int, panes binary")

    def _windows(self, panes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the windows that hold a pane: one row per pane, and whether they do."""
        ends = (panes[:, 0] // self.slide * self.slide + self.window)[:, None] - np.arange(-(-self.window // self.slide)) * self.slide
        return ends, ends > panes[:, :1]

    def _closed(self, key: tuple, done: int, panes: np.ndarray, floor: int) -> Iterator[pd.DataFrame]:
        """Windows that the watermark has passed since it was at `done`."""
        ends, holds = self._windows(panes)
        row, at = np.nonzero(holds & (ends > done) & (ends <= floor))
        if len(row):
            closed = combined(ends[row, at], panes[row, 1:])
            numbers = dict(zip(("window_end", "order_cnt", "filled", "high", "low", "last_start"), closed.T))
            yield pd.DataFrame({**{name: [value] * len(closed) for name, value in zip(self.names, key)}, **numbers})

    def _keep(self, panes: np.ndarray, floor: int) -> None:
        """Write the panes with windows to come, and set the timer for the first of these to end."""
        ends, holds = self._windows(panes)
        to_come = holds & (ends > floor)
        panes = panes[to_come.any(axis=1)]
        if len(panes):
            self.panes.update((floor, len(panes), packed(panes)))
            self.handle.registerTimer(timer_at(int(ends[to_come].min())))
        else:
            self.panes.clear()

    def _kept(self) -> tuple[int, np.ndarray]:
        done, n, panes = self.panes.get() or (0, 0, b"")
        return done, unpacked(panes, n)

    def handleInputRows(self, key, rows, timerValues):
        floor = timerValues.getCurrentWatermarkInMs() * 1000
        done, panes = self._kept()
        yield from self._closed(key, done, panes, floor)  # late rows do not enter what the watermark has passed
        fresh = b"".join(pane for frame in rows for pane in frame["panes"])
        every = np.concatenate([panes, np.frombuffer(fresh, dtype=np.int64).reshape(-1, len(PANE))])
        self._keep(combined(every[:, 0], every[:, 1:]), floor)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        floor = timerValues.getCurrentWatermarkInMs() * 1000
        done, panes = self._kept()
        yield from self._closed(key, done, panes, floor)
        self._keep(panes, floor)

    def close(self) -> None:
        pass


def timer_at(end: int) -> int:
    """The timer (ms) of an end in microseconds: timers fire once the watermark is beyond them, windows close once it is at their end."""
    return -(-end // 1000) - 1


def paned(orders: DataFrame, key: str, width: int) -> DataFrame:
    """(key, panes, event_time): the rows of a pane are summed per Arrow batch, so a key that holds many rows is thinned before it moves. A pane is its numbers as bytes."""
    cents = (F.col("energy_kwh").cast("decimal(18,2)") * 100).cast("long")
    at = F.unix_micros("start_time")
    zero = F.lit(0).cast("long")
    rows = orders.where(F.col("start_time").isNotNull()).select(
        key, (at - F.pmod(at, F.lit(width))).alias("pane"), F.lit(1).cast("long").alias("n"), F.col("energy_kwh").isNotNull().cast("long").alias("filled"),
        F.coalesce(F.shiftright(cents, 32), zero).alias("high"), F.coalesce(cents.bitwiseAND(F.lit(2**32 - 1)), zero).alias("low"), at.alias("last"),
    )

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by([key, "pane"]).aggregate([(c, "sum") for c in PANE[1:5]] + [("last", "max")]).combine_chunks()
            numbers = np.column_stack([sums[c].to_numpy() for c in ("pane", "n_sum", "filled_sum", "high_sum", "low_sum", "last_max")])
            panes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * len(PANE)), len(numbers), [None, pa.py_buffer(numbers.tobytes())]).cast(pa.binary())
            yield from pa.table([sums[key], panes, sums["last_max"]], names=[key, "panes", "last"]).to_batches()

    kind = orders.schema[key].dataType.simpleString()
    return rows.mapInArrow(reduce, f"`{key}` {kind}, panes binary, last long").withColumn("event_time", F.timestamp_micros("last"))


def station_status(orders: DataFrame, lateness: str = LATENESS, window: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Rolling weekly orders and energy per station.

    Of a stream, a station's orders are kept as sums per pane - the widest that all windows are made of -, in one state row per station, and a
    timer hands on the windows that the watermark has passed; a late order enters the windows that are still open. Windows start at multiples of `slide` since 1970.
    """
    if not orders.isStreaming:
        windows = _timed(orders, "start_time", lateness).groupBy(F.window("start_time", window, slide), "station_id")
        return windows.agg(
            F.count(F.lit(1)).alias("order_cnt"), F.sum(F.col("energy_kwh").cast("decimal(18,2)")).cast("double").alias("energy_sum"), F.max("start_time").cast("timestamp_ntz").alias("last_start")
        ).select(*_bounds(), "station_id", "order_cnt", "energy_sum", "last_start")
    orders.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    width, step = (pd.Timedelta(x) // pd.Timedelta("1us") for x in (window, slide))
    kind = orders.schema["station_id"].dataType.simpleString()
    rows = paned(orders.select(F.col("start_time").cast("timestamp"), "station_id", "energy_kwh"), "station_id", math.gcd(width, step))
    timed = rows.withWatermark("event_time", lateness).select("station_id", "panes")  # without their time no row is dropped before the processor sees it
    closed = timed.groupBy("station_id").transformWithStateInPandas(WindowProcessor(width, step, ["station_id"]), T._parse_datatype_string(STATUS_COLUMNS.format(f"station_id {kind}")), "Append", "EventTime")
    whole = F.col("high").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("low").cast("decimal(20,0)")
    energy = F.when(F.col("filled") > 0, (whole * F.lit("0.01").cast("decimal(3,2)")).cast("double"))
    ends = {"window_start": F.col("window_end") - width, "window_end": F.col("window_end"), "last_start": F.col("last_start")}
    stamp = {name: F.timestamp_micros(micros).cast("timestamp_ntz").alias(name) for name, micros in ends.items()}
    return closed.select(stamp["window_start"], stamp["window_end"], "station_id", "order_cnt", energy.alias("energy_sum"), stamp["last_start"])


def risk_daily(punishments: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Daily punishments per risk type."""
    kind = F.col("punish_type")
    days = _timed(punishments, "punish_time", lateness).groupBy(F.window("punish_time", "1 day"), "risk_type")
    return days.agg(
        F.count(F.lit(1)).alias("punish_cnt"), F.count_if(kind == "ban").alias("ban_cnt"), F.count_if(kind == "mute").alias("mute_cnt"),
        F.count_if(kind == "warning").alias("warning_cnt"),
    ).select(F.col("window.start").cast("date").alias("metric_date"), "risk_type", "punish_cnt", "ban_cnt", "mute_cnt", "warning_cnt")


def deduplicated(events: DataFrame, key: str, ts: str, lateness: str = LATENESS) -> DataFrame:
    """Drop replayed events; ids are remembered only as long as the watermark needs them."""
    return _timed(events, ts, lateness).dropDuplicatesWithinWatermark([key]).withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def enriched(events: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Attach a static dimension; events without a match stay."""
    return events.join(dimension, key, "left")


def batch_version(store: SnapshotStore, progress: str, batch_id: int) -> int:
    """The dimension's version for a micro-batch: the newest when it runs first, noted beside the progress, and the same whenever it is run again."""
    place = f"{progress}-dimension/batch_id={batch_id}"
    if not is_complete(store.spark, place):
        store.spark.createDataFrame([(store.versions()[-1],)], "version int").coalesce(1).write.mode("overwrite").parquet(place)
    return store.spark.read.schema("version int").parquet(place).first()[0]


def enriched_by_version(stream: DataFrame, store: SnapshotStore, key: str, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Attach a dimension that may change while the stream runs: every micro-batch reads it again, as of one version.

    Events without a match stay; `dim_version` says which version they met. A batch that is run again after a failure meets the same
    version and overwrites its own rows. At least one version must exist; it keeps the versions that open batches have noted.
    """
    fields = [f for f in store.read().schema if f.name != key]
    clash = {f.name for f in fields} & {*stream.columns, "dim_version", "batch_id"}
    if clash:
        raise ValueError(f"columns of the events and the dimension clash: {sorted(clash)}")
    progress = checkpoint or scratch_path(stream.sparkSession, f"{name}-progress")

    def work(batch: DataFrame, batch_id: int) -> DataFrame:
        here = replace(store, spark=batch.sparkSession)
        version = batch_version(here, progress, batch_id)
        return batch.join(here.read(version), key, "left").select(*stream.columns, *[f.name for f in fields], F.lit(version).alias("dim_version"))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*stream.schema, *fields])
    return run_per_batch(stream, name, work, f"{schema}, dim_version int", path, progress)


def sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", lateness: str = LATENESS) -> DataFrame:
    """Behaviour chains: message, private message and payment counts per user session."""
    kind = F.col("event_type")
    grouped = _timed(events, ts, lateness).groupBy(F.session_window(ts, gap).alias("window"), user)
    return grouped.agg(
        F.count(F.lit(1)).alias("event_cnt"), F.count_if(kind == "view").alias("message_cnt"), F.count_if(kind == "click").alias("private_cnt"),
        F.count_if(kind == "purchase").alias("payment_cnt"),
    ).select(*_bounds(), user, "event_cnt", "message_cnt", "private_cnt", "payment_cnt")


#: Kinds of a behaviour chain in the order of its steps.
CHAIN = ("view", "click", "purchase")
CHAIN_COLUMNS = "window_start timestamp, window_end timestamp, user_id long, event_cnt long, message_cnt long, private_cnt long, payment_cnt long, chain_steps int, chain_end timestamp"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def chain_of(events: list[tuple[int, str]], steps: Sequence[str] = CHAIN) -> tuple[int, int | None]:
    """(steps taken, time of the last step if all were): the events, sorted by time, read by an automaton; those of one instant count in any order."""
    taken, i = 0, 0
    while i < len(events) and taken < len(steps):
        at, kinds = events[i][0], set()
        while i < len(events) and events[i][0] == at:
            kinds.add(events[i][1])
            i += 1
        while taken < len(steps) and steps[taken] in kinds:
            taken += 1
        if taken == len(steps):
            return taken, at
    return taken, None


def split_sessions(events: list[tuple[int, str]], gap: int) -> list[list[tuple[int, str]]]:
    """Sessions of sorted events: a pause of `gap` microseconds or more ends one."""
    out: list[list[tuple[int, str]]] = []
    for event in events:
        if not out or event[0] - out[-1][-1][0] >= gap:
            out.append([])
        out[-1].append(event)
    return out


class ChainProcessor(StatefulProcessor):
    """Keeps a user's open events and a timer for the first possible end of a session; a session leaves when the watermark has passed its end.

    A timer that finds nothing closed, because later events have joined the session, is set again for the first end there is then.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getValueState("events", "at binary, kind binary")

    def _kept(self) -> list[tuple[int, str]]:
        """Open events; of kinds outside the chain only their number counts."""
        at, kinds = self.events.get() or (b"", b"")
        return [(t, CHAIN[k] if k < len(CHAIN) else "") for t, k in zip(np.frombuffer(at, dtype=np.int64).tolist(), kinds)]

    def _keep(self, events: list[tuple[int, str]]) -> None:
        kinds = bytes(CHAIN.index(kind) if kind in CHAIN else len(CHAIN) for _, kind in events)
        self.events.update((np.array([t for t, _ in events], dtype=np.int64).tobytes(), kinds))

    def handleInputRows(self, key, rows, timerValues):
        floor = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = []
        for frame in rows:
            fresh += [(at, kind) for at, kind in zip(frame["at"].tolist(), frame["event_type"].tolist()) if at >= floor]
        if fresh:
            self._keep(self._kept() + fresh)
            self._wake(split_sessions(sorted(fresh, key=lambda e: e[0]), self.gap))
        return iter([])

    def _wake(self, sessions: list[list[tuple[int, str]]]) -> None:
        """One timer, whatever the number of sessions: each costs a message and a call."""
        self.handle.registerTimer(timer_at(sessions[0][-1][0] + self.gap))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        floor = timerValues.getCurrentWatermarkInMs() * 1000
        events = sorted(self._kept(), key=lambda e: e[0])
        open_sessions, rows = [], []
        for session in split_sessions(events, self.gap):
            end = session[-1][0] + self.gap
            if end > floor:
                open_sessions.append(session)
                continue
            steps, done = chain_of(session)
            counts = [sum(kind == k for _, kind in session) for k in CHAIN]
            rows.append((session[0][0], end, key[0], len(session), *counts, steps, done))
        if open_sessions:
            self._wake(open_sessions)
        if rows:
            self._keep([event for session in open_sessions for event in session]) if open_sessions else self.events.clear()
            out = pd.DataFrame(rows, columns=["window_start", "window_end", "user_id", "event_cnt", "message_cnt", "private_cnt", "payment_cnt", "chain_steps", "chain_end"])
            for name in ("window_start", "window_end", "chain_end"):
                out[name] = pd.to_datetime(out[name], unit="us")
            out["chain_steps"] = out["chain_steps"].astype("int32")
            yield out

    def close(self) -> None:
        pass


def behaviour_chains(events: DataFrame, user: str, ts: str, gap_minutes: int = 30, lateness: str = LATENESS) -> DataFrame:
    """Sessions of a user with their counts and the ordered chain message -> private message -> payment: `chain_steps` steps were taken, the last at `chain_end`.

    Events may arrive in any order within the allowed lateness: a user's open events are kept as state (RocksDB, so state beyond memory is fine) and
    timers in event time close a session once no event can join it any more; its events then leave the state. Older events than the
    watermark are dropped, as are rows without user or time. The result does not depend on how events are dealt into batches.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    timed = _timed(events.where(F.col(user).isNotNull()), ts, lateness).select(F.col(user).cast("long").alias("user_id"), ts, F.unix_micros(ts).alias("at"), "event_type")
    out = timed.groupBy("user_id").transformWithStateInPandas(ChainProcessor(gap_minutes * 60_000_000), T._parse_datatype_string(CHAIN_COLUMNS), "Append", "EventTime")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "chain_end")}).withColumnRenamed("user_id", user)


def _bounds() -> list[Column]:
    return [F.col(f"window.{edge}").cast("timestamp_ntz").alias(f"window_{edge}") for edge in ("start", "end")]


def _timed(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC, so the value stays the same."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
