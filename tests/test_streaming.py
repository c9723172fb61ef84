"""Streams over several files equal their batch twin; late events are dropped."""

import datetime as dt

import pytest

from tidewell.streaming import jobs

SCHEMA = "txn_id long, account_id long, amount double, txn_time timestamp_ntz, txn_status string"
T0 = dt.datetime(2024, 1, 1)


def write(spark, rows, folder, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).parquet(str(folder))


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.fixture
def folder(spark, tmp_path):
    path = tmp_path / "in"
    write(spark, [(i, i % 3, 5.0, minutes(i), "SUCCESS" if i % 4 else "FAILED") for i in range(120)], path)
    return path


def test_windows_equal_batch(spark, folder):
    write(spark, [(999, 9, 1.0, minutes(100000), "SUCCESS")], folder)  # closes every earlier window
    stream = jobs.file_stream(spark, str(folder), SCHEMA, files_per_batch=1)
    got = jobs.run_to_table(jobs.abnormal_windows(stream), "t").where("account_id <> 9")
    batch = jobs.abnormal_windows(spark.read.parquet(str(folder))).where("account_id <> 9")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert got.count() > 0


def test_late_and_replayed_events(spark, folder, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        return jobs.run_to_table(jobs.deduplicated(jobs.file_stream(spark, str(folder), SCHEMA), "txn_id", "txn_time"), "d", out, progress)

    assert run().count() == 120
    write(spark, [(119, 2, 5.0, minutes(119), "SUCCESS"), (500, 1, 5.0, minutes(121), "SUCCESS")], folder)  # one replay, one new
    assert run().count() == 121
    write(spark, [(600, 1, 5.0, minutes(-600), "SUCCESS")], folder)  # older than the watermark
    assert run().count() == 121


EVENTS = "event_id long, user_id long, event_type string, ts timestamp_ntz"


def test_chains_follow_order_whatever_the_batches(spark, tmp_path):
    """Events out of order over several batches, two sessions of a user, ties, a chain in the wrong order, and an event that comes too late."""
    folder = tmp_path / "in"

    def put(rows):
        spark.createDataFrame([(n, u, kind, minutes(m)) for n, (u, kind, m) in enumerate(rows)], EVENTS).coalesce(1).write.mode("append").parquet(str(folder))

    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        return {(r.user_id, r.window_start): r for r in jobs.run_to_table(jobs.behaviour_chains(jobs.file_stream(spark, str(folder), EVENTS), "user_id", "ts"), "c", out, progress).collect()}

    put([(1, "click", 10), (1, "purchase", 25), (2, "purchase", 0), (2, "click", 1), (2, "view", 2), (None, "view", 3)])
    assert run() == {}
    put([(1, "view", 5), (1, "view", 70), (1, "purchase", 70), (1, "click", 70), (3, "view", 60), (3, "click", 85), (3, "view", 100)])  # user 1's chain begins in the second batch
    assert set(run()) == {(2, minutes(0))}  # the watermark is at 40 minutes, the session's end at 32
    put([(9, "view", 400)])
    done = run()
    assert set(done) == {(1, minutes(5)), (1, minutes(70)), (2, minutes(0)), (3, minutes(60))}
    assert [(r.event_cnt, r.chain_steps, r.chain_end) for r in (done[1, minutes(5)], done[1, minutes(70)], done[2, minutes(0)], done[3, minutes(60)])] == [
        (3, 3, minutes(25)), (3, 3, minutes(70)), (3, 1, None), (3, 2, None)
    ]
    assert done[3, minutes(60)].window_end == minutes(130) and done[1, minutes(5)].private_cnt == 1
    put([(1, "view", 300), (4, "view", 401), (9, "click", 410)])  # older than the watermark: never seen
    put([(9, "purchase", 900)])
    done = run()
    assert set(done) == {(1, minutes(5)), (1, minutes(70)), (2, minutes(0)), (3, minutes(60)), (4, minutes(401)), (9, minutes(400))}
    assert done[9, minutes(400)].chain_steps == 2


ORDERS = "station_id long, energy_kwh double, start_time timestamp_ntz"


def test_station_windows_from_panes_equal_native_windows(spark, tmp_path):
    """Several batches, an empty station and energy, windows of uneven slide, an end at the watermark, late orders: as native windows give over the rows in time.

    A station is one state row, whatever the number of its windows.
    """
    folder, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    first = [(n % 3 or None, None if n % 5 == 0 else n / 4, minutes(n * 700)) for n in range(60)] + [(7, None, minutes(50)), (8, 1.0, None)]
    late = (1, 100.0, minutes(59 * 700 - 3 * 1440))
    batches = [first, [late, (1, 999.0, minutes(-20000))], [(9, 1.0, minutes(30 * 1440 + 60))], [(9, 1.0, minutes(90 * 1440))]]

    def run(rows):
        spark.createDataFrame(rows, ORDERS).coalesce(1).write.mode("append").parquet(folder)
        return jobs.run_to_table(jobs.station_status(jobs.file_stream(spark, folder, ORDERS), window="7 days", slide="2 days"), "s", out, progress)

    for rows in batches[:3]:
        got = run(rows)
    assert max(r.window_end for r in got.collect()) == minutes(30 * 1440)  # the watermark
    got = run(batches[3])
    in_time = spark.createDataFrame([row for rows in batches for row in rows if row[1] not in (100.0, 999.0)], ORDERS)
    on_time = jobs.station_status(in_time, window="7 days", slide="2 days").where("window_end < timestamp_ntz'2024-03-20'")
    key = lambda row: str(tuple(row))
    before = sorted((tuple(r) for r in on_time.collect()), key=key)
    watermark = minutes(59 * 700 - 60)
    open_then = lambda row: row[2] == 1 and row[0] <= late[2] < row[1] and row[1] > watermark
    want = [(*row[:3], row[3] + 1, (row[4] or 0) + 100.0, max(row[5], late[2])) if open_then(row) else row for row in before]
    assert any(map(open_then, before))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert spark.read.format("statestore").option("stateVarName", "panes").load(progress).count() <= 2  # only stations with windows to come


class Handle:
    def __init__(self):
        self.timers = []

    def registerTimer(self, at):
        self.timers.append(at)


class Value:
    kept = None

    def get(self):
        return self.kept

    def update(self, value):
        self.kept = value


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_one_timer_for_all_sessions_of_a_user(spark):
    """A timer costs a message and a call; one per session made the stream's time grow with sessions."""
    import pandas as pd

    chains = jobs.ChainProcessor(30 * 60_000_000)
    chains.handle, chains.events = Handle(), Value()
    rows = pd.DataFrame({"at": [n * 3_600_000_000 for n in range(1000)], "event_type": ["view"] * 1000})
    list(chains.handleInputRows((1,), iter([rows]), Clock(0)))
    assert chains.handle.timers == [30 * 60_000 - 1]
    assert len(list(chains.handleExpiredTimer((1,), Clock(30 * 60_000 - 1), None))) == 0
    assert chains.handle.timers == [30 * 60_000 - 1] * 2


def test_session_ends_at_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(0, 1, "view", minutes(0)), (1, 2, "view", minutes(90))], EVENTS).coalesce(1).write.parquet(folder)
    assert [r.user_id for r in jobs.run_to_table(jobs.behaviour_chains(jobs.file_stream(spark, folder, EVENTS), "user_id", "ts"), "e").collect()] == [1]
