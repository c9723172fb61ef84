"""Day folders, table versions and a dimension that changes under a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.operators import layout
from tidewell.operators.snapshots import SnapshotStore
from tidewell.streaming import jobs

FACT = "id long, ts timestamp_ntz, amount double"
T0 = dt.datetime(2024, 1, 1)


def facts(spark, days, amount=1.0, per_day=3):
    return spark.createDataFrame([(d * 100 + i, T0 + dt.timedelta(days=d, hours=i), amount) for d in days for i in range(per_day)], FACT)


def files_of(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_replaced_dropped_and_pruned(spark, tmp_path):
    path = str(tmp_path / "facts")
    layout.write_days(facts(spark, range(30)).union(spark.createDataFrame([(-1, None, 0.0)], FACT)), "ts", path)
    before = files_of(tmp_path / "facts")
    layout.write_days(facts(spark, [28, 29, 30], 2.0), "ts", path)
    after = files_of(tmp_path / "facts")
    assert {p: t for p, t in before.items() if p in after} == {p: t for p, t in before.items() if not p.parent.name.endswith(("29", "30"))}
    assert layout.read_days(spark, path, FACT).groupBy().sum("amount").first()[0] == 28 * 3 + 3 * 3 * 2.0
    recent = layout.recent_facts(spark, path, FACT, "ts", 5)
    newest = T0 + dt.timedelta(days=30, hours=2)
    assert sorted(r["id"] for r in recent.collect()) == sorted(r["id"] for r in facts(spark, range(31)).collect() if r["ts"] >= newest - dt.timedelta(days=5))
    assert recent.select("id", "day").distinct().count() == 16
    assert "day#" in plan(recent.select("id")).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    for file in (tmp_path / "facts" / "day=2024-01-02").iterdir():  # a day out of range is never opened
        file.write_bytes(b"damaged")
    assert layout.recent_facts(spark, path, FACT, "ts", 5).count() == 16
    after = files_of(tmp_path / "facts")
    assert layout.drop_days_before(spark, path, dt.date(2024, 1, 26)) == [dt.date(2024, 1, d) for d in range(1, 26)]
    kept = files_of(tmp_path / "facts")
    assert kept == {p: t for p, t in after.items() if p in kept} and layout.stored_days(spark, path)[0] == dt.date(2024, 1, 26)
    assert layout.recent_facts(spark, path, FACT, "ts", 5).count() == 16


def test_no_days(spark, tmp_path):
    path = str(tmp_path / "facts")
    assert layout.stored_days(spark, path) == [] and layout.folder_names(spark, path) == []
    layout.write_days(facts(spark, []), "ts", path)
    assert layout.recent_facts(spark, path, FACT, "ts", 5).count() == 0 and layout.drop_days_before(spark, path, dt.date(2024, 1, 1)) == []
    with pytest.raises(ValueError, match="day"):
        layout.write_days(facts(spark, [1]).withColumn("day", F.lit(1)), "ts", path)


ROW = "k long, text string, n int"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROW)


def test_versions(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "t"), "k", buckets=32)
    base = [(i, f"text {i}", i) for i in range(200)] + [(None, "no key", None), (-1, None, 1), (-2, "", 1)]
    assert store.versions() == [] and store.commit(rows(spark, *base)) == 1
    first = files_of(tmp_path / "t" / "data")
    second = [r for r in base if r[0] not in (3, 4)] + [(1000, "new", 0)]
    second = [(k, "other" if k == 7 else "" if k == -1 else t, n) for k, t, n in second]
    assert store.commit(rows(spark, *second)) == 2
    assert {(r["k"], r["change"]) for r in store.changes(2).collect()} == {(3, "removed"), (4, "removed"), (7, "changed"), (-1, "changed"), (1000, "added")}
    assert all(r["content_hash"] is None for r in store.changes(2).where("change = 'removed'").collect())
    written = {p.parent.name for p in (tmp_path / "t" / "data" / "tw_version=2").rglob("*.parquet")}
    assert 1 <= len(written) <= 5 and all(files_of(tmp_path / "t" / "data")[p] == t for p, t in first.items())

    def held(version=None):
        return sorted(map(tuple, store.read(version).collect()), key=repr)

    assert held(1) == sorted(base, key=repr) and held(2) == held() == sorted(second, key=repr)
    assert "tw_bucket" in plan(store.read(2)).split("PartitionFilters: ")[1].split("PushedFilters: []")[0] and store.read(2).columns == ["k", "text", "n"]
    # The same version again is not written again; nothing changed writes no bucket; everything removed.
    stamps = files_of(tmp_path / "t")
    assert store.commit(rows(spark, (5, "ignored", 1)), 2) == 2 and files_of(tmp_path / "t") == stamps
    assert store.commit(rows(spark, *second)) == 3 and store.changes(3).count() == 0 and held() == sorted(second, key=repr)
    assert store.commit(rows(spark)) == 4 and held() == [] and store.changes(4).where("change = 'removed'").count() == len(second)
    assert store.commit(rows(spark, *base)) == 5 and held() == sorted(base, key=repr)
    with pytest.raises(ValueError, match="older"):
        SnapshotStore(spark, store.path, "k", 32).commit(rows(spark), 0)
    with pytest.raises(ValueError, match="same columns"):
        store.commit(rows(spark).withColumn("more", F.lit(1)))
    with pytest.raises(Exception, match="repeated key"):
        store.commit(rows(spark, (1, "a", 1), (1, "b", 1)))
    assert store.versions() == [1, 2, 3, 4, 5]
    assert store.forget(2) == [1, 2, 3] and store.versions() == [4, 5] and held(4) == [] and held() == sorted(base, key=repr)


def test_an_unfinished_version_does_not_exist(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "t"), "k", buckets=8)
    store.commit(rows(spark, (1, "a", 1), (2, "b", 2)))
    store.commit(rows(spark, (1, "x", 1), (2, "y", 2), (3, "z", 3)))
    (tmp_path / "t" / "manifest" / "version=2" / "_SUCCESS").unlink()
    assert store.versions() == [1] and sorted(r["text"] for r in store.read().collect()) == ["a", "b"]
    assert store.commit(rows(spark, (1, "a", 1), (2, "c", 2))) == 2
    assert sorted(r["text"] for r in store.read().collect()) == ["a", "c"] and [r["k"] for r in store.changes(2).collect()] == [2]


def test_empty_first_version(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "t"), "k")
    assert store.commit(rows(spark)) == 1 and store.read().columns == ["k", "text", "n"] and store.read().count() == 0
    assert store.commit(rows(spark, (1, "a", None))) == 2 and store.read().first()["text"] == "a" and store.read(1).count() == 0


def test_dimension_changes_between_batches(spark, tmp_path):
    store, arrived = SnapshotStore(spark, str(tmp_path / "dim"), "account", buckets=4), tmp_path / "in"
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def deliver(*events):
        spark.createDataFrame(list(events), "event long, account long").coalesce(1).write.mode("append").parquet(str(arrived))
        stream = jobs.file_stream(spark, str(arrived), "event long, account long")
        return {r["event"]: (r["name"], r["dim_version"]) for r in jobs.enriched_by_version(stream, store, "account", "e", out, progress).collect()}

    store.commit(spark.createDataFrame([(1, "one"), (2, "two")], "account long, name string"))
    assert deliver((10, 1), (11, 2), (12, 3), (13, None)) == {10: ("one", 1), 11: ("two", 1), 12: (None, 1), 13: (None, 1)}
    store.commit(spark.createDataFrame([(1, "ONE"), (3, "three")], "account long, name string"))
    got = deliver((20, 1), (21, 2), (22, 3))
    assert got[10] == ("one", 1) and (got[20], got[21], got[22]) == (("ONE", 2), (None, 2), ("three", 2))
    # The second batch is run again after the dimension changed once more: its commit is taken back.
    store.commit(spark.createDataFrame([(1, "later")], "account long, name string"))
    done = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"))
    (tmp_path / "progress" / "commits" / f".{done[-1].name}.crc").unlink(missing_ok=True)
    done[-1].unlink()
    assert deliver((30, 1)) == got | {30: ("later", 3)}
    with pytest.raises(ValueError, match="clash"):
        jobs.enriched_by_version(jobs.file_stream(spark, str(arrived), "event long, account long, name string"), store, "account", "e")
