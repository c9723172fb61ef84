"""Operators against brute force on small random data, hot keys included."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidewell.operators import graph, quality, ranking, relational, similarity
from tidewell.operators.knn import knn_topk
from tidewell.plans import charging, live, metrics


@pytest.fixture(scope="module")
def rng():
    return random.Random(11)


def test_pct_rank_and_quantiles(spark, rng):
    values = [float(rng.choice([0, 0, 0, 1, 2.5, 7, 7, 9])) if rng.random() < 0.6 else round(rng.random() * 50, 3) for _ in range(500)] + [None] * 7
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    got = {r.id: r.p for r in ranking.pct_rank_average(df, {"v": "p"}).collect()}
    expected = pd.Series(values, dtype=float).rank(pct=True)
    for i, e in enumerate(expected):
        assert (got[i] is None and np.isnan(e)) or abs(got[i] - e) < 1e-12
    row = ranking.exact_quantiles(df, "v", {"q1": 0.25, "q3": 0.75}).first()
    clean = [v for v in values if v is not None]
    assert abs(row.q1 - np.quantile(clean, 0.25)) < 1e-9 and abs(row.q3 - np.quantile(clean, 0.75)) < 1e-9


def test_rolling_baseline(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(10)], "d int, v int")
    got = [r.b for r in ranking.rolling_baseline(df, "v", "d", "b").orderBy("d").collect()]
    expected = pd.Series(range(1, 11)).rolling(7, min_periods=3).mean().shift(1)
    assert [None if np.isnan(e) else e for e in expected] == got


def test_components_with_a_hot_key(spark, rng):
    edges = [(i, "hot") for i in range(60)] + [(100 + i, f"k{i}") for i in range(40)] + [(101 + i, f"k{i}") for i in range(40)] + [(900, None)]
    df = spark.createDataFrame(edges, "m long, k string")
    got = {r.m: r.component for r in graph.member_components(df, "m", "k").collect()}
    assert {got[i] for i in range(60)} == {0}
    assert {got[i] for i in range(100, 141)} == {100}
    assert 900 not in got


def test_similar_groups_never_join_different_texts(spark, rng):
    base = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(12)]
    texts = [(i * 10 + j, t if j == 0 else t[: 60 + j] + "z" + t[60 + j :]) for i, t in enumerate(base) for j in range(4)]
    got = {r.id: r.group for r in similarity.similar_groups(spark.createDataFrame(texts, "id long, t string"), "id", "t").collect()}
    assert all(got[key] == key // 10 * 10 for key, _ in texts)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_knn_matches_brute_force(spark, metric):
    gen = np.random.default_rng(3)
    q, v = gen.normal(size=(7, 5)), gen.normal(size=(90, 5))
    qs = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "qid long, embedding array<double>")
    vs = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vid long, embedding array<double>")
    got = {}
    for r in knn_topk(qs, vs, 4, ["qid"], "vid", metric, query_block=3, vector_block=20).orderBy("qid", "rank_no").collect():
        got.setdefault(r.qid, []).append(r.vid)
    for i in range(len(q)):
        d = ((v - q[i]) ** 2).sum(axis=1) if metric == "l2" else 1 - v @ q[i] / (np.linalg.norm(v, axis=1) * np.linalg.norm(q[i]))
        assert got[i] == list(np.argsort(d, kind="stable")[:4])


def test_leaders_give_the_same_top_n_as_the_full_product(spark, rng):
    zones, powers = ["A", "B", "C"], ["DC", "AC"]
    vehicles = [(f"V{i}", rng.choice(zones), rng.choice(powers)) for i in range(25)]
    stations = [(f"S{i:02d}", rng.choice(zones), rng.choice(powers), 1 + rng.randrange(5) / 10) for i in range(30)]
    oper = {s[0]: rng.randrange(6) / 10 for s in stations}
    sessions = {(rng.choice(vehicles)[0], rng.choice(stations)[0]): rng.randrange(1, 6) for _ in range(40)}
    v = spark.createDataFrame(vehicles, "vehicle_id string, home_zone string, preferred_power_type string")
    s = spark.createDataFrame(stations, "station_id string, station_zone string, power_type string, tariff_cny_per_kwh double")
    p = spark.createDataFrame([(*k, n, 1.0, 1.0) for k, n in sessions.items()], "vehicle_id string, station_id string, session_cnt_30d long, avg_energy_kwh_30d double, avg_amount_cny_30d double")
    o = spark.createDataFrame(list(oper.items()), "station_id string, station_operability_score double")
    got = {(r.vehicle_id, r.rank_no): r.station_id for r in charging.reco_topn(charging.candidate_features(v, s, p, o)).collect()}
    for vid, zone, power in vehicles:
        scored = []
        for sid, sz, sp, tariff in stations:
            n = sessions.get((vid, sid), 0)
            score = 0.35 * min(1.0, n / 4) + 0.25 * (zone == sz) + 0.15 * (power == sp) + 0.15 * oper[sid] + 0.10 * (1 - min(1.0, tariff / 2.2))
            scored.append((-round(score, 4), sid))
        assert [got[vid, i] for i in (1, 2, 3)] == [sid for _, sid in sorted(scored)[:3]]


def test_room_features_equal_the_fan_out(spark, rng):
    users = [f"U{i}" for i in range(9)]
    ts = dt.datetime(2024, 1, 1)
    rooms = [(f"R{i}", "h", "live", ts, 10) for i in range(5)]
    messages = [(f"M{i}", rng.choice(users[:7]), "R0" if rng.random() < 0.5 else f"R{rng.randrange(4)}", ts + dt.timedelta(minutes=i), rng.choice(["private_message", "public_chat"])) for i in range(60)]
    reports = [(f"P{i}", rng.choice(users), ts) for i in range(20)]
    punished = [(f"N{i}", rng.choice(users[:4]), ts, "fraud", "ban") for i in range(6)]
    frames = {
        "rooms": spark.createDataFrame(rooms, "room_id string, host_id string, room_type string, start_time timestamp_ntz, duration_seconds int"),
        "messages": spark.createDataFrame(messages, "message_id string, user_id string, room_id string, send_time timestamp_ntz, message_type string"),
        "reports": spark.createDataFrame(reports, "report_id string, target_id string, report_time timestamp_ntz"),
        "punished": spark.createDataFrame(punished, "punish_id string, user_id string, punish_time timestamp_ntz, risk_type string, punish_type string"),
    }
    naive = spark.sql(
        """SELECT r.room_id, count(DISTINCT m.message_id) AS message_cnt, count(DISTINCT CASE WHEN message_type = 'private_message' THEN m.message_id END) AS private_message_cnt,
           count(DISTINCT p.report_id) AS report_cnt, count(DISTINCT n.user_id) AS punished_user_cnt
           FROM {rooms} r LEFT JOIN {messages} m ON r.room_id = m.room_id LEFT JOIN {reports} p ON m.user_id = p.target_id LEFT JOIN {punished} n ON m.user_id = n.user_id GROUP BY 1""",
        **frames,
    )
    fast = live.room_risk_features(*frames.values()).select(naive.columns)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, naive.collect()))


def test_group_members_counts_without_pairs(spark):
    df = spark.createDataFrame([(1, "d"), (2, "d"), (3, "e"), (4, None)], "u long, d string")
    got = {r.u: r.n for r in relational.group_members(df, "d", "u", "n").collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 0}


def test_quality_on_empty_and_bad_tables(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert [r.check_result for r in quality.run_checks(empty, quality.not_null("a", "id"), quality.row_count("b")).collect()] == ["FAIL", "FAIL"]
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1,), (3,), (None,)], "id long")
    row = quality.foreign_key("fk", child, "id", parent).first()
    assert (row.check_result, row.detail) == ("FAIL", "2")
    assert quality.foreign_key("fk", empty.select("id"), "id", parent).first().check_result == "FAIL"
    gaps = metrics.sequence_gaps(spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3), (2, 3)], "k int, n int"), "k", "n")
    assert [r.k for r in gaps.collect()] == [2]


def test_require_columns(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        relational.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])
    assert relational.since(spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 9),)], "t timestamp_ntz"), "t", 3).count() == 1


def test_metric_spike_zero_baseline(spark):
    rows = [(f"2024-01-0{i}", 0 if i < 5 else 9) for i in range(1, 7)]
    daily = spark.createDataFrame(rows, "d string, n long").select(F.to_date("d").alias("metric_date"), F.col("n").alias("punish_cnt"))
    got = live.metric_spike(daily, live.AlertRule("punish_cnt", 1.4, 2)).orderBy("metric_date").collect()
    assert [r.spike_ratio for r in got] == [float("inf"), 5.0]


def test_count_per_group_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, k string")
    assert {r.id: r.n for r in relational.count_per_group(df, ["k"], "n").collect()} == {1: 2, 2: 2, 3: 1}


def test_facts_without_a_user_belong_to_nobody(spark):
    reports = spark.createDataFrame([(1, None), (2, None), (3, 5)], "report_id long, target_id long")
    punishments = spark.createDataFrame([(1, None), (2, 7)], "punish_id long, user_id long")
    rows = live.user_facts(reports, punishments).collect()
    assert sorted((r["user_id"], r["report_cnt"], r["punish_cnt"]) for r in rows) == [(5, 1, 0), (7, 0, 1)]


def test_top_list_longer_than_the_candidates_is_refused(spark, small):
    from tidewell.checks.charging import Charging
    from tidewell.sources.star import Star

    pairs = Charging(Star(spark, small)).candidates()
    assert charging.reco_topn(pairs, 2).count() > 0
    with pytest.raises(ValueError):
        charging.reco_topn(pairs, 8)


def test_neighbours_are_chosen_before_rounding(spark):
    vectors = spark.createDataFrame([(i, [1e-4 * (10 - i)]) for i in range(10)], "k long, embedding array<double>")
    query = spark.createDataFrame([(0, [0.0])], "q long, embedding array<double>")
    assert [r["k"] for r in knn_topk(query, vectors, 3, ["q"], "k").orderBy("rank_no").collect()] == [9, 8, 7]


def test_undecided_rows_are_rejected(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    good, bad = relational.split_valid(df, F.col("v") > 0)
    assert [r["v"] for r in good.collect()] == [1] and {r["v"] for r in bad.collect()} == {-1, None}


def test_groups_are_searched_to_the_end(spark):
    """Many texts share a bucket with a leader they do not match; links among them are found all the same."""
    rows = [(i, f"text number {i // 2} " + "common words that all share " * 3 + "abcdefgh"[i // 2] * 60) for i in range(16)]
    got = {r["id"]: r["group"] for r in similarity.similar_groups(spark.createDataFrame(rows, "id long, t string"), "id", "t", 0.95, bands=40, rows=1).collect()}
    assert all(got[i] == got[i + 1] for i in range(0, 16, 2)) and len(set(got.values())) == 8


def test_links_beside_a_leader_are_found(spark, monkeypatch):
    """Variants of a template and texts near single variants: the groups that comparing all pairs of each bucket makes."""
    rng = random.Random(4)

    def change(text, spots):
        return "".join(rng.choice("uvwxyz") if at % 12 == 0 and at // 12 in spots else c for at, c in enumerate(text))

    texts = {}
    for n in range(20):  # a leader, texts like it, and texts that are only like one of those
        base = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(120))
        like = [change(base, rng.sample(range(5), 4)) for _ in range(3)]
        texts |= {n * 10 + i: t for i, t in enumerate([base, *like, *(change(t, range(6, 10)) for t in like)])}
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    signed = {r["id"]: (set(r["s"]["sh"]), set(r["s"]["bands"])) for r in df.select("id", similarity.signature_udf(2, 1)("t").alias("s")).collect()}
    root = {i: i for i in texts}
    for a in texts:
        for b in (b for b in texts if b < a):
            (x, p), (y, q) = signed[a], signed[b]
            if p & q and len(x & y) * 1.8 >= (len(x) + len(y)) * 0.8 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    compare = similarity.compare_cells
    for cell in (256, 2):
        monkeypatch.setattr(similarity, "compare_cells", lambda entries, sets, threshold, cell=cell: compare(entries, sets, threshold, cell))
        assert {r["id"]: r["group"] for r in similarity.similar_groups(df, "id", "t", bands=2, rows=1).collect()} == root


@pytest.mark.parametrize("threshold, block", [(0.3, 16_384), (0.8, 7), (1.0, 7)])
def test_no_link_is_missed(spark, monkeypatch, threshold, block):
    """The groups that comparing all pairs makes, for texts of very different sizes, one block a class or many; at 0.3 bands would miss most links."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij😀") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    texts = {"", "a", "ab ", "b", None}
    for length in (1, 2, 4, 9, 30, 30, 120, 600):
        base = [rng.choice(words) for _ in range(length)]
        for _ in range(14):
            texts.add(" ".join(rng.choice(words) if rng.random() < 0.08 else w for w in base) + rng.choice(["", "", " ", "  "]))
    texts = dict(enumerate(sorted(texts, key=str)))
    sets = {i: {t[k : k + 3] for k in range(len(t) - 2)} for i, t in ((i, (t or "").ljust(3)) for i, t in texts.items())}
    root = {i: i for i in texts}
    for a in texts:
        for b in range(a):
            if len(sets[a] & sets[b]) * (1 + threshold) >= (len(sets[a]) + len(sets[b])) * threshold and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    monkeypatch.setattr(similarity, "BLOCK", block)
    got = similarity.similar_groups(spark.createDataFrame(list(texts.items()), "id long, t string"), "id", "t", threshold)
    assert {r["id"]: r["group"] for r in got.collect()} == root and len(set(root.values())) > 5
    assert similarity.similar_groups(spark.createDataFrame([], "id long, t string"), "id", "t", threshold).count() == 0


def test_texts_are_not_copied_for_the_blocks_they_meet(spark, monkeypatch):
    """However many blocks there are, a frame that is written or shuffled holds each text once."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(80)]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(40)]
    rows = [(i, t, i % 7) for i, t in enumerate(texts + [t[:-1] for t in texts])]
    frames, write = [], DataFrameWriter.parquet

    def noted(self, *args, **named):
        frames.append(self._df)
        return write(self, *args, **named)

    monkeypatch.setattr(similarity, "BLOCK", 9)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    df = spark.createDataFrame(rows, "id long, t string, m int")
    got = {r["id"]: r["group"] for r in similarity.similar_groups(df.select("id", "t"), "id", "t").collect()}
    monkeypatch.undo()
    assert all(got[i] == got[i + 40] == i for i in range(40))
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in frames]
    assert not any("Generate" in x or "Join" in x and "bits" in x for x in plans)
    assert {f.count() for f in frames if "bits" in f.columns} == {80}
    carried = similarity.similar_groups(df, "id", "t", carry=["m"]).collect()
    assert {(r["id"], r["group"], r["m"]) for r in carried} == {(i, i % 40, i % 7) for i in range(80)} and len(carried) == 80


def test_default_focus_terms(spark):
    from tidewell.plans import retrieval

    rows = [(1, "年假有几天", "a", "annual leave and paid leave"), (1, "年假有几天", "b", "something else"), (2, "其他", "c", "something else")]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "query_id long, question string, chunk_id string, text string, score double, rank_no long")
    assert {r["chunk_id"] for r in retrieval.focus_filter(df).collect()} == {"a", "c"}


def plain_reached(events, steps):
    """Steps taken by each user: at every instant, in time order, further steps are taken while one of their events is there."""
    by_user = {}
    for user, at, kind in events:
        if user is not None and at is not None:
            by_user.setdefault(user, {}).setdefault(at, set()).add(kind)
    out = {}
    for user, instants in by_user.items():
        state = 0
        for at in sorted(instants):
            while state < len(steps) and steps[state] in instants[at]:
                state += 1
        out[user] = state
    return out


def test_funnel_follows_the_order_of_events(spark, rng):
    """Repeated steps, ties, rows out of order, users without a first step, and a hot user over many days."""
    t0 = dt.datetime(2024, 1, 1)
    kinds = ["click", "view", "click", "purchase"]
    events = [(1, t0 + dt.timedelta(hours=h), kind) for h, kind in enumerate(kinds)]  # a click before and after the view
    events += [(2, t0, "purchase"), (2, t0, "click"), (2, t0, "view"), (3, t0, "purchase"), (None, t0, "view"), (4, None, "view"), (5, t0, "other")]
    events += [(6, t0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 40)), rng.choice(["view", "other"])) for _ in range(3000)]
    events += [(6, t0 + dt.timedelta(days=20), "click"), (6, t0 + dt.timedelta(days=20, hours=1), "purchase")]
    events += [(10 + rng.randrange(40), t0 + dt.timedelta(hours=rng.randrange(90)), rng.choice([*kinds, "other", None])) for _ in range(400)]
    rng.shuffle(events)
    df = spark.createDataFrame(events, "u long, t timestamp_ntz, kind string")
    steps = ["view", "click", "purchase"]
    conds = [(s, F.col("kind") == s) for s in steps]
    for part in ("day", "hour", "month"):
        got = {r.u: r.reached for r in metrics.steps_reached(df, "u", "t", conds, part).collect()}
        want = plain_reached(events, steps)
        assert got == {u: want[u] for u in got} and all(want[u] == 0 for u in want.keys() - got.keys())
    assert (got[1], got[2], got[3], got[6]) == (3, 3, 0, 3)
    rows = metrics.conversion_funnel(df, "u", "t", conds).orderBy("step_no").collect()
    assert [r.user_cnt for r in rows] == [sum(v > i for v in want.values()) for i in range(3)]
    empty = metrics.conversion_funnel(df.limit(0), "u", "t", conds).orderBy("step_no").collect()
    assert [(r.user_cnt, r.step_rate) for r in empty] == [(0, None)] * 3


def test_sketches_of_days_give_periods(spark):
    """Periods read sketches only, days without events included; estimates are within four standard errors."""
    t0 = dt.datetime(2024, 1, 1)
    days = [d for d in range(45) if d % 9]
    rows = spark.createDataFrame([(d,) for d in days], "d int").withColumn("u", F.explode(F.sequence(F.col("d") * 300, F.col("d") * 300 + 2999)))
    events = rows.select((F.lit(t0) + F.make_dt_interval(F.col("d"))).alias("t"), "u")
    sketches = metrics.daily_sketches(events, "t", "u")
    assert sketches.count() == len(days)
    for length in (1, 7, 30):
        got = {(r.day - t0.date()).days: r.distinct_cnt for r in metrics.period_distinct(sketches, length).collect()}
        assert sorted(got) == days
        for d in days:
            exact = len({u for x in days if d - length < x <= d for u in range(x * 300, x * 300 + 3000)})
            assert abs(got[d] - exact) <= 4 * 1.04 / 64 * exact
    assert metrics.period_distinct(metrics.daily_sketches(events.limit(0), "t", "u"), 7).count() == 0


def test_contraction_reads_less_every_round(spark, rng):
    """A long chain, a hot key, a tree and lone members: as the plain version, and settled edges are not read again."""
    edges = [(i, f"e{i}") for i in range(400)] + [(i + 1, f"e{i}") for i in range(400)]
    edges += [(1000 + i, "hot") for i in range(300)] + [(2000, "alone"), (2001, None), (None, "hot")]
    edges += [(3000 + i, f"t{i}") for i in range(1, 120)] + [(3000 + (i - 1) // 2, f"t{i}") for i in range(1, 120)]
    edges += [(5000 + rng.randrange(200), f"r{rng.randrange(150)}") for _ in range(260)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "m long, k string")
    trace = []
    got = {r.m: r.component for r in graph.contracted_components(df, "m", "k", trace).collect()}
    assert got == {r.m: r.component for r in graph.member_components(df, "m", "k").collect()}
    assert {got[i] for i in range(401)} == {0} and {got[1000 + i] for i in range(300)} == {1000} and got[2000] == 2000 and {got[3000 + i] for i in range(120)} == {3000}
    assert all(b < a for a, b in zip(trace, trace[1:])) and len(trace) < 15
    assert graph.contracted_components(df.limit(0), "m", "k").count() == 0


def test_payload_rounds_exact_sums(spark):
    """A double of ten billion thousands keeps no fourth decimal: rounded from it, the cost would end in .13."""
    from tidewell.plans import finance

    clean = spark.createDataFrame([("N", "2024-01", 2e13, 1e13, 1e13, 1.0), ("N", "2024-01", 0.1249, 0.1249, 0.0, 1.0)], "region string, month string, sales_amount double, cost_amount double, profit double, order_count double")
    sums = '"sales_amount":20000000000000.12,"cost_amount":10000000000000.12,"profit":10000000000000.00,"order_count":2'
    summary = '"total_sales":20000000000000.12,"total_cost":10000000000000.12,"total_profit":10000000000000.00,"total_orders":2,"profit_margin":0.5000'
    assert finance.json_payload(clean).first()[0] == f'{{"summary":{{{summary}}},"by_region":[{{"region":"N",{sums}}}],"by_month":[{{"month":"2024-01",{sums}}}]}}'
