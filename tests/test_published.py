"""Default thresholds on the published small inputs give the published results."""

import csv
import io

import pytest
from published import EXPECTED, INPUTS
from pyspark.sql import functions as F

from tidewell.plans import bank, charging, finance, game, live

TYPES = {
    "double": "avg_rank top4_rate win_rate balance amount credit_limit used_credit overdue_amount tariff_cny_per_kwh energy_kwh amount_cny online_rate",
    "int": "play_cnt top4_cnt win_cnt player_cnt cost appear_cnt dpd_days is_current_overdue available_ports is_success queue_minutes fault_count duration_seconds duration_hours refund_flag",
    "date": "dt snapshot_date due_date",
    "timestamp_ntz": "txn_time start_time end_time register_time send_time report_time review_time punish_time order_time",
}
KIND = {column: kind for kind, columns in TYPES.items() for column in columns.split()}


def parsed(text):
    return list(csv.DictReader(io.StringIO(text.strip())))


@pytest.fixture(scope="module")
def given(spark):
    def read(name):
        rows = parsed(INPUTS[name])
        raw = spark.createDataFrame([[v or None for v in r.values()] for r in rows], ", ".join(f"{c} string" for c in rows[0]))
        return raw.select(*[F.col(c).cast(KIND.get(c, "string")).alias(c) for c in raw.columns])

    return read


def agree(df, name, keys, skip=()):
    """Same rows and values; numbers to four digits."""
    want = {tuple(r[k] for k in keys): r for r in parsed(EXPECTED[name])}
    got = {tuple(str(r[k]) for k in keys): r for r in df.collect()}
    assert got.keys() == want.keys()
    for key, expected in want.items():
        for column, value in expected.items():
            if column in skip or column in keys:
                continue
            have = got[key][column]
            if value == "":
                assert have is None, (key, column)
            elif isinstance(have, (int, float)):
                assert float(have) == pytest.approx(float(value), abs=6e-5), (key, column)
            else:
                assert str(have) == value, (key, column)


@pytest.fixture(scope="module")
def bank_layers(given):
    transactions = given("transaction").withColumns({"channel": F.lower("channel"), "txn_type": F.lower("txn_type"), "txn_status": F.upper("txn_status")})
    accounts = given("account").withColumn("status", F.upper("status"))
    credit = given("credit").withColumn("utilization_rate", F.round(F.col("used_credit") / F.col("credit_limit"), 4))
    customers = accounts.select("customer_id").distinct()
    behavior = bank.customer_behavior(transactions, accounts)
    scores = bank.customer_risk_score(bank.customer_risk_features(customers, behavior, credit, given("overdue"), accounts))
    return customers, transactions, accounts, behavior, scores


def test_bank(bank_layers):
    customers, transactions, accounts, behavior, scores = bank_layers
    agree(scores, "customer_risk_score", ["customer_id"])
    agree(bank.customer_segment(customers, behavior, accounts, scores), "customer_segment", ["customer_id"])
    agree(bank.abnormal_transactions(transactions, accounts), "abnormal_transactions", ["txn_id"])


def test_charging(given):
    facts, payments = charging.charge_fact(given("charge_order")), given("charge_payment")
    stations = given("station").withColumnRenamed("zone", "station_zone")
    operability = charging.station_operability(stations, charging.station_performance(facts, payments), given("station_ops"))
    pairs = charging.candidate_features(given("vehicle"), stations, charging.vehicle_station_preference(facts, payments), operability)
    agree(charging.reco_topn(pairs), "reco_topn", ["vehicle_id", "station_id"])


def test_live_platform(given):
    accounts, messages, reports = given("behavior"), given("message"), given("report")
    punishments, payments = given("punishment"), given("payment")
    agree(live.suspect_clusters(accounts, payments, reports, punishments), "suspect_clusters", ["cluster_type", "cluster_key"])
    agree(live.room_risk_features(given("room"), messages, reports, punishments), "room_risk_features", ["room_id"])
    features = live.account_risk_features(accounts, messages, reports, punishments, payments, F.lit("2026-06-25").cast("timestamp_ntz"))
    agree(features, "account_risk_features", ["user_id"], skip=("account_age_hours",))
    agree(live.risk_event_ranking(live.bad_case_review(given("review"), features)), "risk_event_ranking", ["case_id"])


def test_game(given):
    daily = given("comp_daily")
    agree(game.patch_delta_reading(daily, "S11.3", "S11.4"), "patch_delta", ["comp_id"])
    agree(game.comp_meta_summary(daily), "comp_meta", ["comp_id"])
    agree(game.migration_share(given("migration")), "migration_share", ["before_comp_id", "after_comp_id"])
    agree(game.unit_item_risk(given("unit_item")), "unit_item_risk", ["patch_version", "unit_id", "item_combo"])


def test_finance(spark):
    def raw(name, numbered=False):
        rows = parsed_with_blanks(INPUTS[name])
        values = [[v or None for v in r.values()] + ([i if any(r.values()) else None] if numbered else []) for i, r in enumerate(rows)]
        return spark.createDataFrame(values, ", ".join(f"{c} string" for c in rows[0]) + (", file_row long" if numbered else ""))

    orders = raw("order_raw", numbered=True)
    reconciled = finance.reconcile_orders(finance.clean_orders(orders), finance.clean_payments(raw("pay_raw")), finance.clean_refunds(raw("refund_raw")))
    agree(reconciled, "clean_orders", ["order_id"])
    agree(finance.reconcile_alerts(reconciled), "alerts", ["order_id"])
    agree(finance.daily_finance_report(reconciled), "daily_finance", ["order_date", "shop"])
    assert {r["issue"]: r["affected_rows"] for r in finance.cleaning_log(orders).collect()} == {"空行": 1, "重复订单": 1}


def parsed_with_blanks(text):
    """Rows of the text, with blank lines between them as rows without values."""
    lines = text.strip("\n").split("\n")
    head = next(csv.reader(lines[:1]))
    return [dict(zip(head, [*(row or []), *[""] * len(head)])) for row in csv.reader(lines[1:])]
