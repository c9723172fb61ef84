"""Streams over the shared tables, run to the end of their input, with the closed part as check SQL.

In append mode a window appears once the watermark has passed its end; the checks apply the same rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, money, sql
from tidewell.operators import quality as dq
from tidewell.operators import snapshots
from tidewell.session import scratch_path
from tidewell.sources.star import Star
from tidewell.streaming import jobs


class StreamedStar(Star):
    """The same derivations, with one table read as a file stream."""

    def __init__(self, s: Star, streamed: str):
        super().__init__(s.spark, s.root)
        self.streamed = streamed

    def table(self, name: str):
        if name != self.streamed:
            return super().table(name)
        return jobs.file_stream(self.spark, self.root, super().table(name).schema, f"{name}.parquet")


def closed(ts: str, table: str, end: str) -> str:
    return f"{end} <= (SELECT MAX({ts}) - INTERVAL 1 HOUR FROM {table})"


cte("slides", """
SELECT t.*, time_bucket(INTERVAL 10 MINUTE, txn_time) - i * INTERVAL 10 MINUTE AS window_start FROM fact_transaction t, range(6) r(i)
""")


@query("stream_abnormal_txn", sql(f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, account_id, COUNT(*) AS txn_cnt, COUNT(*) FILTER (WHERE txn_status = 'FAILED') AS failed_cnt, {money('amount')} AS amount_sum
FROM slides GROUP BY window_start, account_id HAVING COUNT(*) >= 2 AND {closed('txn_time', 'fact_transaction', 'window_start + INTERVAL 1 HOUR')}
"""))
def _(s: Star):
    return jobs.run_to_table(jobs.abnormal_windows(StreamedStar(s, "events").fact_transaction(), 2), "abnormal-windows")


@query("stream_station_status", sql(f"""
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, station_id, COUNT(*) AS order_cnt, {money('energy_kwh')} AS energy_sum, MAX(start_time) AS last_start
FROM (SELECT o.*, date_trunc('day', start_time)::TIMESTAMP - i * INTERVAL 1 DAY AS window_start FROM charge_order o, range(7) r(i)) GROUP BY window_start, station_id
HAVING {closed('start_time', 'charge_order', 'window_start + INTERVAL 7 DAY')}
"""))
def _(s: Star):
    return jobs.run_to_table(jobs.station_status(StreamedStar(s, "lineitem").charge_order()), "station-status")


@query("stream_risk_daily", sql(f"SELECT * FROM risk_daily_layer WHERE {closed('punish_time', 'punishment_event', 'metric_date + INTERVAL 1 DAY')}"))
def _(s: Star):
    return jobs.run_to_table(jobs.risk_daily(StreamedStar(s, "events").punishment_event()), "risk-daily")


@query("stream_dedup", sql("SELECT event_id, user_id, ts FROM events"))
def _(s: Star):
    # Every event is delivered twice.
    e = StreamedStar(s, "events").table("events").select("event_id", "user_id", "ts")
    replayed = e.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return jobs.run_to_table(jobs.deduplicated(replayed, "event_id", "ts"), "dedup")


@query("stream_static_enrich", sql("SELECT t.*, a.customer_id, a.status FROM fact_transaction t LEFT JOIN dim_account a ON t.account_id = a.account_id"))
def _(s: Star):
    accounts = s.dim_account().select("account_id", "customer_id", "status")
    return jobs.run_to_table(jobs.enriched(StreamedStar(s, "events").fact_transaction(), accounts, "account_id"), "enriched")


@query("stream_versioned_enrich", sql("""
SELECT t.txn_id, t.txn_time, t.account_id, a.customer_id, CASE WHEN EXTRACT(DAY FROM t.txn_time) <= 15 THEN a.status || ' (old)' ELSE a.status END AS status,
       CASE WHEN EXTRACT(DAY FROM t.txn_time) <= 15 THEN 1 ELSE 2 END AS dim_version
FROM fact_transaction t LEFT JOIN dim_account a ON t.account_id = a.account_id
"""))
def _(s: Star):
    # The transactions of the first half of the months arrive before the accounts change, the others after it.
    facts, accounts = s.fact_transaction().select("txn_id", "txn_time", "account_id"), s.dim_account().select("account_id", "customer_id", "status")
    arrived, out, progress = (scratch_path(s.spark, f"arrivals-{part}") for part in ("in", "out", "progress"))
    store, early = snapshots.SnapshotStore(s.spark, scratch_path(s.spark, "account-versions"), "account_id"), F.dayofmonth("txn_time") <= 15
    for dimension, rows in ((accounts.withColumn("status", F.concat("status", F.lit(" (old)"))), facts.where(early)), (accounts, facts.where(~early))):
        store.commit(dimension)
        rows.write.mode("append").parquet(arrived)
        joined = jobs.enriched_by_version(jobs.file_stream(s.spark, arrived, facts.schema), store, "account_id", "versioned", out, progress)
    return joined.drop("batch_id")


@query("stream_session", sql(f"""
WITH numbered AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM (
  SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)),
one AS (SELECT user_id, session_no, MIN(ts) AS t1 FROM numbered WHERE event_type = 'view' GROUP BY 1, 2),
two AS (SELECT user_id, session_no, t1, MIN(ts) AS t2 FROM one JOIN numbered USING (user_id, session_no) WHERE event_type = 'click' AND ts >= t1 GROUP BY 1, 2, 3),
three AS (SELECT user_id, session_no, MIN(ts) AS t3 FROM two JOIN numbered USING (user_id, session_no) WHERE event_type = 'purchase' AND ts >= t2 GROUP BY 1, 2),
counted AS (
  SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL 30 MINUTE AS window_end, user_id, session_no, COUNT(*) AS event_cnt, COUNT(*) FILTER (WHERE event_type = 'view') AS message_cnt,
         COUNT(*) FILTER (WHERE event_type = 'click') AS private_cnt, COUNT(*) FILTER (WHERE event_type = 'purchase') AS payment_cnt
  FROM numbered GROUP BY user_id, session_no HAVING {closed('ts', 'events', 'MAX(ts) + INTERVAL 30 MINUTE')})
SELECT window_start, window_end, user_id, event_cnt, message_cnt, private_cnt, payment_cnt, (one.t1 IS NOT NULL)::INT + (t2 IS NOT NULL)::INT + (t3 IS NOT NULL)::INT AS chain_steps, t3 AS chain_end
FROM counted LEFT JOIN one USING (user_id, session_no) LEFT JOIN two USING (user_id, session_no) LEFT JOIN three USING (user_id, session_no)
"""))
def _(s: Star):
    return jobs.run_to_table(jobs.behaviour_chains(StreamedStar(s, "events").table("events"), "user_id", "ts"), "behaviour-chains")


@query("stream_dq", sql("""
SELECT 'amount >= 0' AS check_item, CASE WHEN COUNT(*) FILTER (WHERE amount < 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS check_result, CAST(COUNT(*) FILTER (WHERE amount < 0) AS VARCHAR) AS detail, 0::BIGINT AS batch_id FROM fact_transaction
UNION ALL SELECT 'rows arrived', CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END, CAST(COUNT(*) AS VARCHAR), 0 FROM fact_transaction
"""))
def _(s: Star):
    check = lambda batch, _: dq.run_checks(batch, dq.non_negative("amount >= 0", "amount"), dq.row_count("rows arrived"))
    return jobs.run_per_batch(StreamedStar(s, "events").fact_transaction(), "stream-dq", check, "check_item string, check_result string, detail string")
