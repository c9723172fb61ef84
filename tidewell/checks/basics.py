"""Sources, cleaning, joins, aggregates, windows, sets and scalar functions, one query per operator shape."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.checks import bank as bank_checks
from tidewell.checks import charging as charging_checks
from tidewell.checks import finance as finance_checks
from tidewell.checks import live as live_checks
from tidewell.checks.catalog import query
from tidewell.checks.ctes import K, cents_text, cte, money, ratio, rnd, sql
from tidewell.functions import exprs as x
from tidewell.functions import text as tx
from tidewell.operators import layout
from tidewell.operators import ranking as rk
from tidewell.operators import relational as rel
from tidewell.plans import bank, charging, game, live
from tidewell.session import scratch_path
from tidewell.sources import files
from tidewell.sources.star import Star

# --- sources and sinks ----------------------------------------------------------------------------------

TXN_SCHEMA = "txn_id long, account_id long, amount double, txn_time timestamp_ntz, channel string, txn_type string, txn_status string"


@query("read_csv_table", sql("SELECT * FROM fact_transaction"))
def _(s: Star):
    path = files.write_csv_result(s.fact_transaction(), scratch_path(s.spark, "transactions"))
    return files.read_csv_table(s.spark, path, TXN_SCHEMA)


@query("read_csv_dates", sql("SELECT dt, patch_version, region, rank_tier, comp_id, play_cnt FROM comp_daily"))
def _(s: Star):
    daily = s.comp_daily().select(F.date_format("dt", "yyyy/MM/dd").alias("dt"), "patch_version", "region", "rank_tier", "comp_id", "play_cnt")
    path = files.write_csv_result(daily, scratch_path(s.spark, "daily"))
    schema = "dt date, patch_version string, region string, rank_tier string, comp_id string, play_cnt long"
    return files.read_csv_table(s.spark, path, schema, "yyyy/MM/dd")


@query("require_columns", sql("SELECT date, region, sales_amount FROM sales_raw"))
def _(s: Star):
    return rel.require_columns(s.sales_raw(), ["date", "region", "sales_amount", "cost_amount", "order_count"]).select("date", "region", "sales_amount")


@query("read_documents", sql("SELECT source, CAST(SUM(length(text) + 1) AS BIGINT) AS char_cnt FROM documents GROUP BY 1"))
def _(s: Star):
    folder = scratch_path(s.spark, "documents")
    s.table("documents").select("source", "text").write.partitionBy("source").option("lineSep", "\n").text(folder)
    docs = files.read_documents(s.spark, folder)
    return docs.groupBy(F.regexp_extract("path", "source=([^/]+)", 1).alias("source")).agg(F.sum(F.length("text").cast("long")).alias("char_cnt"))


@query("write_csv_result", sql("SELECT customer_id, name, city FROM dim_customer"))
def _(s: Star):
    path = files.write_csv_result(s.dim_customer(), scratch_path(s.spark, "customers"), ["city", "customer_id"])
    return files.read_csv_table(s.spark, path, "customer_id long, name string, city string")


# --- projection, filter, cleaning -----------------------------------------------------------------------


@query("dwd_standardize", sql("""
SELECT CAST(event_id AS BIGINT) AS txn_id, CAST(value AS DOUBLE) AS amount, lower(event_type) AS channel,
       upper(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END) AS txn_status, CAST(ts AS DATE) AS txn_date FROM events
"""))
def _(s: Star):
    return s.fact_transaction().select(
        F.col("txn_id").cast("long").alias("txn_id"), F.col("amount").cast("double").alias("amount"), F.lower("channel").alias("channel"),
        F.upper(F.lower("txn_status")).alias("txn_status"), F.col("txn_time").cast("date").alias("txn_date"),
    )


@query("filter_status", sql("SELECT order_id, vehicle_id, station_id, energy_kwh FROM charge_order WHERE status = 'COMPLETED'"))
def _(s: Star):
    return s.charge_order().where(F.col("status") == "COMPLETED").select("order_id", "vehicle_id", "station_id", "energy_kwh")


@query("try_cast_date", sql("SELECT order_id, TRY_CAST(order_date AS DATE) AS settle_date FROM (SELECT order_id, CASE WHEN length(order_date) = 10 AND order_date LIKE '%-%' THEN order_date ELSE 'n/a' END AS order_date FROM order_raw)"))
def _(s: Star):
    d = F.when((F.length("order_date") == 10) & F.col("order_date").contains("-"), F.col("order_date")).otherwise("n/a")
    return s.order_raw().select("order_id", d.try_cast("date").alias("settle_date"))


@query("safe_ratio", sql(f"SELECT credit_id, {ratio('used_credit', 'credit_limit')} AS utilization_rate, {ratio('used_credit', 'used_credit')} AS self_rate FROM fact_credit_snapshot"))
def _(s: Star):
    return s.fact_credit_snapshot().select(
        "credit_id", x.safe_ratio("used_credit", "credit_limit").alias("utilization_rate"), x.safe_ratio("used_credit", "used_credit").alias("self_rate")
    )


@query("parse_mixed_date", sql(f"SELECT order_id, {finance_checks.mixed('order_date')} AS order_date FROM order_raw"))
def _(s: Star):
    return s.order_raw().select("order_id", x.parse_mixed_date("order_date").alias("order_date"))


@query("clean_money", sql(f"SELECT file_row, {finance_checks.clean('amount')} AS amount FROM order_raw"))
def _(s: Star):
    return s.order_raw().select("file_row", x.clean_money("amount").alias("amount"))


@query("trim_text_columns", sql("SELECT file_row, trim(shop) AS shop, trim(status) AS status FROM order_raw"))
def _(s: Star):
    return s.order_raw().select("file_row", F.trim("shop").alias("shop"), F.trim("status").alias("status"))


@query("map_values", sql("SELECT file_row, CASE trim(province) WHEN '浙冮' THEN '浙江' WHEN '廣东' THEN '广东' ELSE trim(province) END AS province FROM order_raw"))
def _(s: Star):
    from tidewell.plans.finance import PROVINCES

    return s.order_raw().select("file_row", x.map_values(F.trim("province"), PROVINCES).alias("province"))


@query("drop_all_null_rows", sql("SELECT * FROM order_raw WHERE order_id IS NOT NULL OR file_row IS NOT NULL"))
def _(s: Star):
    return rel.drop_all_null_rows(s.order_raw())


@query("dedup_keep_first", sql("SELECT * FROM order_raw QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY file_row) = 1"))
def _(s: Star):
    return rel.dedup_keep_first(s.order_raw(), ["order_id"], [F.col("file_row")])


@query("null_fill", sql("SELECT c.customer_id, COALESCE(txn_cnt_30d, 0) AS txn_cnt_30d, COALESCE(days_since_last_txn, 999) AS days_since_last_txn FROM dim_customer c LEFT JOIN behavior_layer b ON c.customer_id = b.customer_id"))
def _(s: Star):
    b = bank_checks.Bank(s)
    wide = b.customers.select("customer_id").join(b.behavior().select("customer_id", "txn_cnt_30d", "days_since_last_txn"), "customer_id", "left")
    return rel.null_fill(wide, {"txn_cnt_30d": 0, "days_since_last_txn": 999})


@query("case_label", sql("""
SELECT txn_id, CASE WHEN amount >= 200 THEN 'large' WHEN amount >= 50 THEN 'medium' ELSE 'small' END AS first_wins,
       CASE WHEN txn_status = 'FAILED' THEN 'failed' WHEN amount >= 50 THEN 'medium' WHEN amount >= 10 THEN 'small' ELSE 'tiny' END AS last_wins FROM fact_transaction
"""))
def _(s: Star):
    a = F.col("amount")
    return s.fact_transaction().select(
        "txn_id",
        x.label([(a >= 200, "large"), (a >= 50, "medium")], "small").alias("first_wins"),
        x.label_last_wins([(a >= 10, "small"), (a >= 50, "medium"), (F.col("txn_status") == "FAILED", "failed")], "tiny").alias("last_wins"),
    )


@query("disjunctive_filter", sql("SELECT * FROM fact_transaction WHERE amount > 200 OR txn_status = 'FAILED' OR EXTRACT(HOUR FROM txn_time) BETWEEN 0 AND 5"))
def _(s: Star):
    return s.fact_transaction().where(x.any_of([F.col("amount") > 200, F.col("txn_status") == "FAILED", bank.is_night(F.col("txn_time"))]))


@query("mask_sensitive", sql("""
SELECT customer_id, left(name, 3) || repeat('*', length(name) - 7) || right(name, 4) AS phone_style, repeat('*', length(name) - 4) || right(name, 4) AS id_style,
       sha256(CAST(customer_id AS VARCHAR)) AS account_hash FROM dim_customer
"""))
def _(s: Star):
    return s.dim_customer().select(
        "customer_id", x.mask_middle("name").alias("phone_style"), x.mask_head("name").alias("id_style"), x.hash_id("customer_id").alias("account_hash")
    )


@query("retention_filter", sql("SELECT txn_id, txn_time FROM fact_transaction WHERE txn_time >= (SELECT MAX(txn_time) - INTERVAL 20 DAY FROM fact_transaction)"))
def _(s: Star):
    return rel.since(s.fact_transaction(), "txn_time", 20).select("txn_id", "txn_time")


@query("retention_by_day", sql("""
SELECT txn_id, txn_time, account_id, CASE WHEN txn_time::DATE > newest::DATE - 3 THEN amount + 1 ELSE amount END AS amount
FROM fact_transaction, (SELECT MAX(txn_time) AS newest FROM fact_transaction) WHERE txn_time >= newest - INTERVAL 20 DAY
"""))
def _(s: Star):
    # All days are loaded, the last three again with corrected amounts, and days out of retention are dropped.
    facts = s.fact_transaction().select("txn_id", "txn_time", "account_id", "amount")
    path, schema = scratch_path(s.spark, "facts-by-day"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in facts.schema)
    layout.write_days(facts, "txn_time", path)
    newest = max(layout.stored_days(s.spark, path), default=dt.date.min)
    layout.write_days(facts.where(F.col("txn_time").cast("date") > F.date_sub(F.lit(newest), 3)).withColumn("amount", F.col("amount") + 1), "txn_time", path)
    layout.drop_days_before(s.spark, path, newest - dt.timedelta(days=20) if newest > dt.date.min else newest)
    return layout.recent_facts(s.spark, path, schema, "txn_time", 20).drop(layout.DAY)


# --- joins ----------------------------------------------------------------------------------------------


@query("inner_join_dim", sql("SELECT * FROM txn_customer"))
def _(s: Star):
    return bank.with_customer(s.fact_transaction(), s.dim_account())


@query("left_join_fill", sql("""
SELECT c.customer_id, COALESCE(n, 0) AS order_cnt, COALESCE(t, 0) AS txn_cnt FROM dim_customer c
LEFT JOIN (SELECT customer_id, COUNT(*) AS n FROM fact_credit_snapshot GROUP BY 1) o ON c.customer_id = o.customer_id
LEFT JOIN (SELECT account_id, COUNT(*) AS t FROM fact_transaction GROUP BY 1) f ON c.customer_id = f.account_id
"""))
def _(s: Star):
    orders = s.fact_credit_snapshot().groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_cnt"))
    txns = s.fact_transaction().groupBy(F.col("account_id").alias("customer_id")).agg(F.count(F.lit(1)).alias("txn_cnt"))
    wide = s.dim_customer().select("customer_id").join(orders, "customer_id", "left").join(txns, "customer_id", "left")
    return wide.na.fill(0, ["order_cnt", "txn_cnt"])


@query("full_outer_compare", sql("""
SELECT COALESCE(a.customer_id, b.customer_id) AS customer_id, COALESCE(a.n, 0) AS before_cnt, COALESCE(b.n, 0) AS after_cnt
FROM (SELECT customer_id, COUNT(*) AS n FROM fact_credit_snapshot WHERE snapshot_date < DATE '1998-07-01' GROUP BY 1) a
FULL OUTER JOIN (SELECT customer_id, COUNT(*) AS n FROM fact_credit_snapshot WHERE snapshot_date >= DATE '1998-07-01' GROUP BY 1) b ON a.customer_id = b.customer_id
"""))
def _(s: Star):
    cut = F.lit("1998-07-01").cast("date")
    credit = s.fact_credit_snapshot()
    before = credit.where(F.col("snapshot_date") < cut).groupBy("customer_id").agg(F.count(F.lit(1)).alias("before_cnt"))
    after = credit.where(F.col("snapshot_date") >= cut).groupBy("customer_id").agg(F.count(F.lit(1)).alias("after_cnt"))
    return before.join(after, "customer_id", "full_outer").na.fill(0, ["before_cnt", "after_cnt"])


@query("cross_join_candidates", sql("""
SELECT v.vehicle_id, COUNT(*) AS candidate_cnt, COUNT(*) FILTER (WHERE v.home_zone = s.station_zone) AS zone_match_cnt,
       COUNT(*) FILTER (WHERE v.preferred_power_type = s.power_type) AS power_match_cnt,
       COUNT(*) FILTER (WHERE v.home_zone = s.station_zone AND v.preferred_power_type = s.power_type) AS both_match_cnt
FROM dim_vehicle v CROSS JOIN dim_station s GROUP BY 1
"""))
def _(s: Star):
    return charging.candidate_grid(s.dim_vehicle(), s.dim_station())


@query("self_join_cluster_size", sql("SELECT a.user_id, COUNT(DISTINCT b.user_id) AS device_user_cnt FROM account_behavior a LEFT JOIN account_behavior b ON a.device_id = b.device_id GROUP BY 1"))
def _(s: Star):
    return rel.group_members(s.account_behavior(), "device_id", "user_id", "device_user_cnt")


@query("multi_fanout_join", sql("SELECT room_id, message_cnt, report_cnt, punished_user_cnt FROM room_feature_layer"))
def _(s: Star):
    return live_checks.Live(s).room_features().select("room_id", "message_cnt", "report_cnt", "punished_user_cnt")


@query("non_equi_self_join", sql("""
SELECT a.user_id, COUNT(DISTINCT b.user_id) AS ip_user_cnt FROM account_behavior a
LEFT JOIN account_behavior b ON a.ip = b.ip AND b.register_time >= TIMESTAMP '2024-01-01 08:00:00' GROUP BY 1
"""))
def _(s: Star):
    recent = F.col("register_time") >= F.lit("2024-01-01 08:00:00").cast("timestamp_ntz")
    return rel.group_members(s.account_behavior(), "ip", "user_id", "ip_user_cnt", recent)


@query("fk_anti_check", sql("SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"))
def _(s: Star):
    return rel.orphans(s.table("documents"), "doc_id", s.table("labels")).select("doc_id", "source")


@query("scalar_subquery_join", sql("SELECT txn_id, amount FROM fact_transaction WHERE amount >= (SELECT MAX(amount) / 2 FROM fact_transaction)"))
def _(s: Star):
    t = s.fact_transaction()
    return t.where(F.col("amount") >= rel.scalar(t, F.max("amount")) / F.lit(2.0)).select("txn_id", "amount")


@query("key_share_join", sql("""
SELECT c.*, c.play_cnt / CAST(t.total AS DOUBLE) AS share FROM (SELECT region, rank_tier, final_comp_id, COUNT(*) AS play_cnt FROM match_result GROUP BY 1, 2, 3) c
JOIN (SELECT region, rank_tier, COUNT(*) AS total FROM match_result GROUP BY 1, 2) t ON c.region = t.region AND c.rank_tier = t.rank_tier
"""))
def _(s: Star):
    counts = s.match_result().groupBy("region", "rank_tier", "final_comp_id").agg(F.count(F.lit(1)).alias("play_cnt"))
    total = F.sum("play_cnt").over(Window.partitionBy("region", "rank_tier"))
    return counts.withColumn("share", F.col("play_cnt").cast("double") / total.cast("double"))


# --- aggregations ---------------------------------------------------------------------------------------


@query("group_basic", sql(f"""
SELECT station_id, COUNT(*) AS n, {money('energy_kwh')} AS energy_sum, {money('energy_kwh')} / COUNT(energy_kwh) AS energy_avg, MIN(start_time) AS first_start, MAX(start_time) AS last_start
FROM charge_order GROUP BY 1
"""))
def _(s: Star):
    return s.charge_order().groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n"), x.money_sum("energy_kwh").alias("energy_sum"), x.money_avg("energy_kwh").alias("energy_avg"),
        F.min("start_time").alias("first_start"), F.max("start_time").alias("last_start"),
    )


@query("group_stddev", sql(f"SELECT customer_id, COALESCE({rnd('STDDEV_SAMP(amount)', 2)}, 0) AS std_amount FROM txn_customer GROUP BY 1"))
def _(s: Star):
    t = bank.with_customer(s.fact_transaction(), s.dim_account())
    return t.groupBy("customer_id").agg(F.coalesce(x.round_n(F.stddev_samp("amount"), 2), F.lit(0.0)).alias("std_amount"))


@query("count_distinct", sql("SELECT user_id, COUNT(DISTINCT message_id) AS message_cnt_all, COUNT(DISTINCT CASE WHEN message_type = 'private_message' THEN message_id END) AS private_message_cnt FROM message_event GROUP BY 1"))
def _(s: Star):
    return live.message_counts(s.message_event())


@query("conditional_sum", sql(f"""
SELECT customer_id, COUNT(*) FILTER (WHERE is_current_overdue = 1) AS current_cnt, {money('CASE WHEN is_current_overdue = 1 THEN overdue_amount ELSE 0 END')} AS current_amount
FROM fact_overdue GROUP BY 1
"""))
def _(s: Star):
    current = F.col("is_current_overdue") == 1
    return s.fact_overdue().groupBy("customer_id").agg(
        F.count_if(current).alias("current_cnt"), x.money_sum(F.when(current, F.col("overdue_amount")).otherwise(0.0)).alias("current_amount")
    )


@query("conditional_rate", sql("SELECT unit_id, CAST(COUNT(*) FILTER (WHERE rank_no <= 4) AS DOUBLE) / COUNT(*) AS top4_rate FROM match_result GROUP BY 1"))
def _(s: Star):
    return s.match_result().groupBy("unit_id").agg(x.rate(F.col("rank_no") <= 4).alias("top4_rate"))


@query("filtered_count", sql("SELECT risk_type, COUNT(*) FILTER (WHERE punish_type = 'ban') AS ban_cnt, COUNT(*) FILTER (WHERE punish_type = 'mute') AS mute_cnt FROM punishment_event GROUP BY 1"))
def _(s: Star):
    kind = F.col("punish_type")
    return s.punishment_event().groupBy("risk_type").agg(F.count_if(kind == "ban").alias("ban_cnt"), F.count_if(kind == "mute").alias("mute_cnt"))


@query("having_filter", sql("SELECT unit_id, item_combo, COUNT(*) AS n FROM match_result GROUP BY 1, 2 HAVING COUNT(*) >= 300"))
def _(s: Star):
    return s.match_result().groupBy("unit_id", "item_combo").agg(F.count(F.lit(1)).alias("n")).where("n >= 300")


@query("any_flag", sql("SELECT customer_id, MAX(CASE WHEN dpd_days > 45 THEN 1 ELSE 0 END) AS long_overdue_flag FROM fact_overdue GROUP BY 1"))
def _(s: Star):
    return s.fact_overdue().groupBy("customer_id").agg(F.bool_or(F.col("dpd_days") > 45).cast("int").alias("long_overdue_flag"))


@query("group_named_pandas", sql("""
SELECT patch_version, final_comp_id, COUNT(match_id) AS play_cnt, CAST(COUNT(*) FILTER (WHERE rank_no <= 4) AS DOUBLE) / COUNT(*) AS top4_rate,
       CAST(COUNT(*) FILTER (WHERE rank_no = 1) AS DOUBLE) / COUNT(*) AS win_rate, CAST(SUM(rank_no) AS DOUBLE) / COUNT(rank_no) AS avg_rank
FROM match_result WHERE patch_version IS NOT NULL AND final_comp_id IS NOT NULL GROUP BY 1, 2
"""))
def _(s: Star):
    keyed = s.match_result().where(F.col("patch_version").isNotNull() & F.col("final_comp_id").isNotNull())
    return keyed.groupBy("patch_version", "final_comp_id").agg(
        F.count("match_id").alias("play_cnt"), x.rate(F.col("rank_no") <= 4).alias("top4_rate"), x.rate(F.col("rank_no") == 1).alias("win_rate"),
        x.int_avg("rank_no").alias("avg_rank"),
    )


@query("global_totals", sql(f"SELECT {money('amount')} AS total_amount, COUNT(*) AS order_cnt, {ratio('SUM(refund_flag)', 'COUNT(*)')} AS refund_share FROM payment_order"))
def _(s: Star):
    n = F.count(F.lit(1))
    return s.payment_order().agg(x.money_sum("amount").alias("total_amount"), n.alias("order_cnt"), x.safe_ratio(F.sum("refund_flag"), n).alias("refund_share"))


@query("min_max_of_counts", sql("SELECT MIN(cnt) AS min_cnt, MAX(cnt) AS max_cnt FROM (SELECT vehicle_id, COUNT(*) AS cnt FROM charge_order GROUP BY 1)"))
def _(s: Star):
    per = s.charge_order().groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("cnt"))
    return per.agg(F.min("cnt").alias("min_cnt"), F.max("cnt").alias("max_cnt"))


@query("scalar_snapshot", sql("""
SELECT (SELECT COUNT(*) FROM dim_customer) AS customer_cnt, (SELECT COUNT(*) FROM fact_transaction) AS txn_cnt, (SELECT MAX(txn_time) FROM fact_transaction) AS last_txn,
       (SELECT COUNT(*) FROM fact_overdue WHERE is_current_overdue = 1) AS overdue_cnt
"""))
def _(s: Star):
    head = s.fact_transaction().agg(F.count(F.lit(1)).alias("txn_cnt"), F.max("txn_time").alias("last_txn"))
    return head.select(
        rel.scalar(s.dim_customer(), F.count(F.lit(1))).alias("customer_cnt"), "txn_cnt", "last_txn",
        rel.scalar(s.fact_overdue(), F.count_if(F.col("is_current_overdue") == 1)).alias("overdue_cnt"),
    )


# --- windows --------------------------------------------------------------------------------------------


@query("rank_topn", sql("SELECT * FROM (SELECT customer_id, credit_id, credit_limit, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY credit_limit DESC, credit_id) AS rank_no FROM fact_credit_snapshot) WHERE rank_no <= 3"))
def _(s: Star):
    credit = s.fact_credit_snapshot().select("customer_id", "credit_id", "credit_limit")
    return rk.top_n(credit, ["customer_id"], [F.desc("credit_limit"), F.asc("credit_id")], 3)


@query("rank_over_aggregate", sql("""
SELECT player_id, final_comp_id, cnt FROM (SELECT player_id, final_comp_id, COUNT(*) AS cnt, ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY COUNT(*) DESC, final_comp_id) AS rn
FROM match_result GROUP BY 1, 2) WHERE rn = 1
"""))
def _(s: Star):
    return rk.mode_per_key(s.match_result(), "player_id", "final_comp_id")


@query("qualify_latest", sql("SELECT * FROM latest_credit_layer"))
def _(s: Star):
    return bank.latest_credit(s.fact_credit_snapshot())


@query("count_over_hour", sql("SELECT txn_id, customer_id, date_trunc('hour', txn_time) AS txn_hour, COUNT(*) OVER (PARTITION BY customer_id, date_trunc('hour', txn_time)) AS hourly_txn_cnt FROM txn_customer"))
def _(s: Star):
    t = bank.with_customer(s.fact_transaction(), s.dim_account()).select("txn_id", "customer_id", x.hour_start("txn_time").alias("txn_hour"))
    return rel.count_per_group(t, ["customer_id", "txn_hour"], "hourly_txn_cnt")


@query("rolling_baseline", sql("""
SELECT dt, event_type, n, CASE WHEN COUNT(*) OVER w >= 3 THEN CAST(SUM(n) OVER w AS DOUBLE) / COUNT(*) OVER w END AS baseline
FROM (SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)
WINDOW w AS (PARTITION BY event_type ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
"""))
def _(s: Star):
    daily = s.table("events").groupBy(F.col("ts").cast("date").alias("dt"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return rk.rolling_baseline(daily, "n", "dt", "baseline", ["event_type"])


@query("rank_pct_average", sql(f"SELECT txn_id, {live_checks.pct('amount')} AS amount_pct FROM fact_transaction"))
def _(s: Star):
    return rk.pct_rank_average(s.fact_transaction().select("txn_id", "amount"), {"amount": "amount_pct"}).select("txn_id", "amount_pct")


@query("share_of_total", sql("SELECT city, n, n / (SELECT CAST(COUNT(*) AS DOUBLE) FROM dim_customer) AS share FROM (SELECT city, COUNT(*) AS n FROM dim_customer GROUP BY 1)"))
def _(s: Star):
    return rel.share(s.dim_customer().groupBy("city").agg(F.count(F.lit(1)).alias("n")), "n", "share")


# --- sort, limit, sets ----------------------------------------------------------------------------------


@query("multi_key_sort", sql("SELECT city, name, customer_id FROM dim_customer"))
def _(s: Star):
    return s.dim_customer().select("city", "name", "customer_id").orderBy(F.desc("city"), F.asc("name"), "customer_id")


@query("limit_preview", sql("SELECT txn_id, amount FROM fact_transaction ORDER BY amount DESC, txn_id LIMIT 20"))
def _(s: Star):
    return s.fact_transaction().select("txn_id", "amount").orderBy(F.desc("amount"), "txn_id").limit(20)


@query("best_worst_key", sql("""
SELECT (SELECT region FROM sales_region_layer ORDER BY profit, region LIMIT 1) AS worst_key, MIN(profit) AS worst_value,
       (SELECT region FROM sales_region_layer ORDER BY profit DESC, region DESC LIMIT 1) AS best_key, MAX(profit) AS best_value, COUNT(*) AS key_cnt FROM sales_region_layer
"""))
def _(s: Star):
    from tidewell.plans.finance import sales_by_region

    return rk.best_and_worst(sales_by_region(finance_checks.sales(s)), "region", "profit")


@query("union_distinct", sql("SELECT user_id, order_id, amount FROM participants"))
def _(s: Star):
    return live.payment_participants(s.payment_order())


@query("union_mixed", sql("SELECT * FROM cluster_edges"))
def _(s: Star):
    return live.cluster_members(s.account_behavior(), s.payment_order())


@query("ordered_distinct", sql("""
SELECT user_id, list(event_type ORDER BY first_id) AS event_types FROM (SELECT user_id, event_type, MIN(event_id) AS first_id FROM events GROUP BY 1, 2) GROUP BY 1
"""))
def _(s: Star):
    # First positions are reduced per (user, type) before the list is built, so the list length is bounded by the types.
    first = s.table("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_id"))
    ordered = F.array_sort(F.collect_list(F.struct("first_id", "event_type")))
    return first.groupBy("user_id").agg(F.array_distinct(F.transform(ordered, lambda e: e["event_type"])).alias("event_types"))


# --- scalar functions -----------------------------------------------------------------------------------


@query("fn_null", sql("SELECT file_row, COALESCE(shop, 'none') AS shop, NULLIF(freight, '¥0') AS freight FROM order_raw"))
def _(s: Star):
    return s.order_raw().select("file_row", F.coalesce("shop", F.lit("none")).alias("shop"), F.nullif("freight", F.lit("¥0")).alias("freight"))


@query("fn_math", sql(f"""
SELECT account_id, {rnd('balance', 0)} AS whole, LEAST(balance, 1000e0) AS capped, GREATEST(0e0, LEAST(1e0, balance / 1e4)) AS clamped, abs(balance) AS magnitude FROM dim_account
"""))
def _(s: Star):
    return s.dim_account().select(
        "account_id", x.round_n("balance", 0).alias("whole"), x.capped("balance", 1000).alias("capped"),
        x.clamp(F.col("balance") / F.lit(1e4)).alias("clamped"), F.abs("balance").alias("magnitude"),
    )


@query("fn_date", sql("""
SELECT txn_id, DATE_DIFF('hour', txn_time, TIMESTAMP '2024-02-01') AS hours_left, DATE_DIFF('minute', txn_time, TIMESTAMP '2024-02-01') AS minutes_left,
       DATE_DIFF('day', CAST(txn_time AS DATE), DATE '2024-02-01') AS days_left, date_trunc('hour', txn_time) AS hour_start, EXTRACT(HOUR FROM txn_time) AS hour_no,
       CAST(txn_time AS DATE) AS day, strftime(txn_time, '%Y-%m') AS month, txn_time - INTERVAL 7 DAY AS week_ago FROM fact_transaction
"""))
def _(s: Star):
    t, end = F.col("txn_time"), F.lit("2024-02-01").cast("timestamp_ntz")
    return s.fact_transaction().select(
        "txn_id", x.boundaries_crossed("HOUR", t, end).alias("hours_left"), x.boundaries_crossed("MINUTE", t, end).alias("minutes_left"),
        F.datediff(end.cast("date"), t.cast("date")).cast("long").alias("days_left"), x.hour_start(t).alias("hour_start"), F.hour(t).cast("long").alias("hour_no"),
        t.cast("date").alias("day"), F.date_format(t, "yyyy-MM").alias("month"), (t - F.expr("INTERVAL 7 DAY")).alias("week_ago"),
    )


@query("fn_string", sql("SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, p_brand || '/' || p_type AS joined, trim(' ' || p_name || ' ') AS trimmed, substring(p_name, 1, 4) AS head FROM part"))
def _(s: Star):
    return s.table("part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), F.concat_ws("/", "p_brand", "p_type").alias("joined"),
        F.trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("trimmed"), F.substring("p_name", 1, 4).alias("head"),
    )


@query("fn_regex", sql(r"""
SELECT event_id, regexp_replace(props, '[0-9]+', '<num>', 'g') AS folded, regexp_extract(props, '([0-9]+)', 1) AS digits, regexp_matches(props, '"k": [0-4][0-9]?\}') AS low_k FROM events
"""))
def _(s: Star):
    return s.table("events").select(
        "event_id", F.regexp_replace("props", "[0-9]+", "<num>").alias("folded"), F.regexp_extract("props", "([0-9]+)", 1).alias("digits"),
        F.col("props").rlike(r'"k": [0-4][0-9]?\}').alias("low_k"),
    )


@query("fn_cast", sql("SELECT file_row, TRY_CAST(order_id AS BIGINT) AS order_no, TRY_CAST(amount AS DOUBLE) AS amount_no, CAST(file_row AS VARCHAR) AS row_text FROM order_raw"))
def _(s: Star):
    return s.order_raw().select(
        "file_row", F.col("order_id").try_cast("bigint").alias("order_no"), F.col("amount").try_cast("double").alias("amount_no"), F.col("file_row").cast("string").alias("row_text")
    )


@query("fn_array", sql("""
SELECT doc_id, len(list_filter(['tion', 'the', 'schul', 'eau'], lambda t: contains(lower(text), t))) AS hit_cnt,
       len(list_filter(['tion', 'the', 'schul', 'eau'], lambda t: contains(lower(text), t))) > 0 AS any_hit FROM documents
"""))
def _(s: Star):
    terms = F.array(*[F.lit(t) for t in ("tion", "the", "schul", "eau")])
    hits = F.filter(terms, lambda t: F.lower("text").contains(t))
    return s.table("documents").select("doc_id", F.size(hits).cast("long").alias("hit_cnt"), F.exists(terms, lambda t: F.lower("text").contains(t)).alias("any_hit"))


@query("fn_json", sql(f"SELECT event_id, {K} AS k, '{{\"event_id\":' || event_id || ',\"k\":' || {K} || '}}' AS record FROM events"))
def _(s: Star):
    k = F.get_json_object("props", "$.k").cast("int")
    return s.table("events").select("event_id", k.alias("k"), F.to_json(F.struct("event_id", k.alias("k"))).alias("record"))
