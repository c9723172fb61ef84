"""The independent side: the domain tables and layers once more, as SQL for a single-node engine.

`sql(body)` puts in front of a statement the common table expressions it mentions, so every query of the
catalog can be checked by one self-contained statement over the shared Parquet tables.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, text: str) -> None:
    CTES[name] = text.strip()


def sql(body: str, recursive: bool = False) -> str:
    needed: list[str] = []

    def require(text: str) -> None:
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                require(definition.replace(name, ""))
                if name not in needed:
                    needed.append(name)

    require(body)
    body = body.strip()
    parts = [f"{n} AS (\n{CTES[n]}\n)" for n in needed]
    if body.upper().startswith("WITH "):
        parts.append(body[5:])
        body = ""
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


def rnd(expr: str, digits: int) -> str:
    return f"(round(({expr}) * 1e{digits}) / 1e{digits})"


def money(expr: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def ratio(a: str, b: str, digits: int | None = 4) -> str:
    q = f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"
    return q if digits is None else rnd(q, digits)


def pick(value: str, *labels: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels))
    return f"(CASE ({value}) % {len(labels)} {cases} END)"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# --- game -----------------------------------------------------------------------------------------------

cte("match_result", """
SELECT l_orderkey AS match_id, l_suppkey AS player_id, p_type AS final_comp_id, p_brand AS unit_id,
       p_type AS item_combo, l_linenumber AS rank_no,
       CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'S11.3' ELSE 'S11.4' END AS patch_version,
       CASE WHEN l_returnflag = 'R' THEN 'casual' ELSE 'ranked' END AS mode,
       l_linestatus AS region, l_returnflag AS rank_tier, CAST(l_shipdate AS DATE) AS dt
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
cte("player_econ", """
SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'S11.3' ELSE 'S11.4' END AS patch_version,
       l_linestatus AS region, l_returnflag AS rank_tier, CAST(l_linenumber AS DOUBLE) AS first_level8_round,
       l_quantity AS total_roll_cnt, l_extendedprice AS final_gold
FROM lineitem
""")
cte("comp_daily", """
SELECT CAST(date_trunc('month', dt) AS DATE) AS dt, patch_version, region, rank_tier, final_comp_id AS comp_id,
       'comp ' || lower(final_comp_id) AS comp_name, CASE WHEN final_comp_id < 'M' THEN 'A' ELSE 'B' END AS tier,
       COUNT(*) AS play_cnt, COUNT(*) FILTER (WHERE rank_no <= 4) AS top4_cnt,
       COUNT(*) FILTER (WHERE rank_no = 1) AS win_cnt, CAST(SUM(rank_no) AS DOUBLE) / COUNT(*) AS avg_rank
FROM match_result GROUP BY ALL
""")
cte("player_daily", """
SELECT user_id AS player_id, CAST(ts AS DATE) AS dt, 1 AS login_flag,
       COUNT(*) FILTER (WHERE event_type = 'view') AS match_cnt,
       CAST(COALESCE(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE) AS pay_amount
FROM events GROUP BY 1, 2
""")

# --- bank -----------------------------------------------------------------------------------------------

cte("dim_customer", """
SELECT c_custkey AS customer_id, c_name AS name, n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
cte("dim_account", """
SELECT c_custkey AS account_id, c_custkey AS customer_id, c_acctbal AS balance,
       CASE WHEN c_acctbal < 0 THEN 'FROZEN' ELSE 'ACTIVE' END AS status FROM customer
""")
cte("fact_transaction", """
SELECT event_id AS txn_id, user_id AS account_id, value AS amount, ts AS txn_time, event_type AS channel,
       event_type AS txn_type, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS txn_status FROM events
""")
cte("fact_credit_snapshot", f"""
SELECT o_orderkey AS credit_id, o_custkey AS customer_id, o_totalprice AS credit_limit,
       o_totalprice * CAST(o_orderkey % 100 AS DOUBLE) / 1e2 AS used_credit, CAST(o_orderdate AS DATE) AS snapshot_date,
       {ratio('o_totalprice * CAST(o_orderkey % 100 AS DOUBLE) / 1e2', 'o_totalprice')} AS utilization_rate
FROM orders
""")
cte("fact_overdue", """
SELECT o_custkey AS customer_id, CAST(l_shipdate AS DATE) AS due_date, l_extendedprice AS overdue_amount,
       CAST(l_quantity AS INTEGER) AS dpd_days, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_current_overdue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
""")

# --- charging -------------------------------------------------------------------------------------------

cte("charge_order", """
SELECT l_orderkey AS order_id, o_custkey AS vehicle_id, l_suppkey AS station_id, l_shipdate AS start_time,
       l_shipdate + to_minutes(CAST(l_quantity AS INTEGER)) AS end_time, l_quantity AS energy_kwh,
       CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'CANCELLED' END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
cte("charge_payment", """
SELECT o_orderkey AS order_id, o_totalprice AS amount_cny, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_success FROM orders
""")
cte("dim_vehicle", """
SELECT c_custkey AS vehicle_id, c_nationkey AS home_zone,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'DC_FAST' ELSE 'AC_SLOW' END AS preferred_power_type FROM customer
""")
cte("dim_station", f"""
SELECT s_suppkey AS station_id, s_nationkey AS station_zone, {pick('s_suppkey', 'DC_FAST', 'AC_SLOW')} AS power_type,
       s_suppkey % 20 AS available_ports, 1e0 + CAST(s_suppkey % 13 AS DOUBLE) / 1e1 AS tariff_cny_per_kwh FROM supplier
""")
cte("station_ops", """
SELECT s_suppkey AS station_id, 0.9::DOUBLE + CAST(s_suppkey % 10 AS DOUBLE) / 1e2 AS online_rate,
       CAST(s_suppkey % 40 AS INTEGER) AS queue_minutes, CAST(s_suppkey % 7 AS INTEGER) AS fault_count FROM supplier
""")

# --- live platform --------------------------------------------------------------------------------------

cte("account_behavior", """
SELECT user_id, MIN(ts) AS register_time, 'D' || (user_id % 40) AS device_id, '10.0.0.' || (user_id % 60) AS ip,
       'C' || (user_id % 5) AS country, CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS is_host
FROM events GROUP BY user_id
""")
cte("message_event", f"""
SELECT event_id AS message_id, user_id, {K} % 30 AS room_id, 'join my ' || event_type || ' group ' || {K} AS content,
       ts AS send_time, CASE WHEN event_type = 'click' THEN 'private_message' ELSE 'public_chat' END AS message_type
FROM events WHERE event_type IN ('view', 'click', 'signup')
""")
cte("room_event", f"""
SELECT room_id, MIN(user_id) AS host_id, {pick('room_id', 'live', 'voice_room')} AS room_type,
       MIN(send_time) AS start_time, CAST(room_id * 60 + 3600 AS INTEGER) AS duration_seconds FROM message_event GROUP BY room_id
""")
cte("report_event", """
SELECT event_id AS report_id, user_id AS target_id, ts AS report_time FROM events WHERE event_type = 'error'
""")
cte("review_event", f"""
SELECT event_id AS case_id, user_id AS target_id, ts AS review_time,
       {pick('event_id', 'violation', 'normal', 'suspicious')} AS review_result,
       {pick('event_id', 'not_appealed', 'upheld', 'overturned', 'not_appealed')} AS appeal_result
FROM events WHERE event_type = 'error'
""")
cte("punishment_event", f"""
SELECT event_id AS punish_id, user_id, ts AS punish_time, {pick('event_id', 'inducement', 'fraud', 'scam', 'spam')} AS risk_type,
       {pick('event_id', 'ban', 'mute', 'warning', 'warning', 'mute')} AS punish_type
FROM events WHERE event_type = 'signup' AND value >= 100
""")
cte("payment_order", f"""
SELECT event_id AS order_id, user_id AS payer_id, CAST({K} AS BIGINT) AS receiver_id, value AS amount, ts AS order_time,
       'PS' || (event_id % 20) AS payment_subject, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS refund_flag
FROM events WHERE event_type = 'purchase'
""")

# --- finance and sales ----------------------------------------------------------------------------------

CENTS = "CAST(round(o_totalprice * 1e2) AS BIGINT)"


def cents_text(c: str) -> str:
    return f"('¥' || (({c}) // 100) || '.' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))"


cte("order_sheet", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey AS file_row,
       CASE o_orderkey % 3 WHEN 0 THEN year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate)
            WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y%m%d') END AS order_date,
       ' ' || o_orderpriority AS shop, {pick('o_custkey', '浙冮', '浙江 ', '廣东', '广东', '江苏', '上海')} AS province,
       CASE WHEN {CENTS} // 100 >= 1000
            THEN '¥' || ({CENTS} // 100000) || ',' || lpad(CAST(({CENTS} // 100) % 1000 AS VARCHAR), 3, '0') || '.' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0')
            ELSE ' ¥' || ({CENTS} // 100) || '.' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0') || ' ' END AS amount,
       '¥' || (o_custkey % 20) AS freight,
       CASE o_orderstatus WHEN 'F' THEN '已付款' WHEN 'O' THEN '已取消' ELSE '已付款 ' END AS status
FROM orders
""")
cte("order_raw", """
SELECT * FROM order_sheet
UNION ALL SELECT order_id, file_row + 1000000000000, order_date, shop, province, amount, freight, status FROM order_sheet WHERE status = '已付款 '
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM region
""")
cte("pay_raw", f"""
SELECT 'PAY' || o_orderkey AS pay_id, CAST(o_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y%m%d') AS pay_date,
       {cents_text('received_cents')} AS received, ' ¥' || (o_orderkey % 30) AS fee, {pick('o_custkey', '支付宝', ' 微信', '银行卡 ')} AS channel
FROM (SELECT o.*, CASE o_orderpriority
        WHEN '1-URGENT' THEN {CENTS} + (o_custkey % 20) * 100 - (o_orderkey % 30) * 100
        WHEN '2-HIGH' THEN GREATEST({CENTS} + (o_custkey % 20) * 100 - (o_orderkey % 30) * 100 - COALESCE(refund_cents, 0), 0)
        ELSE {CENTS} END AS received_cents
      FROM orders o LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(round(l_extendedprice * 1e2) AS BIGINT)) AS BIGINT) AS refund_cents
                               FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON o_orderkey = l_orderkey
      WHERE o_orderpriority <> '5-LOW')
""")
cte("refund_raw", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, strftime(l_shipdate, '%Y-%m-%d') AS refund_date,
       {cents_text('CAST(round(l_extendedprice * 1e2) AS BIGINT)')} AS refund
FROM lineitem WHERE l_returnflag = 'R'
""")
cte("sales_raw", """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
       CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN NULL ELSE r_name END AS region,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN -CAST(l_extendedprice AS DECIMAL(12,2)) ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS VARCHAR) AS sales_amount,
       CASE WHEN l_tax = 0.08::DOUBLE THEN 'n/a' ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS VARCHAR) END AS cost_amount,
       '1' AS order_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")

# --- corpus ---------------------------------------------------------------------------------------------

cte("corpus", f"""
SELECT 'doc-' || doc_id AS name, text, source AS owner, {pick('doc_id', 'internal', 'public')} AS confidentiality FROM documents
UNION ALL SELECT 'page-' || page_id, html, 'web', 'public' FROM pages
""")
cte("vectors", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings")
cte("knowledge", """
SELECT source || ':0:' || doc_id AS chunk_id, text, source, 1 AS page, lang AS section, embedding
FROM documents JOIN vectors ON doc_id = vec_id
""")
cte("questions", r"""
SELECT item_id AS query_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS question,
       lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS rewritten FROM benchmark
""")
cte("question_vectors", """
SELECT item_id AS query_id, vec_id % 2 AS variant, embedding FROM benchmark JOIN vectors ON item_id = vec_id // 2
""")
cte("qa_audit", """
SELECT u.conv_id || ':' || a.turn AS request_id, u.text AS question, a.text AS answer, CAST(length(a.text) AS INTEGER) AS latency_ms,
       CAST(u.conv_id % 100 AS DOUBLE) / 1e2 AS confidence
FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")
