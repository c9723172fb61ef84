"""Reconciliation and sales queries with their check SQL."""

from __future__ import annotations

from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, money, rnd, sql
from tidewell.plans import finance
from tidewell.sources import files
from tidewell.sources.star import Star
from tidewell.session import scratch_path


def clean(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL OR trim(regexp_replace({c}, '[¥,]', '', 'g')) = '' THEN 0 ELSE CAST(trim(regexp_replace({c}, '[¥,]', '', 'g')) AS DOUBLE) END)"


def mixed(c: str) -> str:
    return f"CAST(COALESCE(try_strptime(trim({c}), '%Y/%-m/%-d'), try_strptime(trim({c}), '%Y-%m-%d'), try_strptime(trim({c}), '%Y%m%d')) AS DATE)"


cte("clean_order_layer", f"""
SELECT order_id, file_row, {mixed('order_date')} AS order_date, trim(shop) AS shop,
       CASE trim(province) WHEN '浙冮' THEN '浙江' WHEN '廣东' THEN '广东' ELSE trim(province) END AS province,
       {clean('amount')} AS amount, {clean('freight')} AS freight, trim(status) AS status
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY file_row) AS rn FROM order_raw WHERE order_id IS NOT NULL) WHERE rn = 1
""")
cte("clean_pay_layer", f"SELECT pay_id, order_id, {mixed('pay_date')} AS pay_date, {clean('received')} AS received, {clean('fee')} AS fee, trim(channel) AS channel FROM pay_raw")
cte("clean_refund_layer", f"SELECT order_id, {mixed('refund_date')} AS refund_date, {clean('refund')} AS refund FROM refund_raw")
cte("reconciled_layer", f"""
SELECT *, CASE WHEN status = '已付款' AND received = 0 THEN '已付款但缺支付流水' WHEN status = '已取消' AND received > 0 THEN '订单取消但存在收款'
               WHEN abs(difference) > 0.01::DOUBLE THEN '金额不一致' WHEN refund > 0 THEN '存在退款' ELSE '正常' END AS reason
FROM (SELECT *, amount + freight - refund - fee AS receivable, amount + freight - refund - fee - received AS difference
      FROM (SELECT o.*, COALESCE(p.received, 0) AS received, COALESCE(p.fee, 0) AS fee, p.channel, COALESCE(r.refund, 0) AS refund
            FROM clean_order_layer o LEFT JOIN clean_pay_layer p ON o.order_id = p.order_id
            LEFT JOIN (SELECT order_id, {money('refund')} AS refund FROM clean_refund_layer GROUP BY 1) r ON o.order_id = r.order_id))
""")
cte("sales_typed", """
SELECT CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date, region, TRY_CAST(sales_amount AS DOUBLE) AS sales_amount,
       TRY_CAST(cost_amount AS DOUBLE) AS cost_amount, TRY_CAST(order_count AS DOUBLE) AS order_count FROM sales_raw
""")
VALID = "COALESCE(date IS NOT NULL AND region IS NOT NULL AND sales_amount >= 0 AND cost_amount >= 0 AND order_count >= 0, FALSE)"
cte("sales_clean", f"""
SELECT *, CAST(CAST(sales_amount AS DECIMAL(18,4)) - CAST(cost_amount AS DECIMAL(18,4)) AS DOUBLE) AS profit, strftime(date, '%Y-%m') AS month FROM sales_typed WHERE {VALID}
""")
SUMS = ", ".join(f"{money(c, 4)} AS {c}" for c in ("sales_amount", "cost_amount", "profit")) + ", CAST(SUM(CAST(order_count AS BIGINT)) AS BIGINT) AS order_count"
cte("sales_region_layer", f"SELECT region, {SUMS} FROM sales_clean GROUP BY 1")
cte("sales_month_layer", f"SELECT month, {SUMS} FROM sales_clean GROUP BY 1")
cte("sales_kpi_layer", f"""
SELECT {rnd('sales_amount', 2)} AS total_sales, {rnd('cost_amount', 2)} AS total_cost, {rnd('profit', 2)} AS total_profit, order_count AS total_orders,
       {rnd('profit / sales_amount', 4)} AS profit_margin FROM (SELECT {SUMS} FROM sales_clean)
""")
D2 = "CAST(CAST({0} AS DECIMAL(24,2)) AS VARCHAR)"
cte("sales_hint_layer", f"""
SELECT 0::BIGINT AS pos, 'Region with lowest profit: ' || region || ' (profit=' || {D2.format('profit')} || ').' AS hint FROM (SELECT * FROM sales_region_layer ORDER BY profit, region LIMIT 1)
UNION ALL SELECT 1, 'Region with highest profit: ' || region || ' (profit=' || {D2.format('profit')} || ').' FROM (SELECT * FROM sales_region_layer ORDER BY profit DESC, region DESC LIMIT 1)
""")


class Recon:
    def __init__(self, s: Star):
        self.orders, self.payments, self.refunds = finance.clean_orders(s.order_raw()), finance.clean_payments(s.pay_raw()), finance.clean_refunds(s.refund_raw())

    def table(self):
        return finance.reconcile_orders(self.orders, self.payments, self.refunds)


def sales(s: Star):
    return finance.validate_sales(s.sales_raw())[0]


@query("clean_orders", sql("SELECT * FROM clean_order_layer"))
def _(s: Star):
    return finance.clean_orders(s.order_raw())


@query("clean_payments", sql("SELECT * FROM clean_pay_layer"))
def _(s: Star):
    return finance.clean_payments(s.pay_raw())


@query("clean_refunds", sql("SELECT * FROM clean_refund_layer"))
def _(s: Star):
    return finance.clean_refunds(s.refund_raw())


@query("cleaning_log", sql("""
SELECT '空行' AS issue, COUNT(*) AS affected_rows, '删除整行为空的数据' AS action FROM order_raw WHERE order_id IS NULL HAVING COUNT(*) > 0
UNION ALL SELECT '重复订单', COUNT(*) - COUNT(DISTINCT order_id), '按订单号去重，保留第一条记录' FROM order_raw WHERE order_id IS NOT NULL HAVING COUNT(*) > COUNT(DISTINCT order_id)
"""))
def _(s: Star):
    return finance.cleaning_log(s.order_raw())


@query("reconcile_orders", sql("SELECT * FROM reconciled_layer"))
def _(s: Star):
    return Recon(s).table()


@query("reconcile_alerts", sql("SELECT * FROM reconciled_layer WHERE reason <> '正常'"))
def _(s: Star):
    return finance.reconcile_alerts(Recon(s).table())


@query("daily_finance_report", sql(f"""
SELECT *, received - refund - fee AS net_income FROM (SELECT order_date, shop, {money('amount')} AS gmv, COUNT(order_id) AS order_cnt, {money('refund')} AS refund,
       {money('fee')} AS fee, {money('received')} AS received FROM reconciled_layer GROUP BY 1, 2)
"""))
def _(s: Star):
    return finance.daily_finance_report(Recon(s).table())


@query("validate_split", sql(f"SELECT date, region, sales_amount, cost_amount, order_count, {VALID} AS is_valid FROM sales_typed"))
def _(s: Star):
    from pyspark.sql import functions as F

    good, bad = finance.validate_sales(s.sales_raw())
    return good.drop("profit", "month").withColumn("is_valid", F.lit(True)).unionByName(bad.withColumn("is_valid", F.lit(False)))


@query("sales_kpis", sql("SELECT * FROM sales_kpi_layer"))
def _(s: Star):
    return finance.sales_kpis(sales(s))


@query("sales_by_region", sql("SELECT * FROM sales_region_layer"))
def _(s: Star):
    return finance.sales_by_region(sales(s))


@query("sales_by_month", sql("SELECT * FROM sales_month_layer"))
def _(s: Star):
    return finance.sales_by_month(sales(s))


@query("avg_order_value", sql("SELECT region, sales_amount / order_count AS avg_order_value FROM sales_region_layer"))
def _(s: Star):
    return finance.avg_order_value(sales(s))


@query("anomaly_hints", sql("SELECT * FROM sales_hint_layer"))
def _(s: Star):
    return finance.anomaly_hints(finance.sales_by_region(sales(s)))


@query("template_summary", sql(f"""
SELECT 'Daily report summary (fallback mode):' || chr(10) || '- Total sales: ' || {D2.format('total_sales')} || chr(10) || '- Total profit: ' || {D2.format('total_profit')}
       || chr(10) || '- Profit margin: ' || CAST(CAST(profit_margin AS DECIMAL(10,4)) AS VARCHAR) || chr(10) || '- Key observations: '
       || (SELECT string_agg(hint, '; ' ORDER BY pos) FROM sales_hint_layer) || chr(10) || '- Next step: investigate low-profit region and optimize cost drivers.' AS summary
FROM sales_kpi_layer
"""))
def _(s: Star):
    data = finance.sales_cube(sales(s))
    return finance.template_summary(finance.sales_kpis(data), finance.anomaly_hints(finance.sales_by_region(data)))


M2 = "CAST({0} AS DECIMAL(24,2))"


def record(key: str) -> str:
    return f"""'{{"{key}":"' || {key} || '","sales_amount":' || {D2.format('sales_amount')} || ',"cost_amount":' || {D2.format('cost_amount')} || ',"profit":' || {D2.format('profit')} || ',"order_count":' || order_count || '}}'"""


@query("write_json_payload", sql(f"""
SELECT '{{"summary":{{"total_sales":' || {D2.format('total_sales')} || ',"total_cost":' || {D2.format('total_cost')} || ',"total_profit":' || {D2.format('total_profit')}
       || ',"total_orders":' || total_orders || ',"profit_margin":' || CAST(CAST(profit_margin AS DECIMAL(10,4)) AS VARCHAR) || '}},"by_region":['
       || (SELECT string_agg({record('region')}, ',' ORDER BY profit, region) FROM sales_region_layer) || '],"by_month":['
       || (SELECT string_agg({record('month')}, ',' ORDER BY month) FROM sales_month_layer) || ']}}' AS payload
FROM sales_kpi_layer
"""))
def _(s: Star):
    path = files.write_json_payload(finance.json_payload(sales(s)), scratch_path(s.spark, "payload"))
    return s.spark.read.text(path).withColumnRenamed("value", "payload")
