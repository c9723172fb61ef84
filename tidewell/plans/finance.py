"""Order, payment and refund reconciliation, and the sales KPI report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.exprs import clean_money, label, map_values, money_sum, parse_mixed_date, round_n
from tidewell.operators.ranking import best_and_worst
from tidewell.operators.relational import dedup_keep_first, drop_all_null_rows, split_valid
from tidewell.session import materialize

# Spelling repairs of province names, order states, and the reasons of the alert list.
PROVINCES = {"浙冮": "浙江", "浙江": "浙江", "廣东": "广东", "广东": "广东", "江苏": "江苏", "上海": "上海"}
PAID, CANCELLED = "已付款", "已取消"
UNPAID_REASON, CANCELLED_REASON = "已付款但缺支付流水", "订单取消但存在收款"
MISMATCH_REASON, REFUND_REASON, NORMAL_REASON = "金额不一致", "存在退款", "正常"


def clean_orders(raw: DataFrame, order: Column | str = "file_row", text_columns: Sequence[str] = ("shop", "province", "status")) -> DataFrame:
    """Drop blank rows, keep the first row per order, parse dates and money, trim text, repair provinces.

    Missing text stays NULL.
    """
    first = dedup_keep_first(drop_all_null_rows(raw), ["order_id"], [F.col(order) if isinstance(order, str) else order])
    tidy = {c: F.trim(c) for c in text_columns}
    if "province" in tidy:
        tidy["province"] = map_values(tidy["province"], PROVINCES)
    return first.withColumns(
        {"order_date": parse_mixed_date("order_date"), "amount": clean_money("amount"), "freight": clean_money("freight"), **tidy}
    )


def cleaning_log(raw: DataFrame) -> DataFrame:
    """(issue, rows, action) for blank rows and repeated orders; issues that did not occur are left out.

    Counted from one row per order id, so no row is sorted or moved for the count.
    """
    blank = F.greatest(*[F.col(c).isNotNull().cast("int") for c in raw.columns]) == 0
    per_order = raw.groupBy("order_id").agg(F.count_if(blank).alias("blank"), F.count_if(~blank).alias("n"))
    counts = per_order.agg(F.sum("blank").alias("blank"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("repeated"))
    rows = F.array(
        F.struct(F.lit("空行").alias("issue"), F.col("blank").alias("affected_rows"), F.lit("删除整行为空的数据").alias("action")),
        F.struct(F.lit("重复订单").alias("issue"), F.col("repeated").alias("affected_rows"), F.lit("按订单号去重，保留第一条记录").alias("action")),
    )
    return counts.select(F.inline(rows)).where("affected_rows > 0")


def clean_payments(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {"pay_date": parse_mixed_date("pay_date"), "received": clean_money("received"), "fee": clean_money("fee"), "channel": F.trim("channel")}
    )


def clean_refunds(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"refund_date": parse_mixed_date("refund_date"), "refund": clean_money("refund")})


def reconcile_orders(orders: DataFrame, payments: DataFrame, refunds: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Expected against received money per order, with the reason of a difference.

    Refunds are summed per order first. Payments are not: two payments of one order give two rows.
    """
    refunded = refunds.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(money_sum("refund").alias("refund"))
    wide = (
        orders.join(payments.select("order_id", "received", "fee", "channel"), "order_id", "left")
        .join(refunded, "order_id", "left")
        .na.fill(0.0, ["received", "fee", "refund"])
        .withColumn("receivable", F.col("amount") + F.col("freight") - F.col("refund") - F.col("fee"))
        .withColumn("difference", F.col("receivable") - F.col("received"))
    )
    reason = label(
        [
            ((F.col("status") == PAID) & (F.col("received") == 0), UNPAID_REASON),
            ((F.col("status") == CANCELLED) & (F.col("received") > 0), CANCELLED_REASON),
            (F.abs("difference") > tolerance, MISMATCH_REASON),
            (F.col("refund") > 0, REFUND_REASON),
        ],
        NORMAL_REASON,
    )
    return wide.withColumn("reason", reason)


def daily_finance_report(reconciled: DataFrame) -> DataFrame:
    keyed = reconciled.where(F.col("order_date").isNotNull() & F.col("shop").isNotNull())
    daily = keyed.groupBy("order_date", "shop").agg(
        money_sum("amount").alias("gmv"), F.count("order_id").alias("order_cnt"), money_sum("refund").alias("refund"),
        money_sum("fee").alias("fee"), money_sum("received").alias("received"),
    )
    return daily.withColumn("net_income", F.col("received") - F.col("refund") - F.col("fee"))


def reconcile_alerts(reconciled: DataFrame) -> DataFrame:
    return reconciled.where(F.col("reason") != NORMAL_REASON)


# --- sales ----------------------------------------------------------------------------------------------

SALES_NUMBERS = ("sales_amount", "cost_amount", "order_count")


def validate_sales(raw: DataFrame, date_pattern: str = "yyyy-MM-dd") -> tuple[DataFrame, DataFrame]:
    """Typed rows with profit and month, and the rejected rows.

    The date has one declared layout; any other text, a missing region and unparseable or negative numbers
    reject the row.
    """
    typed = raw.withColumns(
        {"date": F.try_to_timestamp("date", F.lit(date_pattern)).cast("date"), **{c: F.col(c).try_cast("double") for c in SALES_NUMBERS}}
    )
    valid = F.col("date").isNotNull() & F.col("region").isNotNull()
    for c in SALES_NUMBERS:
        valid = valid & F.col(c).isNotNull() & (F.col(c) >= 0)
    clean, rejected = split_valid(typed, valid)
    exact = F.col("sales_amount").cast("decimal(18,4)") - F.col("cost_amount").cast("decimal(18,4)")
    return clean.withColumns({"profit": exact.cast("double"), "month": F.date_format("date", "yyyy-MM")}), rejected


SALES_MONEY = ("sales_amount", "cost_amount", "profit")


def _sales_sums(exact: bool = False) -> list[Column]:
    totals = [F.sum(F.col(c).cast("decimal(28,4)")) for c in SALES_MONEY]
    return [
        *[(t if exact else t.cast("double")).alias(c) for t, c in zip(totals, SALES_MONEY)],
        F.sum(F.col("order_count").cast("bigint")).alias("order_count"),
    ]


def sales_cube(clean: DataFrame) -> DataFrame:
    """Exact sums per region and month, written once: all sales reports of one run read this small table."""
    return materialize(clean.groupBy("region", "month").agg(*_sales_sums(exact=True)), "sales-cube")


def sales_kpis(clean: DataFrame) -> DataFrame:
    totals = clean.agg(*_sales_sums()).na.fill(0)
    margin = F.when(F.col("sales_amount") != 0, F.try_divide(F.col("profit"), F.col("sales_amount"))).otherwise(0.0)
    return totals.select(
        round_n("sales_amount", 2).alias("total_sales"), round_n("cost_amount", 2).alias("total_cost"), round_n("profit", 2).alias("total_profit"),
        F.col("order_count").alias("total_orders"), round_n(margin, 4).alias("profit_margin"),
    )


def sales_by_region(clean: DataFrame) -> DataFrame:
    return clean.groupBy("region").agg(*_sales_sums()).orderBy("profit", "region")


def sales_by_month(clean: DataFrame) -> DataFrame:
    return clean.groupBy("month").agg(*_sales_sums()).orderBy("month")


def avg_order_value(clean: DataFrame) -> DataFrame:
    sums = clean.groupBy("region").agg(*_sales_sums())
    return sums.select("region", F.try_divide(F.col("sales_amount"), F.col("order_count").cast("double")).alias("avg_order_value"))


def _money_text(value: str) -> Column:
    return F.col(value).cast("decimal(24,2)").cast("string")


def anomaly_hints(by_region: DataFrame) -> DataFrame:
    """Sentences about the regions with the lowest and the highest profit, in order."""
    edge = best_and_worst(by_region, "region", "profit")
    low = F.concat(F.lit("Region with lowest profit: "), "worst_key", F.lit(" (profit="), _money_text("worst_value"), F.lit(")."))
    high = F.concat(F.lit("Region with highest profit: "), "best_key", F.lit(" (profit="), _money_text("best_value"), F.lit(")."))
    texts = (
        F.when(F.col("key_cnt") == 0, F.array(F.lit("No data available.")))
        .when(F.col("key_cnt") == 1, F.array(low))
        .otherwise(F.array(low, high))
    )
    return edge.select(F.posexplode(texts).alias("pos", "hint")).select(F.col("pos").cast("bigint").alias("pos"), "hint")


def template_summary(kpis: DataFrame, hints: DataFrame) -> DataFrame:
    """The fixed-text report: one row, one text."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "hint")))
    joined = hints.agg(F.array_join(F.transform(ordered, lambda h: h["hint"]), "; ").alias("hints")).scalar()
    text = F.concat_ws(
        "\n",
        F.lit("Daily report summary (fallback mode):"),
        F.concat(F.lit("- Total sales: "), _money_text("total_sales")),
        F.concat(F.lit("- Total profit: "), _money_text("total_profit")),
        F.concat(F.lit("- Profit margin: "), F.col("profit_margin").cast("decimal(10,4)").cast("string")),
        F.concat(F.lit("- Key observations: "), joined),
        F.lit("- Next step: investigate low-profit region and optimize cost drivers."),
    )
    return kpis.select(text.alias("summary"))


def json_payload(clean: DataFrame) -> DataFrame:
    """Summary, regions and months as one JSON document; both lists are bounded by regions and months. Amounts are exact sums, rounded once."""
    money = lambda c, name=None: F.col(c).cast("decimal(24,2)").alias(name or c)

    def records(df: DataFrame, key: str, order: Sequence[str]) -> Column:
        fields = [key, money("sales_amount"), money("cost_amount"), money("profit"), "order_count"]
        rows = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*fields).alias("r"))))
        return df.agg(F.transform(rows, lambda x: x["r"]).alias("rows")).scalar()

    clean = sales_cube(clean)
    margin = sales_kpis(clean).select(F.col("profit_margin").cast("decimal(10,4)")).scalar()
    totals = clean.agg(*_sales_sums(exact=True)).select(*[F.coalesce(c, F.lit(0)).alias(c) for c in (*SALES_MONEY, "order_count")])
    summary = F.struct(
        money("sales_amount", "total_sales"), money("cost_amount", "total_cost"), money("profit", "total_profit"), F.col("order_count").alias("total_orders"), margin.alias("profit_margin")
    )
    payload = F.struct(
        summary.alias("summary"),
        records(clean.groupBy("region").agg(*_sales_sums(exact=True)), "region", ["profit", "region"]).alias("by_region"),
        records(clean.groupBy("month").agg(*_sales_sums(exact=True)), "month", ["month"]).alias("by_month"),
    )
    return totals.select(F.to_json(payload).alias("payload"))
