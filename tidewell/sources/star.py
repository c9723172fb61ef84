"""The shared star-schema tables, and the domain tables derived from them.

Each method of `Star` returns a lazy DataFrame; only the columns a query uses are read from Parquet. The same
derivations are written once more as SQL in `tidewell.checks.ctes` for the independent check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.exprs import safe_ratio


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(value: Column, *labels: str) -> Column:
    """Label by value modulo the number of labels."""
    position = F.pmod(value, F.lit(len(labels))) + 1
    return F.element_at(F.array(*[F.lit(x) for x in labels]), position.cast("int"))


class Star:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def texts(self, name: str) -> DataFrame:
        """A table whose rows carry long texts, dealt over as many tasks as `spark.tidewell.text.partitions` says, if set.

        For inputs of few large files; the data is not looked at, and without the setting nothing moves.
        """
        wanted = self.spark.conf.get("spark.tidewell.text.partitions", None)
        return self.table(name).repartition(int(wanted)) if wanted else self.table(name)

    # --- game -------------------------------------------------------------------------------------------

    def _line_facts(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("match_id"),
            F.col("l_suppkey").alias("player_id"),
            "l_partkey",
            F.col("l_linenumber").alias("rank_no"),
            F.when(F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz"), "S11.3").otherwise("S11.4").alias("patch_version"),
            F.when(F.col("l_returnflag") == "R", "casual").otherwise("ranked").alias("mode"),
            F.col("l_linestatus").alias("region"),
            F.col("l_returnflag").alias("rank_tier"),
            F.col("l_shipdate").cast("date").alias("dt"),
            F.col("l_linenumber").cast("double").alias("first_level8_round"),
            F.col("l_quantity").alias("total_roll_cnt"),
            F.col("l_extendedprice").alias("final_gold"),
        )

    def match_result(self) -> DataFrame:
        part = self.table("part").select(
            "p_partkey", F.col("p_type").alias("final_comp_id"), F.col("p_brand").alias("unit_id"), F.col("p_type").alias("item_combo")
        )
        lines = self._line_facts()
        return lines.join(part, lines.l_partkey == part.p_partkey).select(
            "match_id", "player_id", "final_comp_id", "unit_id", "item_combo", "rank_no",
            "patch_version", "mode", "region", "rank_tier", "dt",
        )

    def player_econ(self) -> DataFrame:
        return self._line_facts().select(
            "patch_version", "region", "rank_tier", "first_level8_round", "total_roll_cnt", "final_gold"
        )

    def comp_daily(self) -> DataFrame:
        month = self.match_result().withColumn("dt", F.trunc("dt", "month"))
        return month.groupBy("dt", "patch_version", "region", "rank_tier", F.col("final_comp_id").alias("comp_id")).agg(
            F.count(F.lit(1)).alias("play_cnt"),
            F.count_if(F.col("rank_no") <= 4).alias("top4_cnt"),
            F.count_if(F.col("rank_no") == 1).alias("win_cnt"),
            (F.sum("rank_no").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_rank"),
        ).withColumns({"comp_name": F.concat(F.lit("comp "), F.lower("comp_id")), "tier": F.when(F.col("comp_id") < "M", "A").otherwise("B")})

    def player_daily(self) -> DataFrame:
        value = F.col("value").cast("decimal(18,2)")
        return self.table("events").groupBy(F.col("user_id").alias("player_id"), F.col("ts").cast("date").alias("dt")).agg(
            F.lit(1).alias("login_flag"),
            F.count_if(F.col("event_type") == "view").alias("match_cnt"),
            F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", value)), F.lit(0)).cast("double").alias("pay_amount"),
        )

    # --- bank -------------------------------------------------------------------------------------------

    def dim_customer(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
        customer = self.table("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), "c_nationkey")
        return customer.join(nation, "c_nationkey").select("customer_id", "name", "city")

    def dim_account(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_acctbal").alias("balance"),
            F.when(F.col("c_acctbal") < 0, "FROZEN").otherwise("ACTIVE").alias("status"),
        )

    def fact_transaction(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("txn_id"),
            F.col("user_id").alias("account_id"),
            F.col("value").alias("amount"),
            F.col("ts").alias("txn_time"),
            F.col("event_type").alias("channel"),
            F.col("event_type").alias("txn_type"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("txn_status"),
        )

    def fact_credit_snapshot(self) -> DataFrame:
        used = F.col("o_totalprice") * F.pmod("o_orderkey", F.lit(100)).cast("double") / F.lit(100.0)
        return self.table("orders").select(
            F.col("o_orderkey").alias("credit_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("credit_limit"),
            used.alias("used_credit"),
            F.col("o_orderdate").cast("date").alias("snapshot_date"),
            safe_ratio(used, "o_totalprice").alias("utilization_rate"),
        )

    def fact_overdue(self) -> DataFrame:
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
        lines = self.table("lineitem").where(F.col("l_returnflag") == "R")
        return lines.join(orders, "l_orderkey").select(
            "customer_id",
            F.col("l_shipdate").cast("date").alias("due_date"),
            F.col("l_extendedprice").alias("overdue_amount"),
            F.col("l_quantity").cast("int").alias("dpd_days"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("is_current_overdue"),
        )

    # --- charging ---------------------------------------------------------------------------------------

    def charge_order(self) -> DataFrame:
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("vehicle_id"))
        minutes = F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))
        return self.table("lineitem").join(orders, "l_orderkey").select(
            F.col("l_orderkey").alias("order_id"),
            "vehicle_id",
            F.col("l_suppkey").alias("station_id"),
            F.col("l_shipdate").alias("start_time"),
            (F.col("l_shipdate") + minutes).alias("end_time"),
            F.col("l_quantity").alias("energy_kwh"),
            F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("CANCELLED").alias("status"),
        )

    def charge_payment(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_totalprice").alias("amount_cny"),
            F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("is_success"),
        )

    def dim_vehicle(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("vehicle_id"),
            F.col("c_nationkey").alias("home_zone"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "DC_FAST").otherwise("AC_SLOW").alias("preferred_power_type"),
        )

    def dim_station(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.table("supplier").select(
            s.alias("station_id"),
            F.col("s_nationkey").alias("station_zone"),
            _pick(s, "DC_FAST", "AC_SLOW").alias("power_type"),
            F.pmod(s, F.lit(20)).alias("available_ports"),
            (F.lit(1.0) + F.pmod(s, F.lit(13)).cast("double") / F.lit(10.0)).alias("tariff_cny_per_kwh"),
        )

    def station_ops(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.table("supplier").select(
            s.alias("station_id"),
            (F.lit(0.9) + F.pmod(s, F.lit(10)).cast("double") / F.lit(100.0)).alias("online_rate"),
            F.pmod(s, F.lit(40)).cast("int").alias("queue_minutes"),
            F.pmod(s, F.lit(7)).cast("int").alias("fault_count"),
        )

    # --- live platform ----------------------------------------------------------------------------------

    def account_behavior(self) -> DataFrame:
        u = F.col("user_id")
        return self.table("events").groupBy("user_id").agg(F.min("ts").alias("register_time")).select(
            "user_id",
            "register_time",
            F.concat(F.lit("D"), F.pmod(u, F.lit(40)).cast("string")).alias("device_id"),
            F.concat(F.lit("10.0.0."), F.pmod(u, F.lit(60)).cast("string")).alias("ip"),
            F.concat(F.lit("C"), F.pmod(u, F.lit(5)).cast("string")).alias("country"),
            F.when(F.pmod(u, F.lit(10)) == 0, 1).otherwise(0).alias("is_host"),
        )

    def message_event(self) -> DataFrame:
        e = self.table("events").where(F.col("event_type").isin("view", "click", "signup")).withColumn("k", _k())
        return e.select(
            F.col("event_id").alias("message_id"),
            "user_id",
            F.pmod("k", F.lit(30)).alias("room_id"),
            F.concat(F.lit("join my "), "event_type", F.lit(" group "), F.col("k").cast("string")).alias("content"),
            F.col("ts").alias("send_time"),
            F.when(F.col("event_type") == "click", "private_message").otherwise("public_chat").alias("message_type"),
        )

    def room_event(self) -> DataFrame:
        rooms = self.message_event().groupBy("room_id").agg(F.min("user_id").alias("host_id"), F.min("send_time").alias("start_time"))
        return rooms.withColumns(
            {"room_type": _pick(F.col("room_id"), "live", "voice_room"), "duration_seconds": (F.col("room_id") * 60 + 3600).cast("int")}
        )

    def report_event(self) -> DataFrame:
        return self.table("events").where(F.col("event_type") == "error").select(
            F.col("event_id").alias("report_id"), F.col("user_id").alias("target_id"), F.col("ts").alias("report_time")
        )

    def review_event(self) -> DataFrame:
        e = F.col("event_id")
        return self.table("events").where(F.col("event_type") == "error").select(
            e.alias("case_id"),
            F.col("user_id").alias("target_id"),
            F.col("ts").alias("review_time"),
            _pick(e, "violation", "normal", "suspicious").alias("review_result"),
            _pick(e, "not_appealed", "upheld", "overturned", "not_appealed").alias("appeal_result"),
        )

    def punishment_event(self) -> DataFrame:
        """Sign-ups that come with a large value."""
        e = F.col("event_id")
        return self.table("events").where((F.col("event_type") == "signup") & (F.col("value") >= 100)).select(
            e.alias("punish_id"),
            "user_id",
            F.col("ts").alias("punish_time"),
            _pick(e, "inducement", "fraud", "scam", "spam").alias("risk_type"),
            _pick(e, "ban", "mute", "warning", "warning", "mute").alias("punish_type"),
        )

    def payment_order(self) -> DataFrame:
        e = F.col("event_id")
        return self.table("events").where(F.col("event_type") == "purchase").select(
            e.alias("order_id"),
            F.col("user_id").alias("payer_id"),
            _k().cast("bigint").alias("receiver_id"),
            F.col("value").alias("amount"),
            F.col("ts").alias("order_time"),
            F.concat(F.lit("PS"), F.pmod(e, F.lit(20)).cast("string")).alias("payment_subject"),
            F.when(F.pmod(e, F.lit(5)) == 0, 1).otherwise(0).alias("refund_flag"),
        )

    # --- finance and sales ------------------------------------------------------------------------------

    def _order_text(self) -> DataFrame:
        """Orders as an exported sheet writes them: mixed date layouts and currency text from exact cents."""
        d, cents = F.col("o_orderdate"), F.round(F.col("o_totalprice") * 100).cast("bigint")
        whole, rest = F.floor(cents / 100).cast("bigint"), F.pmod(cents, F.lit(100)).cast("string")
        thousands, units = F.floor(whole / 1000).cast("bigint"), F.lpad(F.pmod(whole, F.lit(1000)).cast("string"), 3, "0")
        fraction = F.concat(F.lit("."), F.lpad(rest, 2, "0"))
        grouped = F.concat(F.lit("¥"), thousands.cast("string"), F.lit(","), units, fraction)
        plain = F.concat(F.lit(" ¥"), whole.cast("string"), fraction, F.lit(" "))
        slash = F.concat_ws("/", F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string"))
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_orderkey").alias("file_row"),
            _pick_col(F.col("o_orderkey"), slash, F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "yyyyMMdd")).alias("order_date"),
            F.concat(F.lit(" "), "o_orderpriority").alias("shop"),
            _pick(F.col("o_custkey"), "浙冮", "浙江 ", "廣东", "广东", "江苏", "上海").alias("province"),
            F.when(whole >= 1000, grouped).otherwise(plain).alias("amount"),
            F.concat(F.lit("¥"), F.pmod("o_custkey", F.lit(20)).cast("string")).alias("freight"),
            F.col("o_orderstatus").alias("_status"),
        )

    def order_raw(self) -> DataFrame:
        """Dirty order sheet: pending orders are exported twice, and a blank line separates the regions."""
        status = F.when(F.col("_status") == "F", "已付款").when(F.col("_status") == "O", "已取消").otherwise("已付款 ")
        sheet = self._order_text().withColumn("status", status)
        resent = sheet.where(F.col("_status") == "P").withColumn("file_row", F.col("file_row") + F.lit(10**12))
        blank = self.table("region").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in sheet.schema.fields])
        return sheet.unionByName(resent).unionByName(blank).drop("_status")

    def pay_raw(self) -> DataFrame:
        """Payments of all orders but the lowest priority; urgent ones settle to the cent, refunds included."""
        refunds = self.table("lineitem").where(F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("refund_cents")
        )
        o = self.table("orders").where(F.col("o_orderpriority") != "5-LOW")
        fee = F.pmod("o_orderkey", F.lit(30))
        freight = F.pmod("o_custkey", F.lit(20))
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        settled = cents + freight * 100 - fee * 100
        received = (
            F.when(F.col("o_orderpriority") == "1-URGENT", settled)
            .when(F.col("o_orderpriority") == "2-HIGH", F.greatest(settled - F.coalesce("refund_cents", F.lit(0)), F.lit(0)))
            .otherwise(cents)
        )
        j = o.join(refunds, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("received_cents", received)
        return j.select(
            F.concat(F.lit("PAY"), F.col("o_orderkey").cast("string")).alias("pay_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("pay_date"),
            _cents_text(F.col("received_cents")).alias("received"),
            F.concat(F.lit(" ¥"), fee.cast("string")).alias("fee"),
            _pick(F.col("o_custkey"), "支付宝", " 微信", "银行卡 ").alias("channel"),
        )

    def refund_raw(self) -> DataFrame:
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        return self.table("lineitem").where(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("refund_date"),
            _cents_text(cents).alias("refund"),
        )

    def sales_raw(self) -> DataFrame:
        """Sales sheet as text: low-priority rows use another date layout, some regions are missing."""
        t = self.table
        geo = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
            t("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(F.col("c_custkey").alias("o_custkey"), "r_name")
        o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        cost = price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
        j = t("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(geo, "o_custkey")
        return j.select(
            F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "MM/dd/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
            F.when((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P"), F.lit(None)).otherwise(F.col("r_name")).alias("region"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), -price).otherwise(price).cast("string").alias("sales_amount"),
            F.when(F.col("l_tax") == 0.08, F.lit("n/a")).otherwise(cost.cast("decimal(18,4)").cast("string")).alias("cost_amount"),
            F.lit("1").alias("order_count"),
        )

    # --- corpus -----------------------------------------------------------------------------------------

    def corpus(self) -> DataFrame:
        """All documents and web pages with owner and confidentiality."""
        docs = self.texts("documents").select(
            F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
            F.col("text"),
            F.col("source").alias("owner"),
            _pick(F.col("doc_id"), "internal", "public").alias("confidentiality"),
        )
        pages = self.texts("pages").select(
            F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("name"),
            F.col("html").alias("text"),
            F.lit("web").alias("owner"),
            F.lit("public").alias("confidentiality"),
        )
        return docs.unionByName(pages)

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))

    def knowledge(self) -> DataFrame:
        """Documents that have a vector: the retrievable entries."""
        d = self.table("documents").select("doc_id", "text", "source", "lang")
        v = self.vectors().withColumnRenamed("vec_id", "doc_id")
        return d.join(v, "doc_id").select(
            F.concat_ws(":", "source", F.lit("0"), F.col("doc_id").cast("string")).alias("chunk_id"),
            "text",
            F.col("source"),
            F.lit(1).alias("page"),
            F.col("lang").alias("section"),
            "embedding",
        )

    def questions(self) -> DataFrame:
        """Benchmark items as questions; the reworded form is the lower-cased text."""
        text = F.trim(F.regexp_replace("text", r"\s+", " "))
        return self.table("benchmark").select(F.col("item_id").alias("query_id"), text.alias("question"), F.lower(text).alias("rewritten"))

    def question_vectors(self) -> DataFrame:
        """Two vectors per question, one for each wording."""
        v = self.vectors()
        return self.table("benchmark").select(F.col("item_id").alias("query_id")).join(
            v.select(F.floor(F.col("vec_id") / 2).cast("bigint").alias("query_id"), F.pmod("vec_id", F.lit(2)).alias("variant"), "embedding"),
            "query_id",
        )

    def qa_audit(self) -> DataFrame:
        """User turns with the assistant turn right after them."""
        c = self.table("conversations")
        user = c.where(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
        reply = c.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("answer"))
        return user.join(reply, ["conv_id", "turn"]).select(
            F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("request_id"),
            "question",
            "answer",
            F.length("answer").alias("latency_ms"),
            (F.pmod("conv_id", F.lit(100)).cast("double") / F.lit(100.0)).alias("confidence"),
        )


def _pick_col(value: Column, *choices: Column) -> Column:
    position = F.pmod(value, F.lit(len(choices))) + 1
    return F.element_at(F.array(*choices), position.cast("int"))


def _cents_text(cents: Column) -> Column:
    whole, rest = F.floor(cents / 100).cast("bigint"), F.pmod(cents, F.lit(100))
    return F.concat(F.lit("¥"), whole.cast("string"), F.lit("."), F.lpad(rest.cast("string"), 2, "0"))
