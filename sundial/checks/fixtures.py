"""Tables in the shape the feature jobs expect, derived from the test tables.

Each one exists twice: as a DataFrame and as SQL. Sizes grow with the test tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_SNAPSHOT = dt.date(2001, 7, 29)
EVENTS_SNAPSHOT = dt.date(2024, 1, 28)

COSTS = ["t_tot_cost", "t_prom_cost", "s_tot_cost", "s_ext_org_cost", "s_int_org_cost", "s_intn_org_cost",
         "s_org_cost", "s_prom_cost", "v_tot_cost", "v_ext_org_cost", "v_int_org_cost", "v_intn_org_cost",
         "v_org_cost", "v_prom_cost", "re_charge", "m_org_cost", "g_monthly_fee", "g_reg_fee", "g_org_cost",
         "vas_tot_cost", "vas_org_cost", "vas_prom_cost", "t_org_cost"]
# Costs the postpaid table does not have.
PREPAID_ONLY = ["re_charge", "vas_prom_cost", "t_prom_cost"]
BALANCES = [10, 11, 12, 13, 14, 15, 16, 17, 18, 21, 22, 24, 25, 34, 38, 45, 46]
SUFFIXES = ["X", "_60", "_TS", "-VOICE", "_DATA", "_NEW", "_KDS", "_4G", "_4", "_1", "U", "KID", "", "CAR"]
BRANDS = ["Samsung Electronics", "apple inc", "Redmi", "POCO", "Mi", "Xiaomi", "OPPO", "OnePlus", "vivo", "Huawei",
          "HONOR", "realme", "Motorola", "ZTE Corporation", "Google Inc", "Nokia", "Amazon", "LG Electronics",
          "Shenzhen Huafurui Technology Co Ltd", "Quectel Wireless Solutions Co Ltd", "Fossil Group Inc", None]
MODELS = ["Galaxy S{n} Ultra 5G", "iPhone {n} Pro Max", "Note {n} Pro+", "X{n} Pro", "mi {n}", "A{n} (2020)", "Watch {n} 44mm",
          "Tab S{n}FE", "SM-A{n}0F Galaxy A{n}", "Moto G{n} Power 5G", "Blade {n} 4G", "Pixel {n}XL", "ipad pro 11 {n}",
          "Flip {n}", "Reno {n} 5 G", "test imei {n}", "Mate {n} X", "iPhone SE 2 202{d}", "Module {n}00000", "Lumia {n}00",
          "Z Fold {n} Z Fold {n} 5G", "Fire HD {n}", "Chromebook {n}", None]


def text_array(values: list) -> str:
    return ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)


class Fixtures:
    """Test tables and the tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # devices

    def order_lines(self) -> DataFrame:
        return self.orders.join(self.lineitem, F.expr("o_orderkey = l_orderkey"))

    def sightings(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "o_custkey AS phone_number", "l_partkey AS imei", "l_suppkey AS tac", "to_date(l_shipdate) AS date",
            "l_linenumber % 2 AS channel")

    def imei_weekly(self) -> DataFrame:
        weekly = self.sightings().withColumn("week", F.expr("date_add(date, 6 - weekday(date))"))
        return weekly.groupBy("phone_number", "imei", "tac", "week").agg(
            F.count_distinct("date").alias("device_num_day_l1w")).withColumnRenamed("week", "date")

    def activation(self) -> DataFrame:
        return self.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first")).selectExpr(
            "o_custkey AS phone_number", "date_add(to_date(first), 90) AS last_activated_date",
            f"date_sub(DATE'{ORDERS_SNAPSHOT}', CAST(o_custkey % 14 AS INT)) AS date")

    def naid_monthly(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "o_custkey AS phone_number", "l_suppkey % 40 AS naid", "trunc(l_shipdate, 'MM') AS date").distinct()

    def tac_map(self) -> DataFrame:
        joined = self.supplier.join(self.nation, F.expr("s_nationkey = n_nationkey")).filter("s_suppkey % 7 <> 0")
        return joined.selectExpr(
            "s_suppkey AS tac", "n_name AS device_brand", "s_name AS device_model",
            "CASE s_nationkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' END AS device_os",
            "CASE s_suppkey % 2 WHEN 0 THEN 'Smartphone' ELSE 'Tablet' END AS device_type")

    def device_current(self) -> DataFrame:
        days = self.sightings().selectExpr(
            "phone_number", "date_add(date, 6 - weekday(date)) AS week", "tac % 4 AS tac")
        counts = days.groupBy("phone_number", "week", "tac").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("phone_number", "week").agg(F.max_by("tac", F.struct("n", "tac")).alias("tac"))
        named = best.join(self.tac_map().select("tac", "device_brand"), "tac", "left")
        return named.selectExpr("phone_number", "week AS date", "tac AS device_current_tac_l2w",
                                "coalesce(lower(device_brand), 'unmapped') AS device_current_brand_l2w")

    # places

    def cell_daily(self) -> DataFrame:
        cells = self.events.selectExpr(
            "user_id AS phone_number", "CAST(get_json_object(props, '$.k') AS BIGINT) AS cell_id", "to_date(ts) AS date")
        return cells.groupBy("phone_number", "cell_id", "date").agg(F.count(F.lit(1)).alias("count"))

    def cell_map(self) -> DataFrame:
        cells = self.cell_daily().select("cell_id").distinct().filter("cell_id % 4 <> 0").selectExpr(
            "cell_id", "explode(array(0, 1)) AS version",
            "CAST(CASE WHEN cell_id < 80 THEN 0 ELSE cell_id % 5 END AS INT) AS place")
        placed = cells.withColumn("place", F.expr("(place + 1 - version) % 5"))
        return placed.join(self.region, F.expr("place = r_regionkey")).selectExpr(
            "cell_id", "place * 10 AS district_code", "concat('D', place) AS district_name", "place AS province_code",
            "r_name AS province_name", "date_add(DATE'2023-01-01', 365 * version) AS date")

    def seed_daily(self) -> DataFrame:
        places = self.region.selectExpr("r_regionkey AS place", "r_name AS ref_province_name")
        return self.order_lines().join(F.broadcast(places), F.expr("place = (o_custkey + l_suppkey % 2) % 5")).selectExpr(
            "o_custkey AS phone_number", "l_suppkey AS cell_id", "CAST(l_quantity AS BIGINT) AS sum_logs_count", "l_partkey % 50 AS ref_cell_id",
            "CAST(l_linenumber AS BIGINT) AS ref_sum_logs_count", "ref_province_name", "to_date(l_shipdate) AS date")

    # wallets

    def wallet_daily(self) -> DataFrame:
        daily = self.events.selectExpr("user_id", "to_date(ts) AS date", "event_id", "event_id % 2 AS parity").groupBy(
            "user_id", "date", "parity").agg(F.min("event_id").alias("e"))
        ago = "date_sub(date, CAST(e % {} AS INT))"
        codes = "concat('B', e % 27, '#b', e % 27, ',', CASE WHEN e % 3 = 0 THEN '' ELSE concat(' b', e % 4, '#x') END, ',B', e % 27)"
        return daily.selectExpr(
            "user_id AS phone_number", "CASE parity WHEN 0 THEN 'MM' ELSE 'VP' END AS mother_system", "e AS mobile_id",
            "e % 63 AS province_code", "e % 700 AS district", f"{ago.format(900)} AS actv_date",
            f"{ago.format(60)} AS updated_date", f"{ago.format(365)} AS pin_date", f"{ago.format(120)} AS info_updated_date",
            f"CASE WHEN e % 5 <> 0 THEN {ago.format(400)} END AS money_source_linked_date",
            f"{ago.format(30)} AS customer_type_date", "CASE WHEN e % 7 <> 0 THEN 'BANK,CARD,BANK' ELSE 'CARD' END AS money_source_table",
            f"CASE WHEN e % 11 <> 0 THEN {codes} END AS money_sources", "e % 3 AS pin_status", "e % 4 AS mobile_level",
            "CASE WHEN e % 6 = 0 THEN e % 50 END AS company_id", "CASE WHEN e % 4 <> 0 THEN 'SHOP' END AS channel_type",
            "CASE WHEN e % 10 <> 0 THEN concat('V', e % 3) END AS partner_bank_code",
            "CASE WHEN e % 13 <> 0 THEN concat('C', e % 2) END AS core_bank_code", "date")

    def bank_map(self) -> DataFrame:
        return self.nation.selectExpr(
            "concat('B', n_nationkey) AS bank_code",
            "CASE n_nationkey % 6 WHEN 0 THEN 'State-Owned Commercial Bank' WHEN 1 THEN 'State-Owned Limited Liability Bank' "
            "WHEN 2 THEN 'Wholly Foreign-Owned Bank' WHEN 3 THEN 'Non-Bank Financial Institution' "
            "WHEN 4 THEN 'Joint Stock Commercial Bank' ELSE 'Joint Venture Bank' END AS bank_type",
            "CASE n_nationkey % 3 WHEN 0 THEN 'Large' WHEN 1 THEN 'Medium' ELSE 'small' END AS bank_size")

    # operator A payments

    def data_charge(self) -> DataFrame:
        k = "CAST(get_json_object(props, '$.k') AS DOUBLE)"
        return self.events.selectExpr(
            "user_id AS phone_number", "ts AS start_time", "CASE WHEN event_id % 9 <> 0 THEN value END AS up_data",
            f"value * {k} AS down_data", "value AS charge_amount", f"{k} * 10 AS balance_remain", "to_date(ts) AS date")

    def usage_pre(self) -> DataFrame:
        costs = [f"o_totalprice * {i} / 100 AS {c}" for i, c in enumerate(COSTS, 3)]
        return self.orders.filter("o_custkey % 2 = 1").selectExpr(
            "o_custkey AS phone_number", *costs, "trunc(o_orderdate, 'MM') AS date")

    def usage_pos(self) -> DataFrame:
        costs = [f"o_totalprice * {i} / 90 AS {c}" for i, c in enumerate(COSTS, 2) if c not in PREPAID_ONLY]
        return self.orders.filter("o_custkey % 2 = 0").selectExpr(
            "o_custkey AS phone_number", *costs, "trunc(o_orderdate, 'MM') AS date")

    def balance_a(self) -> DataFrame:
        parts = [f"(o_orderkey * {n}) % 40 * 10000000.0D AS BAL_{n}" for n in BALANCES]
        return self.orders.selectExpr(
            "o_custkey AS phone_number", "CASE WHEN o_orderkey % 5 = 0 THEN 0.0D ELSE (o_totalprice - 50000) * 3000 END AS BAL_1",
            *parts, "to_date(o_orderdate) AS date")

    def recharge(self) -> DataFrame:
        joined = self.orders.join(self.customer, F.expr("o_custkey = c_custkey"))
        return joined.selectExpr(
            "o_custkey AS phone_number", "o_totalprice / 4 AS recharge_amount",
            "CASE WHEN o_orderpriority < '4' THEN 'V' ELSE 'C' END AS trade_method", "c_acctbal * 6 AS pre_balance",
            "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS recharge_time", "to_date(o_orderdate) AS date")

    def vas_package(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "o_custkey AS phone_number", f"concat('PK', l_partkey % 5, element_at(array({text_array(SUFFIXES)}), "
            f"CAST(l_partkey % {len(SUFFIXES)} AS INT) + 1)) AS package_name", "l_quantity * 500 AS charge_amount",
            "to_date(l_shipdate) AS date")

    def vas_service(self) -> DataFrame:
        return self.events.selectExpr("user_id AS phone_number", "event_type AS service_name", "round(value, 0) AS price", "to_date(ts) AS date")

    def service_map(self) -> DataFrame:
        return self.events.filter("event_type <> 'error'").groupBy("event_type").agg(
            F.round(F.avg("value"), 4).alias("mean_age_group")).withColumnRenamed("event_type", "service_name")

    def vas_charge_daily(self) -> DataFrame:
        return self.order_lines().groupBy(F.col("o_custkey").alias("phone_number"), F.to_date("l_shipdate").alias("date")).agg(
            F.sum("l_extendedprice").alias("vas_charge_amt_total"), F.count(F.lit(1)).alias("vas_charge_txn_num"),
            F.count_distinct("l_suppkey").alias("vas_charge_service_num"),
            *[F.sum(F.expr(f"CASE WHEN l_linenumber = {i} THEN l_extendedprice END")).alias(f"vas_charge_amt_{c}_total")
              for i, c in enumerate(["lottery", "phongthuy", "kid", "monthly", "weekly", "daily"], 1)])

    def balance_txn(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_custkey AS phone_number", "CASE WHEN o_orderkey % 50 = 0 THEN 0.0 ELSE o_totalprice - 250000 END AS amount",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'X_PROVISIONING_LOAN_1' WHEN o_orderpriority = '2-HIGH' THEN 'AIRTIME_UNG' "
            "ELSE o_orderpriority END AS reason", "to_date(o_orderdate) AS date")

    # operator B payments

    def usage_b(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "o_custkey AS phone_number", "CASE l_linenumber % 4 WHEN 0 THEN 'SMS' WHEN 1 THEN 'VOICE' WHEN 2 THEN 'DATA' ELSE 'OTHER' END AS service_type",
            "CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END AS charge_amount", "l_shipdate AS start_time", "to_date(l_shipdate) AS date")

    def balance_b(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_custkey AS phone_number", "CASE WHEN o_orderkey % 20 = 0 THEN 0.0 ELSE o_totalprice - 200000 END AS balance",
            "CASE o_orderkey % 5 WHEN 0 THEN '142' WHEN 1 THEN concat('3', o_orderkey % 10) ELSE '0' END AS account_code",
            "CASE o_custkey % 2 WHEN 0 THEN 'PRE' ELSE 'POST' END AS billing_type", "to_date(o_orderdate) AS date")

    def vas_b(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "o_custkey AS phone_number", "CASE l_linenumber % 3 WHEN 0 THEN 'REG' WHEN 1 THEN 'UNREG' ELSE 'CONTENT' END AS transaction_type",
            "l_suppkey % 9 AS service_name", "l_extendedprice AS charge_amount", "to_date(l_shipdate) AS date")

    def airtime(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "o_custkey AS phone_number", "l_suppkey AS receive_phone_number",
            "CASE l_linenumber % 3 WHEN 0 THEN 'utn' WHEN 1 THEN '2FRIEND' ELSE 'UDV' END AS service_name",
            "l_quantity * l_linenumber * 500 AS amount",
            "l_shipdate + make_dt_interval(0, CAST(l_orderkey % 24 AS INT)) AS transaction_time", "to_date(l_shipdate) AS date")

    def hour_map(self) -> DataFrame:
        hours = self.orders.selectExpr("CAST(o_orderkey % 24 AS INT) AS hour").distinct()
        return hours.selectExpr("hour", "CASE WHEN hour >= 6 AND hour < 18 THEN 'daytime' ELSE 'nighttime' END AS hour_range_level2")

    # calendars and series

    def series(self) -> DataFrame:
        return self.orders.groupBy(F.lower("o_orderstatus").alias("ticker"), F.to_date("o_orderdate").alias("date")).agg(
            F.max("o_totalprice").alias("close"), (F.count(F.lit(1)) * 1000.0).alias("volume"))

    def indicator(self) -> DataFrame:
        return self.lineitem.groupBy(F.lower("l_returnflag").alias("indicator"), F.trunc("l_shipdate", "MM").alias("date")).agg(
            F.round(F.avg("l_discount") * 100, 2).alias("percentage")).filter("month(date) <> 5")

    def holidays(self) -> DataFrame:
        names = ("CASE date_format(o_orderdate, 'MM-dd') WHEN '01-01' THEN 'New Year' WHEN '02-05' THEN 'Lunar New Year' "
                 "WHEN '04-30' THEN 'Reunification Day' WHEN '05-01' THEN 'Labour Day' WHEN '05-02' THEN 'Labour Day' "
                 "WHEN '09-02' THEN 'National Day' WHEN '12-25' THEN 'Christmas' END")
        return self.orders.selectExpr("to_date(o_orderdate) AS date", f"{names} AS holiday").filter("holiday IS NOT NULL").distinct().selectExpr(
            "date", "date_add(date, CASE holiday WHEN 'Lunar New Year' THEN 6 WHEN 'National Day' THEN 1 ELSE 0 END) AS end_date", "holiday",
            "CASE holiday WHEN 'Christmas' THEN 'regional' ELSE 'national' END AS scope")

    # labels, evaluation, registry, device names

    def label(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_custkey AS phone_number", "to_date(o_orderdate) AS disburse_date", "o_orderpriority AS product",
            "CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS label_value").distinct()

    def predictions(self) -> DataFrame:
        y = "CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END"
        return self.orders.selectExpr(
            "concat('f', o_orderkey % 3) AS feature", "CAST(o_custkey % 8 AS INT) AS experiment_id", f"{y} AS y_true",
            f"floor(((o_orderkey * 7919 % 1000) / 1200.0D + {y} * 0.02D) * 100) / 100.0D AS p_base",
            f"floor(((o_orderkey * 7919 % 1000) / 1200.0D + {y} * (o_orderkey % 3) * 0.03D + (o_custkey % 5) * 0.004D) * 100) / 100.0D AS p_new")

    def tac_raw(self) -> DataFrame:
        model = f"element_at(array({text_array(MODELS)}), CAST(p_partkey % {len(MODELS)} AS INT) + 1)"
        return self.part.selectExpr(
            "CAST(p_partkey DIV 2 AS BIGINT) AS tac",
            f"element_at(array({text_array(BRANDS)}), CAST((p_partkey * 7 + p_size) % {len(BRANDS)} AS INT) + 1) AS device_brand",
            f"replace(replace({model}, '{{n}}', CAST(p_size AS STRING)), '{{d}}', CAST(p_size % 10 AS STRING)) AS device_model")

    def catalog(self) -> DataFrame:
        kinds = "'cs_generic', 'cs_bnpl', 'leadgen', 'is_numeric'"
        scoped = "CASE WHEN p_partkey % 2 = 0 THEN concat('_c', p_partkey % 7) ELSE '' END"
        return self.part.selectExpr(
            f"concat('op', chr(97 + CAST(p_partkey % 2 AS INT)), {scoped}, '__', element_at(array({kinds}), CAST(p_size % 4 AS INT) + 1), '__v', p_size % 3) AS client_model_code",
            "concat('family_', p_size % 4) AS model_family").distinct()

    def assignments(self) -> DataFrame:
        tokens = "'cs', 'bnpl', 'lead', 'is', 'cs_generic', 'other'"
        token = f"element_at(array({tokens}), CAST(o_orderkey % 6 AS INT) + 1)"
        operator = "concat('op', chr(97 + CAST(o_custkey % 2 AS INT)))"
        code = (f"CASE o_orderkey % 4 WHEN 0 THEN concat({operator}, '_x__[c', o_custkey % 7, '_', {token}, '_v', o_orderkey % 3, ']') "
                f"WHEN 1 THEN concat({operator}, '_[', {token}, '_v', o_orderkey % 3, ']') "
                f"WHEN 2 THEN concat({operator}, '__leadgen__v', o_orderkey % 3) ELSE '-' END")
        return self.orders.selectExpr(
            "o_orderkey AS assignment_id", f"{operator} AS telco", "concat('client_', o_custkey % 20) AS client",
            "CASE WHEN o_orderkey % 3 = 0 THEN concat('p', o_orderkey % 5) ELSE '' END AS client_product", f"{code} AS client_model_code",
            "concat('scores_', o_orderkey % 4) AS target_score_table", "to_date(o_orderdate) AS date_start",
            "CASE WHEN o_orderkey % 5 <> 0 THEN date_add(to_date(o_orderdate), CAST(o_orderkey % 400 AS INT)) END AS date_end")


_SUNDAY = "CAST(date + (7 - isodow(date))::INT AS DATE)"
_AGO = "CAST(date - (e % {})::INT AS DATE)"
_CODES = "concat('B', e % 27, '#b', e % 27, ',', CASE WHEN e % 3 = 0 THEN '' ELSE concat(' b', e % 4, '#x') END, ',B', e % 27)"
_K = "CAST(json_extract_string(props, '$.k') AS {})"
_Y = "CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END"
_TOKEN = "(['cs', 'bnpl', 'lead', 'is', 'cs_generic', 'other'])[o_orderkey % 6 + 1]"
_OPERATOR = "concat('op', chr(97 + (o_custkey % 2)::INT))"
_MODEL = f"([{text_array(MODELS)}])[p_partkey % {len(MODELS)} + 1]"

# SQL text of every derived table, with the derived tables it reads.
SQL: dict[str, tuple[str, str]] = {
    "order_lines": ("", "SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey"),
    "sightings": ("order_lines", "SELECT o_custkey AS phone_number, l_partkey AS imei, l_suppkey AS tac, CAST(l_shipdate AS DATE) AS date, l_linenumber % 2 AS channel FROM order_lines"),
    "imei_weekly": ("sightings", f"SELECT phone_number, imei, tac, {_SUNDAY} AS date, count(DISTINCT s.date) AS device_num_day_l1w FROM sightings s GROUP BY 1, 2, 3, 4"),
    "activation": ("", f"SELECT o_custkey AS phone_number, CAST(min(o_orderdate) AS DATE) + 90 AS last_activated_date, DATE '{ORDERS_SNAPSHOT}' - (o_custkey % 14)::INT AS date FROM orders GROUP BY o_custkey"),
    "naid_monthly": ("order_lines", "SELECT DISTINCT o_custkey AS phone_number, l_suppkey % 40 AS naid, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM order_lines"),
    "tac_map": ("", "SELECT s_suppkey AS tac, n_name AS device_brand, s_name AS device_model, CASE s_nationkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' END AS device_os, CASE s_suppkey % 2 WHEN 0 THEN 'Smartphone' ELSE 'Tablet' END AS device_type FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0"),
    "device_current": ("sightings tac_map", f"SELECT phone_number, week AS date, w.tac AS device_current_tac_l2w, coalesce(lower(device_brand), 'unmapped') AS device_current_brand_l2w FROM (SELECT phone_number, {_SUNDAY} AS week, tac % 4 AS tac, row_number() OVER (PARTITION BY phone_number, {_SUNDAY} ORDER BY count(*) DESC, tac % 4 DESC) AS rn FROM sightings GROUP BY 1, 2, 3) w LEFT JOIN tac_map m ON m.tac = w.tac WHERE rn = 1"),
    "cell_daily": ("", f"SELECT user_id AS phone_number, {_K.format('BIGINT')} AS cell_id, CAST(ts AS DATE) AS date, count(*) AS count FROM events GROUP BY 1, 2, 3"),
    "cell_map": ("cell_daily", "SELECT cell_id, place * 10 AS district_code, concat('D', place) AS district_name, place AS province_code, r_name AS province_name, DATE '2023-01-01' + 365 * version AS date FROM (SELECT cell_id, version, (CASE WHEN cell_id < 80 THEN 0 ELSE cell_id % 5 END + 1 - version) % 5 AS place FROM (SELECT DISTINCT cell_id FROM cell_daily WHERE cell_id % 4 <> 0) c, (VALUES (0), (1)) v(version)) p JOIN region ON place = r_regionkey"),
    "seed_daily": ("order_lines", "SELECT o_custkey AS phone_number, l_suppkey AS cell_id, CAST(l_quantity AS BIGINT) AS sum_logs_count, l_partkey % 50 AS ref_cell_id, CAST(l_linenumber AS BIGINT) AS ref_sum_logs_count, r_name AS ref_province_name, CAST(l_shipdate AS DATE) AS date FROM order_lines JOIN region ON r_regionkey = (o_custkey + l_suppkey % 2) % 5"),
    "wallet_daily": ("", f"SELECT user_id AS phone_number, CASE parity WHEN 0 THEN 'MM' ELSE 'VP' END AS mother_system, e AS mobile_id, e % 63 AS province_code, e % 700 AS district, {_AGO.format(900)} AS actv_date, {_AGO.format(60)} AS updated_date, {_AGO.format(365)} AS pin_date, {_AGO.format(120)} AS info_updated_date, CASE WHEN e % 5 <> 0 THEN {_AGO.format(400)} END AS money_source_linked_date, {_AGO.format(30)} AS customer_type_date, CASE WHEN e % 7 <> 0 THEN 'BANK,CARD,BANK' ELSE 'CARD' END AS money_source_table, CASE WHEN e % 11 <> 0 THEN {_CODES} END AS money_sources, e % 3 AS pin_status, e % 4 AS mobile_level, CASE WHEN e % 6 = 0 THEN e % 50 END AS company_id, CASE WHEN e % 4 <> 0 THEN 'SHOP' END AS channel_type, CASE WHEN e % 10 <> 0 THEN concat('V', e % 3) END AS partner_bank_code, CASE WHEN e % 13 <> 0 THEN concat('C', e % 2) END AS core_bank_code, date FROM (SELECT user_id, CAST(ts AS DATE) AS date, event_id % 2 AS parity, min(event_id) AS e FROM events GROUP BY 1, 2, 3) d"),
    "bank_map": ("", "SELECT concat('B', n_nationkey) AS bank_code, (['State-Owned Commercial Bank', 'State-Owned Limited Liability Bank', 'Wholly Foreign-Owned Bank', 'Non-Bank Financial Institution', 'Joint Stock Commercial Bank', 'Joint Venture Bank'])[n_nationkey % 6 + 1] AS bank_type, (['Large', 'Medium', 'small'])[n_nationkey % 3 + 1] AS bank_size FROM nation"),
    "data_charge": ("", f"SELECT user_id AS phone_number, ts AS start_time, CASE WHEN event_id % 9 <> 0 THEN value END AS up_data, value * {_K.format('DOUBLE')} AS down_data, value AS charge_amount, {_K.format('DOUBLE')} * 10 AS balance_remain, CAST(ts AS DATE) AS date FROM events"),
    "usage_pre": ("", "SELECT o_custkey AS phone_number, " + ", ".join(f"o_totalprice * {i} / 100 AS {c}" for i, c in enumerate(COSTS, 3)) + ", CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders WHERE o_custkey % 2 = 1"),
    "usage_pos": ("", "SELECT o_custkey AS phone_number, " + ", ".join(f"o_totalprice * {i} / 90 AS {c}" for i, c in enumerate(COSTS, 2) if c not in PREPAID_ONLY) + ", CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders WHERE o_custkey % 2 = 0"),
    "balance_a": ("", "SELECT o_custkey AS phone_number, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE (o_totalprice - 50000) * 3000 END AS BAL_1, " + ", ".join(f"CAST((o_orderkey * {n}) % 40 * 10000000.0 AS DOUBLE) AS BAL_{n}" for n in BALANCES) + ", CAST(o_orderdate AS DATE) AS date FROM orders"),
    "recharge": ("", "SELECT o_custkey AS phone_number, o_totalprice / 4 AS recharge_amount, CASE WHEN o_orderpriority < '4' THEN 'V' ELSE 'C' END AS trade_method, c_acctbal * 6 AS pre_balance, o_orderdate + to_hours(o_orderkey % 24) AS recharge_time, CAST(o_orderdate AS DATE) AS date FROM orders JOIN customer ON o_custkey = c_custkey"),
    "vas_package": ("order_lines", f"SELECT o_custkey AS phone_number, concat('PK', l_partkey % 5, ([{text_array(SUFFIXES)}])[l_partkey % {len(SUFFIXES)} + 1]) AS package_name, l_quantity * 500 AS charge_amount, CAST(l_shipdate AS DATE) AS date FROM order_lines"),
    "vas_service": ("", "SELECT user_id AS phone_number, event_type AS service_name, round(value, 0) AS price, CAST(ts AS DATE) AS date FROM events"),
    "service_map": ("", "SELECT event_type AS service_name, round(avg(value), 4) AS mean_age_group FROM events WHERE event_type <> 'error' GROUP BY 1"),
    "vas_charge_daily": ("order_lines", "SELECT o_custkey AS phone_number, CAST(l_shipdate AS DATE) AS date, sum(l_extendedprice) AS vas_charge_amt_total, count(*) AS vas_charge_txn_num, count(DISTINCT l_suppkey) AS vas_charge_service_num, " + ", ".join(f"sum(l_extendedprice) FILTER (l_linenumber = {i}) AS vas_charge_amt_{c}_total" for i, c in enumerate(["lottery", "phongthuy", "kid", "monthly", "weekly", "daily"], 1)) + " FROM order_lines GROUP BY 1, 2"),
    "balance_txn": ("", "SELECT o_custkey AS phone_number, CASE WHEN o_orderkey % 50 = 0 THEN 0.0 ELSE o_totalprice - 250000 END AS amount, CASE o_orderpriority WHEN '1-URGENT' THEN 'X_PROVISIONING_LOAN_1' WHEN '2-HIGH' THEN 'AIRTIME_UNG' ELSE o_orderpriority END AS reason, CAST(o_orderdate AS DATE) AS date FROM orders"),
    "usage_b": ("order_lines", "SELECT o_custkey AS phone_number, (['SMS', 'VOICE', 'DATA', 'OTHER'])[l_linenumber % 4 + 1] AS service_type, CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END AS charge_amount, l_shipdate AS start_time, CAST(l_shipdate AS DATE) AS date FROM order_lines"),
    "balance_b": ("", "SELECT o_custkey AS phone_number, CASE WHEN o_orderkey % 20 = 0 THEN 0.0 ELSE o_totalprice - 200000 END AS balance, CASE o_orderkey % 5 WHEN 0 THEN '142' WHEN 1 THEN concat('3', o_orderkey % 10) ELSE '0' END AS account_code, CASE o_custkey % 2 WHEN 0 THEN 'PRE' ELSE 'POST' END AS billing_type, CAST(o_orderdate AS DATE) AS date FROM orders"),
    "vas_b": ("order_lines", "SELECT o_custkey AS phone_number, (['REG', 'UNREG', 'CONTENT'])[l_linenumber % 3 + 1] AS transaction_type, l_suppkey % 9 AS service_name, l_extendedprice AS charge_amount, CAST(l_shipdate AS DATE) AS date FROM order_lines"),
    "airtime": ("order_lines", "SELECT o_custkey AS phone_number, l_suppkey AS receive_phone_number, (['utn', '2FRIEND', 'UDV'])[l_linenumber % 3 + 1] AS service_name, l_quantity * l_linenumber * 500 AS amount, l_shipdate + to_hours(l_orderkey % 24) AS transaction_time, CAST(l_shipdate AS DATE) AS date FROM order_lines"),
    "hour_map": ("", "SELECT DISTINCT o_orderkey % 24 AS hour, CASE WHEN o_orderkey % 24 >= 6 AND o_orderkey % 24 < 18 THEN 'daytime' ELSE 'nighttime' END AS hour_range_level2 FROM orders"),
    "series": ("", "SELECT lower(o_orderstatus) AS ticker, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS close, count(*) * 1000.0::DOUBLE AS volume FROM orders GROUP BY 1, 2"),
    "indicator": ("", "SELECT * FROM (SELECT lower(l_returnflag) AS indicator, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, round(avg(l_discount) * 100, 2) AS percentage FROM lineitem GROUP BY 1, 2) i WHERE month(date) <> 5"),
    "holidays": ("", "SELECT date, date + CASE holiday WHEN 'Lunar New Year' THEN 6 WHEN 'National Day' THEN 1 ELSE 0 END AS end_date, holiday, CASE holiday WHEN 'Christmas' THEN 'regional' ELSE 'national' END AS scope FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CASE strftime(o_orderdate, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '02-05' THEN 'Lunar New Year' WHEN '04-30' THEN 'Reunification Day' WHEN '05-01' THEN 'Labour Day' WHEN '05-02' THEN 'Labour Day' WHEN '09-02' THEN 'National Day' WHEN '12-25' THEN 'Christmas' END AS holiday FROM orders) h WHERE holiday IS NOT NULL"),
    "label": ("", f"SELECT DISTINCT o_custkey AS phone_number, CAST(o_orderdate AS DATE) AS disburse_date, o_orderpriority AS product, {_Y} AS label_value FROM orders"),
    "predictions": ("", f"SELECT concat('f', o_orderkey % 3) AS feature, o_custkey % 8 AS experiment_id, {_Y} AS y_true, floor(((o_orderkey * 7919 % 1000) / 1200.0::DOUBLE + {_Y} * 0.02::DOUBLE) * 100) / 100.0::DOUBLE AS p_base, floor(((o_orderkey * 7919 % 1000) / 1200.0::DOUBLE + {_Y} * (o_orderkey % 3) * 0.03::DOUBLE + (o_custkey % 5) * 0.004::DOUBLE) * 100) / 100.0::DOUBLE AS p_new FROM orders"),
    "tac_raw": ("", f"SELECT p_partkey // 2 AS tac, ([{text_array(BRANDS)}])[(p_partkey * 7 + p_size) % {len(BRANDS)} + 1] AS device_brand, replace(replace({_MODEL}, '{{n}}', p_size::VARCHAR), '{{d}}', (p_size % 10)::VARCHAR) AS device_model FROM part"),
    "catalog": ("", "SELECT DISTINCT concat('op', chr(97 + (p_partkey % 2)::INT), CASE WHEN p_partkey % 2 = 0 THEN concat('_c', p_partkey % 7) ELSE '' END, '__', (['cs_generic', 'cs_bnpl', 'leadgen', 'is_numeric'])[p_size % 4 + 1], '__v', p_size % 3) AS client_model_code, concat('family_', p_size % 4) AS model_family FROM part"),
    "assignments": ("", f"SELECT o_orderkey AS assignment_id, {_OPERATOR} AS telco, concat('client_', o_custkey % 20) AS client, CASE WHEN o_orderkey % 3 = 0 THEN concat('p', o_orderkey % 5) ELSE '' END AS client_product, CASE o_orderkey % 4 WHEN 0 THEN concat({_OPERATOR}, '_x__[c', o_custkey % 7, '_', {_TOKEN}, '_v', o_orderkey % 3, ']') WHEN 1 THEN concat({_OPERATOR}, '_[', {_TOKEN}, '_v', o_orderkey % 3, ']') WHEN 2 THEN concat({_OPERATOR}, '__leadgen__v', o_orderkey % 3) ELSE '-' END AS client_model_code, concat('scores_', o_orderkey % 4) AS target_score_table, CAST(o_orderdate AS DATE) AS date_start, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + (o_orderkey % 400)::INT END AS date_end FROM orders"),
}


def ctes(names: list[str]) -> str:
    """WITH clause of the named derived tables and everything they read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for inner in SQL[name][0].split():
            visit(inner)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return f"WITH {', '.join(f'{n} AS ({SQL[n][1]})' for n in ordered)} " if ordered else ""
