"""Single operators: projections, joins, aggregates, windows, sorts, sets, quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from sundial.checks.device_queries import ACTIVATED, SNAP, history_sql, shape_sql, since
from sundial.checks.fixtures import COSTS, EVENTS_SNAPSHOT, ORDERS_SNAPSHOT
from sundial.checks.payment_a_queries import ESNAP, activated, own_sql
from sundial.checks.registry import query
from sundial.functions.dates import add_months, eligible_sunday, require_new_year, require_sunday
from sundial.functions.numbers import flag
from sundial.functions.texts import category_or_unmapped, slug
from sundial.operators import aggregates as agg
from sundial.operators import columns, joins, ordering, quality, sequences, sets, windows
from sundial.operators.aggregates import Bucket
from sundial.operators.distincts import Part, aggregated, nested_levels
from sundial.operators.windows import LookBack, Measure, Offset, last, last_and_previous, parse_window, windowed_aggregate
from sundial.plans import devices, markets, provinces, training
from sundial.sources import scans

PHONE = "phone_number"


# projections

@query("P1_prefix", "SELECT n_nationkey, n_name AS geo_n_name, n_regionkey AS geo_n_regionkey FROM nation", texts="geo_n_name")
def p1(f):
    return columns.with_prefix(f.nation, "geo", ["n_nationkey"])


@query("P2_suffix", "SELECT c_custkey, c_nationkey AS c_nationkey_crm, c_acctbal AS c_acctbal_crm FROM customer", doubles=".*acctbal.*")
def p2(f):
    return columns.with_suffix(f.customer.select("c_custkey", "c_nationkey", "c_acctbal"), "crm", ["c_custkey"])


KEPT = [c for c in COSTS if c.startswith("v_") and c.endswith("_cost") and "org" not in c]


@query("P3_columns_by_name", f"SELECT phone_number, date, {', '.join(KEPT)} FROM usage_pre", "usage_pre", "v_.*", "date")
def p3(f):
    return columns.matching(f.usage_pre(), starts=("v_",), ends=("_cost",), without=("org",), keys=[PHONE, "date"])


@query("P4_decimals_to_double", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM orders", doubles="price")
def p4(f):
    return columns.decimals_to_double(f.orders.selectExpr("o_orderkey", "CAST(o_totalprice AS DECIMAL(18,2)) AS price"))


@query("P5_named_to_double", "SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS sms_cnt, TRY_CAST(o_orderpriority AS DOUBLE) AS sms_text FROM orders", doubles="sms.*")
def p5(f):
    return columns.named_to_double(f.orders.selectExpr("o_orderkey", "CAST(o_custkey AS STRING) AS sms_cnt", "o_orderpriority AS sms_text"), ["sms"])


@query("P6_nan_to_null", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price, o_orderstatus FROM orders", doubles="price", texts="o_orderstatus")
def p6(f):
    return columns.nan_to_null(f.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN double('NaN') ELSE o_totalprice END AS price", "o_orderstatus"))


@query("P7_fill_missing", "SELECT phone_number, mother_system, date, coalesce(company_id, -1) AS company_id, coalesce(channel_type, '') AS channel_type FROM wallet_daily", "wallet_daily", texts="mother_system|date|channel_type")
def p7(f):
    rows = f.wallet_daily().select(PHONE, "mother_system", "date", "company_id", "channel_type")
    return columns.fill_missing(rows, -1, "", keys=[PHONE])


@query("P8_align_schema", "SELECT phone_number, t_tot_cost, -1.0 AS re_charge, date FROM usage_pos", "usage_pos", "t_tot_cost|re_charge", "date")
def p8(f):
    return columns.align_to(f.usage_pos(), [PHONE, "t_tot_cost", "re_charge", "date"], -1.0)


@query("P9_kept_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer", texts="c_mktsegment")
def p9(f):
    return columns.keep(f.customer, ["c_mktsegment", "c_nationkey", "not_there"], ["c_custkey"])


@query("P10_activation_strict", f"SELECT t.phone_number, t.date, count(*) AS n FROM recharge t JOIN {ACTIVATED} a USING (phone_number) WHERE t.date > a.lad GROUP BY 1, 2", "recharge activation", texts="date")
def p10(f):
    return joins.current_activation(f.recharge(), activated(f), strict=True).groupBy(PHONE, "date").agg(F.count(F.lit(1)).alias("n"))


@query("P10_activation", f"SELECT phone_number, date, count(*) AS n FROM {own_sql('recharge')} GROUP BY 1, 2", "recharge activation", texts="date")
def p10b(f):
    return joins.current_activation(f.recharge(), activated(f)).groupBy(PHONE, "date").agg(F.count(F.lit(1)).alias("n"))


@query("P11_usable_accounts", "SELECT phone_number, date, balance FROM balance_b WHERE NOT starts_with(account_code, '3') AND NOT contains(account_code, '142') AND balance >= 0", "balance_b", "balance", "date")
def p11(f):
    from sundial.plans.balances import usable_accounts

    return usable_accounts(f.balance_b()).select(PHONE, "date", "balance")


@query("P12_not_null", "SELECT mother_system, count(*) AS n FROM wallet_daily WHERE money_sources IS NOT NULL GROUP BY 1", "wallet_daily", texts="mother_system")
def p12(f):
    return f.wallet_daily().filter(F.col("money_sources").isNotNull()).groupBy("mother_system").agg(F.count(F.lit(1)).alias("n"))


@query("P13_category_or_unmapped", "SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE coalesce(lower(device_brand), 'unmapped') END AS brand FROM supplier LEFT JOIN tac_map ON tac = s_suppkey", "tac_map", texts="brand")
def p13(f):
    joined = f.supplier.join(f.tac_map(), F.expr("tac = s_suppkey"), "left")
    key = F.expr("CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey END")
    return joined.select("s_suppkey", category_or_unmapped(key, F.col("device_brand")).alias("brand"))


@query("P14_free_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus IN ('F', 'O')", doubles="o_totalprice")
def p14(f):
    return f.orders.filter("o_totalprice > 250000 AND o_orderstatus IN ('F', 'O')").select("o_orderkey", "o_totalprice")


# joins

@query("J1_inner_two_keys", "SELECT phone_number, date, count(*) AS n FROM recharge JOIN balance_b USING (phone_number, date) GROUP BY 1, 2", "recharge balance_b", texts="date")
def j1(f):
    return f.recharge().join(f.balance_b(), [PHONE, "date"]).groupBy(PHONE, "date").agg(F.count(F.lit(1)).alias("n"))


@query("J2_left", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def j2(f):
    return f.customer.join(f.orders, F.expr("c_custkey = o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


def parts(f, test: str, alias: str):
    return f.recharge().filter(test).groupBy(PHONE).agg(F.count(F.lit(1)).alias(alias))


@query("J3_outer_chain", "SELECT * FROM (SELECT phone_number, count(*) AS a FROM recharge WHERE trade_method = 'V' AND recharge_amount > 100000 GROUP BY 1) "
       "FULL JOIN (SELECT phone_number, count(*) AS b FROM recharge WHERE trade_method = 'C' AND recharge_amount > 100000 GROUP BY 1) USING (phone_number) "
       "FULL JOIN (SELECT phone_number, count(*) AS c FROM recharge WHERE recharge_amount < 2000 GROUP BY 1) USING (phone_number)", "recharge")
def j3(f):
    return joins.outer_on_key([parts(f, "trade_method = 'V' AND recharge_amount > 100000", "a"), parts(f, "trade_method = 'C' AND recharge_amount > 100000", "b"),
                               parts(f, "recharge_amount < 2000", "c")], [PHONE])


@query("J4_outer_named_keys", "SELECT coalesce(a.phone_number, b.receiver) AS phone_number, sent, got FROM (SELECT phone_number, count(*) AS sent FROM airtime GROUP BY 1) a "
       "FULL JOIN (SELECT receive_phone_number AS receiver, count(*) AS got FROM airtime GROUP BY 1) b ON a.phone_number = b.receiver", "airtime")
def j4(f):
    sent = f.airtime().groupBy(PHONE).agg(F.count(F.lit(1)).alias("sent"))
    got = f.airtime().groupBy(F.col("receive_phone_number").alias("receiver")).agg(F.count(F.lit(1)).alias("got"))
    return joins.outer_on(sent, got, PHONE, "receiver")


@query("J5_lookup", "SELECT device_brand, count(*) AS n FROM sightings LEFT JOIN tac_map USING (tac) GROUP BY 1", "sightings tac_map", texts="device_brand")
def j5(f):
    return joins.lookup(f.sightings(), f.tac_map(), "tac", check=True).groupBy("device_brand").agg(F.count(F.lit(1)).alias("n"))


@query("J6_present_in", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) GROUP BY 1")
def j6(f):
    heavy = f.lineitem.filter("l_quantity > 45").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.present_in(f.orders, heavy, ["o_orderkey"]).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


def weekly_devices(f):
    return f.imei_weekly().groupBy(PHONE, "date").agg(F.count(F.lit(1)).alias("n"))


J7 = ("SELECT l.*, f.date, f.n FROM label l LEFT JOIN (SELECT phone_number, date, count(*) AS n FROM {table} GROUP BY 1, 2) f "
      "ON f.phone_number = l.phone_number AND l.disburse_date - f.date BETWEEN 3 AND 9")


@query("J7_point_in_time_weekly", J7.format(table="imei_weekly"), "label imei_weekly", texts="disburse_date|product|date")
def j7(f):
    return joins.point_in_time(f.label(), weekly_devices(f), weekly=True)


@query("J7_point_in_time_any_day", J7.format(table="sightings"), "label sightings", texts="disburse_date|product|date")
def j7b(f):
    daily = f.sightings().groupBy(PHONE, "date").agg(F.count(F.lit(1)).alias("n"))
    return joins.bounded_point_in_time(f.label(), daily)


@query("J8_snapped_merge", "SELECT l.*, f.date, f.n FROM label l LEFT JOIN (SELECT phone_number, date, count(*) AS n FROM imei_weekly GROUP BY 1, 2) f ON f.phone_number = l.phone_number "
       "AND f.date = l.disburse_date - (isodow(l.disburse_date) + CASE WHEN isodow(l.disburse_date) <= 3 THEN 7 ELSE 0 END)::INT", "label imei_weekly", texts="disburse_date|product|date")
def j8(f):
    return joins.snapped_merge(f.label(), weekly_devices(f), by_key=True)


WIDE = "SELECT l.*, a.n AS n, b.total FROM label l LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = l.phone_number LEFT JOIN (SELECT o_custkey, CAST(sum(o_totalprice) AS DECIMAL(18,2)) AS total FROM orders GROUP BY 1) b ON b.o_custkey = l.phone_number"


@query("J9_wide_merge", WIDE, "label", "total", "disburse_date|product", digits=2)
def j9(f):
    orders = f.orders.withColumnRenamed("o_custkey", PHONE)
    n = orders.groupBy(PHONE).agg(F.count(F.lit(1)).alias("n"))
    total = orders.groupBy(PHONE).agg(F.sum("o_totalprice").cast("decimal(18,2)").alias("total"), F.count(F.lit(1)).alias("n"))
    return joins.wide_merge(f.label(), {"n": n, "total": total}, [PHONE])


@query("J10_sample_merge", "SELECT l.*, a.n AS n_first, b.n AS n_second FROM label l LEFT JOIN (SELECT phone_number, disburse_date, count(*) AS n FROM label GROUP BY 1, 2) a USING (phone_number, disburse_date) "
       "LEFT JOIN (SELECT phone_number, disburse_date, max(label_value) AS n FROM label WHERE label_value = 1 GROUP BY 1, 2) b USING (phone_number, disburse_date)", "label", texts="disburse_date|product")
def j10(f):
    keys = [PHONE, "disburse_date"]
    first = f.label().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    second = f.label().filter("label_value = 1").groupBy(*keys).agg(F.max("label_value").alias("n"))
    return training.merge_sample_tables(f.label(), {"first": first, "second": second})


@query("J11_look_back_join", "SELECT s.ticker, s.date AS snap, count(r.close) AS n, sum(r.volume) AS volume FROM (SELECT ticker, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM series GROUP BY 1) s "
       "JOIN series r ON r.ticker = s.ticker AND r.date > s.date - 28 AND r.date <= s.date WHERE isodow(s.date) = 7 GROUP BY 1, 2", "series", "volume", "ticker|snap")
def j11(f):
    newest = f.series().groupBy("ticker").agg(F.max("date").alias("last"))
    spread = joins.last_days_per_sunday(f.series(), 4).join(newest, "ticker").filter("snap <= last")
    return spread.groupBy("ticker", "snap").agg(F.count("close").alias("n"), F.sum("volume").alias("volume"))


@query("J12_as_of", "SELECT l.phone_number, l.disburse_date, l.product, l.label_value, b.amount FROM label l ASOF LEFT JOIN (SELECT phone_number, date, max(amount) AS amount FROM balance_txn GROUP BY 1, 2) b "
       "ON b.phone_number = l.phone_number AND b.date <= l.disburse_date - 30", "label balance_txn", "amount", "disburse_date|product", digits=2)
def j12(f):
    points = f.balance_txn().groupBy(PHONE, "date").agg(F.max("amount").alias("amount"))
    left = f.label().withColumn("at", F.date_sub("disburse_date", 30))
    return joins.as_of(left, points, [PHONE], "at", "date", ["amount"]).drop("at")


@query("J13_nearest_events", "WITH cal AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM holidays), (SELECT max(date) FROM holidays), INTERVAL 1 DAY)) AS DATE) AS date) "
       "SELECT date, (SELECT min(h.date) FROM holidays h WHERE h.date >= cal.date) - date AS ahead, date - (SELECT max(h.date) FROM holidays h WHERE h.date <= cal.date) AS behind FROM cal", "holidays", texts="date")
def j13(f):
    days = scans.calendar(f.holidays()).join(f.holidays().select("date", F.lit(1).alias("hit")).distinct(), "date", "left").fillna(0)
    ahead, behind = joins.nearest_events(days, "hit")
    return days.select("date", ahead.alias("ahead"), behind.alias("behind"))


GRID = (f"WITH days AS (SELECT phone_number, date, sum(charge_amount) AS x FROM data_charge WHERE date > {ESNAP} - 14 AND date <= {ESNAP} GROUP BY 1, 2), "
        f"grid AS (SELECT * FROM (SELECT DISTINCT phone_number FROM days) p, (SELECT {ESNAP} - i::INT AS date FROM range(14) r(i)) d) "
        "SELECT phone_number, avg(coalesce(x, 0)) AS mean, stddev_samp(coalesce(x, 0)) AS std FROM grid LEFT JOIN days USING (phone_number, date) GROUP BY 1")


def zero_filled(f):
    days = scans.last_weeks(f.data_charge(), EVENTS_SNAPSHOT, 2).groupBy(PHONE, "date").agg(F.sum("charge_amount").alias("x"))
    return agg.zero_filled_mean_std(days, [PHONE], {"x": ("mean", "std")}, 14)


@query("J14_dense_grid_without_cross_join", GRID, "data_charge", "mean|std", digits=4)
def j14(f):
    return zero_filled(f)


@query("J15_ranked_side_by_side", "WITH r AS (SELECT phone_number, tac, count(*) AS n, row_number() OVER (PARTITION BY phone_number ORDER BY count(*) DESC, tac) AS rn FROM sightings GROUP BY 1, 2) "
       "SELECT phone_number, max(tac) FILTER (rn = 1) AS first_tac, max(tac) FILTER (rn = 2) AS second_tac, sum(n) AS total FROM r GROUP BY 1", "sightings")
def j15(f):
    per_tac = f.sightings().groupBy(PHONE, "tac").agg(F.count(F.lit(1)).alias("n"))
    ranked = per_tac.withColumn("rank", F.row_number().over(Window.partitionBy(PHONE).orderBy(F.col("n").desc(), "tac")))
    return ranked.groupBy(PHONE).agg(F.max(F.when(F.col("rank") == 1, F.col("tac"))).alias("first_tac"),
                                     F.max(F.when(F.col("rank") == 2, F.col("tac"))).alias("second_tac"), F.sum("n").alias("total"))


@query("J16_below_own_average", "WITH a AS (SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY 1) SELECT o_custkey, count(*) AS n FROM orders JOIN a USING (o_custkey) WHERE o_totalprice < m GROUP BY 1")
def j16(f):
    means = f.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("m"))
    return f.orders.join(means, "o_custkey").filter("o_totalprice < m").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("J17_total_and_part", "SELECT phone_number, count(*) AS total, count(*) FILTER (trade_method = 'V') AS vouchers FROM recharge GROUP BY 1", "recharge")
def j17(f):
    return f.recharge().groupBy(PHONE).agg(F.count(F.lit(1)).alias("total"), agg.count_where(F.col("trade_method") == "V").alias("vouchers"))


@query("J18_valid_at", f"SELECT assignment_id, telco FROM assignments WHERE date_start <= {SNAP} AND (date_end IS NULL OR date_end >= {SNAP})", "assignments", texts="telco")
def j18(f):
    return joins.valid_at(f.assignments(), ORDERS_SNAPSHOT).select("assignment_id", "telco")


@query("J18_valid_on_days", "SELECT d.date, count(*) AS n FROM (SELECT DISTINCT date FROM holidays UNION ALL SELECT DATE '2150-07-01') d JOIN (SELECT CASE WHEN assignment_id % 7 <> 0 THEN date_start END AS date_start, date_end FROM assignments) a ON (a.date_start IS NULL OR a.date_start <= d.date) AND (a.date_end IS NULL OR a.date_end >= d.date) GROUP BY 1", "assignments holidays", texts="date")
def j18b(f):
    """With open starts, open ends and a day far ahead."""
    days = f.holidays().select("date").distinct().unionByName(f.spark.sql("SELECT DATE '2150-07-01' AS date"))
    rows = f.assignments().withColumn("date_start", F.expr("CASE WHEN assignment_id % 7 <> 0 THEN date_start END"))
    return joins.valid_on_days(rows, days).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("J19_first_candidate", "SELECT assignment_id, base_code, model_family FROM assignments LEFT JOIN (SELECT client_model_code AS base_code, model_family FROM catalog) ON base_code = client_model_code", "assignments catalog", texts="base_code|model_family")
def j19(f):
    rows = f.assignments().select("assignment_id", F.array(F.lit("none"), F.col("client_model_code")).alias("codes"))
    catalog = f.catalog().withColumnRenamed("client_model_code", "base_code")
    return joins.first_candidate(rows, "codes", catalog, "base_code", "model_family", ["assignment_id"]).drop("codes")


# aggregates

W = [12, 24, 48]
A1_MEASURES = [("count", "*", "count(*)", "n"), ("sum", "recharge_amount", "sum(recharge_amount)", "amount"), ("avg", "recharge_amount", "avg(recharge_amount)", "mean"),
               ("min", "pre_balance", "min(pre_balance)", "low"), ("stddev", "recharge_amount", "stddev_samp(recharge_amount)", "spread")]


@query("A1_windowed_aggregate", "SELECT phone_number, " + ", ".join(f"{sql} FILTER ({since(n)}) AS {alias}_l{n}w" for n in W for _, _, sql, alias in A1_MEASURES) + f" FROM recharge WHERE {since(48)} GROUP BY 1",
       "recharge", "(amount|mean|low|spread)_.*", digits=4)
def a1(f):
    return windowed_aggregate(f.recharge(), [PHONE], [Measure(func, c, alias) for func, c, _, alias in A1_MEASURES], last(*W), ORDERS_SNAPSHOT)


@query("A2_windowed_distinct", "SELECT phone_number, " + ", ".join(f"count(DISTINCT tac) FILTER ({since(n)}) AS tacs_l{n}w, count(*) FILTER ({since(n)}) AS n_l{n}w, max(date) FILTER ({since(n)}) AS last_l{n}w" for n in W) + f" FROM sightings WHERE {since(48)} GROUP BY 1",
       "sightings", texts="last_.*")
def a2(f):
    measures = [Measure("count_distinct", "tac", "tacs"), Measure("count", "*", "n"), Measure("max", "date", "last")]
    return windowed_aggregate(f.sightings(), [PHONE], measures, last(*W), ORDERS_SNAPSHOT)


@query("A2_windowed_distinct_two_columns", "SELECT tac, " + ", ".join(f"count(DISTINCT imei) FILTER ({since(n)}) AS imeis_l{n}w, count(DISTINCT phone_number) FILTER ({since(n)}) AS phones_l{n}w" for n in W) + f" FROM sightings WHERE {since(48)} GROUP BY 1", "sightings")
def a2b(f):
    return windowed_aggregate(f.sightings(), ["tac"], [Measure("count_distinct", "imei", "imeis"), Measure("count_distinct", PHONE, "phones")], last(*W), ORDERS_SNAPSHOT)


A3 = {"l12w": since(12), "l24w_to_l12w": since(24, 12), "l30d": f"date > {SNAP} - 30 AND date <= {SNAP}", "l6m": f"date > DATE '2001-01-29' AND date <= {SNAP}",
      "l2y": f"date > DATE '1999-07-29' AND date <= {SNAP}", "current": f"date <= {SNAP}"}


@query("A3_window_kinds", "SELECT phone_number, " + ", ".join(f"count(*) FILTER ({t}) AS n_{n}" for n, t in A3.items()) + f", count(*) FILTER (date <= {SNAP} - 84) AS old_l12w FROM recharge WHERE date <= {SNAP} GROUP BY 1", "recharge")
def a3(f):
    kinds = [parse_window("last 12 weeks"), parse_window("last 24 weeks", "last 12 weeks"), parse_window("last 30 days"), parse_window("last 6 months"), parse_window("last 2 years"), LookBack()]
    counted = windowed_aggregate(f.recharge(), [PHONE], [Measure("count", "*", "n")], kinds, ORDERS_SNAPSHOT)
    old = windowed_aggregate(f.recharge(), [PHONE], [Measure("count", "*", "old")], [LookBack(None, Offset(12))], ORDERS_SNAPSHOT)
    return counted.join(old, PHONE, "left").fillna(0)


def device_sets(f):
    return windowed_aggregate(f.sightings(), [PHONE], [Measure("collect_set", "tac", "tacs")], last_and_previous(12, 24), ORDERS_SNAPSHOT)


SETS_SQL = ("sets AS (SELECT phone_number, " + ", ".join(
    f"coalesce(list(DISTINCT tac) FILTER ({since(n)}), []) AS c{n}, coalesce(list(DISTINCT tac) FILTER ({since(2 * n, n)}), []) AS h{n}" for n in (12, 24)) + f" FROM sightings WHERE {since(48)} GROUP BY 1)")


@query("A4_windowed_sets", f"WITH {SETS_SQL} SELECT phone_number, len(c12) AS n_l12w, len(h12) AS n_l24w_to_l12w, len(c24) AS n_l24w, len(h24) AS n_l48w_to_l24w, list_sum(c24) AS sum_l24w FROM sets", "sightings")
def a4(f):
    sizes = [F.size(f"tacs_{w}").alias(f"n_{w}") for w in ("l12w", "l24w_to_l12w", "l24w", "l48w_to_l24w")]
    total = F.aggregate("tacs_l24w", F.lit(0).cast("long"), lambda a, x: a + x)
    return device_sets(f).select(PHONE, *sizes, F.when(F.size("tacs_l24w") > 0, total).alias("sum_l24w"))


RATIO = "round(coalesce({part} / nullif(len(list_distinct(list_concat(c{n}, h{n}))), 0), 0), 6)"


@query("A5_overlap_ratio", f"WITH {SETS_SQL} SELECT phone_number, " + ", ".join(RATIO.format(part=f"len(list_intersect(c{n}, h{n}))", n=n) + f" AS tacs_intersection_ratio_l{n}w" for n in (12, 24)) + " FROM sets", "sightings", "tacs.*")
def a5(f):
    wide = device_sets(f)
    return columns.matching(wide.select(PHONE, *sets.set_ratio_columns(wide.columns)), without=("except",), keys=[PHONE])


@query("A6_novelty_ratio", f"WITH {SETS_SQL} SELECT phone_number, " + ", ".join(RATIO.format(part=f"(len(c{n}) - len(list_intersect(c{n}, h{n})))", n=n) + f" AS tacs_except_ratio_l{n}w" for n in (12, 24)) + " FROM sets", "sightings", "tacs.*")
def a6(f):
    wide = device_sets(f)
    return columns.matching(wide.select(PHONE, *sets.set_ratio_columns(wide.columns)), without=("intersection",), keys=[PHONE])


PAIRS = "pairs AS (SELECT phone_number, tac, " + ", ".join(f"count(*) FILTER ({since(n)}) AS x_l{n}w" for n in W) + f" FROM sightings WHERE {since(48)} GROUP BY 1, 2)"


def pairs(f):
    return windowed_aggregate(f.sightings(), [PHONE, "tac"], [Measure("count", "*", "x")], last(*W), ORDERS_SNAPSHOT)


@query("A7_entropy", f"WITH {PAIRS}, p AS (SELECT phone_number, " + ", ".join(f"x_l{n}w::DOUBLE / nullif(sum(x_l{n}w) OVER (PARTITION BY phone_number), 0) AS p{n}" for n in W) + " FROM pairs) SELECT phone_number, "
       + ", ".join(f"round(-sum(CASE WHEN p{n} > 0 THEN p{n} * log2(p{n}) ELSE 0 END), 6) AS x_entropy_l{n}w" for n in W) + " FROM p GROUP BY 1", "sightings", "x_.*")
def a7(f):
    wide = pairs(f)
    return wide.groupBy(PHONE).agg(*sets.statistic_columns(windows.plain_columns(wide, [PHONE, "tac"]), {"entropy": []}))


@query("A8_distribution", f"WITH {PAIRS} SELECT phone_number, " + ", ".join(
    f"max(x_l{n}w) AS x_max_l{n}w, avg(x_l{n}w) AS x_avg_l{n}w, stddev_samp(x_l{n}w) AS x_std_l{n}w, {shape_sql(f'x_l{n}w', 'skewness')} AS x_skewness_l{n}w, {shape_sql(f'x_l{n}w', 'kurtosis')} AS x_kurtosis_l{n}w" for n in W) + " FROM pairs GROUP BY 1",
    "sightings", "x_(avg|std|skewness|kurtosis).*")
def a8(f):
    wide = pairs(f)
    statistics = {"min": ["x_"], "max": [], "avg": [], "std": [], "skewness": [], "kurtosis": []}
    return wide.groupBy(PHONE).agg(*sets.statistic_columns(windows.plain_columns(wide, [PHONE, "tac"]), statistics))


@query("A9_shared_counts", "SELECT tac, " + ", ".join(f"count(DISTINCT phone_number) FILTER ({since(n)}) AS device_tac_distinct_pn_count_l{n}w" for n in devices.WINDOW_WEEKS) + f" FROM ({history_sql('imei_weekly', '>')}) GROUP BY 1", "imei_weekly activation")
def a9(f):
    history = devices.activated_history(f.imei_weekly(), f.activation(), ORDERS_SNAPSHOT)
    return devices.shared_counts(devices.pair_activity(history, devices.TAC, ORDERS_SNAPSHOT), devices.TAC).drop("__pairs")


@query("A10_fan_out", "SELECT phone_number, " + ", ".join(f"count(DISTINCT imei) FILTER ({since(n)}) AS imeis_l{n}w" for n in devices.WINDOW_WEEKS) + f" FROM imei_weekly WHERE {since(96)} GROUP BY 1", "imei_weekly")
def a10(f):
    return windowed_aggregate(f.imei_weekly(), [PHONE], [Measure("count_distinct", "imei", "imeis")], last(*devices.WINDOW_WEEKS), ORDERS_SNAPSHOT)


@query("A11_pair_activity", "SELECT phone_number, naid, " + ", ".join(f"count(DISTINCT date) FILTER ({since(n)}) AS nid_distinct_weeks_count_l{n}w" for n in devices.WINDOW_WEEKS) + f" FROM naid_monthly WHERE {since(104)} GROUP BY 1, 2", "naid_monthly")
def a11(f):
    rows = scans.after_until(f.naid_monthly(), ORDERS_SNAPSHOT - dt.timedelta(weeks=104), ORDERS_SNAPSHOT)
    wide = devices.pair_activity(rows, devices.NATIONAL_ID, ORDERS_SNAPSHOT)
    return wide.select(PHONE, "naid", *[c for c in wide.columns if c.startswith("nid_")])


@query("A12_zero_filled_mean_std", GRID, "data_charge", "mean|std", digits=4)
def a12(f):
    return zero_filled(f)


@query("A13_roll_forward", "WITH w AS (SELECT phone_number, date, sum(device_num_day_l1w) AS d, max(device_num_day_l1w) AS m, min(device_num_day_l1w) AS l, avg(device_num_day_l1w) AS a FROM imei_weekly GROUP BY 1, 2) "
       f"SELECT phone_number, sum(d) AS days_l12w, max(m) AS top_l12w, min(l) AS low_l12w, avg(a) AS mean_l12w FROM w WHERE {since(12)} GROUP BY 1", "imei_weekly", "mean.*")
def a13(f):
    days = F.col("device_num_day_l1w")
    weekly = f.imei_weekly().groupBy(PHONE, "date").agg(F.sum(days).alias("days_l1w"), F.max(days).alias("top_l1w"), F.min(days).alias("low_l1w"), F.avg(days).alias("mean_l1w"))
    return agg.roll_forward(scans.last_weeks(weekly, ORDERS_SNAPSHOT, 12), [PHONE], {"days": "sum", "top": "max", "low": "min", "mean": "avg"}, "l1w", "l12w")


@query("A14_statistics_by_name", "SELECT phone_number, " + ", ".join(f"{e}({c}) AS {c}_{n}" for c in COSTS for e, n in (("avg", "avg"), ("stddev_samp", "std"), ("sum", "sum"), ("min", "min"))) + " FROM usage_pre GROUP BY 1", "usage_pre", ".*_(avg|std|sum|min)", digits=3)
def a14(f):
    functions = {"avg": F.avg, "std": F.stddev, "sum": F.sum, "min": F.min}
    return f.usage_pre().groupBy(PHONE).agg(*[fn(c).alias(f"{c}_{n}") for c in COSTS for n, fn in functions.items()])


@query("A15_conditional", "SELECT phone_number, sum(amount) FILTER (amount > 0) AS cash_out, count(*) FILTER (amount < 0) AS n_in, avg(amount) FILTER (amount < 0) AS mean_in FROM balance_txn GROUP BY 1", "balance_txn", "cash_out|mean_in", digits=3)
def a15(f):
    amount = F.col("amount")
    return f.balance_txn().groupBy(PHONE).agg(agg.sum_where(amount > 0, amount).alias("cash_out"), agg.count_where(amount < 0).alias("n_in"), F.avg(F.when(amount < 0, amount)).alias("mean_in"))


@query("A16_conditional_distinct", "SELECT phone_number, count(DISTINCT service_name) FILTER (transaction_type = 'REG') AS reg, count(DISTINCT date) FILTER (charge_amount > 50000) AS days FROM vas_b GROUP BY 1", "vas_b")
def a16(f):
    return aggregated(f.vas_b(), [PHONE], [Part("reg", "count_distinct", F.col("service_name"), F.col("transaction_type") == "REG"),
                                           Part("days", "count_distinct", F.col("date"), F.col("charge_amount") > 50000)])


@query("A17_two_level", "SELECT phone_number, avg(b) AS mean, max(b) AS top, count(*) AS days FROM (SELECT phone_number, date, sum(balance) AS b FROM balance_b GROUP BY 1, 2) GROUP BY 1", "balance_b", "mean|top", digits=3)
def a17(f):
    daily = agg.pre_aggregate(f.balance_b(), [PHONE], ["date"], [F.sum("balance").alias("b")])
    return daily.groupBy(PHONE).agg(F.avg("b").alias("mean"), F.max("b").alias("top"), F.count(F.lit(1)).alias("days"))


@query("A18_bucket_shares", "SELECT phone_number, avg(CASE WHEN recharge_amount < 20000 THEN 1 ELSE 0 END) * 100 AS pct_low, avg(CASE WHEN recharge_amount >= 20000 AND recharge_amount <= 90000 THEN 1 ELSE 0 END) * 100 AS pct_mid, "
       "count(*) FILTER (recharge_amount > 90000) AS n_high FROM recharge GROUP BY 1", "recharge", "pct.*")
def a18(f):
    amount = F.col("recharge_amount")
    shares = agg.bucket_shares(amount, [Bucket("low", high=20_000), Bucket("mid", 20_000, 90_000, True, True)], "pct_{}", 100.0)
    return f.recharge().groupBy(PHONE).agg(*shares, *agg.bucket_counts(amount, [Bucket("high", 90_000, None, False)], "n_{}"))


@query("A19_pivot_known_values", "SELECT phone_number, " + ", ".join(f"sum(up_data) FILTER (hour(start_time) = {h}) AS up_{h}" for h in (4, 6, 7, 22)) + " FROM data_charge GROUP BY 1", "data_charge", "up.*", digits=4)
def a19(f):
    return f.data_charge().withColumn("hour", F.hour("start_time")).groupBy(PHONE).agg(*agg.pivot_sums("hour", [4, 6, 7, 22], {"up_data": "up_{}"}))


@query("A20_two_levels", "SELECT * FROM (SELECT cell_id, ref_province_name, count(DISTINCT date) AS days_cell_prov FROM seed_daily GROUP BY 1, 2) JOIN (SELECT cell_id, count(DISTINCT date) AS days_cell FROM seed_daily GROUP BY 1) USING (cell_id)", "seed_daily", texts="ref_province_name")
def a20(f):
    return nested_levels(f.seed_daily(), "cell_id", "ref_province_name", {}, {"date": ("days_cell_prov", "days_cell")})


@query("A21_stored_levels", "WITH m AS (SELECT strftime(date, '%Y-%m') AS month, * FROM seed_daily) SELECT * FROM (SELECT cell_id, ref_province_name, sum(d) AS a FROM (SELECT month, cell_id, ref_province_name, count(DISTINCT date) AS d FROM m GROUP BY 1, 2, 3) GROUP BY 1, 2) "
       "JOIN (SELECT cell_id, sum(d) AS b FROM (SELECT month, cell_id, count(DISTINCT date) AS d FROM m GROUP BY 1, 2) GROUP BY 1) USING (cell_id)", "seed_daily", texts="ref_province_name")
def a21(f):
    stored = provinces.monthly_days(f.seed_daily().withColumn("month", F.date_format("date", "yyyy-MM")))
    return agg.two_levels_of_stored(stored, "cell_id", "ref_province_name", "count_date", ("a", "b"))


@query("A22_first_known", "SELECT phone_number, min(partner_bank_code) AS first_code FROM wallet_daily GROUP BY 1", "wallet_daily", texts="first_code")
def a22(f):
    return f.wallet_daily().groupBy(PHONE).agg(F.min("partner_bank_code").alias("first_code"))


@query("A23_distinct_rows", "SELECT phone_number, count(*) AS n FROM (SELECT DISTINCT phone_number, service_name, price FROM vas_service) GROUP BY 1", "vas_service")
def a23(f):
    return f.vas_service().dropDuplicates([PHONE, "service_name", "price"]).groupBy(PHONE).agg(F.count(F.lit(1)).alias("n"))


@query("A24_quantile", "SELECT o_custkey, quantile_disc(o_totalprice, 0.05) AS low FROM orders GROUP BY 1", doubles="low", digits=2)
def a24(f):
    return f.orders.groupBy("o_custkey").agg(F.percentile_approx("o_totalprice", 0.05, 10_000).alias("low"))


@query("A25_busy_days", "SELECT date FROM recharge GROUP BY 1 HAVING count(*) >= 8", "recharge", texts="date", whole=False)
def a25(f):
    return agg.busy_days(f.recharge(), 8)


@query("A26_weighted_sum", "SELECT phone_number, sum(price * mean_age_group) AS weighted FROM vas_service JOIN service_map USING (service_name) GROUP BY 1", "vas_service service_map", "weighted", digits=2)
def a26(f):
    return agg.weighted_sum(f.vas_service(), f.service_map(), "service_name", [PHONE], "price", "mean_age_group", "weighted")


@query("A27_date_bounds", "SELECT min(date) AS min_date, max(date) AS max_date FROM recharge", "recharge", texts=".*_date", whole=False)
def a27(f):
    return agg.date_bounds(f.recharge())


@query("A28_latest_value", f"SELECT phone_number, max(last_activated_date) AS last_activated_date FROM activation WHERE date > {SNAP} - 14 AND date <= {SNAP} GROUP BY 1", "activation", texts="last_activated_date")
def a28(f):
    return devices.activation_dates(f.activation(), ORDERS_SNAPSHOT)


# windows

@query("W1_newest_row", "SELECT * FROM cell_map QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY date DESC) = 1", "cell_map", texts="district_name|province_name|date")
def w1(f):
    return sequences.newest_row(f.cell_map(), ["cell_id"], "date")


RANKED = "SELECT phone_number, tac, n, seen, row_number() OVER (PARTITION BY phone_number ORDER BY n DESC, seen DESC, tac) AS rank FROM (SELECT phone_number, tac, count(*) AS n, max(date) AS seen FROM sightings GROUP BY 1, 2)"


@query("W2_ranked_devices", f"SELECT * FROM ({RANKED}) WHERE rank <= 3", "sightings", texts="seen")
def w2(f):
    per_tac = f.sightings().groupBy(PHONE, "tac").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("seen"))
    return sequences.top_per_group(per_tac, [PHONE], [F.col("n").desc(), F.col("seen").desc(), F.col("tac")], 3)


@query("W3_dominant_value", "WITH t AS (SELECT phone_number, cell_id // 20 AS area, sum(count) AS total FROM cell_daily GROUP BY 1, 2), r AS (SELECT *, dense_rank() OVER (PARTITION BY phone_number ORDER BY total DESC) AS r FROM t), "
       "k AS (SELECT *, max(total) FILTER (r = 2) OVER (PARTITION BY phone_number) AS t2, count(*) FILTER (r = 1) OVER (PARTITION BY phone_number) AS n1 FROM r) SELECT phone_number, area, total FROM k WHERE r = 1 AND n1 = 1 AND (t2 IS NULL OR total >= t2 * 1.25)", "cell_daily")
def w3(f):
    totals = f.cell_daily().groupBy(PHONE, F.expr("cell_id DIV 20").alias("area")).agg(F.sum("count").alias("total"))
    return sequences.dominant_value(totals, PHONE, "area", "total", 1.25)


@query("W4_previous_value", "SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS change FROM series", "series", "change", "ticker|date", whole=False)
def w4(f):
    return f.series().select("ticker", "date", sequences.change_rate("close", ["ticker"], "date").alias("change"))


MARKED = ("marked AS (SELECT phone_number, date, device_current_tac_l2w AS device, coalesce((device_current_tac_l2w <> lag(device_current_tac_l2w) OVER w)::INT, 0) AS is_switch FROM device_current WINDOW w AS (PARTITION BY phone_number ORDER BY date)), "
          "grouped AS (SELECT *, sum(is_switch) OVER (PARTITION BY phone_number ORDER BY date) AS switch_group FROM marked)")


def marked(f):
    rows = f.device_current().select(PHONE, "date", F.col("device_current_tac_l2w").alias("device"))
    return sequences.switches(rows, PHONE, "device", "date")


@query("W5_switches", f"WITH {MARKED} SELECT * FROM grouped", "device_current", texts="date")
def w5(f):
    return marked(f).drop("previous_value")


@query("W6_streaks", f"WITH {MARKED} SELECT phone_number, switch_group, count(*) AS streak_length FROM grouped GROUP BY 1, 2", "device_current")
def w6(f):
    return sequences.streaks(marked(f), PHONE)


@query("W7_previous_marked_date", f"WITH {MARKED} SELECT phone_number, date, max(CASE WHEN is_switch = 1 THEN date END) OVER (PARTITION BY phone_number ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM grouped", "device_current", texts="date|previous")
def w7(f):
    return marked(f).select(PHONE, "date", sequences.previous_marked_date(PHONE, "date", F.col("is_switch") == 1).alias("previous"))


@query("W8_switch_gap", f"WITH {MARKED}, s AS (SELECT phone_number, date FROM grouped WHERE is_switch = 1) SELECT phone_number, date, (date - lag(date) OVER (PARTITION BY phone_number ORDER BY date)) / 7.0 AS gap FROM s", "device_current", "gap", "date")
def w8(f):
    rows = devices.device_sequence(f.device_current(), "device_current_tac_l2w").filter("is_switch = 1")
    return rows.select(PHONE, "date", (F.datediff("date", "previous_switch") / 7.0).alias("gap"))


@query("W9_value_at_latest", "SELECT phone_number, date, first_value(device_current_tac_l2w) OVER (PARTITION BY phone_number ORDER BY date DESC) AS current_device FROM device_current", "device_current", texts="date")
def w9(f):
    return devices.device_sequence(f.device_current(), "device_current_tac_l2w").select(PHONE, "date", "current_device")


@query("W10_recent_rows", "SELECT phone_number, date, count(*) AS n FROM (SELECT * FROM sightings QUALIFY max(date) OVER (PARTITION BY phone_number) - date < 14) GROUP BY 1, 2", "sightings", texts="date")
def w10(f):
    return sequences.recent_rows(f.sightings(), [PHONE], "date", 14).groupBy(PHONE, "date").agg(F.count(F.lit(1)).alias("n"))


@query("W11_drawdown", "SELECT ticker, date, close / max(close) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS drawdown FROM series", "series", "drawdown", "ticker|date", whole=False)
def w11(f):
    peak = F.max("close").over(Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return f.series().select("ticker", "date", (F.col("close") / peak - 1).alias("drawdown"))


@query("W12_first_and_last_known", "SELECT phone_number, mother_system, min_by(company_id, date) FILTER (company_id IS NOT NULL) AS first_company, max_by(company_id, date) FILTER (company_id IS NOT NULL) AS last_company FROM wallet_daily GROUP BY 1, 2", "wallet_daily", texts="mother_system")
def w12(f):
    known = F.when(F.col("company_id").isNotNull(), F.col("date"))
    return f.wallet_daily().groupBy(PHONE, "mother_system").agg(F.min_by("company_id", known).alias("first_company"), F.max_by("company_id", known).alias("last_company"))


@query("W13_forward_fill", "WITH spine AS (SELECT indicator, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM indicator GROUP BY 1) "
       "SELECT s.indicator, s.date, i.percentage FROM spine s ASOF JOIN indicator i ON i.indicator = s.indicator AND i.date <= s.date", "indicator", "percentage", "indicator|date", whole=False)
def w13(f):
    dense = scans.calendar(f.indicator(), keys=["indicator"]).join(f.indicator(), ["indicator", "date"], "left")
    return sequences.forward_fill(dense, ["indicator"], "date", ["percentage"])


@query("W14_growth", "SELECT indicator, date, " + ", ".join(f"percentage / lag(percentage, {k}) OVER (PARTITION BY indicator ORDER BY date) - 1 AS g{k}" for k in (1, 4, 12)) + " FROM indicator", "indicator", "g.*", "indicator|date", whole=False)
def w14(f):
    return f.indicator().select("indicator", "date", *[sequences.growth("percentage", ["indicator"], "date", k).alias(f"g{k}") for k in (1, 4, 12)])


@query("W15_share_of_total", "SELECT o_orderkey, o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey) AS share FROM orders", doubles="share")
def w15(f):
    return sets.share_of_total(f.orders, "o_totalprice", ["o_custkey"], "share").select("o_orderkey", "share")


@query("W11_running_totals", "SELECT o_orderkey, coalesce(count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM orders")
def running(f):
    rows = f.orders.select("o_orderstatus", "o_orderkey", F.lit(1).alias("one"))
    return sequences.running_totals(rows, ["o_orderstatus"], "o_orderkey", {"one": "before"}).select("o_orderkey", "before")


# sorts and limits

@query("O1_sorted_for_write", "SELECT o_orderkey, o_totalprice FROM orders", doubles="o_totalprice")
def o1(f):
    return ordering.sorted_for_write(f.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 4)


@query("O2_multi_key_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def o2(f):
    best = ordering.top_n(f.orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50)
    return best.select("o_orderkey", F.row_number().over(Window.orderBy(F.col("o_totalprice").desc(), "o_orderkey")).alias("place"))


@query("O3_top_n", "SELECT phone_number, sum(recharge_amount) AS total FROM recharge GROUP BY 1 ORDER BY total DESC, phone_number LIMIT 25", "recharge", "total", digits=2)
def o3(f):
    totals = f.recharge().groupBy(PHONE).agg(F.sum("recharge_amount").alias("total"))
    return ordering.top_n(totals, [F.col("total").desc(), F.col(PHONE)], 25)


@query("O4_top_k_per_group", f"SELECT * FROM ({RANKED}) WHERE rank <= 2", "sightings", texts="seen")
def o4(f):
    return w2(f).filter("rank <= 2")


@query("O5_emptiness_probe", "SELECT count(*) AS n FROM recharge", "recharge")
def o5(f):
    return quality.require_rows(f.recharge()).agg(F.count(F.lit(1)).alias("n"))


PRIORITIES = ["5-LOW", "3-MEDIUM", "1-URGENT"]


@query("O6_ordered_category", "SELECT o_orderkey, coalesce(list_position(['5-LOW', '3-MEDIUM', '1-URGENT'], o_orderpriority), 0) AS place FROM orders")
def o6(f):
    return f.orders.select("o_orderkey", ordering.rank_of("o_orderpriority", PRIORITIES).alias("place")).orderBy("place", "o_orderkey")


# set operations

@query("U1_union_by_name", "SELECT date, count(*) AS n FROM (SELECT phone_number, date FROM recharge UNION ALL SELECT phone_number, date FROM balance_txn) GROUP BY 1", "recharge balance_txn", texts="date")
def u1(f):
    return f.recharge().select(PHONE, "date").unionByName(f.balance_txn().select("date", PHONE)).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("U2_days_in_one_scan", "SELECT date, count(*) AS n FROM usage_pre WHERE date IN (DATE '2001-07-01', DATE '2001-06-01', DATE '2001-05-01', DATE '2001-04-01') GROUP BY 1", "usage_pre", texts="date")
def u2(f):
    return scans.first_of_months(f.usage_pre(), ORDERS_SNAPSHOT, 4).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("U3_union_with_new_key", "SELECT phone_number, sum(amount) AS amount FROM (SELECT phone_number, amount FROM airtime WHERE service_name <> '2FRIEND' UNION ALL SELECT receive_phone_number, amount FROM airtime WHERE service_name = '2FRIEND') GROUP BY 1", "airtime", "amount")
def u3(f):
    rows = f.airtime()
    taken = rows.filter("service_name = '2FRIEND'").select(F.col("receive_phone_number").alias(PHONE), "amount")
    return rows.filter("service_name <> '2FRIEND'").select(PHONE, "amount").unionByName(taken).groupBy(PHONE).agg(F.sum("amount").alias("amount"))


@query("U4_distinct_after_union", "SELECT date, count(*) AS n FROM (SELECT phone_number, date FROM sightings WHERE channel = 0 UNION SELECT phone_number, date FROM sightings WHERE channel = 1) GROUP BY 1", "sightings", texts="date")
def u4(f):
    rows = f.sightings()
    return rows.filter("channel = 0").select(PHONE, "date").union(rows.filter("channel = 1").select(PHONE, "date")).distinct().groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("U5_array_sets", f"WITH {SETS_SQL} SELECT phone_number, len(list_intersect(c12, h12)) AS both, len(list_distinct(list_concat(c12, h12))) AS either, len(c12) - len(list_intersect(c12, h12)) AS only_current FROM sets", "sightings")
def u5(f):
    a, b = "tacs_l12w", "tacs_l24w_to_l12w"
    return device_sets(f).select(PHONE, F.size(F.array_intersect(a, b)).alias("both"), F.size(F.array_union(a, b)).alias("either"), F.size(F.array_except(a, b)).alias("only_current"))


# quality

@query("Q1_days_complete", f"SELECT count(DISTINCT date) AS days FROM data_charge WHERE date > {ESNAP} - 7 AND date <= {ESNAP}", "data_charge")
def q1(f):
    week = quality.require_days(scans.last_weeks(f.data_charge(), EVENTS_SNAPSHOT, 1), 7)
    return quality.distinct_days(week)


@query("Q2_days_with_tolerance", f"SELECT count(DISTINCT date) AS days FROM data_charge WHERE date > {ESNAP} - 28 AND date <= {ESNAP}", "data_charge")
def q2(f):
    month = scans.last_weeks(f.data_charge(), EVENTS_SNAPSHOT, 4)
    return quality.distinct_days(quality.require_days(month, 29, tolerance=1))


@query("Q3_try_later", f"SELECT count(*) AS n FROM cell_daily WHERE date BETWEEN {ESNAP} - 2 AND {ESNAP}", "cell_daily")
def q3(f):
    three = scans.between(f.cell_daily(), EVENTS_SNAPSHOT - dt.timedelta(days=2), EVENTS_SNAPSHOT)
    return quality.require_days(three, 3, retry=True).agg(F.count(F.lit(1)).alias("n"))


@query("Q4_unique_keys", "SELECT phone_number, disburse_date, count(*) AS rows FROM label GROUP BY 1, 2 HAVING count(*) > 1", "label", texts="disburse_date")
def q4(f):
    return quality.duplicate_keys(f.label(), [PHONE, "disburse_date"])


@query("Q5_rows_present", "SELECT count(*) AS n FROM series", "series")
def q5(f):
    return quality.require_rows(f.series()).agg(F.count(F.lit(1)).alias("n"))


@query("Q6_sunday_snapshot", f"SELECT count(*) AS n FROM imei_weekly WHERE date = {SNAP}", "imei_weekly")
def q6(f):
    return scans.on_day(f.imei_weekly(), require_sunday(ORDERS_SNAPSHOT)).agg(F.count(F.lit(1)).alias("n"))


@query("Q7_new_year_run", "SELECT count(*) AS n FROM seed_daily WHERE date >= DATE '2000-01-01' AND date < DATE '2001-01-01'", "seed_daily")
def q7(f):
    run = require_new_year("2001-01-01")
    return f.seed_daily().filter((F.col("date") >= F.lit(add_months(run, -12))) & (F.col("date") < F.lit(run))).agg(F.count(F.lit(1)).alias("n"))


TYPED = "typed AS (SELECT o_orderkey::VARCHAR AS key, o_totalprice::VARCHAR AS price, CASE WHEN o_orderkey % 50 = 0 THEN 'x' ELSE o_custkey::VARCHAR END AS customer, o_orderpriority AS priority FROM orders)"
PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS filled, count(TRY_CAST({c} AS DOUBLE)) AS numeric_n, count(*) FILTER (TRY_CAST({c} AS DOUBLE) = floor(TRY_CAST({c} AS DOUBLE))) AS whole_n FROM typed" for c in ("key", "price", "customer", "priority"))


@query("Q8_wrong_types", f"WITH {TYPED} SELECT \"column\", round(numeric_n / filled, 4) AS convert_ratio, round(whole_n / numeric_n, 4) AS int_like_ratio, CASE WHEN whole_n / numeric_n >= 0.98 THEN 'int' ELSE 'float' END AS suggest_type FROM ({PROFILE}) WHERE numeric_n / filled >= 0.95",
       doubles=".*ratio", texts="column|suggest_type", whole=False)
def q8(f):
    typed = f.orders.selectExpr("CAST(o_orderkey AS STRING) AS key", "CAST(o_totalprice AS STRING) AS price", "CASE WHEN o_orderkey % 50 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS customer", "o_orderpriority AS priority")
    return quality.wrong_types(typed)


@query("Q10_row_report", "SELECT count(*) AS rows, count(DISTINCT phone_number) AS phones, count(DISTINCT (phone_number, disburse_date)) AS phone_dates FROM label", "label")
def q10(f):
    return quality.row_report(f.label(), {"phones": [PHONE], "phone_dates": [PHONE, "disburse_date"]})


@query("UD1_sunday_without_udf", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - (isodow(o_orderdate) + CASE WHEN isodow(o_orderdate) <= 3 THEN 7 ELSE 0 END)::INT AS sunday FROM orders", texts="sunday")
def ud1(f):
    return f.orders.select("o_orderkey", eligible_sunday(F.to_date("o_orderdate")).alias("sunday"))


@query("FS6_slug_columns", "SELECT o_custkey, " + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS n_{slug(p)}" for p in PRIORITIES) + " FROM orders GROUP BY 1")
def slug_columns(f):
    return f.orders.groupBy("o_custkey").agg(*[F.sum(flag(F.col("o_orderpriority") == p)).alias(f"n_{slug(p)}") for p in PRIORITIES])


@query("J11_growth_of_sundays", "SELECT indicator, count(*) AS n FROM (SELECT indicator, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS snap FROM indicator GROUP BY 1) WHERE isodow(snap) = 7 GROUP BY 1", "indicator", texts="indicator")
def sundays_per_indicator(f):
    return markets.indicator_features(f.indicator()).groupBy("indicator").agg(F.count(F.lit(1)).alias("n"))
