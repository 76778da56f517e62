"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sundial.checks.fixtures import ORDERS_SNAPSHOT
from sundial.checks.payment_a_queries import FAMILY
from sundial.checks.registry import query
from sundial.functions import dates, numbers, texts
from sundial.plans import device_names as dn

SNAP = f"DATE '{ORDERS_SNAPSHOT}'"


@query("FS1_case_and_trim", "SELECT o_orderkey, lower(o_orderpriority) AS low, upper(trim(concat('  ', o_orderstatus, ' '))) AS up FROM orders", texts="low|up")
def fs1(f):
    return f.orders.select("o_orderkey", F.lower("o_orderpriority").alias("low"), F.upper(F.trim(F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")))).alias("up"))


CODES = "list_distinct(list_filter(list_transform(string_split(coalesce(money_sources, ''), ','), lambda x: upper(trim(string_split(x, '#')[1]))), lambda x: x <> ''))"


@query("FS2_code_list", f"SELECT phone_number, mother_system, date, array_to_string(list_sort({CODES}), '|') AS codes FROM wallet_daily", "wallet_daily", texts="mother_system|date|codes")
def fs2(f):
    return f.wallet_daily().select("phone_number", "mother_system", "date", F.array_join(F.array_sort(texts.code_list(F.col("money_sources"))), "|").alias("codes"))


@query("FS3_explode_size", f"SELECT code, count(*) AS n, sum(k) AS total FROM (SELECT unnest({CODES}) AS code, len({CODES}) AS k FROM wallet_daily) GROUP BY 1", "wallet_daily", texts="code")
def fs3(f):
    rows = f.wallet_daily().select(texts.code_list(F.col("money_sources")).alias("codes"))
    return rows.select(F.explode("codes").alias("code"), F.size("codes").alias("k")).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query("FS4_package_family", f"SELECT family, count(*) AS n FROM (SELECT {FAMILY} AS family FROM (SELECT package_name AS n FROM vas_package)) GROUP BY 1", "vas_package", texts="family")
def fs4(f):
    return f.vas_package().groupBy(texts.package_family(F.col("package_name")).alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query("FS5_starts_and_contains", "SELECT account_code, count(*) AS n FROM balance_b WHERE starts_with(account_code, '3') OR contains(account_code, '42') GROUP BY 1", "balance_b", texts="account_code")
def fs5(f):
    code = F.col("account_code")
    return f.balance_b().filter(code.startswith("3") | code.contains("42")).groupBy("account_code").agg(F.count(F.lit(1)).alias("n"))


@query("FS7_regex_with_groups", "SELECT p_partkey, regexp_replace(p_name, '(\\w+) (\\w+)', '\\2-\\1', 'g') AS swapped, regexp_replace(p_brand, 'Brand#(\\d+)', 'brand \\1', 'g') AS brand FROM part", texts="swapped|brand")
def fs7(f):
    return f.part.select("p_partkey", F.regexp_replace("p_name", r"(\w+) (\w+)", "$2-$1").alias("swapped"), F.regexp_replace("p_brand", r"Brand#(\d+)", "brand $1").alias("brand"))


@query("FS8_dictionary", "SELECT device_brand, count(*) AS n FROM (SELECT CASE lower(device_brand) WHEN 'redmi' THEN 'xiaomi' WHEN 'poco' THEN 'xiaomi' WHEN 'mi' THEN 'xiaomi' WHEN 'shenzhen huafurui technology co ltd' THEN 'cubot' ELSE lower(device_brand) END AS device_brand FROM tac_raw) GROUP BY 1", "tac_raw", texts="device_brand")
def fs8(f):
    brand = F.lower("device_brand")
    known = F.try_element_at(dn._literal_map(dn.BRAND_ALIASES), brand)
    return f.tac_raw().groupBy(F.coalesce(known, brand).alias("device_brand")).agg(F.count(F.lit(1)).alias("n"))


@query("FS9_keywords", "SELECT p_partkey, regexp_matches(p_name, '(?i)\\b(?:ring|widget)\\b') AS hit FROM part")
def fs9(f):
    return f.part.select("p_partkey", F.col("p_name").rlike(r"(?i)\b(?:ring|widget)\b").alias("hit"))


@query("FD1_dates_and_text", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%Y-%m') AS m, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS s FROM orders", texts="d|m|s")
def fd1(f):
    return f.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"), dates.month_label(F.to_date("o_orderdate")).alias("m"), F.from_unixtime(F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))).alias("s"))


@query("FD2_days_between", f"SELECT o_orderkey, {SNAP} - CAST(o_orderdate AS DATE) AS age FROM orders")
def fd2(f):
    return f.orders.select("o_orderkey", dates.days_since(F.to_date("o_orderdate"), ORDERS_SNAPSHOT).alias("age"))


@query("FD3_interval_arithmetic", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 10 AS d, CAST(o_orderdate - INTERVAL 12 WEEK AS DATE) AS w, CAST(o_orderdate - INTERVAL 6 MONTH AS DATE) AS m, CAST(o_orderdate - INTERVAL 1 YEAR AS DATE) AS y FROM orders", texts="d|w|m|y")
def fd3(f):
    day = F.to_date("o_orderdate")
    return f.orders.select("o_orderkey", F.date_sub(day, 10).alias("d"), F.date_sub(day, 84).alias("w"), F.add_months(day, -6).alias("m"), F.add_months(day, -12).alias("y"))


@query("FD4_calendar_parts", "SELECT event_id, hour(ts) AS h, dayofweek(ts) + 1 AS dow, isodow(ts) - 1 AS wd, week(ts) AS w, isoyear(ts) AS iso, year(ts) AS y, month(ts) AS m FROM events")
def fd4(f):
    ts, day = F.col("ts"), F.to_date("ts")
    return f.events.select("event_id", F.hour(ts).alias("h"), F.dayofweek(ts).alias("dow"), F.weekday(ts).alias("wd"), F.weekofyear(ts).alias("w"), dates.iso_year(day).alias("iso"), F.year(ts).alias("y"), F.month(ts).alias("m"))


@query("FD5_eligible_sunday", "SELECT date, date - (isodow(date) + CASE WHEN isodow(date) <= 3 THEN 7 ELSE 0 END)::INT AS sunday, date - isodow(date)::INT AS before, date - (isodow(date) % 7)::INT AS on_or_before FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)",
       texts=".*", whole=False)
def fd5(f):
    day = F.col("date")
    return f.orders.select(F.to_date("o_orderdate").alias("date")).distinct().select(
        "date", dates.eligible_sunday(day).alias("sunday"), dates.last_sunday_before(day).alias("before"), dates.sunday_on_or_before(day).alias("on_or_before"))


@query("FD6_week_sunday", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + (7 - isodow(o_orderdate))::INT AS sunday FROM orders", texts="sunday")
def fd6(f):
    return f.orders.select("o_orderkey", dates.week_sunday(F.to_date("o_orderdate")).alias("sunday"))


@query("FD7_day_parts", "SELECT event_id, (hour(ts) >= 6 AND hour(ts) < 18)::INT AS daytime, (isodow(ts) > 5)::INT AS weekend FROM events")
def fd7(f):
    return f.events.select("event_id", dates.is_daytime(F.col("ts")).alias("daytime"), dates.is_weekend(F.col("ts")).alias("weekend"))


@query("FD8_months", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS next, "
       f"CAST(o_orderdate AS DATE) > DATE '2001-04-29' AND CAST(o_orderdate AS DATE) <= {SNAP} AS last_quarter FROM orders", texts="first|next")
def fd8(f):
    day = F.to_date("o_orderdate")
    start = dates.add_months(ORDERS_SNAPSHOT, -3)
    return f.orders.select("o_orderkey", F.trunc(day, "MM").alias("first"), F.add_months(F.trunc(day, "MM"), 1).alias("next"), ((day > F.lit(start)) & (day <= F.lit(ORDERS_SNAPSHOT))).alias("last_quarter"))


@query("FM1_arithmetic", "SELECT o_orderkey, abs(o_totalprice - 250000) AS a, greatest(o_totalprice, 100000) AS g, least(o_totalprice, 100000) AS l, sqrt(o_totalprice) AS s, log2(o_totalprice) AS b FROM orders", doubles="a|g|l|s|b")
def fm1(f):
    price = F.col("o_totalprice")
    return f.orders.select("o_orderkey", F.abs(price - 250000).alias("a"), F.greatest(price, F.lit(100000.0)).alias("g"), F.least(price, F.lit(100000.0)).alias("l"), F.sqrt(price).alias("s"), F.log2(price).alias("b"))


RATIOS = "SELECT o_orderkey, o_orderkey % 7 AS n, o_custkey % 5 AS d FROM orders"


def ratio(f, make):
    rows = f.orders.selectExpr("o_orderkey", "o_orderkey % 7 AS n", "o_custkey % 5 - 1 AS d")
    return rows.select("o_orderkey", make(F.col("n"), F.col("d")).alias("ratio"))


RATIO_ROWS = "(SELECT o_orderkey, o_orderkey % 7 AS n, o_custkey % 5 - 1 AS d FROM orders)"


@query("FM2_safe_ratio", f"SELECT o_orderkey, CASE WHEN d > 0 THEN round(n / d, 6) END AS ratio FROM {RATIO_ROWS}", doubles="ratio")
def fm2(f):
    return ratio(f, numbers.safe_ratio)


@query("FM3_ratio_or_zero", f"SELECT o_orderkey, CASE WHEN d <> 0 THEN n / d ELSE 0 END AS ratio FROM {RATIO_ROWS}", doubles="ratio")
def fm3(f):
    return ratio(f, numbers.ratio_or_zero)


@query("FM4_smoothed_ratio", f"SELECT o_orderkey, (n + 0.0001::DOUBLE) / (d + 2.0001::DOUBLE) AS ratio FROM {RATIO_ROWS}", doubles="ratio")
def fm4(f):
    return ratio(f, lambda n, d: numbers.smoothed_ratio(n, d, 0.0001, 2.0001))


@query("FM5_ratio_or_null", f"SELECT o_orderkey, n / nullif(d, 0) AS ratio FROM {RATIO_ROWS}", doubles="ratio")
def fm5(f):
    return ratio(f, numbers.ratio_or_null)


@query("FM6_sign_and_flags", "SELECT phone_number, date, CASE WHEN amount > 0 THEN 0 WHEN amount < 0 THEN 1 ELSE -1 END AS direction, (reason LIKE '%UNG%')::INT AS advance FROM balance_txn", "balance_txn", texts="date")
def fm6(f):
    amount = F.col("amount")
    direction = F.when(amount > 0, 0).when(amount < 0, 1).when(amount == 0, -1)
    return f.balance_txn().select("phone_number", "date", direction.alias("direction"), numbers.flag(F.col("reason").contains("UNG")).alias("advance"))


@query("FM7_scaled_sum", "SELECT phone_number, date, BAL_10 / 10000 + BAL_11 / 10000 + BAL_12 / 10000 AS total FROM balance_a", "balance_a", "total", "date")
def fm7(f):
    return f.balance_a().select("phone_number", "date", numbers.scaled_sum(["BAL_10", "BAL_11", "BAL_12"], 10_000.0).alias("total"))


@query("FM8_parsed_numbers", "SELECT o_orderkey, round(o_totalprice, 2) AS price, floor(o_totalprice / 1000) * 1000.0 AS volume, (o_orderkey % 97) / 10.0 AS percent FROM orders", doubles="price|volume|percent", digits=2)
def fm8(f):
    volume = F.when(F.col("o_totalprice") >= 1000, F.concat(F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit("K"))).otherwise("")
    return f.orders.select("o_orderkey", numbers.parse_number(F.format_number("o_totalprice", 2)).alias("price"), numbers.parse_volume(volume).alias("volume"),
                           numbers.parse_percent(F.concat(F.format_string("%.1f", (F.col("o_orderkey") % 97) / 10.0), F.lit("%"))).alias("percent"))


@query("FN1_null_handling", "SELECT phone_number, mother_system, date, coalesce(company_id, 0) AS c, nullif(pin_status, 0) AS s, (channel_type IS NULL)::INT AS missing FROM wallet_daily", "wallet_daily", texts="mother_system|date")
def fn1(f):
    return f.wallet_daily().select("phone_number", "mother_system", "date", F.coalesce("company_id", F.lit(0)).alias("c"), F.nullif("pin_status", F.lit(0)).alias("s"), F.col("channel_type").isNull().alias("missing"))


@query("FC1_constant_column", "SELECT n_nationkey, '2001-07' AS month, 1 AS one FROM nation", texts="month")
def fc1(f):
    return f.nation.select("n_nationkey", F.lit("2001-07").alias("month"), F.lit(1).alias("one"))
