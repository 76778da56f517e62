"""Operator A payment families."""

from __future__ import annotations

from sundial.checks.device_queries import ACTIVATED
from sundial.checks.fixtures import BALANCES, COSTS, EVENTS_SNAPSHOT, ORDERS_SNAPSHOT, PREPAID_ONLY
from sundial.checks.registry import query
from sundial.plans import balances, data_charge, devices, recharges, usage, value_added

SNAP = f"DATE '{ORDERS_SNAPSHOT}'"
ESNAP = f"DATE '{EVENTS_SNAPSHOT}'"
PROMO_ROWS = 8


def activated(f):
    return devices.activation_dates(f.activation(), ORDERS_SNAPSHOT)


def own_sql(table: str, test: str = ">=", date: str = "date") -> str:
    return f"(SELECT t.* FROM {table} t JOIN {ACTIVATED} a USING (phone_number) WHERE t.{date} {test} a.lad)"


BEFORE = {"prebal_lt_1k": "pre_balance < 1000", "prebal_lt_10k": "pre_balance < 10000",
          "prebal_10k_20k": "pre_balance >= 10000 AND pre_balance < 20000",
          "prebal_20k_50k": "pre_balance >= 20000 AND pre_balance < 50000", "prebal_gt_50k": "pre_balance >= 50000"}
AMOUNT = {"lt_10k": "recharge_amount < 10000", "amount_10k_20k": "recharge_amount >= 10000 AND recharge_amount <= 20000",
          "amount_20k_50k": "recharge_amount > 20000 AND recharge_amount <= 50000",
          "amount_50k_100k": "recharge_amount > 50000 AND recharge_amount <= 100000", "amount_gt_100k": "recharge_amount > 100000"}


def recharge_sql(source: str, months, compare, methods: bool, promo: str) -> str:
    """One aggregate per window, outer-joined and filled, as the definition reads."""
    frames, names = [], []
    for m in months:
        w = f"l{m}m"
        cols = {"recharge_amount_total": "sum(recharge_amount)", "recharge_count": "count(recharge_amount)",
                "recharge_amount_avg": "avg(recharge_amount)", "recharge_day_count": "count(DISTINCT r.date)"}
        for name, test in (BEFORE | AMOUNT).items():
            flag = f"CASE WHEN {test} THEN 1 ELSE 0 END"
            cols[f"recharge_{name}_pct"] = f"avg({flag}) * 100.0::DOUBLE"
            cols[f"recharge_{name}_count"] = f"sum({flag})"
        promoted = "p.date IS NOT NULL"
        cols["recharge_promote_amount_total"] = f"sum(CASE WHEN {promoted} THEN recharge_amount ELSE 0 END)"
        cols["recharge_promote_count"] = f"sum(CASE WHEN {promoted} THEN 1 ELSE 0 END)"
        cols["recharge_promote_amount_pct"] = f"sum(CASE WHEN {promoted} THEN recharge_amount ELSE 0 END) * 100.0 / sum(recharge_amount)"
        cols["recharge_promote_count_pct"] = f"sum(CASE WHEN {promoted} THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(recharge_amount)"
        if methods:
            for k, code in (("v", "V"), ("c", "C")):
                cols[f"recharge_amount_{k}_total"] = f"sum(CASE WHEN trade_method = '{code}' THEN recharge_amount ELSE 0 END)"
                cols[f"recharge_count_{k}"] = f"count(*) FILTER (trade_method = '{code}')"
            cols["recharge_count_v_pct"] = "count(*) FILTER (trade_method = 'V') * 100.0::DOUBLE / count(*)"
            cols["recharge_amount_v_pct"] = "sum(CASE WHEN trade_method = 'V' THEN recharge_amount ELSE 0 END) * 100.0 / sum(recharge_amount)"
            cols["recharge_method_count"] = "count(DISTINCT trade_method)"
        names += [f"{c}_{w}" for c in cols]
        inside = f"date > CAST({SNAP} - INTERVAL {m} MONTH AS DATE) AND date <= {SNAP}"
        days = promo.format(inside=inside)
        frames.append(f"(SELECT phone_number, {', '.join(f'{e} AS {c}_{w}' for c, e in cols.items())} FROM (SELECT * FROM src WHERE {inside}) r "
                      f"LEFT JOIN ({days}) p ON r.date = p.date GROUP BY 1)")
    joined = frames[0]
    for i, frame in enumerate(frames[1:]):
        joined = f"{joined} AS a{i} FULL JOIN {frame} AS b{i} USING (phone_number)" if i == 0 else f"{joined} FULL JOIN {frame} AS b{i} USING (phone_number)"
    filled = f"SELECT phone_number, {', '.join(f'coalesce({n}, 0) AS {n}' for n in names)} FROM {joined}"
    short, long = (f"l{m}m" for m in compare)
    ratios = ", ".join(f"({c}_{short} + 0.0001::DOUBLE) / ({c}_{long} + 0.0001::DOUBLE) AS {c}_{short}_vs_{long}" for c in recharges.COMPARED)
    return f"WITH src AS ({source}) SELECT *, {ratios} FROM ({filled})"


RECHARGE_DOUBLES = ".*(_total_|_avg_|_pct_|_vs_).*"
PROMO_A = f"SELECT date FROM src WHERE {{inside}} GROUP BY date HAVING count(*) >= {PROMO_ROWS}"


@query("FP22_recharge_features", recharge_sql(f"SELECT * FROM {own_sql('recharge')} WHERE recharge_amount > 0", (3, 6, 12), (3, 12), True, PROMO_A),
       "recharge activation", RECHARGE_DOUBLES, digits=4)
def recharge(f):
    own = devices.current_activation(f.recharge(), activated(f))
    return recharges.recharge_features(own, ORDERS_SNAPSHOT, promotion_rows=PROMO_ROWS)


DAY = {"lt_1k": "{b} > 0 AND {b} < 1000", "lt_5k": "{b} > 0 AND {b} < 5000", "lt_10k": "{b} > 0 AND {b} < 10000", "zero": "{b} = 0",
       "1k_to_5k": "{b} >= 1000 AND {b} < 5000", "5k_to_10k": "{b} >= 5000 AND {b} < 10000", "10k_to_20k": "{b} >= 10000 AND {b} < 20000",
       "20k_to_50k": "{b} >= 20000 AND {b} < 50000", "50k_to_100k": "{b} >= 50000 AND {b} < 100000", "ge_100k": "{b} >= 100000"}


def day_balance_sql(columns: list[str]) -> str:
    parts = []
    for b in columns:
        parts += [f"avg({b}) AS {b}_avg_per_day", f"max({b}) AS {b}_max_per_day", f"coalesce(stddev_samp({b}), 0) AS {b}_sd_per_day"]
        parts += [f"avg(CASE WHEN {test.format(b=b)} THEN 1 ELSE 0 END) AS {b}_pct_day_{name}" for name, test in DAY.items()]
    return ", ".join(parts)


def balance_sql(daily: str) -> str:
    promo = " + ".join(f"BAL_{n} / 10000.0" for n in BALANCES)
    return (f"WITH daily AS (SELECT phone_number, date, sum(balance) AS balance, sum(promo) AS balance_promo FROM (SELECT phone_number, date, BAL_1 / 10000.0 AS balance, {promo} AS promo "
            f"FROM balance_a WHERE date BETWEEN {SNAP} - 59 AND {SNAP}) WHERE balance >= 0 GROUP BY 1, 2) "
            f"SELECT phone_number, {day_balance_sql(['balance', 'balance_promo'])} FROM {daily} GROUP BY 1")


@query("FP21_balance_features", balance_sql("daily"), "balance_a", "balance.*")
def balance(f):
    return balances.balance_features(f.balance_a(), ORDERS_SNAPSHOT)


@query("FP21_balance_features_equal_days_once", balance_sql("(SELECT DISTINCT phone_number, balance, balance_promo FROM daily)"), "balance_a", "balance.*")
def balance_collapsed(f):
    return balances.balance_features(f.balance_a(), ORDERS_SNAPSHOT, collapse_equal_days=True)


# data charge, first generation

SUNDAY = "CAST(date + (7 - isodow(date))::INT AS DATE)"
HOURLY = ("daily AS (SELECT phone_number, date, CASE WHEN isodow(date) <= 5 THEN 'weekday' ELSE 'weekend' END AS is_weekend, hour(start_time) AS hour, "
          "sum(up_data) AS up_data, sum(down_data) AS down_data, count(DISTINCT start_time) AS num_time, "
          "count(DISTINCT start_time) FILTER (up_data IS NOT NULL) AS num_time_upload_per_hour, "
          "count(DISTINCT start_time) FILTER (down_data IS NOT NULL) AS num_time_download_per_hour FROM data_charge GROUP BY 1, 2, 3, 4)")
WEEKLY = (f"weekly AS (SELECT phone_number, {SUNDAY} AS week, is_weekend, hour, sum(up_data) AS data_charge_updata_hour_l1w, sum(down_data) AS data_charge_downdata_hour_l1w, "
          "count(DISTINCT date) AS data_charge_num_date_per_hour_l1w, sum(num_time) AS data_charge_num_per_hour_l1w, "
          "sum(num_time_upload_per_hour) AS data_charge_num_upload_per_hour_l1w, sum(num_time_download_per_hour) AS data_charge_num_download_per_hour_l1w FROM daily GROUP BY 1, 2, 3, 4)")


@query("FP17_hourly_daily", f"WITH {HOURLY} SELECT * FROM daily", "data_charge", "(up|down)_data", "date|is_weekend", digits=4)
def hourly_daily(f):
    return data_charge.hourly_per_day(f.data_charge())


@query("FP17_hourly_weekly", f"WITH {HOURLY}, {WEEKLY} SELECT week AS date, * EXCLUDE (week) FROM weekly", "data_charge", ".*(up|down)data.*", "date|is_weekend", digits=4)
def hourly_weekly(f):
    return data_charge.hourly_per_week(data_charge.hourly_per_day(f.data_charge()))


def hourly_sql(n: int, hours: list[int], counts: bool) -> str:
    w, parts = f"l{n}w", []
    for h in hours:
        parts += [f"sum(up) FILTER (hour = {h}) AS data_charge_updata_at_{h}_per_wk_{w}", f"sum(down) FILTER (hour = {h}) AS data_charge_downdata_at_{h}_{w}"]
        if counts:
            parts += [f"sum(dates) FILTER (hour = {h}) AS data_charge_num_date_at_{h}_{w}", f"sum(uploads) FILTER (hour = {h}) AS data_charge_num_upload_at_{h}_{w}"]
    return (f"WITH {HOURLY}, {WEEKLY}, means AS (SELECT phone_number, is_weekend, hour, avg(data_charge_updata_hour_l1w) AS up, avg(data_charge_downdata_hour_l1w) AS down, "
            "sum(data_charge_num_date_per_hour_l1w) AS dates, sum(data_charge_num_upload_per_hour_l1w) AS uploads FROM weekly "
            f"WHERE week BETWEEN {ESNAP} - {7 * (n - 1)} AND {ESNAP} GROUP BY 1, 2, 3) SELECT phone_number, {', '.join(parts)} FROM means GROUP BY 1")


@query("FP17_hourly_12_weeks", hourly_sql(12, data_charge.HOURS_12W, False), "data_charge", ".*(up|down)data.*", digits=4)
def hourly_12(f):
    weeks = data_charge.hourly_per_week(data_charge.hourly_per_day(f.data_charge()))
    return data_charge.hourly_features(weeks, EVENTS_SNAPSHOT, 12, data_charge.HOURS_12W, False)


@query("FP17_hourly_24_weeks", hourly_sql(24, data_charge.HOURS_24W, True), "data_charge", ".*(up|down)data.*", digits=4)
def hourly_24(f):
    weeks = data_charge.hourly_per_week(data_charge.hourly_per_day(f.data_charge()))
    return data_charge.hourly_features(weeks, EVENTS_SNAPSHOT, 24, data_charge.HOURS_24W, True)


# data charge, second generation

DAYTIME = "hour(start_time) >= 6 AND hour(start_time) < 18"
TOTALS = ("days AS (SELECT phone_number, date, sum(charge_amount) AS data_amt_charge_total, sum(up_data) AS data_upload_size, sum(down_data) AS data_download_size, "
          "avg(balance_remain) AS data_blanace_remain_avg, count(DISTINCT hour(start_time)) AS data_hour_distinct_num, count(*) AS data_txn_num, "
          "max(start_time) AS data_time_end, min(start_time) AS data_time_start, "
          f"sum(charge_amount) FILTER ({DAYTIME}) AS data_amt_charge_daytime_total, sum(up_data) FILTER ({DAYTIME}) AS data_upload_size_daytime_total, "
          f"sum(down_data) FILTER ({DAYTIME}) AS data_download_size_daytime_total, count(*) FILTER ({DAYTIME}) AS data_txn_daytime_num FROM data_charge GROUP BY 1, 2)")


@query("FP18_data_daily", f"WITH {TOTALS} SELECT * EXCLUDE (data_time_end, data_time_start), epoch(date_trunc('second', data_time_end)) - epoch(date_trunc('second', data_time_start)) AS seconds FROM days",
       "data_charge", ".*(amt|size|avg).*", "date", digits=4)
def data_daily(f):
    days = data_charge.daily_totals(f.data_charge())
    return days.selectExpr("*", "unix_timestamp(data_time_end) - unix_timestamp(data_time_start) AS seconds").drop("data_time_end", "data_time_start")


def weekly_sql() -> str:
    zero = ["data_amt_charge_total", "data_upload_size", "data_download_size", "data_blanace_remain_avg",
            "data_amt_charge_daytime_total", "data_upload_size_daytime_total", "data_download_size_daytime_total"]
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in zero)
    up, down, upd, downd = "data_upload_size", "data_download_size", "data_upload_size_daytime_total", "data_download_size_daytime_total"
    derived = (f"epoch(date_trunc('second', data_time_end)) - epoch(date_trunc('second', data_time_start)) AS usage_time_interval, "
               f"{up} / nullif({down}, 0) AS data_upload_vs_download_size, {upd} / nullif({up}, 0) AS data_upload_daytime_vs_wholeday_size, "
               f"{downd} / nullif({down}, 0) AS data_download_daytime_vs_wholeday_size, ({downd} + {upd}) / nullif({down} + {up}, 0) AS data_daytime_vs_wholeday_size")
    parts = []
    for name, function, column, weekend in data_charge.WEEK_COLUMNS:
        if function == "active":
            parts.append(f"count(*) FILTER ({column} >= 1) AS {name}_l1w")
        else:
            parts.append(f"{function}({column}){' FILTER (isodow(date) > 5)' if weekend else ''} AS {name}_l1w")
    return (f"{TOTALS}, filled AS (SELECT * REPLACE ({filled}) FROM days), ready AS (SELECT *, {derived} FROM filled), "
            f"weeks AS (SELECT phone_number, {SUNDAY} AS date, {', '.join(parts)} FROM ready GROUP BY phone_number, {SUNDAY})")


@query("FP18_data_weekly", f"WITH {weekly_sql()} SELECT * FROM weeks", "data_charge", "data_.*(amt|size|avg|blanace|wholeday).*", "date", digits=4)
def data_weekly(f):
    return data_charge.weekly_totals(data_charge.daily_totals(f.data_charge()))


def period_sql(n: int) -> str:
    inside = f"date > {ESNAP} - {7 * n} AND date <= {ESNAP}"
    filled = ", ".join(f"coalesce({c}_l1w, 0) AS {c}" for c, _, _ in data_charge.PERIOD_NAMES)
    parts = ", ".join(f"avg({c}) AS {mean}_l{n}w, stddev_samp({c}) AS {std}_l{n}w" for c, mean, std in data_charge.PERIOD_NAMES)
    return (f"WITH {weekly_sql()}, own AS (SELECT * FROM weeks WHERE {inside}), "
            f"grid AS (SELECT * FROM (SELECT DISTINCT phone_number FROM own) p, (SELECT {ESNAP} - (7 * i)::INT AS date FROM range({n}) r(i)) d), "
            f"dense AS (SELECT phone_number, {filled} FROM grid LEFT JOIN own USING (phone_number, date)) SELECT phone_number, {parts} FROM dense GROUP BY 1")


@query("FP18_data_4_weeks", period_sql(4), "data_charge", "(data|usage)_.*", digits=3)
def data_4(f):
    weeks = data_charge.weekly_totals(data_charge.daily_totals(f.data_charge()))
    return data_charge.period_features(weeks, EVENTS_SNAPSHOT, 4)


@query("FP18_data_8_weeks", period_sql(8), "data_charge", "(data|usage)_.*", digits=3)
def data_8(f):
    weeks = data_charge.weekly_totals(data_charge.daily_totals(f.data_charge()))
    return data_charge.period_features(weeks, EVENTS_SNAPSHOT, 8)


# usage

def usage_sql(months: int) -> str:
    dates = f"date IN (SELECT CAST(date_trunc('month', {SNAP}) AS DATE) - to_months(i::INT) FROM range({months}) r(i))"
    pos = ", ".join("-1 AS " + c if c in PREPAID_ONLY else c for c in COSTS)
    stats = ", ".join(f"{e}({c}) AS usage_{c}_{n}_l{months}m" for c in COSTS for e, n in (("min", "min"), ("stddev_samp", "std"), ("sum", "sum")))
    return (f"rows AS (SELECT phone_number, {', '.join(COSTS)} FROM (SELECT DISTINCT * FROM {own_sql('usage_pre')} WHERE {dates}) "
            f"UNION ALL SELECT phone_number, {pos} FROM (SELECT DISTINCT * FROM {own_sql('usage_pos')} WHERE {dates})), "
            f"stats AS (SELECT phone_number, {stats} FROM rows GROUP BY 1)")


@query("FP19_usage_statistics", f"WITH {usage_sql(3)} SELECT * FROM stats", "usage_pre usage_pos activation", "usage_.*", digits=3)
def usage_stats(f):
    rows = usage.monthly_usage(f.usage_pre(), f.usage_pos(), activated(f), ORDERS_SNAPSHOT, 3)
    return usage.usage_statistics(rows, 3)


SHARES = ", ".join(f"CASE WHEN usage_t_tot_cost_sum_l3m <> 0 THEN usage_{c}_sum_l3m / usage_t_tot_cost_sum_l3m ELSE 0.0 END AS usage_{n}_l3m" for n, c in usage.COST_SHARES)


@query("FP19_usage_cost_shares", f"WITH {usage_sql(3)} SELECT phone_number, {SHARES} FROM stats", "usage_pre usage_pos activation", "usage_.*")
def usage_shares(f):
    rows = usage.monthly_usage(f.usage_pre(), f.usage_pos(), activated(f), ORDERS_SNAPSHOT, 3)
    return usage.cost_shares(usage.usage_statistics(rows, 3), 3)


MONTHS6 = f"date IN (SELECT CAST(date_trunc('month', {SNAP}) AS DATE) - to_months(i::INT) FROM range(6) r(i))"


@query("FP20_mean_total_cost", f"SELECT phone_number, avg(c) AS avg_total_cost_l6m FROM (SELECT phone_number, t_tot_cost AS c FROM usage_pre WHERE {MONTHS6} UNION ALL "
       f"SELECT phone_number, t_org_cost + v_int_org_cost + v_ext_org_cost + v_intn_org_cost FROM usage_pos WHERE {MONTHS6}) GROUP BY 1", "usage_pre usage_pos", "avg.*", digits=3)
def mean_cost(f):
    return usage.mean_total_cost(f.usage_pre(), f.usage_pos(), ORDERS_SNAPSHOT)


# value-added services

FAMILY = """CASE WHEN n LIKE '%X' AND n <> 'MIMAX' THEN left(n, length(n) - 1) WHEN n LIKE '%\\_60' ESCAPE '\\' OR n LIKE '%_60' THEN replace(n, '_60', '')
 WHEN n LIKE '%_TS' THEN replace(n, '_TS', '') WHEN n LIKE '%VOICE%' THEN regexp_replace(n, '-VOICE|VOICE|_VOICE1', '', 'g')
 WHEN n LIKE '%DATA%' THEN regexp_replace(n, '-DATA|_DATA', '', 'g') WHEN n LIKE 'VTR%' THEN left(n, 3) WHEN n LIKE '%_NEW' THEN left(n, length(n) - 4)
 WHEN n LIKE '%_KDS' THEN 'GOI_CUOC_DOANH_NGH_TANG/BAN' WHEN n LIKE '%KID%' THEN 'GOI_KID_DINH_VI' WHEN n LIKE '%_4G%' THEN regexp_replace(n, '_4G|_4G_', '', 'g')
 WHEN n LIKE '%_4' THEN replace(n, '_4', '') WHEN n LIKE '%_1' THEN replace(n, '_1', '') WHEN n LIKE '%U' AND n <> 'CAMAU_BACLIEU' THEN left(n, length(n) - 1) ELSE n END"""
PACKAGES = (f"weekly AS (SELECT phone_number, package_name_update, {SUNDAY} AS week, count(DISTINCT date) AS days, sum(charge_amount) AS amount FROM "
            f"(SELECT DISTINCT phone_number, date, charge_amount, {FAMILY} AS package_name_update FROM (SELECT *, package_name AS n FROM vas_package)) "
            "WHERE package_name_update NOT LIKE 'VTR%' AND package_name_update NOT LIKE '%CAR%' AND package_name_update <> 'GOI_KID_DINH_VI' GROUP BY 1, 2, 3)")


@query("FP23_package_weekly", f"WITH {PACKAGES} SELECT phone_number, package_name_update, week AS date, days AS vas3g_dist_date_per_pack_l1w, amount AS vas3g_charge_amount_per_pn_pack_l1w FROM weekly",
       "vas_package", ".*amount.*", "package_name_update|date")
def package_weekly(f):
    return value_added.package_weekly(f.vas_package())


@query("FP23_package_features", f"WITH {PACKAGES} SELECT phone_number, count(DISTINCT package_name_update) AS vas3g_dist_package_l6m, sum(days) AS vas3g_dist_date_l6m, sum(amount) AS vas3g_charge_amount_l6m, "
       f"sum(amount) / sum(days) AS vas3g_charge_amount_wrt_date_l6m FROM weekly WHERE week BETWEEN {SNAP} - 161 AND {SNAP} GROUP BY 1", "vas_package", ".*amount.*")
def package_features(f):
    return value_added.package_features(value_added.package_weekly(f.vas_package()), ORDERS_SNAPSHOT)


ALL_PACKAGES = PACKAGES.split("WHERE package_name_update NOT LIKE")[0] + "WHERE package_name_update IS NOT NULL GROUP BY 1, 2, 3)"


@query("FP23_all_packages", f"WITH {ALL_PACKAGES} SELECT phone_number, package_name_update, week AS date, days AS vas3g_dist_date_per_pack_l1w, amount AS vas3g_charge_amount_per_pn_pack_l1w FROM weekly",
       "vas_package", ".*amount.*", "package_name_update|date")
def all_packages(f):
    return value_added.package_weekly(f.vas_package(), keep_untracked=True)


SERVICE = (f"weekly AS (SELECT phone_number, service_name, {SUNDAY} AS week, count(DISTINCT date) AS days, sum(price) AS price FROM "
           "(SELECT DISTINCT phone_number, date, price, service_name FROM vas_service) GROUP BY 1, 2, 3)")


@query("FP24_service_weekly", f"WITH {SERVICE} SELECT phone_number, service_name, week AS date, days AS vas_charge_dist_date_service_l1w, price AS vas_charge_price_per_pn_service_l1w FROM weekly",
       "vas_service", ".*price.*", "service_name|date")
def service_weekly(f):
    return value_added.service_weekly(f.vas_service())


@query("FP24_service_features", f"WITH {SERVICE} SELECT phone_number, sum(days * mean_age_group) AS vas_charge_sum_date_star_mean_age_l6m, sum(days) AS vas_charge_dist_date_l6m, sum(price) AS vas_charge_price_l6m "
       f"FROM weekly JOIN service_map USING (service_name) WHERE week BETWEEN {ESNAP} - 161 AND {ESNAP} GROUP BY 1", "vas_service service_map", ".*(age|price).*", digits=3)
def service_features(f):
    return value_added.service_features(value_added.service_weekly(f.vas_service()), f.service_map(), EVENTS_SNAPSHOT)


def charge_sql(m: int) -> str:
    sums = ", ".join(f"sum(coalesce({c}, 0)) AS {n}_l{m}m" for c, n in value_added.CHARGE_SUMS.items())
    return f"SELECT phone_number, {sums} FROM vas_charge_daily WHERE date > CAST({SNAP} - INTERVAL {m} MONTH AS DATE) AND date <= {SNAP} GROUP BY 1"


TXN_DAYS = ("days AS (SELECT phone_number, date, count(*) AS n, count(*) FILTER (amount > 0) AS n_out, count(*) FILTER (amount < 0) AS n_in, sum(amount) AS change, "
            "coalesce(sum(amount) FILTER (amount < 0), 0) AS a_in, coalesce(sum(amount) FILTER (amount > 0), 0) AS a_out, "
            "count(*) FILTER (reason LIKE '%PROVISIONING_LOAN%' OR reason LIKE '%AIRTIME_UNG%') AS n_adv, "
            "coalesce(sum(amount) FILTER (reason LIKE '%PROVISIONING_LOAN%' OR reason LIKE '%AIRTIME_UNG%'), 0) AS a_adv FROM balance_txn GROUP BY 1, 2)")


@query("FP26_transactions_daily", f"WITH {TXN_DAYS} SELECT phone_number, date, n AS vas_txn_num, n_out AS vas_txn_cash_out_num, n_in AS vas_txn_cash_in_num, change AS vas_balance_change_amt, "
       "CASE WHEN n_in > 0 THEN a_in END AS vas_amt_cash_in_total, CASE WHEN n_out > 0 THEN a_out END AS vas_amt_cash_out_total, n_adv AS vas_txn_cash_advance_num, "
       "CASE WHEN n_adv > 0 THEN a_adv END AS vas_amt_cash_advance_total FROM days", "balance_txn", ".*amt.*", "date", digits=3)
def transactions_daily(f):
    return value_added.transactions_daily(f.balance_txn())


def transactions_sql(m: int) -> str:
    w = f"l{m}m"
    return (f"WITH {TXN_DAYS} SELECT phone_number, sum(n) AS vas_txn_num_{w}, sum(n_out) AS vas_txn_cash_out_num_{w}, sum(n_in) AS vas_txn_cash_in_num_{w}, avg(n) AS vas_txn_num_mavg_{w}, "
            f"avg(n_out) AS vas_txn_cash_out_num_mavg_{w}, avg(n_in) AS vas_txn_cash_in_num_mavg_{w}, sum(change) AS vas_bal_change_amt_{w}, sum(abs(change)) AS vas_bal_change_abs_amt_{w}, "
            f"stddev_samp(abs(change)) AS vas_bal_change_abs_amt_daily_std_{w}, sum(a_in) AS vas_amt_cash_in_total_{w}, sum(a_out) AS vas_amt_cash_out_total_{w}, "
            f"sum(n_adv) AS vas_txn_cash_advance_num_{w}, sum(a_adv) AS vas_amt_cash_advance_total_{w} FROM days WHERE date > CAST({SNAP} - INTERVAL {m} MONTH AS DATE) AND date <= {SNAP} GROUP BY 1")


for _m in (1, 2, 3):
    query(f"FP25_charge_features_{_m}m", charge_sql(_m), "vas_charge_daily", ".*_amt_.*", digits=3)(
        lambda f, m=_m: value_added.charge_features(f.vas_charge_daily(), ORDERS_SNAPSHOT, m))
    query(f"FP26_transaction_features_{_m}m", transactions_sql(_m), "balance_txn", ".*(amt|mavg).*", digits=3)(
        lambda f, m=_m: value_added.transaction_features(value_added.transactions_daily(f.balance_txn()), ORDERS_SNAPSHOT, m))
