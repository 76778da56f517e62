"""Operator B payment families."""

from __future__ import annotations

from sundial.checks.fixtures import ORDERS_SNAPSHOT
from sundial.checks.payment_a_queries import SNAP, SUNDAY, activated, day_balance_sql, own_sql, recharge_sql
from sundial.checks.registry import query
from sundial.plans import airtime, balances, recharges, usage, value_added

SERVICES = ["sms", "voice", "data", "other"]


def usage_weekly_sql(weeks: int) -> str:
    parts, filled, shares = [], [], []
    for s in SERVICES:
        own = f"service_type = '{s.upper()}'"
        parts += [f"sum(charge_amount) FILTER ({own}) AS {s}_charge_amount", f"count(charge_amount) FILTER ({own}) AS {s}_num",
                  f"count(*) FILTER ({own} AND charge_amount = 0) AS {s}_num_free", f"count(*) FILTER ({own} AND charge_amount <> 0) AS {s}_num_paid"]
        filled.append(f"coalesce({s}_charge_amount, 0) AS {s}_charge_amount")
        shares += [f"coalesce({s}_num_{k} / nullif({s}_num, 0), 0) AS {s}_pct_num_{k}" for k in ("free", "paid")]
        shares.append(f"{s}_charge_amount / ({s}_num_paid + 0.01::DOUBLE) AS {s}_avg_charge_amount")
    totals = ", ".join(f"{' + '.join(f'{s}_{p}' for s in SERVICES)} AS all_{p}" for p in ("charge_amount", "num", "num_free", "num_paid"))
    last = ("all_num_free / nullif(all_num, 0) AS all_pct_num_free, all_num_paid / nullif(all_num, 0) AS all_pct_num_paid, "
            "all_charge_amount / (all_num + 0.01::DOUBLE) AS all_avg_charge_amount")
    rows = f"SELECT DISTINCT * FROM {own_sql('usage_b')} WHERE date > {SNAP} - {7 * weeks} AND date <= {SNAP} AND week(start_time) = week({SUNDAY})"
    return (f"raw AS (SELECT phone_number, {SUNDAY} AS week, {', '.join(parts)} FROM ({rows}) GROUP BY 1, 2), "
            f"filled AS (SELECT phone_number, week AS date, * EXCLUDE (phone_number, week) REPLACE ({', '.join(filled)}) FROM raw), "
            f"shared AS (SELECT *, {', '.join(shares)}, {totals} FROM filled), weekly AS (SELECT *, {last} FROM shared)")


def weekly_usage(f, weeks):
    return usage.usage_weekly(f.usage_b(), activated(f), ORDERS_SNAPSHOT, weeks)


@query("FP27_usage_weekly", f"WITH {usage_weekly_sql(1)} SELECT * FROM weekly", "usage_b activation", ".*(amount|pct).*", "date", digits=4)
def usage_one(f):
    return weekly_usage(f, 1)


def usage_8_sql() -> str:
    parts = []
    for s in ["all", *SERVICES]:
        p = "usage" if s == "all" else f"usage_{s}"
        parts += [f"coalesce(stddev_samp({s}_charge_amount), 0) AS {p}_sd_week_expense_8weeks", f"avg({s}_charge_amount) AS {p}_avg_weeks_expense",
                  f"sum({s}_charge_amount) AS {p}_sum_weeks_expense"]
        parts += [f"sum({s}_{c}) AS usage_{s}_{c}" for c in ("num", "num_free", "num_paid") if (s, c) != ("sms", "num_free")]
        parts += [f"avg({s}_{c}) AS usage_{s}_{c}" for c in ("pct_num_free", "pct_num_paid", "avg_charge_amount")]
    parts += ["coalesce((stddev_samp(all_charge_amount) >= 20000)::INT, 0) AS usage_sd_week_expense_8weeks_ge_25k",
              "coalesce((stddev_samp(all_charge_amount) < 2000)::INT, 0) AS usage_sd_week_expense_8weeks_le_2500"]
    return f"WITH {usage_weekly_sql(8)} SELECT phone_number, {', '.join(parts)} FROM {own_sql('weekly')} GROUP BY 1"


@query("FP27_usage_8_weeks", usage_8_sql(), "usage_b activation", ".*(expense|expense_8weeks|amount|pct.*)", digits=3)
def usage_8(f):
    return usage.usage_8_weeks(weekly_usage(f, 8), activated(f), ORDERS_SNAPSHOT)


def usage_24_sql() -> str:
    chosen = [f"{s}_{c}" for s in [*SERVICES, "all"] for c in ("charge_amount", "num", "num_paid")]
    parts = ", ".join(f"{e}({c}) AS usage_{c}_{n}_l24w" for c in chosen for e, n in (("sum", "sum"), ("min", "min"), ("stddev_samp", "std")))
    return f"WITH {usage_weekly_sql(24)} SELECT phone_number, {parts} FROM (SELECT DISTINCT * EXCLUDE (date) FROM {own_sql('weekly')}) GROUP BY 1"


@query("FP27_usage_24_weeks", usage_24_sql(), "usage_b activation", ".*(amount|std).*", digits=3)
def usage_24(f):
    return usage.usage_24_weeks(weekly_usage(f, 24), activated(f), ORDERS_SNAPSHOT)


def balance_weekly_sql(weeks: int) -> str:
    rows = f"rows AS (SELECT b.*, {SUNDAY} AS week FROM balance_b b WHERE date BETWEEN {SNAP} - {7 * weeks - 1} AND {SNAP})"
    blocks = []
    for kind, code in (("pre", "PRE"), ("post", "POST")):
        for main in (False, True):
            prefix = f"balance_{kind}{'_main' if main else ''}"
            where = f"billing_type = '{code}'" + (" AND account_code = '0'" if main else "")
            source = (f"(SELECT * FROM rows WHERE {where})" if main else
                      f"(SELECT phone_number, week, date, sum(balance) AS balance FROM rows WHERE {where} GROUP BY 1, 2, 3)")
            if kind == "pre":
                tests = {"zero": "balance = 0"} | {n: f"balance <= {v}" for n, v in (balances.PREPAID_LIMITS | (balances.MAIN_ONLY_LIMITS if main else {})).items()}
            else:
                tests = {n: f"balance >= {v}" for n, v in balances.POSTPAID_LIMITS.items()}
            stats = ", ".join(f"{e}(balance) AS {prefix}_amt_{n}_l1w" for e, n in (("min", "min"), ("avg", "avg"), ("max", "max"), ("stddev_samp", "std")))
            days = ", ".join(f"count(DISTINCT date) FILTER ({t}) AS {prefix}_{n}_day_num_l1w" for n, t in tests.items())
            blocks.append(f"(SELECT phone_number, week, {stats}, {days} FROM {source} GROUP BY 1, 2)")
    joined = f"{blocks[0]} b0" + "".join(f" FULL JOIN {b} b{i} USING (phone_number, week)" for i, b in enumerate(blocks[1:], 1))
    return f"{rows}, weekly AS (SELECT phone_number, week AS date, * EXCLUDE (phone_number, week) FROM {joined})"


def weekly_balance(f, weeks):
    subscribers = f.balance_b().select("phone_number", "billing_type").distinct()
    return balances.balance_weekly(f.balance_b().drop("billing_type"), subscribers, ORDERS_SNAPSHOT, weeks)


@query("FP28_balance_weekly", f"WITH {balance_weekly_sql(1)} SELECT * FROM weekly", "balance_b", ".*_amt_.*", "date", digits=4)
def balance_one(f):
    return weekly_balance(f, 1)


def balance_weeks_sql(n: int) -> str:
    parts = []
    for kind in ("pre", "post"):
        for main in (False, True):
            p = f"balance_{kind}{'_main' if main else ''}"
            parts += [f"{e}({p}_amt_{e}_l1w) AS {p}_amt_{e}_l{n}w" for e in ("min", "avg", "max")]
            names = (["zero", *balances.PREPAID_LIMITS, *(balances.MAIN_ONLY_LIMITS if main else {})] if kind == "pre" else list(balances.POSTPAID_LIMITS))
            parts += [f"sum({p}_{d}_day_num_l1w) AS {p}_{d}_day_num_l{n}w" for d in names]
    return f"WITH {balance_weekly_sql(n)} SELECT phone_number, {', '.join(parts)} FROM weekly GROUP BY 1"


for _n in (2, 4, 12):
    query(f"FP28_balance_{_n}_weeks", balance_weeks_sql(_n), "balance_b", ".*_amt_.*", digits=4)(
        lambda f, n=_n: balances.balance_roll_forward(weekly_balance(f, n), ORDERS_SNAPSHOT, n))


@query("FP29_usable_balance_features",
       "WITH daily AS (SELECT phone_number, date, sum(balance) AS balance FROM balance_b "
       f"WHERE date > {SNAP} - 59 AND date <= {SNAP} AND NOT starts_with(account_code, '3') AND NOT contains(account_code, '142') AND balance >= 0 GROUP BY 1, 2) "
       f"SELECT phone_number, {day_balance_sql(['balance'])} FROM {own_sql('daily')} GROUP BY 1", "balance_b activation", "balance.*", digits=4)
def usable(f):
    return balances.usable_balance_features(f.balance_b(), activated(f), ORDERS_SNAPSHOT)


def registrations_sql() -> str:
    blocks = []
    for prefix, code, largest in (("", None, True), ("reg_", "REG", True), ("unreg_", "UNREG", False), ("content_", "CONTENT", True)):
        where = f" WHERE transaction_type = '{code}'" if code else ""
        top = f"max(charge_amount) AS vas_{prefix}txn_max_l1w, " if largest else ""
        blocks.append(f"(SELECT phone_number, {SUNDAY} AS week, count(*) AS vas_{prefix}txn_num_l1w, sum(charge_amount) AS vas_{prefix}txn_amt_l1w, {top}"
                      f"count(DISTINCT date) AS vas_{prefix}day_num_l1w FROM vas_b{where} GROUP BY 1, 2)")
    joined = f"{blocks[0]} b0" + "".join(f" FULL JOIN {b} b{i} USING (phone_number, week)" for i, b in enumerate(blocks[1:], 1))
    return f"weekly AS (SELECT phone_number, week AS date, * EXCLUDE (phone_number, week) FROM {joined})"


@query("FP30_registrations_weekly", f"WITH {registrations_sql()} SELECT * FROM weekly", "vas_b", ".*(amt|max).*", "date", digits=4)
def registrations(f):
    return value_added.registrations_weekly(f.vas_b())


def registrations_weeks_sql(n: int) -> str:
    parts = []
    for p, largest in (("", True), ("reg_", True), ("unreg_", False), ("content_", True)):
        parts += [f"sum(vas_{p}{c}_l1w) AS vas_{p}{c}_l{n}w" for c in ("txn_num", "txn_amt", "day_num")]
        parts += [f"max(vas_{p}txn_max_l1w) AS vas_{p}txn_max_l{n}w"] if largest else []
    return f"WITH {registrations_sql()} SELECT phone_number, {', '.join(parts)} FROM weekly WHERE date BETWEEN {SNAP} - {7 * n - 1} AND {SNAP} GROUP BY 1"


for _n in (2, 4, 8):
    query(f"FP30_registrations_{_n}_weeks", registrations_weeks_sql(_n), "vas_b", ".*(amt|max).*", digits=4)(
        lambda f, n=_n: value_added.registrations_roll_forward(value_added.registrations_weekly(f.vas_b()), ORDERS_SNAPSHOT, n))


@query("FP30_registration_features_60d",
       "SELECT phone_number, count(DISTINCT service_name) AS vas_num_services, count(charge_amount) AS vas_num_times_charge, sum(charge_amount) AS vas_charge_charge "
       f"FROM (SELECT DISTINCT * FROM {own_sql('vas_b')} WHERE date > {SNAP} - 59 AND date <= {SNAP}) GROUP BY 1", "vas_b activation", "vas_charge.*", digits=4)
def registration_features(f):
    return value_added.registration_features(f.vas_b(), activated(f), ORDERS_SNAPSHOT)


def credit_sql(n: int) -> str:
    w, src = f"l{n}w", f"src AS (SELECT * FROM airtime WHERE date BETWEEN {SNAP} - {7 * n - 1} AND {SNAP})"
    return (f"WITH {src}, own AS (SELECT phone_number, count(*) AS vasc_txn_num_{w}, count(DISTINCT date) AS vasc_day_num_{w} FROM src GROUP BY 1), "
            f"credit AS (SELECT phone_number, count(*) AS vasc_credit_txn_num_{w}, sum(amount) AS vasc_credit_amt_{w}, count(DISTINCT date) AS vasc_credit_day_num_{w} FROM "
            "(SELECT phone_number, amount, date FROM src WHERE service_name <> '2FRIEND' UNION ALL SELECT receive_phone_number, amount, date FROM src WHERE service_name = '2FRIEND') GROUP BY 1), "
            f"gift AS (SELECT receive_phone_number AS phone_number, count(*) AS vasc_2friend_num_{w}, sum(amount) AS vasc_2friend_amt_{w}, count(DISTINCT date) AS vasc_2friend_day_num_{w} "
            "FROM src WHERE service_name = '2FRIEND' GROUP BY 1) SELECT * FROM own FULL JOIN credit USING (phone_number) FULL JOIN gift USING (phone_number)")


for _n in (1, 2, 4, 12):
    query(f"FP31_credit_features_{_n}w", credit_sql(_n), "airtime", ".*_amt_.*")(
        lambda f, n=_n: airtime.credit_features(f.airtime(), ORDERS_SNAPSHOT, n))


def airtime_sql(m: int) -> str:
    w = f"l{m}m"
    groups = {"daytime": "hour_range_level2 = 'daytime'", "weekend": "isodow(date) > 5", "utn": "service_name = 'UTN'", "2friend": "service_name = '2FRIEND'", "udv": "service_name = 'UDV'"}
    groups |= {f"{n}_service": f"amount {'<=' if n.startswith('le') else '>='} {v}" for n, v in airtime.AMOUNT_LIMITS.items()}
    sent = [f"count(*) AS vasc_txn_num_{w}", f"sum(amount) AS vasc_amt_total_{w}", f"count(DISTINCT service_name) AS vasc_service_num_{w}",
            f"count(DISTINCT receive_phone_number) FILTER ({groups['2friend']}) AS vasc_receiver2f_num_{w}", f"count(DISTINCT date) AS vasc_active_day_num_{w}"]
    for name, test in groups.items():
        sent += [f"count(*) FILTER ({test}) AS vasc_txn_{name}_num_{w}", f"sum(amount) FILTER ({test}) AS vasc_amt_{name}_total_{w}"]
    sent += [f"count(DISTINCT date) FILTER ({groups[s]}) AS vasc_{s}_active_day_num_{w}" for s in ("utn", "2friend", "udv")]
    got = [f"count(*) AS vasc_txn_receivce2f_num_{w}", f"count(DISTINCT phone_number) AS vasc_sender2f_num_{w}", f"sum(amount) AS vasc_amt_receiver2f_total_{w}",
           f"count(DISTINCT date) AS vasc_receivce2f_active_day_num_{w}", f"count(DISTINCT phone_number) FILTER ({groups['daytime']}) AS vasc_receivcer2f_daytime_{w}",
           f"count(DISTINCT phone_number) FILTER ({groups['weekend']}) AS vasc_receivcer2f_weekend_num_{w}"]
    for name in ("daytime", "weekend"):
        got += [f"count(*) FILTER ({groups[name]}) AS vasc_txn_receivce2f_{name}_num_{w}", f"sum(amount) FILTER ({groups[name]}) AS vasc_amt_receivce2f_{name}_total_{w}"]
    rest = ", ".join(f"vasc_txn_num_{w} - vasc_txn_{o}_num_{w} AS vasc_txn_{n}_num_{w}, vasc_amt_total_{w} - vasc_amt_{o}_total_{w} AS vasc_amt_{n}_total_{w}"
                     for n, o in (("nighttime", "daytime"), ("weekday", "weekend")))
    return (f"WITH src AS (SELECT * REPLACE (upper(service_name) AS service_name) FROM (SELECT DISTINCT * FROM airtime WHERE date BETWEEN CAST({SNAP} - INTERVAL {m} MONTH AS DATE) - 1 AND {SNAP}) a "
            f"LEFT JOIN hour_map h ON h.hour = hour(transaction_time)), sent AS (SELECT phone_number, {', '.join(sent)} FROM src GROUP BY 1), "
            f"got AS (SELECT receive_phone_number AS phone_number, {', '.join(got)} FROM src WHERE service_name = '2FRIEND' GROUP BY 1) "
            f"SELECT *, {rest} FROM sent FULL JOIN got USING (phone_number)")


for _m in (1, 2, 3):
    query(f"FP32_airtime_features_{_m}m", airtime_sql(_m), "airtime hour_map", ".*_amt_.*")(
        lambda f, m=_m: airtime.monthly_features(f.airtime(), f.hour_map(), ORDERS_SNAPSHOT, m))


def use_sql() -> str:
    parts = []
    for name, test in (("UNGTIEN", "service_name <> '2FRIEND'"), ("2FRIEND", "service_name = '2FRIEND'")):
        parts += [f"count(DISTINCT date) FILTER ({test}) AS \"vasc_num_days_uses_{name}\"", f"count(amount) FILTER ({test}) AS \"vasc_num_times_uses_{name}\"",
                  f"coalesce(sum(amount) FILTER ({test}), 0) AS \"vasc_amount_expence_{name}\""]
    return (f"WITH src AS (SELECT DISTINCT * REPLACE (CAST(transaction_time AS DATE) AS date) FROM airtime) "
            f"SELECT phone_number, {', '.join(parts)} FROM {own_sql('src')} WHERE date > {SNAP} - 59 AND date <= {SNAP} GROUP BY 1")


@query("FP33_airtime_use_60d", use_sql(), "airtime activation", ".*amount.*")
def airtime_use(f):
    return airtime.use_features(f.airtime(), activated(f), ORDERS_SNAPSHOT)


def shares_sql() -> str:
    tests = {"le_10k": "r < 10000", "gt_10k_le_20k": "r >= 10000 AND r <= 20000", "gt_20k_le_50k": "r > 20000 AND r <= 50000",
             "gt_50k_le_100k": "r > 50000 AND r <= 100000", "gt_100k": "r > 100000"}
    parts = [f"avg(CASE WHEN {t} THEN 1 ELSE 0 END) AS air_pct_{n}" for n, t in tests.items()]
    return ("WITH promo AS (SELECT CAST(recharge_time AS DATE) AS date FROM recharge GROUP BY 1 HAVING count(*) > 8), "
            f"own AS (SELECT DISTINCT *, recharge_amount AS r FROM {own_sql('recharge', '>=', 'recharge_time')} WHERE recharge_amount > 0 AND date > {SNAP} - 59 AND date <= {SNAP}), "
            f"base AS (SELECT phone_number, {', '.join(parts)}, sum(r) AS air_total_recharge_amount, count(r) AS air_total_recharge_times, "
            "coalesce(sum(r) FILTER (date IN (SELECT date FROM promo)), 0) AS air_promo_recharge_amount, count(r) FILTER (date IN (SELECT date FROM promo)) AS air_promo_recharge_times FROM own GROUP BY 1) "
            "SELECT *, air_promo_recharge_amount / (air_total_recharge_amount + 0.01::DOUBLE) AS air_pct_amount_recharge_promo, "
            "air_promo_recharge_times / (air_total_recharge_times + 0.01::DOUBLE) AS air_pct_times_recharge_promo FROM base")


@query("FP34_recharge_shares", shares_sql(), "recharge activation", ".*(pct|amount).*", digits=4)
def recharge_shares(f):
    days = recharges.promotion_calendar(f.recharge(), 8)
    return recharges.recharge_shares(f.recharge(), activated(f), days, ORDERS_SNAPSHOT)


@query("FP35_recharges_with_balance",
       f"SELECT r.*, b.pre_balance FROM (SELECT phone_number, recharge_amount, trade_method, date FROM recharge WHERE date = {SNAP} - 2) r LEFT JOIN "
       f"(SELECT phone_number, sum(balance) AS pre_balance FROM balance_b WHERE date = {SNAP} - 2 AND NOT starts_with(account_code, '3') AND NOT contains(account_code, '142') AND balance >= 0 GROUP BY 1) b USING (phone_number)",
       "recharge balance_b", "recharge_amount|pre_balance", "trade_method|date", digits=4)
def with_balance(f):
    import datetime as dt

    rows = f.recharge().select("phone_number", "recharge_amount", "trade_method", "date")
    return recharges.recharges_with_balance(rows, f.balance_b(), ORDERS_SNAPSHOT - dt.timedelta(days=2))


@query("FP35_recharge_features", recharge_sql("SELECT * FROM recharge WHERE recharge_amount > 0", (1, 2, 3), (1, 3), False,
                                              "SELECT CAST(recharge_time AS DATE) AS date FROM recharge GROUP BY 1 HAVING count(*) > 8"),
       "recharge", ".*(_total_|_avg_|_pct_|_vs_).*", digits=4)
def recharge_b(f):
    days = recharges.promotion_calendar(f.recharge(), 8)
    return recharges.recharge_features(f.recharge(), ORDERS_SNAPSHOT, (1, 2, 3), (1, 3), methods=False, promotion_days=days)
