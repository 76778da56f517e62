"""Usage families of both operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, as_date, week_sunday
from sundial.functions.numbers import flag, ratio_or_null, ratio_or_zero, smoothed_ratio
from sundial.operators.columns import align_to, fill_missing
from sundial.operators.joins import current_activation
from sundial.sources.scans import after_until, first_of_months, last_weeks

PHONE = "phone_number"

# Operator A

# Fixed values: (share column, cost it divides by the total).
COST_SHARES = [
    ("prom_vs_total", "t_prom_cost"), ("s_vs_total", "s_tot_cost"), ("s_ext_vs_total", "s_ext_org_cost"),
    ("s_int_vs_total", "s_int_org_cost"), ("s_intn_vs_total", "s_intn_org_cost"), ("s_org_vs_total", "s_org_cost"),
    ("s_prom_vs_total", "s_prom_cost"), ("v_vs_total", "v_tot_cost"), ("v_ext_org_vs_total", "v_ext_org_cost"),
    ("v_int_org_vs_total", "v_int_org_cost"), ("v_intn_org_vs_total", "v_intn_org_cost"), ("v_org_vs_total", "v_org_cost"),
    ("v_prom_vs_total", "v_prom_cost"), ("re_charge_vs_total", "re_charge"), ("m_org_vs_total", "m_org_cost"),
    ("g_vs_total", "g_monthly_fee"), ("g_reg_vs_total", "g_reg_fee"), ("g_org_vs_total", "g_org_cost"),
    ("vas_vs_total", "vas_tot_cost"), ("vas_org_vs_total", "vas_org_cost"), ("vas_prom_vs_total", "vas_prom_cost"),
    ("org_vs_total", "t_org_cost")]
TOTAL_COST = "t_tot_cost"


def monthly_usage(prepaid: DataFrame, postpaid: DataFrame, activated: DataFrame, snapshot: DateLike, months: int) -> DataFrame:
    """Pre- and postpaid first-of-month rows under the prepaid schema; unknown costs are -1."""
    own = [current_activation(first_of_months(df, snapshot, months), activated).distinct() for df in (prepaid, postpaid)]
    columns = prepaid.columns
    return own[0].select(*columns).union(align_to(own[1], columns))


def usage_statistics(usage: DataFrame, months: int) -> DataFrame:
    """Minimum, deviation and sum of every cost."""
    costs = [c for c in usage.columns if c not in (PHONE, "date")]
    functions = {"min": F.min, "std": F.stddev, "sum": F.sum}
    return usage.groupBy(PHONE).agg(*[
        function(F.col(c).cast("double")).alias(f"usage_{c}_{name}_l{months}m".lower())
        for c in costs for name, function in functions.items()])


def cost_shares(statistics: DataFrame, months: int) -> DataFrame:
    """Each cost's part of the total cost, 0 without any cost."""
    total = F.col(f"usage_{TOTAL_COST}_sum_l{months}m")
    return statistics.select(PHONE, *[
        ratio_or_zero(F.col(f"usage_{cost}_sum_l{months}m"), total).alias(f"usage_{name}_l{months}m")
        for name, cost in COST_SHARES])


# Parts of the postpaid total cost.
POSTPAID_TOTAL = ["t_org_cost", "v_int_org_cost", "v_ext_org_cost", "v_intn_org_cost"]


def mean_total_cost(prepaid: DataFrame, postpaid: DataFrame, snapshot: DateLike, months: int = 6) -> DataFrame:
    """Mean monthly cost over pre- and postpaid rows."""
    derived = sum((F.col(c) for c in POSTPAID_TOTAL[1:]), F.col(POSTPAID_TOTAL[0]))
    both = first_of_months(prepaid, snapshot, months).select(PHONE, TOTAL_COST).unionByName(
        first_of_months(postpaid, snapshot, months).select(PHONE, derived.alias(TOTAL_COST)))
    return both.groupBy(PHONE).agg(F.avg(TOTAL_COST).alias(f"avg_total_cost_l{months}m"))


# Operator B

SERVICES = ["sms", "voice", "data", "other"]


def usage_weekly(usage: DataFrame, activated: DataFrame, snapshot: DateLike, weeks: int = 1) -> DataFrame:
    """Amounts, free and paid events per service and week, in one conditional aggregate.

    A row counts in the week of its own partition day and only when it started in that ISO week.
    """
    rows = after_until(usage, as_date(snapshot) - dt.timedelta(weeks=weeks), snapshot).select(
        PHONE, "service_type", "charge_amount", "start_time", "date")
    started = F.to_date("start_time")
    week = week_sunday(F.col("date"))
    same_week = F.weekofyear(started) == F.weekofyear(week)
    own = current_activation(rows.filter(same_week), activated).distinct().withColumn("week", week_sunday(F.col("date")))
    amount = F.col("charge_amount")
    aggregates = []
    for service in SERVICES:
        is_service = F.col("service_type") == service.upper()
        aggregates += [
            F.sum(F.when(is_service, amount)).alias(f"{service}_charge_amount"),
            F.count(F.when(is_service, amount)).alias(f"{service}_num"),
            F.sum(flag(is_service & (amount == 0))).alias(f"{service}_num_free"),
            F.sum(flag(is_service & (amount != 0))).alias(f"{service}_num_paid")]
    wide = own.filter(F.col("service_type").isin([s.upper() for s in SERVICES])).groupBy(PHONE, "week").agg(*aggregates)
    wide = fill_missing(wide, 0, keys=[PHONE])
    ratios = {}
    for service in SERVICES:
        ratios |= {f"{service}_pct_num_{kind}": ratio_or_zero(F.col(f"{service}_num_{kind}"), F.col(f"{service}_num")) for kind in ("free", "paid")}
        ratios[f"{service}_avg_charge_amount"] = smoothed_ratio(F.col(f"{service}_charge_amount"), F.col(f"{service}_num_paid"), 0.0, 0.01)
    totals = {f"all_{part}": sum((F.col(f"{s}_{part}") for s in SERVICES[1:]), F.col(f"{SERVICES[0]}_{part}"))
              for part in ("charge_amount", "num", "num_free", "num_paid")}
    wide = wide.withColumns({**ratios, **totals})
    return wide.withColumns({
        **{f"all_pct_num_{kind}": ratio_or_null(F.col(f"all_num_{kind}"), F.col("all_num")) for kind in ("free", "paid")},
        "all_avg_charge_amount": smoothed_ratio(F.col("all_charge_amount"), F.col("all_num"), 0.0, 0.01),
    }).withColumnRenamed("week", "date")


def usage_8_weeks(weekly: DataFrame, activated: DataFrame, snapshot: DateLike) -> DataFrame:
    """Spread and mean of weekly expense, event totals and mean shares over eight weeks."""
    own = current_activation(last_weeks(weekly, snapshot, 8), activated, bounded=True)
    aggregates = []
    for service in ["all", *SERVICES]:
        prefix = "usage" if service == "all" else f"usage_{service}"
        amount = f"{service}_charge_amount"
        aggregates += [F.stddev(amount).alias(f"{prefix}_sd_week_expense_8weeks"), F.avg(amount).alias(f"{prefix}_avg_weeks_expense"),
                       F.sum(amount).alias(f"{prefix}_sum_weeks_expense")]
        counts = ["num", "num_free", "num_paid"] if service != "sms" else ["num", "num_paid"]
        aggregates += [F.sum(f"{service}_{c}").alias(f"usage_{service}_{c}") for c in counts]
        aggregates += [F.avg(f"{service}_{c}").alias(f"usage_{service}_{c}") for c in ("pct_num_free", "pct_num_paid", "avg_charge_amount")]
    # The two spread flags, whose names differ from their limits.
    spread = F.col("usage_sd_week_expense_8weeks")
    flags = {"usage_sd_week_expense_8weeks_ge_25k": (spread >= 20_000).cast("int"),
             "usage_sd_week_expense_8weeks_le_2500": (spread < 2_000).cast("int")}
    return fill_missing(own.groupBy(PHONE).agg(*aggregates).withColumns(flags), 0, keys=[PHONE])


KEPT_ENDINGS = ("_charge_amount", "_num", "_num_paid")
DROPPED_PARTS = ("pct", "avg")


def usage_24_weeks(weekly: DataFrame, activated: DataFrame, snapshot: DateLike, weeks: int = 24,
                   collapse_equal_weeks: bool = True) -> DataFrame:
    """Sum, minimum and deviation of the weekly columns chosen by name.

    With `collapse_equal_weeks` weeks that agree in every column count once.
    """
    rows = after_until(weekly, as_date(snapshot) - dt.timedelta(weeks=weeks), snapshot)
    own = current_activation(rows, activated, bounded=True).drop("date")
    if collapse_equal_weeks:
        own = own.distinct()
    chosen = [c for c in own.columns if c.endswith(KEPT_ENDINGS) and not any(part in c for part in DROPPED_PARTS)]
    functions = {"sum": F.sum, "min": F.min, "std": F.stddev}
    return own.groupBy(PHONE).agg(*[
        function(c).alias(f"usage_{c}_{name}_l{weeks}w") for name, function in functions.items() for c in chosen])
