"""Value-added services: packages, charged services, balance transactions, service registrations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, add_months, as_date, week_sunday
from sundial.functions.numbers import ratio_or_null
from sundial.functions.texts import is_tracked_package, package_family
from sundial.operators.aggregates import count_where, roll_forward, sum_where, weighted_sum
from sundial.operators.columns import fill_missing
from sundial.operators.joins import current_activation
from sundial.sources.scans import after_until, last_weeks

PHONE = "phone_number"


def package_weekly(packages: DataFrame, keep_untracked: bool = False) -> DataFrame:
    """Days and amount per subscriber, week and package family; repeated rows count once.

    Locator, car and child packages are left out unless `keep_untracked`; packages without a name always are.
    """
    rows = packages.withColumn("package_name_update", package_family(F.col("package_name")))
    rows = rows.filter(F.col("package_name_update").isNotNull() if keep_untracked else is_tracked_package(F.col("package_name_update")))
    unique = rows.select(PHONE, "date", "charge_amount", "package_name_update").distinct()
    daily = unique.groupBy(PHONE, "package_name_update", "date").agg(F.sum("charge_amount").alias("amount"))
    return daily.withColumn("week", week_sunday(F.col("date"))).groupBy(PHONE, "package_name_update", "week").agg(
        F.count(F.lit(1)).alias("vas3g_dist_date_per_pack_l1w"), F.sum("amount").alias("vas3g_charge_amount_per_pn_pack_l1w"),
    ).withColumnRenamed("week", "date")


def package_features(weekly: DataFrame, snapshot: DateLike, weeks: int = 24, label: str = "l6m") -> DataFrame:
    """Packages, days, amount and amount per day."""
    per_package = last_weeks(weekly, snapshot, weeks).groupBy(PHONE, "package_name_update").agg(
        F.sum("vas3g_dist_date_per_pack_l1w").alias("days"), F.sum("vas3g_charge_amount_per_pn_pack_l1w").alias("amount"))
    totals = per_package.groupBy(PHONE).agg(
        F.count("package_name_update").alias(f"vas3g_dist_package_{label}"), F.sum("days").alias(f"vas3g_dist_date_{label}"),
        F.sum("amount").alias(f"vas3g_charge_amount_{label}"))
    return totals.withColumn(f"vas3g_charge_amount_wrt_date_{label}", ratio_or_null(
        F.col(f"vas3g_charge_amount_{label}"), F.col(f"vas3g_dist_date_{label}")))


def service_weekly(charges: DataFrame) -> DataFrame:
    """Days and price per subscriber, week and service; repeated rows count once."""
    unique = charges.select(PHONE, "date", "price", "service_name").distinct()
    daily = unique.groupBy(PHONE, "service_name", "date").agg(F.sum("price").alias("price"))
    return daily.withColumn("week", week_sunday(F.col("date"))).groupBy(PHONE, "service_name", "week").agg(
        F.count(F.lit(1)).alias("vas_charge_dist_date_service_l1w"), F.sum("price").alias("vas_charge_price_per_pn_service_l1w"),
    ).withColumnRenamed("week", "date")


def service_features(weekly: DataFrame, encodings: DataFrame, snapshot: DateLike, weeks: int = 24, label: str = "l6m") -> DataFrame:
    """Days weighted by each service's mean age, days and price, over encoded services."""
    return weighted_sum(
        last_weeks(weekly, snapshot, weeks), encodings.select("service_name", "mean_age_group").distinct(), "service_name", [PHONE],
        "vas_charge_dist_date_service_l1w", "mean_age_group", f"vas_charge_sum_date_star_mean_age_{label}",
        [F.sum("vas_charge_dist_date_service_l1w").alias(f"vas_charge_dist_date_{label}"),
         F.sum("vas_charge_price_per_pn_service_l1w").alias(f"vas_charge_price_{label}")])


# Day column and the name of its sum.
CHARGE_SUMS = {
    "vas_charge_amt_total": "vas_charge_amt_total", "vas_charge_txn_num": "vas_charge_txn_num",
    "vas_charge_service_num": "vas_charge_service_num_davg_total", "vas_charge_amt_lottery_total": "vas_charge_amt_lottery_total",
    "vas_charge_amt_phongthuy_total": "vas_charge_amt_phongthuy_total", "vas_charge_amt_kid_total": "vas_charge_amt_kid_total",
    "vas_charge_amt_monthly_total": "vas_charge_amt_monthly_total", "vas_charge_amt_weekly_total": "vas_charge_amt_weekly_total",
    "vas_charge_amt_daily_total": "vas_charge_amt_daily_total"}


def _last_months(df: DataFrame, snapshot: DateLike, months: int) -> DataFrame:
    return after_until(df, add_months(snapshot, -months), snapshot)


def charge_features(daily: DataFrame, snapshot: DateLike, months: int) -> DataFrame:
    """Sums of the daily charge table."""
    return _last_months(daily, snapshot, months).groupBy(PHONE).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"{name}_l{months}m") for c, name in CHARGE_SUMS.items()])


# Parts of a reason that mark a cash advance.
ADVANCE_REASONS = ["PROVISIONING_LOAN", "AIRTIME_UNG"]


def transactions_daily(transactions: DataFrame) -> DataFrame:
    """Cash in, cash out and cash advance per subscriber and day; a positive amount is cash out."""
    amount = F.col("amount")
    cash_out, cash_in = amount > 0, amount < 0
    advance = F.col("reason").rlike("|".join(ADVANCE_REASONS))
    return transactions.groupBy(PHONE, "date").agg(
        F.count(F.lit(1)).alias("vas_txn_num"), count_where(cash_out).alias("vas_txn_cash_out_num"),
        count_where(cash_in).alias("vas_txn_cash_in_num"), F.sum(amount).alias("vas_balance_change_amt"),
        sum_where(cash_in, amount).alias("vas_amt_cash_in_total"), sum_where(cash_out, amount).alias("vas_amt_cash_out_total"),
        count_where(advance).alias("vas_txn_cash_advance_num"), sum_where(advance, amount).alias("vas_amt_cash_advance_total"))


def transaction_features(daily: DataFrame, snapshot: DateLike, months: int) -> DataFrame:
    rows = fill_missing(_last_months(daily, snapshot, months), 0, keys=[PHONE])
    w = f"l{months}m"
    change = F.col("vas_balance_change_amt")
    counts = ["vas_txn_num", "vas_txn_cash_out_num", "vas_txn_cash_in_num"]
    return rows.groupBy(PHONE).agg(
        *[F.sum(c).alias(f"{c}_{w}") for c in counts], *[F.avg(c).alias(f"{c}_mavg_{w}") for c in counts],
        F.sum(change).alias(f"vas_bal_change_amt_{w}"), F.sum(F.abs(change)).alias(f"vas_bal_change_abs_amt_{w}"),
        F.stddev(F.abs(change)).alias(f"vas_bal_change_abs_amt_daily_std_{w}"),
        *[F.sum(c).alias(f"{c}_{w}") for c in ("vas_amt_cash_in_total", "vas_amt_cash_out_total",
                                               "vas_txn_cash_advance_num", "vas_amt_cash_advance_total")])


# Operator B: registrations. Transaction type and whether its maximum is kept.
REGISTRATIONS = {"": (None, True), "reg_": ("REG", True), "unreg_": ("UNREG", False), "content_": ("CONTENT", True)}


def registrations_weekly(services: DataFrame) -> DataFrame:
    """Transactions, amount, largest amount and days per type and week, in one pass over days.

    Columns of a type a subscriber never used stay null.
    """
    amount = F.col("charge_amount")
    first, second = [], []
    for prefix, (code, largest) in REGISTRATIONS.items():
        own = F.lit(True) if code is None else F.col("transaction_type") == code
        first += [count_where(own).alias(f"n_{prefix}"), sum_where(own, amount).alias(f"a_{prefix}"), F.max(F.when(own, amount)).alias(f"m_{prefix}")]
        rows = F.sum(f"n_{prefix}")
        second += [F.nullif(rows, F.lit(0)).alias(f"vas_{prefix}txn_num_l1w"), F.sum(f"a_{prefix}").alias(f"vas_{prefix}txn_amt_l1w"),
                   F.nullif(count_where(F.col(f"n_{prefix}") > 0), F.lit(0)).alias(f"vas_{prefix}day_num_l1w")]
        if largest:
            second.append(F.max(f"m_{prefix}").alias(f"vas_{prefix}txn_max_l1w"))
    daily = services.groupBy(PHONE, "date").agg(*first)
    return daily.withColumn("week", week_sunday(F.col("date"))).groupBy(PHONE, "week").agg(*second).withColumnRenamed("week", "date")


def registrations_roll_forward(weekly: DataFrame, snapshot: DateLike, weeks: int) -> DataFrame:
    rules = {}
    for prefix, (_, largest) in REGISTRATIONS.items():
        rules |= {f"vas_{prefix}txn_num": "sum", f"vas_{prefix}txn_amt": "sum", f"vas_{prefix}day_num": "sum"}
        rules |= {f"vas_{prefix}txn_max": "max"} if largest else {}
    return roll_forward(last_weeks(weekly, snapshot, weeks), [PHONE], rules, "l1w", f"l{weeks}w")


def registration_features(services: DataFrame, activated: DataFrame, snapshot: DateLike, days: int = 59) -> DataFrame:
    """Services, charges and amount of the current activation; repeated rows count once."""
    start = as_date(snapshot) - dt.timedelta(days=days)
    own = current_activation(after_until(services, start, snapshot), activated).distinct()
    per_service = own.groupBy(PHONE, "service_name").agg(
        F.count("charge_amount").alias("times"), F.sum("charge_amount").alias("amount"))
    return per_service.groupBy(PHONE).agg(
        F.count("service_name").alias("vas_num_services"), F.sum("times").alias("vas_num_times_charge"),
        F.sum("amount").alias("vas_charge_charge"))
