"""Balance families of both operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, as_date, week_sunday
from sundial.functions.numbers import scaled_sum
from sundial.operators.aggregates import Bucket, bucket_shares, roll_forward
from sundial.operators.columns import fill_missing
from sundial.operators.joins import current_activation, lookup
from sundial.sources.scans import after_until, last_weeks

PHONE = "phone_number"
SCALE = 10_000.0
# Promotional accounts.
PROMO_ACCOUNTS = [f"BAL_{n}" for n in (10, 11, 12, 13, 15, 14, 16, 17, 18, 21, 22, 24, 25, 38, 34, 45, 46)]
# Day-balance classes.
DAY_BUCKETS = [
    Bucket("lt_1k", 0, 1_000, False), Bucket("lt_5k", 0, 5_000, False), Bucket("lt_10k", 0, 10_000, False),
    Bucket("zero", 0, 0, True, True), Bucket("1k_to_5k", 1_000, 5_000), Bucket("5k_to_10k", 5_000, 10_000),
    Bucket("10k_to_20k", 10_000, 20_000), Bucket("20k_to_50k", 20_000, 50_000),
    Bucket("50k_to_100k", 50_000, 100_000), Bucket("ge_100k", 100_000)]


def _day_statistics(column: str, prefix: str) -> list[Column]:
    return [F.avg(column).alias(f"{prefix}_avg_per_day"), F.max(column).alias(f"{prefix}_max_per_day"),
            F.stddev(column).alias(f"{prefix}_sd_per_day"),
            *bucket_shares(F.col(column), DAY_BUCKETS, f"{prefix}_pct_day_{{}}")]


def balance_features(balances: DataFrame, snapshot: DateLike, days: int = 60, collapse_equal_days: bool = False) -> DataFrame:
    """Main and promotional balance over the last days: level, spread and day shares per class.

    With `collapse_equal_days` days with the same two balances count once.
    """
    start = as_date(snapshot) - dt.timedelta(days=days)
    rows = after_until(balances, start, snapshot).select(
        PHONE, "date", (F.col("BAL_1") / SCALE).alias("balance"), scaled_sum(PROMO_ACCOUNTS, SCALE).alias("balance_promo"))
    daily = rows.filter("balance >= 0").groupBy(PHONE, "date").agg(
        F.sum("balance").alias("balance"), F.sum("balance_promo").alias("balance_promo"))
    if collapse_equal_days:
        daily = daily.select(PHONE, "balance", "balance_promo").distinct()
    features = daily.groupBy(PHONE).agg(*_day_statistics("balance", "balance"), *_day_statistics("balance_promo", "balance_promo"))
    return fill_missing(features, 0, keys=[PHONE])


def usable_accounts(balances: DataFrame) -> DataFrame:
    """Accounts that count as money: no '3...' account, none with '142', no negative balance."""
    code = F.col("account_code")
    return balances.filter(~code.startswith("3") & ~code.contains("142") & (F.col("balance") >= 0))


def usable_balance_features(balances: DataFrame, activated: DataFrame, snapshot: DateLike, days: int = 59) -> DataFrame:
    """Day balance over usable accounts of the current activation."""
    start = as_date(snapshot) - dt.timedelta(days=days)
    rows = usable_accounts(after_until(balances.select(PHONE, "balance", "date", "account_code"), start, snapshot))
    daily = rows.groupBy(PHONE, "date").agg(F.sum("balance").alias("balance"))
    own = current_activation(daily, activated, bounded=True)
    return fill_missing(own.groupBy(PHONE).agg(*_day_statistics("balance", "balance")), 0, keys=[PHONE])


# Thresholds of the day counts, by billing type and whether only the main account counts.
PREPAID_LIMITS = {"leq5k": 5_000, "leq10k": 10_000, "leq20k": 20_000, "leq50k": 50_000, "leq100k": 100_000}
MAIN_ONLY_LIMITS = {"leq200k": 200_000}
POSTPAID_LIMITS = {"gt0": 0, "geq_5k": -5_000, "geq_10k": -10_000, "geq_20k": -20_000, "geq_50k": -50_000,
                   "geq_100k": -100_000, "geq_200k": -200_000, "geq_500k": -500_000, "geq_1000k": -1_000_000}
BILLING = {"pre": "PRE", "post": "POST"}


def _day_counts(kind: str, low: str, high: str, zero: str, main: bool) -> dict[str, Column]:
    """Day-count conditions on a subscriber-day's smallest and largest balance."""
    if kind == "pre":
        limits = PREPAID_LIMITS | (MAIN_ONLY_LIMITS if main else {})
        return {"zero": F.col(zero)} | {name: F.col(low) <= limit for name, limit in limits.items()}
    return {name: F.col(high) >= limit for name, limit in POSTPAID_LIMITS.items()}


def balance_weekly(balances: DataFrame, subscribers: DataFrame, snapshot: DateLike, weeks: int = 1) -> DataFrame:
    """Per subscriber and week: balance level and threshold days, over all and over main accounts.

    A day meets "some balance <= limit" exactly when its smallest balance does, so distinct days
    become plain counts over subscriber-days. Columns of the other billing type stay null.
    """
    rows = lookup(last_weeks(balances, snapshot, weeks), subscribers.select(PHONE, "billing_type"), PHONE, "inner")
    rows = rows.withColumn("week", week_sunday(F.col("date")))
    keys = [PHONE, "week"]
    main = F.when(F.col("account_code") == "0", F.col("balance"))
    daily = rows.groupBy(*keys, "billing_type", "date").agg(
        F.sum("balance").alias("all"), F.min(main).alias("low"), F.max(main).alias("high"),
        F.max(main == 0).alias("zero"), F.count(main).alias("n"))
    daily = daily.withColumn("all_zero", F.col("all") == 0)
    aggregates = []
    for kind, code in BILLING.items():
        own = F.col("billing_type") == code
        is_kind = F.max(own)
        total = F.when(own, F.col("all"))
        prefix = f"balance_{kind}"
        aggregates += [F.min(total).alias(f"{prefix}_amt_min_l1w"), F.avg(total).alias(f"{prefix}_amt_avg_l1w"),
                       F.max(total).alias(f"{prefix}_amt_max_l1w"), F.stddev(total).alias(f"{prefix}_amt_std_l1w")]
        for name, test in _day_counts(kind, "all", "all", "all_zero", False).items():
            aggregates.append(F.when(is_kind, F.count(F.when(own & test, 1))).alias(f"{prefix}_{name}_day_num_l1w"))
        has_main = F.sum(F.when(own, F.col("n"))) > 0
        for name, test in _day_counts(kind, "low", "high", "zero", True).items():
            aggregates.append(F.when(has_main, F.count(F.when(own & test, 1))).alias(f"{prefix}_main_{name}_day_num_l1w"))
    days = daily.groupBy(*keys).agg(*aggregates)
    levels = []
    for kind, code in BILLING.items():
        own = F.when(F.col("billing_type") == code, main)
        levels += [F.min(own).alias(f"balance_{kind}_main_amt_min_l1w"), F.avg(own).alias(f"balance_{kind}_main_amt_avg_l1w"),
                   F.max(own).alias(f"balance_{kind}_main_amt_max_l1w"), F.stddev(own).alias(f"balance_{kind}_main_amt_std_l1w")]
    return days.join(rows.groupBy(*keys).agg(*levels), keys).withColumnRenamed("week", "date")


def balance_roll_forward(weekly: DataFrame, snapshot: DateLike, weeks: int) -> DataFrame:
    """Several weeks from finished weeks: min of min, max of max, mean of means, sums of days."""
    rules = {}
    for kind in BILLING:
        for scope, main in ((f"balance_{kind}", False), (f"balance_{kind}_main", True)):
            rules |= {f"{scope}_amt_min": "min", f"{scope}_amt_avg": "avg", f"{scope}_amt_max": "max"}
            rules |= {f"{scope}_{name}_day_num": "sum" for name in _day_counts(kind, "all", "all", "all", main)}
    return roll_forward(last_weeks(weekly, snapshot, weeks), [PHONE], rules, "l1w", f"l{weeks}w")
