"""Mobile-data charging: day, week and N-week layers, in two generations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, is_daytime, is_weekend, week_sunday
from sundial.functions.numbers import ratio_or_null
from sundial.operators.aggregates import pivot_sums, sum_where, zero_filled_mean_std
from sundial.operators.columns import fill_missing
from sundial.sources.scans import last_weeks

PHONE = "phone_number"

# First generation: hour of day x weekend

# Hours reported for the 12 and 24 week tables.
HOURS_12W = [4, 6, 7]
HOURS_24W = [0, 1, 5, 6, 7, 8, 9, 10, 12, 19, 20, 21, 22]


def hourly_per_day(charges: DataFrame) -> DataFrame:
    """Volume and session starts per subscriber, day and hour.

    Sessions that share a start time count once: rows go to (…, start time) first, so the three
    distinct counts become flag counts.
    """
    keys = [PHONE, "date", "is_weekend", "hour"]
    timed = charges.withColumns({
        "hour": F.hour("start_time"),
        "is_weekend": F.when(is_weekend(F.col("date")) == 1, "weekend").otherwise("weekday")})
    starts = timed.groupBy(*keys, "start_time").agg(
        F.sum("up_data").alias("up_data"), F.sum("down_data").alias("down_data"),
        F.count("up_data").alias("ups"), F.count("down_data").alias("downs"))
    return starts.groupBy(*keys).agg(
        F.sum("up_data").alias("up_data"), F.sum("down_data").alias("down_data"),
        F.count("start_time").alias("num_time"),
        F.count(F.when(F.col("ups") > 0, F.col("start_time"))).alias("num_time_upload_per_hour"),
        F.count(F.when(F.col("downs") > 0, F.col("start_time"))).alias("num_time_download_per_hour"))


def hourly_per_week(days: DataFrame) -> DataFrame:
    """Week totals per hour and weekend flag; the day table holds one row per day and hour."""
    return days.withColumn("date", week_sunday(F.col("date"))).groupBy(PHONE, "date", "is_weekend", "hour").agg(
        F.sum("up_data").alias("data_charge_updata_hour_l1w"), F.sum("down_data").alias("data_charge_downdata_hour_l1w"),
        F.count(F.lit(1)).alias("data_charge_num_date_per_hour_l1w"), F.sum("num_time").alias("data_charge_num_per_hour_l1w"),
        F.sum("num_time_upload_per_hour").alias("data_charge_num_upload_per_hour_l1w"),
        F.sum("num_time_download_per_hour").alias("data_charge_num_download_per_hour_l1w"))


def hourly_features(weeks: DataFrame, snapshot: DateLike, n: int, hours: list[int], counts: bool) -> DataFrame:
    """Weekly averages at chosen hours, weekday and weekend averages added up."""
    w = f"l{n}w"
    means = last_weeks(weeks, snapshot, n).groupBy(PHONE, "is_weekend", "hour").agg(
        F.avg("data_charge_updata_hour_l1w").alias("up"), F.avg("data_charge_downdata_hour_l1w").alias("down"),
        F.sum("data_charge_num_date_per_hour_l1w").alias("dates"), F.sum("data_charge_num_upload_per_hour_l1w").alias("uploads"))
    columns = {"up": f"data_charge_updata_at_{{}}_per_wk_{w}", "down": f"data_charge_downdata_at_{{}}_{w}"}
    if counts:
        columns |= {"dates": f"data_charge_num_date_at_{{}}_{w}", "uploads": f"data_charge_num_upload_at_{{}}_{w}"}
    return means.groupBy(PHONE).agg(*pivot_sums("hour", hours, columns))


# Second generation: totals, daytime, weekend

def daily_totals(charges: DataFrame) -> DataFrame:
    """One row per subscriber and day."""
    daytime = is_daytime(F.col("start_time"))
    return charges.groupBy(PHONE, "date").agg(
        F.sum("charge_amount").alias("data_amt_charge_total"), F.sum("up_data").alias("data_upload_size"),
        F.sum("down_data").alias("data_download_size"), F.avg("balance_remain").alias("data_blanace_remain_avg"),
        F.size(F.collect_set(F.hour("start_time"))).alias("data_hour_distinct_num"), F.count(F.lit(1)).alias("data_txn_num"),
        F.max("start_time").alias("data_time_end"), F.min("start_time").alias("data_time_start"),
        sum_where(daytime, F.col("charge_amount")).alias("data_amt_charge_daytime_total"),
        sum_where(daytime, F.col("up_data")).alias("data_upload_size_daytime_total"),
        sum_where(daytime, F.col("down_data")).alias("data_download_size_daytime_total"),
        F.count(F.when(daytime, 1)).alias("data_txn_daytime_num"))


# Week columns as (name, function, day column, weekend only).
WEEK_COLUMNS = [
    ("data_amt_charge_total", "sum", "data_amt_charge_total", False),
    ("data_upload_size", "sum", "data_upload_size", False),
    ("data_download_size", "sum", "data_download_size", False),
    ("data_balance_remain_davg", "avg", "data_blanace_remain_avg", False),
    ("data_hour_distinct_num_davg", "avg", "data_hour_distinct_num", False),
    ("data_txn_num", "sum", "data_txn_num", False),
    ("data_usage_time_interval_davg", "avg", "usage_time_interval", False),
    ("data_amt_charge_daytime_total", "sum", "data_amt_charge_daytime_total", False),
    ("data_upload_size_daytime", "sum", "data_upload_size_daytime_total", False),
    ("data_download_size_daytime_total", "sum", "data_download_size_daytime_total", False),
    ("data_txn_daytime_num", "sum", "data_txn_daytime_num", False),
    ("data_amt_charge_weekend_total", "sum", "data_amt_charge_total", True),
    ("data_upload_weekend_size", "sum", "data_upload_size", True),
    ("data_download_weekend_size", "sum", "data_download_size", True),
    ("data_blanace_remain_weekend_avg", "sum", "data_blanace_remain_avg", True),
    ("data_hour_distinct_weekend_num_davg", "avg", "data_hour_distinct_num", True),
    ("data_txn_weekend_num", "sum", "data_txn_num", True),
    ("data_usage_time_interval_weekend_davg", "avg", "usage_time_interval", True),
    ("data_amt_charge_daytime_weekend_total", "sum", "data_amt_charge_daytime_total", True),
    ("data_upload_size_daytime_weekend_total", "sum", "data_upload_size_daytime_total", True),
    ("data_download_size_daytime_weekend_total", "sum", "data_download_size_daytime_total", True),
    ("data_txn_weekend_daytime_num", "sum", "data_txn_daytime_num", True),
    ("data_active_day_num", "active", "data_txn_num", False),
    ("data_upload_daytime_vs_wholeday_size_davg", "avg", "data_upload_daytime_vs_wholeday_size", False),
    ("data_download_daytime_vs_wholeday_size_davg", "avg", "data_download_daytime_vs_wholeday_size", False),
    ("data_daytime_vs_wholeday_size_davg", "avg", "data_daytime_vs_wholeday_size", False),
    ("data_upload_vs_download_size_davg", "avg", "data_upload_vs_download_size", False),
]


def weekly_totals(days: DataFrame) -> DataFrame:
    """Week columns from finished days; missing amounts count as 0, undefined ratios stay out."""
    filled = fill_missing(days, 0, keys=[PHONE])
    up, down = F.col("data_upload_size"), F.col("data_download_size")
    up_day, down_day = F.col("data_upload_size_daytime_total"), F.col("data_download_size_daytime_total")
    ready = filled.withColumns({
        "weekend": is_weekend(F.col("date")) == 1,
        "usage_time_interval": F.unix_timestamp("data_time_end") - F.unix_timestamp("data_time_start"),
        "data_upload_vs_download_size": ratio_or_null(up, down),
        "data_upload_daytime_vs_wholeday_size": ratio_or_null(up_day, up),
        "data_download_daytime_vs_wholeday_size": ratio_or_null(down_day, down),
        "data_daytime_vs_wholeday_size": ratio_or_null(down_day + up_day, down + up)})
    functions = {"sum": F.sum, "avg": F.avg, "active": lambda c: F.count(F.when(c >= 1, True))}
    aggregates = []
    for name, function, column, weekend in WEEK_COLUMNS:
        value = F.when(F.col("weekend"), F.col(column)) if weekend else F.col(column)
        aggregates.append(functions[function](value).alias(f"{name}_l1w"))
    return ready.withColumn("date", week_sunday(F.col("date"))).groupBy(PHONE, "date").agg(*aggregates)


# N-week names as (week column, mean name, deviation name).
PERIOD_NAMES = [
    ("data_amt_charge_total", "data_amt_charge_total_wavg", "data_amt_charge_total_wstd"),
    ("data_upload_size", "data_upload_size_wavg", "data_upload_size_wstd"),
    ("data_download_size", "data_download_size_wavg", "data_download_size_wstd"),
    ("data_balance_remain_davg", "data_balance_remain_davg", "data_balance_remain_wstd"),
    ("data_hour_distinct_num_davg", "data_hour_distinct_num_davg", "data_hour_distinct_num_wstd"),
    ("data_txn_num", "data_txn_num_davg", "data_txn_num_wstd"),
    ("data_usage_time_interval_davg", "data_usage_time_interval_davg", "data_usage_time_interval_wstd"),
    ("data_amt_charge_daytime_total", "data_amt_charge_daytime_total_wavg", "data_amt_charge_daytime_total_wstd"),
    ("data_upload_size_daytime", "data_upload_daytime_size_wavg", "data_upload_daytime_size_wstd"),
    ("data_download_size_daytime_total", "data_download_size_daytime_size_wavg", "data_download_size_daytime_wstd"),
    ("data_txn_daytime_num", "data_txn_daytime_num_wavg", "data_txn_daytime_num_wstd"),
    ("data_amt_charge_weekend_total", "data_amt_charge_weekend_total_wavg", "data_amt_charge_weekend_total_wstd"),
    ("data_upload_weekend_size", "data_upload_weekend_size_wavg", "data_upload_weekend_size_wstd"),
    ("data_download_weekend_size", "data_download_weekend_size_wavg", "data_download_weekend_size_wstd"),
    ("data_blanace_remain_weekend_avg", "data_blanace_remain_weekend_avg_total_wavg", "data_blanace_remain_weekend_avg_total_wstd"),
    ("data_hour_distinct_weekend_num_davg", "data_hour_distinct_weekend_num_davg", "data_hour_distinct_weekend_num_wstd"),
    ("data_txn_weekend_num", "data_txn_weekend_num_wavg", "data_txn_weekend_num_wstd"),
    ("data_usage_time_interval_weekend_davg", "usage_time_interval_weekend_davg", "data_usage_time_interval_weekend_wstd"),
    ("data_amt_charge_daytime_weekend_total", "data_amt_charge_daytime_weekend_total_wavq", "data_amt_charge_daytime_weekend_total_wstd"),
    ("data_upload_size_daytime_weekend_total", "data_upload_size_daytime_weekend_total_wavg", "data_upload_size_daytime_weekend_total_wstd"),
    ("data_download_size_daytime_weekend_total", "data_download_size_daytime_weekend_total_wavq", "data_download_size_daytime_weekend_total_wstd"),
    ("data_txn_weekend_daytime_num", "data_txn_daytime_weekend_num_wavg", "data_txn_daytime_weekend_num_wstd"),
    ("data_active_day_num", "data_active_day_num_wavg", "data_active_day_num_wstd"),
    ("data_upload_daytime_vs_wholeday_size_davg", "data_upload_daytime_vs_wholeday_size_davg", "data_upload_daytime_vs_wholeday_size_wstd"),
    ("data_download_daytime_vs_wholeday_size_davg", "data_download_daytime_vs_wholeday_size_davg", "data_download_daytime_vs_wholeday_size_wstd"),
    ("data_daytime_vs_wholeday_size_davg", "data_daytime_vs_wholeday_size_davg", "data_daytime_vs_wholeday_size_wstd"),
    ("data_upload_vs_download_size_davg", "data_upload_vs_download_size_davg", "data_upload_vs_download_size_wstd"),
]


def period_features(weeks: DataFrame, snapshot: DateLike, n: int) -> DataFrame:
    """Mean and deviation over exactly n weeks; a week without traffic counts as 0."""
    names = {f"{c}_l1w": (f"{mean}_l{n}w", f"{std}_l{n}w") for c, mean, std in PERIOD_NAMES}
    return zero_filled_mean_std(last_weeks(weeks, snapshot, n), [PHONE], names, n)
