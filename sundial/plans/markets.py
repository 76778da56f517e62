"""Asset risk and macro indicator features at Sunday snapshots; all series in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sundial.functions.dates import month_label
from sundial.operators.joins import last_days_per_sunday
from sundial.operators.sequences import change_rate, forward_fill, growth
from sundial.sources.scans import calendar

# Fixed values.
WINDOWS = (1, 4, 24)
PAIRS = ((1, 4), (4, 24))
GROWTH_STEPS = (4, 12, 52)
TRADING_DAYS = {"btc": 365}
USUAL_TRADING_DAYS = 252
VAR_LEVEL = 0.05
KEPT_4W = ["return_sharpe", "first_close", "distance_to_low", "return_cvar95", "price_return", "return_max",
           "return_std", "return_min", "price_max"]
KEPT_24W = ["distance_to_high", "return_max", "std_close", "volume_skew", "price_percentile", "volume_max",
            "volume_std", "max_drawdown"]
KEPT_PAIRS = ["return_mean_ratio", "volume_diff", "vol_ratio", "vol_diff", "sharpe_diff"]


def daily_returns(prices: DataFrame) -> DataFrame:
    """Prices on a dense daily calendar per ticker, with the change against the day before."""
    dense = calendar(prices, keys=["ticker"]).join(prices, ["ticker", "date"], "left")
    return dense.withColumn("daily_return", change_rate("close", ["ticker"], "date"))


def asset_features(prices: DataFrame, windows: tuple[int, ...] = WINDOWS, accuracy: int = 10_000) -> DataFrame:
    """Level, drawdown, value at risk, return and volume moments per ticker and Sunday.

    Each day is sent to the Sundays whose longest window holds it, and every window is a condition
    inside one aggregate over (ticker, Sunday).
    """
    daily = daily_returns(prices)
    last = daily.groupBy("ticker").agg(F.max("date").alias("__last"))
    days = last_days_per_sunday(daily, max(windows)).join(last, "ticker").filter("snap <= __last").drop("__last")
    until_now = Window.partitionBy("ticker", "snap").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    inside = {n: F.col("date") > F.date_sub("snap", 7 * n) for n in windows}
    days = days.withColumns({f"__peak_{n}": F.max(F.when(test, F.col("close"))).over(until_now) for n, test in inside.items()})
    rows = days.groupBy("ticker", "snap").agg(*[a for n, test in inside.items() for a in _window_aggregates(n, test, accuracy)])
    risk = rows.select("ticker", "snap", *[f"return_var95_l{n}w" for n in windows])
    tail = days.select("ticker", "snap", "date", "daily_return").join(risk, ["ticker", "snap"]).groupBy("ticker", "snap").agg(*[
        F.avg(F.when(test & (F.col("daily_return") <= F.col(f"return_var95_l{n}w")), F.col("daily_return"))).alias(f"return_cvar95_l{n}w")
        for n, test in inside.items()])
    features = rows.join(tail, ["ticker", "snap"])
    return _with_growth(_with_pairs(_with_derived(features, windows)), windows)


def _window_aggregates(n: int, inside: Column, accuracy: int) -> list[Column]:
    w = f"l{n}w"
    close, change, volume = (F.when(inside, F.col(c)) for c in ("close", "daily_return", "volume"))
    priced = F.when(inside & F.col("close").isNotNull(), F.col("date"))
    return [
        F.max_by("close", priced).alias(f"last_close_{w}"), F.min_by("close", priced).alias(f"first_close_{w}"),
        F.stddev(close).alias(f"std_close_{w}"),
        F.min(F.try_divide(close, F.col(f"__peak_{n}")) - 1).alias(f"max_drawdown_{w}"),
        F.percentile_approx(change, VAR_LEVEL, accuracy).alias(f"return_var95_{w}"),
        F.avg(change).alias(f"return_mean_{w}"), F.stddev(change).alias(f"return_std_{w}"),
        F.min(change).alias(f"return_min_{w}"), F.max(change).alias(f"return_max_{w}"),
        F.avg(volume).alias(f"volume_mean_{w}"), F.stddev(volume).alias(f"volume_std_{w}"),
        F.skewness(volume).alias(f"volume_skew_{w}"), F.max(volume).alias(f"volume_max_{w}"),
        F.min(close).alias(f"price_min_{w}"), F.max(close).alias(f"price_max_{w}")]


def _with_derived(df: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    days = F.lit(float(USUAL_TRADING_DAYS))
    for ticker, count in TRADING_DAYS.items():
        days = F.when(F.col("ticker") == ticker, float(count)).otherwise(days)
    columns = {}
    for n in windows:
        def c(name: str) -> Column:
            return F.col(f"{name}_l{n}w")

        low, high, newest = c("price_min"), c("price_max"), c("last_close")
        columns |= {
            f"distance_to_high_l{n}w": F.try_divide(newest, high) - 1,
            f"distance_to_low_l{n}w": F.when(low > 0, F.try_divide(newest, low) - 1),
            f"price_percentile_l{n}w": F.when(high != low, F.try_divide(newest - low, high - low)),
            f"price_return_l{n}w": F.try_divide(newest, c("first_close")) - 1,
            f"return_sharpe_l{n}w": F.when(c("return_std") != 0, F.try_divide(c("return_mean"), c("return_std")) * F.sqrt(days))}
    return df.withColumns(columns)


def _with_pairs(df: DataFrame) -> DataFrame:
    columns = {}
    for a, b in PAIRS:
        def both(name: str, a=a, b=b) -> tuple[Column, Column]:
            return F.col(f"{name}_l{a}w"), F.col(f"{name}_l{b}w")

        for name, source in (("vol_diff", "return_std"), ("sharpe_diff", "return_sharpe"), ("volume_diff", "volume_mean")):
            short, long = both(source)
            columns[f"{name}_l{a}w_l{b}w"] = short - long
        for name, source in (("vol_ratio", "return_std"), ("return_mean_ratio", "return_mean")):
            short, long = both(source)
            columns[f"{name}_l{a}w_l{b}w"] = F.when(long != 0, F.try_divide(short, long))
    return df.withColumns(columns)


def _with_growth(df: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    return df.withColumns({
        f"price_circle_growth_l{n}w_c{k}w": growth(f"last_close_l{n}w", ["ticker"], "snap", k)
        for n in windows for k in GROWTH_STEPS})


def published_asset_columns(df: DataFrame) -> DataFrame:
    """The columns kept for modelling."""
    kept = [f"{c}_l4w" for c in KEPT_4W] + [f"{c}_l24w" for c in KEPT_24W] + [f"{c}_l4w_l24w" for c in KEPT_PAIRS]
    kept += [f"price_circle_growth_l{n}w_c{k}w" for n in WINDOWS for k in GROWTH_STEPS]
    return df.select("ticker", "snap", *[c for c in df.columns if c in kept])


def indicator_features(monthly: DataFrame, by_month: bool = False) -> DataFrame:
    """An indicator at every Sunday, and its growth over 4, 12 and 52 Sundays.

    The value is carried forward along a daily calendar, or taken from the Sunday's own month.
    """
    unique = monthly.dropDuplicates(["indicator", "date"]).select("indicator", "date", "percentage")
    if by_month:
        sundays = calendar(unique, keys=["indicator"], sundays=True, name="snap").withColumn("__month", month_label(F.col("snap")))
        months = unique.select("indicator", month_label(F.col("date")).alias("__month"), F.col("percentage").alias("value"))
        weekly = sundays.join(months, ["indicator", "__month"]).drop("__month")
    else:
        dense = calendar(unique, keys=["indicator"]).join(unique, ["indicator", "date"], "left")
        filled = forward_fill(dense, ["indicator"], "date", ["percentage"])
        weekly = filled.filter(F.dayofweek("date") == 1).select("indicator", F.col("date").alias("snap"), F.col("percentage").alias("value"))
    return weekly.withColumns({f"circle_growth_c{k}w": growth("value", ["indicator"], "snap", k) for k in GROWTH_STEPS})


def one_row_per_snapshot(df: DataFrame, series: str, names: list[str]) -> DataFrame:
    """Series side by side, `<series>_<column>`, one row per snapshot date."""
    columns = [c for c in df.columns if c not in (series, "snap")]
    return df.groupBy(F.col("snap").alias("date")).agg(*[
        F.max(F.when(F.col(series) == name, F.col(c))).alias(f"{name}_{c}") for name in names for c in columns])


