"""Recharge families of both operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, as_date
from sundial.functions.numbers import smoothed_ratio
from sundial.operators.aggregates import Bucket, bucket_counts, bucket_shares, busy_days
from sundial.operators.columns import fill_missing
from sundial.operators.joins import current_activation, lookup
from sundial.operators.windows import LookBack, last, outer_bound
from sundial.session import cut_lineage
from sundial.sources.scans import after_until, on_day

PHONE = "phone_number"
# Balance before the recharge, and recharged amount.
BEFORE_BUCKETS = [Bucket("lt_1k", high=1_000), Bucket("lt_10k", high=10_000), Bucket("10k_20k", 10_000, 20_000),
                  Bucket("20k_50k", 20_000, 50_000), Bucket("gt_50k", 50_000)]
AMOUNT_BUCKETS = [Bucket("lt_10k", high=10_000), Bucket("amount_10k_20k", 10_000, 20_000, True, True),
                  Bucket("amount_20k_50k", 20_000, 50_000, False, True),
                  Bucket("amount_50k_100k", 50_000, 100_000, False, True), Bucket("amount_gt_100k", 100_000, None, False)]
# Columns whose short and long windows are compared.
COMPARED = ["recharge_amount_total", "recharge_count", "recharge_amount_avg", "recharge_day_count",
            "recharge_prebal_lt_1k_count", "recharge_prebal_lt_10k_count", "recharge_prebal_10k_20k_count",
            "recharge_prebal_20k_50k_count", "recharge_prebal_gt_50k_count", "recharge_lt_10k_count",
            "recharge_amount_10k_20k_count", "recharge_amount_20k_50k_count", "recharge_amount_50k_100k_count",
            "recharge_amount_gt_100k_count", "recharge_promote_amount_total", "recharge_promote_count"]
PROMOTION_ROWS = 3_000_000
METHODS = {"v": "V", "c": "C"}


def daily_recharges(recharges: DataFrame, methods: bool) -> DataFrame:
    """One row per subscriber and day with everything the windows add up."""
    amount, before = F.col("recharge_amount"), F.col("pre_balance")
    sums = [F.sum(amount).alias("amount"), F.count(amount).alias("rows")]
    sums += bucket_counts(before, BEFORE_BUCKETS, "prebal_{}")
    sums += bucket_counts(amount, AMOUNT_BUCKETS, "{}")
    if methods:
        for name, code in METHODS.items():
            own = F.col("trade_method") == code
            sums += [F.sum(F.when(own, amount)).alias(f"amount_{name}"), F.count(F.when(own, 1)).alias(f"rows_{name}")]
        sums.append(F.collect_set("trade_method").alias("methods"))
    return recharges.groupBy(PHONE, "date").agg(*sums)


def _window_columns(window: LookBack, snapshot: DateLike, methods: bool) -> list[Column]:
    inside, w = window.sql("date", snapshot), window.name

    def total(column: str, test: str = "") -> str:
        return f"coalesce(sum(`{column}`) FILTER (WHERE {inside}{test}), 0)"

    def percent(part: str, whole: str) -> str:
        return f"try_divide(CAST({part} AS DOUBLE), {whole}) * 100D"

    rows, amount = total("rows"), total("amount")
    columns = {"amount_total": amount, "count": rows, "amount_avg": f"try_divide({amount}, {rows})", "day_count": f"count(date) FILTER (WHERE {inside})"}
    for name in [f"prebal_{b.name}" for b in BEFORE_BUCKETS] + [b.name for b in AMOUNT_BUCKETS]:
        columns |= {f"{name}_pct": percent(total(name), rows), f"{name}_count": total(name)}
    promoted, promoted_amount = total("rows", " AND is_promote"), total("amount", " AND is_promote")
    columns |= {"promote_amount_total": promoted_amount, "promote_count": promoted,
                "promote_amount_pct": percent(promoted_amount, amount), "promote_count_pct": percent(promoted, rows)}
    if methods:
        for name in METHODS:
            columns |= {f"amount_{name}_total": total(f"amount_{name}"), f"count_{name}": total(f"rows_{name}")}
        columns |= {"count_v_pct": percent(total("rows_v"), rows), "amount_v_pct": percent(total("amount_v"), amount),
                    "method_count": f"size(array_distinct(flatten(collect_set(methods) FILTER (WHERE {inside}))))"}
    return [F.expr(f"{value} AS `recharge_{name}_{w}`") for name, value in columns.items()]


def recharge_features(recharges: DataFrame, snapshot: DateLike, months: tuple[int, ...] = (3, 6, 12),
                      compare: tuple[int, int] = (3, 12), methods: bool = True, promotion_days: DataFrame | None = None,
                      promotion_rows: int = PROMOTION_ROWS, smoothing: float = 0.0001) -> DataFrame:
    """Totals, method split, bucket shares, promotion share and short/long ratios for all windows.

    Rows go to subscriber-days first, then all windows are taken in one aggregate; days need no
    distinct count any more. Promotion days are the days with unusually many recharges, read off
    the same (kept) daily table unless a list is given; that list has one row per calendar day.
    """
    windows = last(*months, unit="m")
    source = after_until(recharges.filter("recharge_amount > 0"), outer_bound(windows, snapshot), snapshot)
    daily = daily_recharges(source, methods)
    if promotion_days is None:
        daily = cut_lineage(daily)
        per_day = daily.groupBy("date").agg(F.sum("rows").alias("__rows"))
        promotion_days = per_day.filter(F.col("__rows") >= promotion_rows)
    marked = lookup(daily, promotion_days.select("date", F.lit(True).alias("is_promote")), "date")
    marked = marked.fillna(False, subset=["is_promote"])
    columns = [c for w in windows for c in _window_columns(w, snapshot, methods)]
    features = fill_missing(marked.groupBy(PHONE).agg(*columns), 0, keys=[PHONE])
    short, long = (f"l{m}m" for m in compare)
    ratios = {f"{c}_{short}_vs_{long}": smoothed_ratio(F.col(f"{c}_{short}"), F.col(f"{c}_{long}"), smoothing, smoothing)
              for c in COMPARED}
    return features.withColumns(ratios)


def recharges_with_balance(recharges: DataFrame, balances: DataFrame, snapshot: DateLike) -> DataFrame:
    """A day's recharges with the subscriber's usable balance of that day."""
    from sundial.operators.joins import present_in
    from sundial.plans.balances import usable_accounts

    day = on_day(recharges, snapshot)
    usable = usable_accounts(present_in(on_day(balances, snapshot), day, [PHONE]))
    before = usable.groupBy(PHONE).agg(F.sum("balance").alias("pre_balance"))
    return day.join(before, PHONE, "left")


# Amount classes; the second starts at 10 000 so that no amount is left out.
AIR_BUCKETS = [Bucket("le_10k", high=10_000), Bucket("gt_10k_le_20k", 10_000, 20_000, True, True),
               Bucket("gt_20k_le_50k", 20_000, 50_000, False, True),
               Bucket("gt_50k_le_100k", 50_000, 100_000, False, True), Bucket("gt_100k", 100_000, None, False)]


def promotion_calendar(recharges: DataFrame, more_than: int = 1_000_000) -> DataFrame:
    """Days with more than so many recharges."""
    dated = recharges.select(F.to_date("recharge_time").alias("date"))
    return busy_days(dated, more_than, strict=True)


def recharge_shares(recharges: DataFrame, activated: DataFrame, promotion_days: DataFrame, snapshot: DateLike,
                    days: int = 59) -> DataFrame:
    """Amount classes and promotion-day shares over the last days."""
    start = as_date(snapshot) - dt.timedelta(days=days)
    rows = after_until(recharges.filter("recharge_amount > 0"), start, snapshot)
    own = current_activation(rows, activated, date="recharge_time").distinct()
    marked = lookup(own, promotion_days.select("date", F.lit(True).alias("is_promote")), "date")
    promoted = F.coalesce("is_promote", F.lit(False))
    amount = F.col("recharge_amount")
    features = marked.groupBy(PHONE).agg(
        *bucket_shares(amount, AIR_BUCKETS, "air_pct_{}"),
        F.sum(amount).alias("air_total_recharge_amount"), F.count(amount).alias("air_total_recharge_times"),
        F.sum(F.when(promoted, amount)).alias("air_promo_recharge_amount"),
        F.count(F.when(promoted, amount)).alias("air_promo_recharge_times"))
    features = fill_missing(features, 0, keys=[PHONE])
    return features.withColumns({
        f"air_pct_{name}_recharge_promo": smoothed_ratio(
            F.col(f"air_promo_recharge_{name}"), F.col(f"air_total_recharge_{name}"), 0.0, 0.01)
        for name in ("amount", "times")})
