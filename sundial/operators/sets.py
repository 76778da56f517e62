"""Set overlap, share and shape statistics built from windowed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.operators.windows import previous_span, split_window


def overlap_ratio(current: Column, history: Column, digits: int = 6) -> Column:
    """|current and history| / |current or history|, 0 when both are empty."""
    return _set_ratio(F.array_intersect(current, history), current, history, digits)


def novelty_ratio(current: Column, history: Column, digits: int = 6) -> Column:
    """|current without history| / |current or history|, 0 when both are empty."""
    return _set_ratio(F.array_except(current, history), current, history, digits)


def _set_ratio(part: Column, current: Column, history: Column, digits: int) -> Column:
    share = F.try_divide(F.size(part).cast("double"), F.size(F.array_union(current, history)))
    return F.round(F.coalesce(share, F.lit(0.0)), digits)


def set_ratio_columns(columns: list[str]) -> list[Column]:
    """Overlap and novelty of every `<base>_l<N>w` set against the span before it."""
    result = []
    for label, ratio in (("intersection_ratio", overlap_ratio), ("except_ratio", novelty_ratio)):
        for column in columns:
            parts = split_window(column)
            if parts and previous_span(column) in columns:
                value = ratio(F.col(column), F.col(previous_span(column)))
                result.append(value.alias(f"{parts[0]}_{label}_{parts[1]}"))
    return result


def entropy(column: str, digits: int = 6) -> Column:
    """Entropy in bits of the shares x / sum(x) inside a group.

    With S = sum(x) it equals log2(S) - sum(x * log2(x)) / S, so two sums are enough: no window
    over the group and full map-side combining, however large one group is.
    """
    x = f"CAST({column} AS DOUBLE)"
    total, weighted = f"sum({x})", f"sum(CASE WHEN {x} > 0 THEN {x} * log2({x}) ELSE 0D END)"
    bits = f"CASE WHEN {total} > 0 THEN log2({total}) - {weighted} / {total} ELSE 0D END"
    return F.expr(f"round(coalesce({bits}, 0D), {digits}) + 0D")


# SQL aggregates by the statistic's name in a column.
STATISTICS = {"min": "min", "max": "max", "avg": "avg", "std": "stddev", "skewness": "skewness", "kurtosis": "kurtosis", "sum": "sum"}


def statistic_columns(columns: list[str], statistics: dict[str, list[str]]) -> list[Column]:
    """Aggregates `<base>_<statistic>_<window>` over windowed columns.

    `statistics` maps a statistic to the name parts it leaves out; span windows are skipped.
    """
    result = []
    for name, excluded in statistics.items():
        for column in columns:
            parts = split_window(column)
            if parts is None or any(part in column for part in excluded):
                continue
            value = entropy(column) if name == "entropy" else F.expr(f"{STATISTICS[name]}({column})")
            result.append(value.alias(f"{parts[0]}_{name}_{parts[1]}"))
    return result


def share_of_total(df: DataFrame, column: str, keys: list[str], alias: str) -> DataFrame:
    """Each row's part of its group's total, from a pre-aggregated total joined back."""
    totals = df.groupBy(*keys).agg(F.sum(column).alias("__total"))
    share = F.try_divide(F.col(column).cast("double"), F.col("__total").cast("double"))
    return df.join(totals, keys).withColumn(alias, share).drop("__total")
