"""Grouped aggregates generated from short specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.functions.numbers import flag, in_range
from sundial.session import cut_lineage


@dataclass(frozen=True)
class Bucket:
    """A named value range; ends are open or closed as stated."""

    name: str
    low: float | None = None
    high: float | None = None
    low_closed: bool = True
    high_closed: bool = False

    def test(self, column: Column) -> Column:
        return in_range(column, self.low, self.high, self.low_closed, self.high_closed)


def bucket_shares(column: Column, buckets: list[Bucket], alias: str, scale: float = 1.0) -> list[Column]:
    """Share of rows per bucket; `alias` is a template with `{}` for the bucket name."""
    return [(F.avg(flag(b.test(column))) * F.lit(scale)).alias(alias.format(b.name)) for b in buckets]


def bucket_counts(column: Column, buckets: list[Bucket], alias: str) -> list[Column]:
    return [F.sum(flag(b.test(column))).alias(alias.format(b.name)) for b in buckets]


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def pivot_sums(key: str, values: list, columns: dict[str, str]) -> list[Column]:
    """Sum of each column at each known key value; alias templates carry `{}` for the value."""
    return [
        F.sum(F.when(F.col(key) == value, F.col(column))).alias(alias.format(value))
        for column, alias in columns.items() for value in values
    ]


def pre_aggregate(df: DataFrame, keys: list[str], grain: list[str], aggregates: list[Column]) -> DataFrame:
    """Bring raw rows to a finer grain first, so a hot key is spread over its grain values."""
    return df.groupBy(*keys, *grain).agg(*aggregates)


def roll_forward(df: DataFrame, keys: list[str], rules: dict[str, str], old: str, new: str) -> DataFrame:
    """Combine finished periods into a longer one: sum of sums, max of max, avg of avg, min of min.

    `rules` maps a column base to its function; columns go from `<base>_<old>` to `<base>_<new>`.
    """
    functions = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "std": F.stddev}
    return df.groupBy(*keys).agg(
        *[functions[rule](f"{base}_{old}").alias(f"{base}_{new}") for base, rule in rules.items()]
    )


def zero_filled_mean_std(df: DataFrame, keys: list[str], columns: dict[str, tuple[str | None, str | None]],
                         periods: int) -> DataFrame:
    """Mean and sample deviation over exactly `periods` periods, absent ones counting as 0.

    Written as sums: mean = S / n and variance = (Q - S * S / n) / (n - 1) around the group's own
    mean of present values, which avoids the key x period grid. `columns` maps a column to its
    mean and deviation names (either may be none). Each key must have at most one row per period.
    """
    aggregates, results = [], []
    n = float(periods)
    for column, (mean, std) in columns.items():
        x = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
        aggregates += [
            F.count(F.lit(1)).alias("__n"), F.avg(x).alias(f"__m_{column}"), F.var_pop(x).alias(f"__v_{column}"),
        ]
        seen = F.col("__n").cast("double")
        average = F.col(f"__m_{column}") * seen / n
        if mean:
            results.append(average.alias(mean))
        if std:
            inside = seen * F.col(f"__v_{column}")
            between = seen * F.pow(F.col(f"__m_{column}") - average, 2) + (F.lit(n) - seen) * F.pow(average, 2)
            results.append(F.sqrt(F.try_divide(inside + between, F.lit(n - 1.0))).alias(std))
    unique = {str(a): a for a in aggregates}.values()
    return df.groupBy(*keys).agg(*unique).select(*keys, *results)


def two_levels(df: DataFrame, outer: str, inner: str, aggregates: list[Column],
               names: dict[str, tuple[str, str]]) -> DataFrame:
    """Inner-level rows with their outer-level subtotal beside them.

    One grouping-sets aggregate is computed once and kept, as both levels are read from it; `names` maps an
    aggregate to its inner and outer column names. The grand total of a full rollup is not computed.
    """
    both = cut_lineage(df.groupingSets([[outer, inner], [outer]], outer, inner).agg(
        F.grouping(inner).alias("__subtotal"), *aggregates
    ))
    details = both.filter("__subtotal = 0").select(
        outer, inner, *[F.col(c).alias(new) for c, (new, _) in names.items()])
    subtotals = both.filter("__subtotal = 1").select(
        outer, *[F.col(c).alias(new) for c, (_, new) in names.items()])
    return details.join(subtotals, outer)


def two_levels_of_stored(df: DataFrame, outer: str, inner: str, total: str,
                         names: tuple[str, str]) -> DataFrame:
    """Like `two_levels` for a stored rollup, where a null inner key marks the subtotal."""
    summed = df.filter(F.col(outer).isNotNull()).groupBy(outer, inner).agg(F.sum(total).alias(total))
    details = summed.filter(F.col(inner).isNotNull()).withColumnRenamed(total, names[0])
    subtotals = summed.filter(F.col(inner).isNull()).select(outer, F.col(total).alias(names[1]))
    return details.join(subtotals, outer)


def busy_days(df: DataFrame, threshold: int, date: str = "date", strict: bool = False) -> DataFrame:
    """Days with at least (or more than) `threshold` rows; at most one row per calendar day."""
    counted = df.groupBy(date).agg(F.count(F.lit(1)).alias("__rows"))
    test = F.col("__rows") > threshold if strict else F.col("__rows") >= threshold
    return counted.filter(test).select(date)


def weighted_sum(df: DataFrame, weights: DataFrame, on: str, keys: list[str], amount: str, weight: str,
                 alias: str, extra: list[Column] | None = None) -> DataFrame:
    """Sum of amount x weight with the weight looked up by `on`."""
    from sundial.operators.joins import lookup

    joined = lookup(df, weights, on, how="inner")
    return joined.groupBy(*keys).agg(F.sum(F.col(amount) * F.col(weight)).alias(alias), *(extra or []))


def date_bounds(df: DataFrame, date: str = "date") -> DataFrame:
    """Smallest and largest day, as a one-row table."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def latest_value(df: DataFrame, keys: list[str], value: str, date: str, since, snapshot) -> DataFrame:
    """Largest value per key among rows dated in (since, snapshot]."""
    recent = df.filter((F.col(date) > F.lit(since)) & (F.col(date) <= F.lit(snapshot)))
    return recent.groupBy(*keys).agg(F.max(value).alias(value))
