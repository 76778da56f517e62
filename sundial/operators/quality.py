"""Completeness, key and type checks. Gates raise; reports return tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IncompleteData(RuntimeError):
    """The window does not hold the days it should."""


class TryLater(IncompleteData):
    """Not enough days yet; running again later may succeed."""


def distinct_days(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.count_distinct(date).alias("days"))


def require_days(df: DataFrame, expected: int, date: str = "date", tolerance: int = 0,
                 retry: bool = False) -> DataFrame:
    """The table itself when it holds `expected` distinct days (at most `tolerance` fewer)."""
    found = distinct_days(df, date).first()["days"]
    if found > expected or found < expected - tolerance:
        raise (TryLater if retry else IncompleteData)(f"{found} of {expected} days present")
    return df


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate keys in {keys}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """Emptiness probe: reads until the first row only."""
    if df.isEmpty():
        raise ValueError("no rows")
    return df


def duplicate_rows(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """All rows of keys that occur with more than one distinct combination of the columns."""
    distinct = df.select(key, *columns).distinct()
    counts = distinct.groupBy(key).agg(F.count(F.lit(1)).alias("key_count")).filter("key_count > 1")
    return df.join(counts, key)


def row_report(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Row count and distinct count per named key, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_distinct(*columns).alias(name) for name, columns in keys.items()])


def text_profile(df: DataFrame, sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """Per text column: filled values, castable share and integer share among castable ones.

    One aggregate over all rows and columns. A caller may ask for a sample of about `sample_size` rows instead.
    """
    columns = [c for c, kind in df.dtypes if kind == "string"]
    source = df.select(*columns)
    if sample_size is not None:
        total = source.count()
        source = source.sample(fraction=min(sample_size / max(total, 1), 1.0), seed=seed)
    aggregates = []
    for c in columns:
        number = F.col(c).try_cast("double")
        whole = number.isNotNull() & (number == F.floor(number))
        aggregates += [F.count(c), F.count(number), F.count_if(whole)]
    wide = source.agg(*[a.alias(f"__{i}") for i, a in enumerate(aggregates)])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__{3 * i}").alias("filled"),
                 F.col(f"__{3 * i + 1}").alias("numeric"), F.col(f"__{3 * i + 2}").alias("whole"))
        for i, c in enumerate(columns)
    ])
    return wide.select(F.inline(entries))


def wrong_types(df: DataFrame, sample_size: int | None = None, numeric: float = 0.95, whole: float = 0.98,
                seed: int = 42) -> DataFrame:
    """Text columns that hold numbers, with the suggested type."""
    profile = text_profile(df, sample_size, seed)
    castable = F.try_divide(F.col("numeric"), F.col("filled"))
    integer = F.try_divide(F.col("whole"), F.col("numeric"))
    return profile.filter(castable >= numeric).select(
        "column", F.round(castable, 4).alias("convert_ratio"), F.round(integer, 4).alias("int_like_ratio"),
        F.when(integer >= whole, "int").otherwise("float").alias("suggest_type"))
