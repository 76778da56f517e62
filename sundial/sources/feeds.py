"""CSV feeds of prices, percentages and holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sundial.functions.numbers import parse_number, parse_percent, parse_volume

# Column names of a price export.
PRICE_COLUMNS = {"Date": "date", "Price": "close", "Open": "open", "High": "high", "Low": "low",
                 "Vol.": "volume", "Change %": "change_pct"}


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, header names trimmed and freed of a byte-order mark."""
    df = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    return df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])


def prices(raw: DataFrame, names: dict[str, str] | None = None, pattern: str = "dd/MM/yyyy") -> DataFrame:
    """Typed price rows; rows without a readable day or close are left out."""
    names = names or PRICE_COLUMNS
    df = raw.select([F.col(f"`{c}`").alias(names.get(c, c)) for c in raw.columns])
    typed = df.withColumns({
        "date": F.to_date(F.try_to_timestamp("date", F.lit(pattern))),
        **{c: parse_number(F.col(c)) for c in ("close", "open", "high", "low") if c in df.columns},
        **({"volume": parse_volume(F.col("volume"))} if "volume" in df.columns else {}),
    })
    return typed.filter("date IS NOT NULL AND close IS NOT NULL")


def percentages(raw: DataFrame, indicator: str | Column) -> DataFrame:
    """Monthly percentage rows tagged with the indicator's name, or with a column that holds it where a feed has several."""
    return raw.select(
        F.to_date(F.try_to_timestamp(F.trim("date"), F.lit("yyyy-MM-dd"))).alias("date"),
        parse_percent(F.col("percentage")).alias("percentage"),
        (indicator if isinstance(indicator, Column) else F.lit(indicator)).alias("indicator"),
    ).filter("date IS NOT NULL AND percentage IS NOT NULL")


# Name part that marks the lunar new year.
LUNAR_NEW_YEAR = "lunar new year"


def holidays(raw: DataFrame, keyword: str = LUNAR_NEW_YEAR) -> DataFrame:
    """One row per day of every national holiday."""
    spans = raw.filter("scope = 'national'").select(
        F.col("date").cast("date").alias("first"), F.col("end_date").cast("date").alias("last"), "holiday",
        F.lower("holiday").contains(keyword).cast("int").alias("is_tet"))
    return spans.select(F.explode(F.sequence("first", "last")).alias("date"), "holiday",
                        F.lit(1).alias("is_national_holiday"), "is_tet")
