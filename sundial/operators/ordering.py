"""Sorts and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges of a sorted write. From 1000 on Spark places no reduce task by where its input lies, so `coalesce` joins neighbours in order.
SORT_RANGES = 1024


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The n best rows; planned as a per-task top-n followed by a merge, never as a full sort."""
    return df.orderBy(*order).limit(n)


def rank_of(column: str, labels: list[str]) -> Column:
    """Position of a label in an ordered list, for sorting an ordered category."""
    return F.array_position(F.array(*[F.lit(label) for label in labels]), F.col(column))


def sorted_for_write(df: DataFrame, keys: list[str], files: int) -> DataFrame:
    """Globally ordered output in a bounded number of files: a range shuffle, local sorts of many small ranges, and their joining.

    The task of a file would hold all of its rows in order to sort them. So each range is sorted in a task of its own and handed on
    whole, under its number; the task of a file only reads its neighbouring ranges, one after the other.
    """
    ranges = files * -(-SORT_RANGES // files)
    in_order = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("__range", F.spark_partition_id())
    return in_order.repartitionById(ranges, "__range").drop("__range").coalesce(files)
