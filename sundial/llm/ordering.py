"""Positions and running sums in a total order, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sundial.llm.shared import bounded, saved

ROWS_A_PART = 250_000
#: Below these bits monotonically_increasing_id() counts rows, above them partitions.
ROW_BITS = 33


def parts_for(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_PART))


def numbered(df: DataFrame, group: str | None, keys: list[Column], amount: str | None = None,
             per_group: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All columns, and for every row its place among the rows of its group, in the order of `keys`.

    Added: __uid (unique), __at (rows before it), __n (rows of the group), and with `amount` (whole numbers, not null) __before
    (their sum before the row) and __total (of the group). `per_group` turns the table of groups (__g, __n, __total) into one with
    further columns beside __g, which every row of the group gets. Rows equal in all keys follow one another in any order.

    Rows are dealt by ranges of (group, keys) and written; a group may cover many ranges. What lies before a range is a sum over
    the small table of (range, group), so no task holds more than one range of a group.
    """
    rows = df.withColumn("__g", F.col(group) if group else F.lit(0))
    order = [F.col("__g").asc_nulls_first(), *keys]
    parts = parts_for(df, df.count())
    rows = saved(rows.repartitionByRange(parts, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
                 .withColumn("__uid", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("__uid", ROW_BITS), F.col("__uid").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    rows = rows.withColumns({"__part": part, "__place": place})
    summed = F.sum(amount) if amount else F.lit(0).cast("long")
    shares = rows.groupBy("__part", "__g").agg(F.count("*").alias("__rows"), F.min("__place").alias("__first"), summed.alias("__sum"))
    shares = saved(shares, "ranges")
    groups = shares.groupBy("__g").agg(F.sum("__rows").alias("__n"), F.sum("__sum").alias("__total"))
    if per_group:
        extra = per_group(groups)
        groups = groups.join(extra.withColumnRenamed("__g", "__of"), F.col("__g").eqNullSafe(F.col("__of"))).drop("__of")
    # a group has one row a range here
    earlier = Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumns({c: F.coalesce(F.sum(of).over(earlier), F.lit(0).cast("long")) for c, of in (("__skip", "__rows"), ("__earlier", "__sum"))})
    shares = shares.withColumnRenamed("__g", "__of").join(groups, F.col("__of").eqNullSafe(F.col("__g"))).drop("__g", "__rows", "__sum")
    shares = bounded(saved(shares.withColumnRenamed("__part", "__range"), "ranges"))
    found = rows.join(shares, (F.col("__part") == F.col("__range")) & F.col("__g").eqNullSafe(F.col("__of")))
    found = found.withColumn("__at", F.col("__skip") + F.col("__place") - F.col("__first"))
    if amount:
        inside = Window.partitionBy("__part", "__g").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("__before", F.col("__earlier") + F.coalesce(F.sum(amount).over(inside), F.lit(0).cast("long")))
    return found.drop("__part", "__place", "__range", "__of", "__skip", "__earlier", "__first", "__g", *([] if amount else ["__total"]))
