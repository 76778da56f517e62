"""Order-dependent operators over ranges of a total order: running totals, carried values, ranks and rotation.

Rows are dealt by ranges of (keys, order) and kept, so a key that holds most of the rows covers many ranges. What a range needs to
know of earlier ones comes from a table with one row per key and range; no task sees a whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sundial.session import cut_lineage

RANGE = "__range"


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows by ranges of `order`, with the number of their range; ranges ascend. Equal rows may fall into neighbouring ranges."""
    return cut_lineage(df.repartitionByRange(*order, F.monotonically_increasing_id()).withColumn(RANGE, F.spark_partition_id()))


def _earlier(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def running_totals(df: DataFrame, keys: list[str], order: str, totals: dict[str, str]) -> DataFrame:
    """Exclusive prefix sums per key: {column: name of its sum over the key's earlier rows}.

    Rows must be unique per key and order value; keys must not be null.
    """
    rows = in_ranges(df, [*keys, order])
    shares = rows.groupBy(*keys, RANGE).agg(*[F.sum(c).alias(f"__sum_{i}") for i, c in enumerate(totals)])
    skipped = shares.select(*keys, RANGE, *[F.coalesce(F.sum(f"__sum_{i}").over(_earlier(keys)), F.lit(0)).alias(f"__skip_{i}") for i in range(len(totals))])
    inside = Window.partitionBy(*keys, RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.join(skipped, [*keys, RANGE])
    sums = {name: F.col(f"__skip_{i}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for i, (c, name) in enumerate(totals.items())}
    return found.withColumns(sums).drop(RANGE, *[f"__skip_{i}" for i in range(len(totals))])


def carried(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Every null `value` replaced by the last one before it in the order, within its key."""
    rows = in_ranges(df, [*keys, *order])
    inside = Window.partitionBy(*keys, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(*order)
    ends = rows.filter(F.col(value).isNotNull()).groupBy(*keys, RANGE).agg(F.max_by(value, place).alias("__end"))
    every = rows.select(*keys, RANGE).distinct().join(ends, [*keys, RANGE], "left")
    brought = every.select(*keys, RANGE, F.last("__end", ignorenulls=True).over(_earlier(keys)).alias("__brought"))
    own = rows.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    return own.join(brought, [*keys, RANGE], "left").withColumn(value, F.coalesce(value, "__brought")).drop(RANGE, "__brought")


def ranks(df: DataFrame, order: str, name: str = "rank") -> DataFrame:
    """Place of every row in the whole table, from 0; `order` is unique."""
    counted = running_totals(df.withColumns({"__all": F.lit(0), "__one": F.lit(1).cast("long")}), ["__all"], order, {"__one": name})
    return counted.drop("__all", "__one")


def rotated(df: DataFrame, order: str, values: list[str], steps: int, name: str = "partner") -> DataFrame:
    """Every row with a struct of the values of the row `steps` places later in the order, the first following the last.

    A join on the rank, which is unique on both sides; `order` is unique.
    """
    ranked = cut_lineage(ranks(df, order, "__rank"))
    rows = ranked.count()
    if not rows:
        return ranked.withColumn(name, F.struct(*values)).drop("__rank")
    there = ranked.select(F.pmod(F.col("__rank") - steps, F.lit(rows)).alias("__rank"), F.struct(*values).alias(name))
    return ranked.join(there, "__rank").drop("__rank")
