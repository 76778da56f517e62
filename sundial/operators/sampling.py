"""Draws that follow from keys alone, exact caps and shares by draw.

A draw is integer arithmetic on the key, so a repeated task, another engine or a later run draws the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the draws: a Mersenne prime and multipliers below it.
PRIME = 2_147_483_647
MIX, LIFT, SHIFT = 48_271, 69_621, 12_345
BUCKETS = 1_024


def _stepped(x, part):
    """One step of the draw; works on columns and on whole numbers."""
    y = (x * MIX + part) % PRIME
    return ((y * y) % PRIME * LIFT + SHIFT) % PRIME


def draw_of(parts: list[int], seed: int) -> int:
    """The draw of whole numbers, computed here."""
    x = seed % PRIME
    for part in [*parts, 0]:
        x = _stepped(x, part % PRIME)
    return x


def _whole(name: str, kind: str) -> Column:
    if kind == "date":
        return F.datediff(F.col(name), F.lit("1970-01-01").cast("date")).cast("long")
    return F.col(name).cast("long") if kind in ("tinyint", "smallint", "int", "bigint", "boolean") else F.xxhash64(name)


def row_draw(df: DataFrame, keys: list[str], seed: int) -> Column:
    """A number from 0 to PRIME - 1 by the key and the seed; a null key part counts as 0."""
    kinds = dict(df.dtypes)
    x = F.lit(seed % PRIME).cast("long")
    for part in [*[F.pmod(F.coalesce(_whole(k, kinds[k]), F.lit(0).cast("long")), F.lit(PRIME)) for k in keys], F.lit(0)]:
        x = _stepped(x, part)
    return x


def nth_smallest(df: DataFrame, draw: Column, wanted: Callable[[int], int], by: str | None = None) -> dict:
    """{group: (value, how many rows with exactly that value are among the n)} of the n-th smallest draw, n = wanted(rows of the group).

    Repeated histograms: a count per bucket of the range that still holds the value, and then only of the bucket that does. Four
    passes settle any draw; the driver sees at most BUCKETS counts a group (a class), no task sorts, and no rows move. The rows
    are read and drawn once; the passes go over their groups and draws alone.
    """
    rows = df.select((F.col(by) if by else F.lit(0)).alias("g"), draw.alias("d")).persist()
    try:
        sizes = {r.g: r["count"] for r in rows.groupBy("g").count().collect()}
        state = {g: [0, PRIME, n] for g, size in sizes.items() if (n := min(wanted(size), size)) > 0}
        while any(width > 1 for _, width, _ in state.values()):
            bucket = F.lit(None).cast("long")
            for g, (low, width, _) in state.items():
                step = -(-width // BUCKETS)
                inside = F.col("g").eqNullSafe(F.lit(g)) & (F.col("d") >= low) & (F.col("d") < low + width)
                bucket = F.when(inside, F.floor((F.col("d") - low) / step)).otherwise(bucket)
            counts = rows.withColumn("b", bucket).where("b IS NOT NULL").groupBy("g", "b").count().collect()
            for g, (low, width, left) in state.items():
                step = -(-width // BUCKETS)
                for b, n in sorted((r.b, r["count"]) for r in counts if r.g == g):
                    if left <= n:
                        state[g] = [low + b * step, min(step, low + width - (low + b * step)), left]
                        break
                    left -= n
        return {g: (low, left) for g, (low, _, left) in state.items()}
    finally:
        rows.unpersist()


def capped(df: DataFrame, keys: list[str], seed: int, rows: int) -> DataFrame:
    """Exactly `rows` rows (or all, if fewer): those with the smallest draws, then the smallest keys.

    A filter on the draw; only rows that share the last draw are ordered.
    """
    draw = row_draw(df, keys, seed)
    found = nth_smallest(df, draw, lambda size: rows)
    if not found:
        return df.limit(0)
    last, ties = found[0]
    return df.where(draw < last).unionByName(df.where(draw == last).orderBy(*keys).limit(ties))


def fraction_of(df: DataFrame, keys: list[str], seed: int, fraction: float) -> DataFrame:
    """Rows whose draw is in the lowest `fraction` of all draws."""
    return df.where(row_draw(df, keys, seed) < int(fraction * PRIME))


def experiment_rows(df: DataFrame, keys: list[str], seed: int, experiment: int, strategy: str = "fixed", fraction: float | None = None, rows: int | None = None,
                    filters: list[str] | None = None) -> DataFrame:
    """Rows of one experiment.

    "filter": those of the experiment's own filter, if it has one, then cap or fraction; "random": cap or fraction; both with a seed
    of the experiment's own. "fixed": fraction, then cap, the same for all experiments. A cap excludes a fraction except in "fixed".
    """
    if strategy not in ("filter", "random", "fixed"):
        raise ValueError(f"unknown strategy: {strategy}")
    own = seed if strategy == "fixed" else seed + experiment
    if strategy == "filter" and filters and experiment < len(filters) and filters[experiment]:
        df = df.where(filters[experiment])
    if fraction is not None and (strategy == "fixed" or rows is None):
        df = fraction_of(df, keys, own, fraction)
    return df if rows is None else capped(df, keys, own, rows)
