"""Several distinct counts beside other aggregates, and distinct counts on nested levels, each in one pass.

A distinct count is taken in two levels: one row per key and value, with a flag for each condition under which the value was seen, then
a count of flags. With several columns a row becomes one row per column (its tag and its value), and the tag of the first
column also carries what is not distinct. Both levels combine before the shuffle, a hot key is spread over its values, and no
row is copied per condition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MERGED = ("sum", "count", "min", "max", "avg", "stddev")
TAG = "__tag"


@dataclass(frozen=True)
class Part:
    """One result column: func over value (rows, if none) of the rows where the condition holds.

    func is one of MERGED or count_distinct; averages and deviations are doubles. Deviations are merged from moments, which costs
    about 2 x log10(mean / deviation) of their 15 digits.
    """

    alias: str
    func: str
    value: Column | None = None
    where: Column | None = None

    @property
    def input(self) -> Column:
        value = F.lit(1) if self.value is None else self.value
        return value if self.where is None else F.when(self.where, value)


def _first(part: Part, x: Column, name: str) -> list[Column]:
    """What one row per key and value keeps of a column: itself, or the moments of a mean or deviation."""
    if part.func == "avg":
        return [F.sum(x.cast("double")).alias(f"{name}_s"), F.count(x).alias(f"{name}_n")]
    if part.func == "stddev":
        y = x.cast("double")
        return [F.avg(y).alias(f"{name}_m"), F.var_pop(y).alias(f"{name}_v"), F.count(y).alias(f"{name}_n")]
    return [{"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[part.func](x).alias(name)]


def _second(part: Part, name: str) -> Column:
    if part.func == "avg":
        return F.try_divide(F.sum(f"{name}_s"), F.sum(f"{name}_n"))
    if part.func == "stddev":
        n, m, v = F.col(f"{name}_n"), F.col(f"{name}_m"), F.col(f"{name}_v")
        total = F.sum(n)
        squares = F.sum(n * v) + F.sum(n * m * m) - F.try_divide(F.pow(F.sum(n * m), 2), total)
        return F.when(total > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (total - 1)))
    return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[part.func](name)


def aggregated(df: DataFrame, keys: list[str], parts: list[Part]) -> DataFrame:
    """One row per key with all parts, in their order. Null values are not counted; a count of nothing is 0, other results are null."""
    for part in parts:
        if part.func != "count_distinct" and part.func not in MERGED:
            raise ValueError(f"not an aggregate that can be merged: {part.func}")
    values: dict[str, Column] = {}
    for part in parts:
        if part.func == "count_distinct":
            if part.value is None:
                raise ValueError(f"a distinct count needs a value: {part.alias}")
            values.setdefault(str(part.value), part.value)
    tags = {text: i for i, text in enumerate(values)}
    inputs, first, second = [], [], []
    for i, part in enumerate(parts):
        name = f"__x{i}"
        if part.func != "count_distinct":
            inputs.append(part.input.alias(name))
            x = F.when(F.col(TAG) == 0, F.col(name)) if len(tags) > 1 else F.col(name)
            first += _first(part, x, name)
            second.append(_second(part, name).alias(part.alias))
            continue
        tag = tags[str(part.value)]
        known = F.col(f"__v{tag}").isNotNull()
        if len(tags) > 1:
            known = known & (F.col(TAG) == tag)
        if part.where is None:
            second.append(F.count(F.when(known, 1)).alias(part.alias))
            continue
        inputs.append(part.where.alias(name))
        first.append(F.max(F.when(known, F.col(name))).alias(name))
        second.append(F.count(F.when(known & F.col(name), 1)).alias(part.alias))
    if not tags:
        rows = df.select(*keys, *inputs)
        plain = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg, "stddev": F.stddev}
        return rows.groupBy(*keys).agg(*[plain[p.func](f"__x{i}").alias(p.alias) for i, p in enumerate(parts)])
    columns = [c.alias(f"__v{i}") for i, c in enumerate(values.values())]
    rows = df.select(*keys, *inputs, *columns)
    grain = [f"__v{i}" for i in range(len(columns))]
    if len(tags) > 1:
        rows, grain = _tagged(rows, grain), [TAG, *grain]
    per_value = rows.groupBy(*keys, *grain)
    per_value = per_value.agg(*first) if first else per_value.agg(F.count(F.lit(1)).alias("__rows"))
    return per_value.groupBy(*keys).agg(*second)


def _tagged(rows: DataFrame, values: list[str]) -> DataFrame:
    """Every row once per value column, with the tag of the column; the other columns are null there and types stay."""
    kinds = dict(rows.dtypes)
    places = [F.struct(F.lit(i).alias(TAG), *[F.col(v).alias(v) if i == j else F.lit(None).cast(kinds[v]).alias(v) for j, v in enumerate(values)])
              for i in range(len(values))]
    return rows.select(*[c for c in rows.columns if c not in values], F.inline(F.array(*places)))


def nested_levels(df: DataFrame, outer: str, inner: str, sums: dict[str, tuple[str, str]], distinct: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows per (outer, inner) with sums and distinct counts, beside the same of the whole outer key.

    Both dictionaries map a column to its inner and outer result names. The outer level follows from the inner rows: sums add up,
    and of each member of an outer key exactly one row is marked, so the marks add up to its distinct members. The table is
    read once. Rows without an outer key are left out; a null inner key is a key.
    """
    members = [F.col(c).alias(f"__v{i}") for i, c in enumerate(distinct)]
    rows = df.filter(F.col(outer).isNotNull()).select(outer, inner, *[F.col(c).alias(f"__s{i}") for i, c in enumerate(sums)], *members)
    grain = [f"__v{i}" for i in range(len(members))]
    if len(members) > 1:
        rows, grain = _tagged(rows, grain), [TAG, *grain]
    first_tag = F.lit(True) if len(members) < 2 else F.col(TAG) == 0
    per_member = rows.groupBy(outer, inner, *grain).agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(F.when(first_tag, F.col(f"__s{i}"))).alias(f"__s{i}") for i in range(len(sums))])
    results = [F.sum(f"__s{i}").alias(names[0]) for i, names in enumerate(sums.values())]
    if members:
        # an outer key and member has one row per inner key here
        per_member = per_member.withColumn("__mark", F.row_number().over(Window.partitionBy(outer, *grain).orderBy(inner)) == 1)
    for i, names in enumerate(distinct.values()):
        known = F.col(f"__v{i}").isNotNull()
        if len(members) > 1:
            known = known & (F.col(TAG) == i)
        results += [F.count(F.when(known, 1)).alias(names[0]), F.count(F.when(known & F.col("__mark"), 1)).alias(f"__m{i}")]
    inside = per_member.groupBy(outer, inner).agg(*results)
    whole = Window.partitionBy(outer)
    wider = {names[1]: F.sum(source).over(whole) for source, names in
             [*[(names[0], names) for names in sums.values()], *[(f"__m{i}", names) for i, names in enumerate(distinct.values())]]}
    return inside.withColumns(wider).drop(*[f"__m{i}" for i in range(len(members))])
