"""Joins on time: point in time, as of, look-back, validity, nearest event; and size-checked lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, day, eligible_sunday, sunday_on_or_before
from sundial.operators.columns import decimals_to_double
from sundial.operators.ranges import carried

BROADCAST_ROWS = 2_000_000
# A key with more rows than this is split into this many parts in `hot_key_join`.
HOT_ROWS = 1_000_000
HOT_PARTS = 256


def within_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True when the table holds at most `limit` rows; reads no more than that many."""
    return df.limit(limit + 1).count() <= limit


def lookup(df: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "left",
           max_rows: int = BROADCAST_ROWS, check: bool = False) -> DataFrame:
    """Join a dimension table.

    Without `check` the choice is Spark's: statistics decide at plan time and adaptive execution
    at run time, so a dimension that outgrows the broadcast threshold is shuffled instead. With
    `check` the size is proven first and a broadcast is then requested.
    """
    if check and within_rows(dimension, max_rows):
        dimension = F.broadcast(dimension)
    return df.join(dimension, on, how)


def hot_key_join(left: DataFrame, right: DataFrame, key: str, spread: list[str], how: str = "inner",
                 hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Equi join of a large table with one that is unique on the key, safe when one key is huge.

    Keys with more than `hot_rows` left rows are found by a combined count over the key column
    alone; there can be at most rows / `hot_rows` of them, so that list may be broadcast. Only
    they are split: their left rows by a hash of `spread`, their right row once per part.
    """
    if hot is None:
        counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
        hot = counts.filter(F.col("__rows") > hot_rows).select(key)
    hot = F.broadcast(hot.withColumn("__hot", F.lit(True)))
    part = F.when(F.col("__hot"), F.pmod(F.xxhash64(*spread), F.lit(HOT_PARTS)).cast("int")).otherwise(0)
    parts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    split = left.join(hot, key, "left").withColumn("__part", part).drop("__hot")
    copied = right.join(hot, key, "left").withColumn("__part", F.explode(parts)).drop("__hot")
    return split.join(copied, [key, "__part"], how).drop("__part")


def current_activation(events: DataFrame, activated: DataFrame, key: str = "phone_number",
                       date: str = "date", since: str = "last_activated_date",
                       strict: bool = False, bounded: bool = False) -> DataFrame:
    """Rows of the subscriber's current activation only; `activated` has one row per subscriber.

    Raw events may put very many rows on one subscriber, so the join is split for such keys. Set
    `bounded` for tables with one row per subscriber and day or week, where none can occur.
    """
    test = F.col(date) > F.col(since) if strict else F.col(date) >= F.col(since)
    since_table = activated.select(key, since)
    if bounded:
        return events.join(since_table, key).filter(test).drop(since)
    spread = [c for c in events.columns if c != key]
    return hot_key_join(events, since_table, key, spread).filter(test).drop(since)


def present_in(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in the other table; never multiplies rows."""
    return df.join(keys.select(*on), on, "left_semi")


def absent_from(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")


def outer_on_key(frames: list[DataFrame], key: list[str]) -> DataFrame:
    """Full outer join of several tables with the key coalesced.

    Prefer one conditional aggregate when the tables share a source.
    """
    return reduce(lambda left, right: left.join(right, key, "outer"), frames)


def outer_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer join on differently named keys; the result keeps the left name."""
    return left.join(right.withColumnRenamed(right_key, left_key), left_key, "outer")


def point_in_time(labels: DataFrame, features: DataFrame, key: str = "phone_number",
                  on_date: str = "disburse_date", date: str = "date",
                  nearest: int = 3, farthest: int = 9, weekly: bool = False) -> DataFrame:
    """Feature rows dated `nearest` to `farthest` days before the label's day, left.

    The range becomes an equi join: every label day is expanded to its eligible feature days
    (label side only, a fixed small factor), so features are shuffled once on (key, date) and a
    feature table partitioned by date is pruned. With `weekly` the features are Sunday snapshots
    and a seven-day range holds exactly one, so no expansion is needed.
    """
    moments = labels.select(key, on_date).distinct()
    if weekly:
        if farthest - nearest != 6:
            raise ValueError("a weekly merge needs a seven-day range")
        eligible = sunday_on_or_before(F.date_sub(F.col(on_date), nearest))
    else:
        eligible = F.explode(F.sequence(F.date_sub(F.col(on_date), farthest), F.date_sub(F.col(on_date), nearest)))
    found = moments.select(key, on_date, eligible.alias(date)).join(features, [key, date])
    return labels.join(found, [key, on_date], "left")


def bounded_point_in_time(labels: DataFrame, features: DataFrame, on_date: str = "disburse_date",
                          date: str = "date", farthest: int = 9, **options) -> DataFrame:
    """`point_in_time` with the feature scan first cut to the labels' own date range."""
    low, high = labels.agg(F.min(on_date), F.max(on_date)).first()
    if low is not None:
        features = features.filter(F.col(date).between(F.date_sub(F.lit(low), farthest), F.lit(high)))
    return point_in_time(labels, features, on_date=on_date, date=date, farthest=farthest, **options)


def snapped_merge(labels: DataFrame, features: DataFrame, key: str = "phone_number",
                  on_date: str = "disburse_date", date: str = "date", by_key: bool = False) -> DataFrame:
    """Features of the newest snapshot published before the label's day, left.

    Calendar-wide features have no subscriber key; `by_key` adds it for those that do.
    """
    moments = labels.select(key, on_date).distinct().withColumn(date, eligible_sunday(F.col(on_date)))
    found = moments.join(features, [key, date] if by_key else [date])
    return labels.join(found, [key, on_date], "left")


def wide_merge(base: DataFrame, tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Left-join many feature tables on the same keys; columns already present are skipped."""
    result = base
    for table in tables.values():
        new = [c for c in table.columns if c not in result.columns]
        if new:
            result = result.join(table.select(*keys, *new), keys, "left")
    return decimals_to_double(result)


def last_days_per_sunday(df: DataFrame, weeks: int, date: str = "date", snap: str = "snap",
                         last_snap: DateLike | Column | None = None) -> DataFrame:
    """Every row once for each Sunday whose last `weeks` weeks contain it.

    A range join turned around: a day serves the Sunday that closes its week and the following
    `weeks` - 1, found by arithmetic; joining or grouping on the Sunday is then an equi operation.
    """
    first = F.date_add(F.col(date), F.lit(6) - F.weekday(date))
    sundays = F.transform(F.sequence(F.lit(0), F.lit(weeks - 1)), lambda i: F.date_add(first, (i * 7).cast("int")))
    spread = df.withColumn(snap, F.explode(sundays))
    if last_snap is None:
        return spread
    limit = last_snap if isinstance(last_snap, Column) else day(last_snap)
    return spread.filter(F.col(snap) <= limit)


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
          values: list[str]) -> DataFrame:
    """For every left row the values of the newest right row not after it.

    Both sides are stacked and dealt by ranges of (key, time) with about equal row counts; the last right row is carried forward
    inside a range, and what a range inherits comes from a small table with one row per key and range. A key that holds nearly
    all rows, or has them all on one day, is cut like any other. Of right rows at one time the largest values count; null keys
    match nothing.
    """
    payload = F.struct(F.col(right_time).alias("__at"), *values)
    stacked = left.withColumns({"__time": F.col(left_time), "__value": F.lit(None).cast(_struct_type(right, right_time, values)),
                                "__side": F.lit(1)})
    points = right.dropna(subset=[*keys, right_time]).groupBy(*keys, F.col(right_time).alias("__time")).agg(F.max(payload).alias("__value")).withColumn("__side", F.lit(0))
    both = carried(stacked.unionByName(points, allowMissingColumns=True), keys, ["__time", "__side"], "__value")
    known = F.lit(True)
    for key in [*keys, "__time"]:
        known = known & F.col(key).isNotNull()
    return both.filter("__side = 1").select(*left.columns, *[F.when(known, F.col("__value").getField(v)).alias(v) for v in values])


def _struct_type(right: DataFrame, right_time: str, values: list[str]):
    return right.select(F.struct(F.col(right_time).alias("__at"), *values).alias("s")).schema["s"].dataType


def nearest_events(calendar: DataFrame, event: str, date: str = "date", keys: list[str] | None = None,
                   missing: int | None = 0) -> tuple[Column, Column]:
    """Days to the next and since the last marked day of a dense calendar (0 on the day itself)."""
    keys = keys or []
    ordered = Window.partitionBy(*keys).orderBy(date) if keys else Window.orderBy(date)
    marked = F.when(F.col(event) == 1, F.col(date))
    ahead = F.min(marked).over(ordered.rowsBetween(0, Window.unboundedFollowing))
    behind = F.max(marked).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    to_next, since_last = F.datediff(ahead, F.col(date)), F.datediff(F.col(date), behind)
    if missing is None:
        return to_next, since_last
    return F.coalesce(to_next, F.lit(missing)), F.coalesce(since_last, F.lit(missing))


def valid_at(df: DataFrame, moment: DateLike | Column, start: str = "date_start", end: str = "date_end") -> DataFrame:
    """Rows whose validity interval holds the day; a null end is open."""
    at = moment if isinstance(moment, Column) else day(moment)
    return df.filter((F.col(start).isNull() | (F.col(start) <= at)) & (F.col(end).isNull() | (F.col(end) >= at)))


def valid_on_days(df: DataFrame, days: DataFrame, date: str = "date", start: str = "date_start",
                  end: str = "date_end") -> DataFrame:
    """Intervals joined to the days they hold, as an equi join on dyadic blocks; a null start or end is open.

    An interval is cut into blocks of 1, 2, 4, ... days, at most two a size; a day lies in one block of every size. An interval and
    a day share exactly one block if the interval holds the day and none otherwise, so the join makes the rows of the result and no
    others. Open ends reach to the first and last day of the day table, so results do not depend on today.

    The day side has one row per distinct day and size; it is broadcast where the days' own range proves it small.
    """
    first, last = days.agg(F.min(date), F.max(date)).first()
    if first is None:
        return df.join(days, F.lit(False))
    sizes = ((last - first).days + 1).bit_length()
    number = lambda c: F.datediff(c, day(first))
    begin = number(F.greatest(F.coalesce(F.col(start), day(first)), day(first)))
    until = number(F.least(F.coalesce(F.col(end), day(last)), day(last))) + 1

    def ends(size: Column) -> Column:
        """The blocks of one size at either end of what larger blocks do not cover."""
        width = F.pow(F.lit(2), size).cast("long")
        low, high = F.ceil(F.col("__begin") / width), F.floor(F.col("__until") / width)
        open_ = low < high
        return F.array(F.when(open_ & (low % 2 == 1), F.struct(size.alias("size"), low.alias("block"))),
                       F.when(open_ & (high % 2 == 1), F.struct(size.alias("size"), (high - 1).alias("block"))))

    cut = df.withColumns({"__begin": begin, "__until": until}).filter("__begin < __until")
    blocks = F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(sizes)), ends)), lambda b: b.isNotNull())
    cut = cut.select(*df.columns, F.inline(blocks).alias("__size", "__block"))
    every = days.filter(F.col(date).isNotNull()).select(date).distinct()
    held = every.select(F.explode(F.sequence(F.lit(0), F.lit(sizes))).alias("__size"), date).withColumn(
        "__block", F.floor(number(F.col(date)) / F.pow(F.lit(2), F.col("__size"))))
    if ((last - first).days + 1) * (sizes + 1) <= BROADCAST_ROWS:
        held = F.broadcast(held)
    hits = cut.join(held, ["__size", "__block"]).drop("__size", "__block")
    return hits.join(days, date).select(*df.columns, *days.columns)


def first_candidate(df: DataFrame, candidates: str, catalog: DataFrame, code: str, value: str, row_id: list[str]) -> DataFrame:
    """The first of a row's ranked codes that exists in the catalog, and its catalog value."""
    ranked = df.select(*row_id, F.posexplode(candidates).alias("__rank", code))
    hits = lookup(ranked, catalog.select(code, value), code, how="inner")
    best = hits.groupBy(*row_id).agg(F.min_by(F.struct(code, value), "__rank").alias("__best"))
    return df.join(best, row_id, "left").select(*df.columns, F.col(f"__best.{code}").alias(code), F.col(f"__best.{value}").alias(value))


def key_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys lost and keys added between two versions of a table."""
    old, new = before.select(key).distinct(), after.select(key).distinct()
    lost = old.join(new, key, "left_anti").withColumn("change", F.lit("lost"))
    return lost.unionByName(new.join(old, key, "left_anti").withColumn("change", F.lit("added")))
