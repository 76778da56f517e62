"""Holiday calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, day, iso_year
from sundial.operators.joins import nearest_events


def holiday_features(holidays: DataFrame, start: DateLike, end: DateLike, spans: tuple[int, ...] = (7, 30),
                     weekly: bool = True, missing: int | None = 0) -> DataFrame:
    """Distances to holidays, holiday days and events around each day, and month and week counts.

    `holidays` has one row per day and holiday. The calendar is dense, so look-arounds are row
    frames; it holds one row per day and stays small whatever the size of the other data.
    """
    per_day = holidays.groupBy("date").agg(
        F.max("is_national_holiday").alias("is_national_holiday"), F.max("is_tet").alias("is_tet"),
        F.collect_set(F.when(F.col("is_national_holiday") == 1, F.col("holiday"))).alias("events"))
    bounds = per_day.agg(F.least(F.min("date"), day(start)).alias("low"), F.greatest(F.max("date"), day(end)).alias("high"))
    bounds = bounds.select(F.coalesce("low", day(start)).alias("low"), F.coalesce("high", day(end)).alias("high"))
    inside = F.col("date").between(day(start), day(end))
    calendar = bounds.select(F.explode(F.sequence("low", "high")).alias("date")).join(per_day, "date", "left").fillna(
        0, subset=["is_national_holiday", "is_tet"]).withColumns({
            "events": F.coalesce("events", F.array().cast("array<string>")),
            "__day": F.when(inside, F.col("is_national_holiday")).otherwise(0),
            "__tet": F.when(inside, F.col("is_tet")).otherwise(0)})
    order = Window.orderBy("date")
    next_holiday, last_holiday = nearest_events(calendar, "is_national_holiday", missing=missing)
    next_tet, last_tet = nearest_events(calendar, "is_tet", missing=missing)
    columns = {"days_to_next_national_holiday": next_holiday, "days_since_last_national_holiday": last_holiday,
               "days_to_tet": next_tet, "days_since_tet": last_tet}
    for n in spans:
        for name, frame in ((f"next_{n}d", order.rowsBetween(1, n)), (f"last_{n}d", order.rowsBetween(-n, -1))):
            columns[f"holiday_day_{name}"] = F.coalesce(F.sum("__day").over(frame), F.lit(0))
            columns[f"holiday_event_{name}"] = F.size(F.array_distinct(F.flatten(F.collect_list("events").over(frame))))
    month = Window.partitionBy(F.trunc("date", "MM"))
    week = Window.partitionBy(iso_year(F.col("date")), F.weekofyear("date"))
    columns |= {"holidays_this_month": F.sum("__day").over(month), "tet_this_month": F.sum("__tet").over(month),
                "holidays_this_week": F.sum("__day").over(week)}
    result = calendar.withColumns(columns).withColumns({
        "is_holiday_week": (F.col("holidays_this_week") > 0).cast("int"),
        "is_weekend": (F.weekday("date") >= 5).cast("int")}).filter(inside).drop("events", "__day", "__tet")
    return result.filter(F.dayofweek("date") == 1) if weekly else result


# Columns of the published weekly table, for spans of 7 and 30 days.
PUBLISHED = ["date", "days_to_tet", "days_since_tet"] + [
    f"holiday_{what}_{side}_{n}d" for n in (7, 30) for what in ("day", "event") for side in ("next", "last")]


def published(features: DataFrame) -> DataFrame:
    return features.select(*[c for c in PUBLISHED if c in features.columns])
