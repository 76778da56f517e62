"""Province of unmapped cells, learnt from subscribers who stay in one province."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, add_months, as_date, month_label
from sundial.operators.aggregates import two_levels_of_stored
from sundial.operators.distincts import nested_levels
from sundial.operators.joins import lookup
from sundial.operators.quality import require_days
from sundial.operators.sequences import dominant_value, newest_row
from sundial.session import cut_lineage
from sundial.sources.scans import between, on_day

PHONE, CELL, PROVINCE = "phone_number", "cell_id", "ref_province_name"
DOMINANCE = 9


def newest_cells(cell_map: DataFrame) -> DataFrame:
    """The newest map entry per cell."""
    columns = [CELL, "district_code", "district_name", "province_code", "province_name", "date"]
    return newest_row(cell_map.select(*columns), [CELL], "date").withColumnRenamed("date", "cell_upd_dt")


def _placed(cell_daily: DataFrame, cell_map: DataFrame, snapshot: DateLike, days: int, check: bool = False) -> DataFrame:
    """Day totals per phone and cell with the cell's province, kept: both sides read them."""
    window = between(cell_daily, as_date(snapshot) - dt.timedelta(days=days - 1), snapshot).filter(f"{PHONE} IS NOT NULL")
    if check:
        window = require_days(window, days, retry=True)
    totals = window.groupBy(PHONE, CELL, "date").agg(F.sum("count").alias("count"))
    return cut_lineage(lookup(totals, newest_cells(cell_map).select(CELL, "province_name"), CELL))


def seed_day(cell_daily: DataFrame, cell_map: DataFrame, snapshot: DateLike, days: int = 3,
             factor: float = DOMINANCE, check: bool = False) -> DataFrame:
    """The day's sightings of unmapped cells by subscribers with one stable province, with that
    day's sightings of mapped cells there as reference.

    A cell's province depends on the cell only, so the day's unmapped sightings come straight from
    the day totals; nothing has to be joined back to the raw rows.
    """
    placed = _placed(cell_daily, cell_map, snapshot, days, check)
    unmapped, references = _parts(placed, snapshot, factor)
    return unmapped.join(references, PHONE)


def seed_parts(cell_daily: DataFrame, cell_map: DataFrame, snapshot: DateLike, days: int = 3, factor: float = DOMINANCE) -> tuple[DataFrame, DataFrame]:
    """The two sides of `seed_day` without their pairs: unmapped sightings, and reference sightings of the stable province."""
    return _parts(_placed(cell_daily, cell_map, snapshot, days), snapshot, factor)


def _parts(placed: DataFrame, snapshot: DateLike, factor: float) -> tuple[DataFrame, DataFrame]:
    today = on_day(placed, snapshot).select(PHONE, CELL, "province_name", F.col("count").alias("sum_logs_count"))
    weights = placed.filter("province_name IS NOT NULL").groupBy(PHONE, "province_name").agg(F.sum("count").alias("sum_logs_count_3d_prov"))
    stable = dominant_value(weights, PHONE, "province_name", "sum_logs_count_3d_prov", factor)
    references = stable.join(today, [PHONE, "province_name"]).select(
        PHONE, F.col("province_name").alias(PROVINCE), F.col(CELL).alias("ref_cell_id"),
        F.col("sum_logs_count").alias("ref_sum_logs_count"), F.col("sum_logs_count_3d_prov").alias("ref_sum_logs_count_3d_prov"))
    return today.filter("province_name IS NULL").drop("province_name"), references


def sums_of_parts(unmapped: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and phones per cell and province over all pairs of a phone's two sides, without building a pair.

    `keys` are shared by both sides (the phone, and the day where there are several); a key has one province. Every unmapped
    row meets all references of its key, so it counts as often as there are such, and brings their total once.
    """
    totals = references.groupBy(*keys, PROVINCE).agg(F.count(F.lit(1)).alias("__n"), F.sum("ref_sum_logs_count").alias("__total"))
    return unmapped.join(totals, keys).groupBy(CELL, PROVINCE).agg(
        F.sum(F.col("sum_logs_count") * F.col("__n")).alias("sum_logs_count"), F.sum("__total").alias("ref_sum_logs_count"), F.sum("__n").alias("pairs"),
        F.count_distinct(PHONE).alias("count_pn"))


def run_month(date: Column) -> Column:
    """Label of the run that processes the day: the month after the day's own."""
    return month_label(F.add_months(F.trunc(date, "MM"), 1))


def month_of_run(seeds: DataFrame, run_date: DateLike) -> DataFrame:
    """The previous month's rows, labelled with the run's month."""
    end = as_date(run_date).replace(day=1)
    rows = seeds.filter((F.col("date") >= F.lit(add_months(end, -1))) & (F.col("date") < F.lit(end)))
    return rows.withColumn("month", F.lit(f"{end:%Y-%m}"))


def monthly_sums(seeds: DataFrame) -> DataFrame:
    return seeds.groupBy("month", CELL, PROVINCE).agg(
        F.sum("sum_logs_count").alias("sum_logs_count"), F.sum("ref_sum_logs_count").alias("ref_sum_logs_count"))


def monthly_days(seeds: DataFrame) -> DataFrame:
    """Distinct days per cell and province, per cell, and overall (null marks the wider level).

    The days of a run month lie in one calendar month, so a set of them is one bit per day of the month: sets of raw rows are merged
    per cell and province, and only those rows are merged again for the wider levels.
    """
    day_bit = F.expr("shiftleft(1L, day(date) - 1)")
    sets = seeds.groupBy("month", CELL, PROVINCE).agg(F.bit_or(day_bit).alias("__days"))
    levels = [["month", CELL, PROVINCE], ["month", CELL], ["month"]]
    return sets.groupingSets(levels, "month", CELL, PROVINCE).agg(F.bit_count(F.bit_or("__days")).cast("long").alias("count_date"))


def monthly_members(seeds: DataFrame, member: str) -> DataFrame:
    """Distinct phones (or reference cells) per cell and province."""
    return seeds.select("month", CELL, PROVINCE, member).distinct()


def _months(table: DataFrame, first: str, until: str) -> DataFrame:
    return table.filter((F.col("month") >= first) & (F.col("month") < until))


def yearly_sums(monthly: DataFrame, first: str, until: str) -> DataFrame:
    columns = ["sum_logs_count", "ref_sum_logs_count"]
    return nested_levels(_months(monthly, first, until), CELL, PROVINCE, {c: (f"{c}_cell_prov", f"{c}_cell") for c in columns},
                         {"month": ("count_month_cell_prov", "count_month_cell")})


def yearly_members(monthly: DataFrame, member: str, name: str, first: str, until: str) -> DataFrame:
    """Distinct members per cell and province beside those per cell."""
    return nested_levels(_months(monthly, first, until), CELL, PROVINCE, {}, {member: (f"{name}_cell_prov", f"{name}_cell")})


def yearly_days(monthly: DataFrame, first: str, until: str) -> DataFrame:
    """Monthly day counts added up, at both stored levels."""
    return two_levels_of_stored(_months(monthly, first, until), CELL, PROVINCE, "count_date", ("count_date_cell_prov", "count_date_cell"))


def yearly_report(sums: DataFrame, phones: DataFrame, reference_cells: DataFrame, days: DataFrame) -> DataFrame:
    keys = [CELL, PROVINCE]
    return sums.join(phones, keys).join(reference_cells, keys).join(days, keys)


def yearly_report_of(sums: DataFrame, phones: DataFrame, reference_cells: DataFrame, days: DataFrame, first: str, until: str) -> DataFrame:
    """The same report straight from the monthly tables, in one grouped pass instead of four tables joined on cell and province.

    Rows of the first three tables are stacked, with the columns of the others null there; a cell and province must be in all three,
    and the day counts are joined as they are stored.
    """
    columns = {"sum_logs_count": "sum_logs_count", "ref_sum_logs_count": "ref_sum_logs_count"}
    parts = [_months(t, first, until) for t in (sums, phones, reference_cells)]
    kept = [[CELL, PROVINCE, "month", *columns], [CELL, PROVINCE, PHONE], [CELL, PROVINCE, "ref_cell_id"]]
    stacked = parts[0].select(*kept[0])
    for part, names in zip(parts[1:], kept[1:]):
        stacked = stacked.unionByName(part.select(*names), allowMissingColumns=True)
    members = {"month": "count_month", PHONE: "count_pn", "ref_cell_id": "count_ref_cell"}
    levels = nested_levels(stacked, CELL, PROVINCE, *[{c: (f"{n}_cell_prov", f"{n}_cell") for c, n in names.items()} for names in (columns, members)])
    whole = levels.filter("count_month_cell_prov > 0 AND count_pn_cell_prov > 0 AND count_ref_cell_cell_prov > 0")
    return whole.join(yearly_days(days, first, until), [CELL, PROVINCE])
