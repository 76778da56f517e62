"""Scans of date-partitioned tables. Predicates stay on the raw column so partitions are pruned."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, as_date, day, month_starts


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", skip_corrupt: bool = False,
               columns: list[str] | None = None) -> DataFrame:
    """A stored table in any installed format, e.g. a lakehouse one."""
    reader = spark.read.format(fmt)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    df = reader.load(path)
    return df.select(*columns) if columns else df


def skipped_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Files of a folder that give no row because they cannot be read: column `file`, the path without its scheme.

    Every column of every row is read, so a file that only breaks at a late column is found too. Sound files without rows, such as a
    writer's empty first part, and empty ones are not listed: what gave no row is read again without passing over errors. Names starting
    with _ or . are no data.
    """
    rows = read_table(spark, path, fmt, skip_corrupt=True)
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*"
    plain = lambda c: F.url_decode(F.regexp_replace(F.regexp_replace(c, r"\+", "%2B"), scheme, "/"))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    read = rows.select(plain(F.col("_metadata.file_path")).alias("file"), whole.alias("h")).groupBy("file").agg(F.bit_xor("h").alias("h"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path"))
    listed = listed.filter(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]")).select("path", F.regexp_replace("path", scheme, "/").alias("file"))
    without_rows = listed.join(read.select("file"), "file", "left_anti").select("path", "file").collect()
    broken = set(_unreadable([r.path for r in without_rows], rows, fmt))
    return spark.createDataFrame([(r.file,) for r in without_rows if r.path in broken], "file string")


def _unreadable(paths: list[str], table: DataFrame, fmt: str) -> list[str]:
    """Those of the files that a strict read fails on; sound ones are passed many at a time, by halving."""
    if not paths:
        return []
    reader = table.sparkSession.read.format(fmt).schema(table.schema).option("ignoreCorruptFiles", "false")
    try:
        strict = reader.load([re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths])
        strict.agg(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in strict.columns]))).collect()
        return []
    except (PySparkException, Py4JJavaError) as error:  # a failed task's error comes as the JVM's own
        if "FAILED_READ_FILE" not in str(error):
            raise
        if len(paths) == 1:
            return paths
    half = len(paths) // 2
    return _unreadable(paths[:half], table, fmt) + _unreadable(paths[half:], table, fmt)


def after_until(df: DataFrame, start: DateLike, end: DateLike, date: str = "date") -> DataFrame:
    """start < date <= end"""
    return df.filter((F.col(date) > day(start)) & (F.col(date) <= day(end)))


def between(df: DataFrame, start: DateLike, end: DateLike, date: str = "date") -> DataFrame:
    """start <= date <= end"""
    return df.filter(F.col(date).between(day(start), day(end)))


def last_weeks(df: DataFrame, snapshot: DateLike, weeks: int, date: str = "date") -> DataFrame:
    """The closed range of 7 x weeks days that ends on the snapshot."""
    end = as_date(snapshot)
    return between(df, end - dt.timedelta(days=7 * weeks - 1), end, date)


def on_day(df: DataFrame, snapshot: DateLike, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) == day(snapshot))


def without_days(df: DataFrame, days: Iterable[DateLike], date: str = "date") -> DataFrame:
    """Leave out known bad days."""
    return df.filter(~F.col(date).isin([as_date(d) for d in days]))


def first_of_months(df: DataFrame, snapshot: DateLike, months: int, date: str = "date") -> DataFrame:
    """The last `months` first-of-month partitions, in one scan."""
    return df.filter(F.col(date).isin(month_starts(snapshot, months)))


def calendar(df: DataFrame, date: str = "date", keys: list[str] | None = None, sundays: bool = False,
             name: str = "date") -> DataFrame:
    """Every day (or Sunday) between the first and last day of the table, per key if given."""
    bounds = df.groupBy(*(keys or [])).agg(F.min(date).alias("__low"), F.max(date).alias("__high"))
    days = bounds.filter("__low IS NOT NULL").select(
        *(keys or []), F.explode(F.sequence("__low", "__high")).alias(name))
    return days.filter(F.dayofweek(name) == 1) if sundays else days
