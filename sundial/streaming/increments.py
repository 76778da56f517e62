"""Incremental updates at partition level: process only days not stored yet, safely repeatable."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, as_date
from sundial.sources.sinks import write_partitions


def stored(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The stored table, or none before the first write."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def new_days(df: DataFrame, existing: DataFrame | None, date: str = "date") -> DataFrame:
    """Rows of days that are not stored yet."""
    if existing is None:
        return df
    return df.join(existing.select(date).distinct(), date, "left_anti")


def append_new_days(df: DataFrame, path: str, date: str = "date") -> None:
    """Store the missing days. A repeated or half-finished run rewrites the same partitions."""
    write_partitions(new_days(df, stored(df.sparkSession, path), date), path, date)


def update_features(raw: DataFrame, path: str, build: Callable[[DataFrame], DataFrame], date: str = "date") -> None:
    """Build features from the raw history and store those snapshots that are missing."""
    append_new_days(build(raw), path, date)


def needed_days(snapshots: Iterable[DateLike], look_back: int) -> list[tuple[dt.date, dt.date]]:
    """The days that snapshots are built from, each `look_back` days before it and itself, as closed ranges that do not touch."""
    ranges: list[tuple[dt.date, dt.date]] = []
    for snapshot in sorted(as_date(s) for s in snapshots):
        start = snapshot - dt.timedelta(days=look_back)
        if ranges and start <= ranges[-1][1] + dt.timedelta(days=1):
            ranges[-1] = ranges[-1][0], snapshot
        else:
            ranges.append((start, snapshot))
    return ranges


def days_of(df: DataFrame, ranges: list[tuple[dt.date, dt.date]], date: str = "date") -> DataFrame:
    """Rows of these days; a test on the raw column, so only their partitions are listed and read."""
    test = F.lit(False)
    for low, high in ranges:
        test = test | F.col(date).between(F.lit(low), F.lit(high))
    return df.filter(test)


def _stored_days(spark: SparkSession, path: str, date: str) -> set[dt.date]:
    """Days that have a folder; no data is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return set()
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return {dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{date}=") and "HIVE_DEFAULT" not in n}


def update_snapshots(source: DataFrame, path: str, snapshots: Iterable[DateLike], look_back: int,
                     build: Callable[[DataFrame, list[dt.date]], DataFrame], date: str = "date") -> list[dt.date]:
    """Build and store the snapshots that have no partition yet, from their own look-back only; the snapshots built.

    `build` gets the source cut to the days that the missing snapshots need, and those snapshots. Its rows of other days are not
    stored. Partitions are written into a staging folder, which readers of the table do not see, and renamed one by one; a run that
    dies leaves whole partitions or none, and the next one builds what is missing. A snapshot without rows gets no
    partition and is built again. One writer at a time.
    """
    spark = source.sparkSession
    missing = sorted({as_date(s) for s in snapshots} - _stored_days(spark, path, date))
    if not missing:
        return []
    rows = build(days_of(source, needed_days(missing, look_back), date), missing).filter(F.col(date).isin(missing))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    table = hadoop(path)
    files = table.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(table):
        for left in files.listStatus(table):  # of runs that died
            if left.getPath().getName().startswith("_staging-"):
                files.delete(left.getPath(), True)
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    rows.write.partitionBy(date).parquet(staging)
    for part in files.listStatus(hadoop(staging)):
        if part.isDirectory() and part.getPath().getName().startswith(f"{date}="):
            target = hadoop(table, part.getPath().getName())
            if not files.rename(part.getPath(), target):
                raise OSError(f"could not move a partition to {target}")
    files.delete(hadoop(staging), True)
    return missing
