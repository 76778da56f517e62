"""Writers of snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, day
from sundial.operators.ordering import sorted_for_write


def write_partitions(df: DataFrame, path: str, by: str | list[str] = "date", fmt: str = "parquet",
                     compression: str = "snappy", cluster: bool = False) -> None:
    """Replace exactly the partitions the rows belong to; other partitions stay.

    `cluster` shuffles rows by partition value first, so that each partition is written by few
    tasks; leave it off when one value may hold most rows.
    """
    by = [by] if isinstance(by, str) else by
    out = df.repartition(*by) if cluster else df
    (out.write.format(fmt).mode("overwrite").option("compression", compression)
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(path))


def write_snapshot(df: DataFrame, path: str, snapshot: DateLike, **options) -> None:
    """Write the table as the partition of one snapshot."""
    write_partitions(df.withColumn("date", day(snapshot)), path, "date", **options)


def write_files(df: DataFrame, path: str, files: int | None = None, sort: list[str] | None = None,
                compression: str = "snappy", fmt: str = "parquet") -> None:
    """A bounded number of files, ordered when sort keys are given; without a bound one per task.

    A bound is met by a shuffle, so what comes before it keeps its own parallelism.
    """
    if sort and files is None:
        raise ValueError("sorted files need their number")
    out = df if files is None else sorted_for_write(df, sort, files) if sort else df.repartition(files)
    out.write.format(fmt).mode("overwrite").option("compression", compression).save(path)


def write_all(source: DataFrame, outputs: dict[str, tuple]) -> None:
    """Several tables from one scan: the source is kept while each output is written.

    `outputs` maps a path to (function of the source, partition column or none).
    """
    source = source.persist()
    try:
        for path, (build, by) in outputs.items():
            table = build(source)
            if by:
                write_partitions(table, path, by)
            else:
                table.write.mode("overwrite").parquet(path)
    finally:
        source.unpersist()


def write_csv(df: DataFrame, path: str) -> None:
    """A small result table with header; dates as text so that any reader agrees."""
    plain = df.select([F.col(c).cast("string").alias(c) if kind == "date" else F.col(c) for c, kind in df.dtypes])
    plain.write.mode("overwrite").option("header", True).csv(path)
