import datetime as dt

import pytest
from pyspark.sql import functions as F

from sundial.operators import ordering
from sundial.sources import feeds, scans, sinks
from sundial.streaming import increments


def test_price_feed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('﻿"Date","Price","Open","High","Low","Vol.","Change %"\n"31/12/2024","1,234.50","1,200.0","1,300","1,100","12.5K","1.2%"\n"bad","1","1","1","1","","0%"\n"01/01/2025","x","1","1","1","3M","0%"\n"02/01/2025","10","9","11","8","","0%"\n', encoding="utf-8")
    rows = feeds.prices(feeds.read_text_csv(spark, str(path))).orderBy("date").collect()
    assert [(r.date, r.close, r.volume) for r in rows] == [(dt.date(2024, 12, 31), 1234.5, 12500.0), (dt.date(2025, 1, 2), 10.0, 0.0)]


def test_percent_feed(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("date, percentage\n2020-01-01,5.60%\n2020-02-01, -1.2% \n,3%\n")
    rows = feeds.percentages(feeds.read_text_csv(spark, str(path)), "cpi").orderBy("date").collect()
    assert [(str(r.date), r.percentage, r.indicator) for r in rows] == [("2020-01-01", 5.6, "cpi"), ("2020-02-01", -1.2, "cpi")]


def test_one_partition_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_snapshot(spark.createDataFrame([(1, 1)], "k int, x int"), path, "2024-01-07")
    sinks.write_snapshot(spark.createDataFrame([(1, 2)], "k int, x int"), path, "2024-01-14")
    sinks.write_snapshot(spark.createDataFrame([(1, 9)], "k int, x int"), path, "2024-01-14")
    assert sorted((str(r.date), r.x) for r in spark.read.parquet(path).collect()) == [("2024-01-07", 1), ("2024-01-14", 9)]


def test_increment_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) AS date, 1 AS x")
    increments.append_new_days(days.filter("date <= DATE'2024-01-02'"), path)
    for _ in range(2):
        increments.append_new_days(days.withColumn("x", F.lit(2)), path)
    assert [r.x for r in spark.read.parquet(path).orderBy("date").collect()] == [1, 1, 2, 2, 2]


def test_bounded_sorted_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_files(spark.range(1000).orderBy(F.rand(1)), path, 3, ["id"])
    parts = spark.read.parquet(path)
    assert parts.inputFiles().__len__() <= 3 and parts.count() == 1000


def test_calendar(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 15)), ("b", dt.date(2024, 1, 7))], "k string, date date")
    got = scans.calendar(df, keys=["k"], sundays=True).collect()
    assert sorted((r.k, str(r.date)) for r in got) == [("a", "2024-01-07"), ("a", "2024-01-14"), ("b", "2024-01-07")]


def test_needed_days_are_merged():
    d = dt.date
    assert increments.needed_days(["2024-01-28", "2024-01-07", "2024-01-14"], 6) == [(d(2024, 1, 1), d(2024, 1, 14)), (d(2024, 1, 22), d(2024, 1, 28))]
    assert increments.needed_days([], 6) == []


def test_missing_snapshots_read_only_their_partitions(spark, tmp_path):
    source, table = str(tmp_path / "raw"), str(tmp_path / "features")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-03-31')) AS date").selectExpr("date", "explode(sequence(1, 3)) AS x")
    sinks.write_partitions(days, source)
    raw, read = spark.read.parquet(source), []

    def build(rows, snapshots):
        read.append({f.rsplit("date=", 1)[1][:10] for f in rows.inputFiles()})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        pairs = rows.crossJoin(F.broadcast(spark.createDataFrame([(s,) for s in snapshots], "snap date")))
        return pairs.filter("date > date_sub(snap, 7) AND date <= snap").groupBy(F.col("snap").alias("date")).agg(F.sum("x").alias("x"))

    first, later = ["2024-01-14", "2024-03-03"], ["2024-01-14", "2024-01-21", "2024-03-03", "2024-03-10"]
    assert [str(d) for d in increments.update_snapshots(raw, table, first, 6, build)] == first
    assert [str(d) for d in increments.update_snapshots(raw, table, later, 6, build)] == ["2024-01-21", "2024-03-10"]
    assert increments.update_snapshots(raw, table, later, 6, build) == [] and len(read) == 2
    week = lambda s: {str(dt.date.fromisoformat(s) - dt.timedelta(days=i)) for i in range(7)}
    pruned = {str(r.date) for r in increments.days_of(raw, increments.needed_days(["2024-01-21", "2024-03-10"], 6)).select("date").distinct().collect()}
    assert pruned == week("2024-01-21") | week("2024-03-10")
    assert sorted((str(r.date), r.x) for r in spark.read.parquet(table).collect()) == [(s, 42) for s in later]


def test_a_run_that_died_leaves_whole_partitions(spark, tmp_path):
    table = tmp_path / "features"
    raw = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-31')) AS date, 1 AS x")
    build = lambda rows, snapshots: rows.filter(F.col("date").isin(snapshots))
    increments.update_snapshots(raw, str(table), ["2024-01-07"], 0, build)
    left = table / "_staging-dead" / "date=2024-01-14"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"half a file")
    assert spark.read.parquet(str(table)).count() == 1
    increments.update_snapshots(raw, str(table), ["2024-01-07", "2024-01-14"], 0, build)
    assert spark.read.parquet(str(table)).count() == 2 and not (table / "_staging-dead").exists()


def test_truncated_files_are_named_and_the_rest_is_read(spark, tmp_path):
    folder = tmp_path / "t x+y"
    spark.range(0, 4000, 1, 4).selectExpr("id", "concat('v', id) AS v").write.parquet(str(folder))
    parts = sorted(folder.glob("part-*.parquet"))
    parts[1].write_bytes(parts[1].read_bytes()[:-200])
    parts[2].write_bytes(b"no table")
    assert scans.read_table(spark, str(folder), skip_corrupt=True).count() == 2000
    assert sorted(r.file for r in scans.skipped_files(spark, str(folder)).collect()) == sorted(map(str, parts[1:3]))
    assert scans.skipped_files(spark, str(folder)).columns == ["file"]


def test_files_without_a_bound_keep_their_tasks(spark, tmp_path):
    sinks.write_files(spark.range(0, 100, 1, 5), str(tmp_path / "five"))
    assert len(list((tmp_path / "five").glob("part-*"))) == 5
    sinks.write_files(spark.range(0, 100, 1, 5), str(tmp_path / "two"), 2)
    assert len(list((tmp_path / "two").glob("part-*"))) == 2


def test_sound_files_without_rows_are_not_named(spark, tmp_path):
    folder = tmp_path / "t [x] {y}"
    # the first task writes its file even without a row
    sinks.write_files(spark.range(0, 100, 1, 5).filter("id >= 20"), str(tmp_path / "plain"))
    assert len(list((tmp_path / "plain").glob("part-*"))) == 5
    assert scans.skipped_files(spark, str(tmp_path / "plain")).collect() == []
    folder.mkdir()
    for part in (tmp_path / "plain").glob("part-*"):
        (folder / part.name).write_bytes(part.read_bytes())
    broken = sorted(folder.glob("part-*"))[3]
    broken.write_bytes(b"no table")
    escaped = str(folder).replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}")
    assert [r.file for r in scans.skipped_files(spark, escaped).collect()] == [str(broken)]


@pytest.mark.parametrize("files", [1, 3, 5])
def test_sorted_files_are_made_of_small_sorts_in_order(spark, tmp_path, files):
    rows = spark.range(0, 30000, 1, 7).select(F.expr("CAST(id * 7919 % 30011 AS BIGINT) AS k"), F.expr("id % 3 AS g"), F.repeat(F.lit("x"), 20).alias("pad"))
    out = ordering.sorted_for_write(rows, ["g", "k"], files)
    sizes = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert 0 < len(sizes) <= files and out.rdd.getNumPartitions() == files
    got = [(r.g, r.k) for r in out.collect()]  # partitions one after the other
    assert got == sorted((r.g, r.k) for r in rows.collect())
    # the stage that writes a file sorts nothing: its only sort stands before the second shuffle
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Coalesce") < plan.index("Sort") and plan.count("Sort ") == 1 and plan.count("Exchange") == 2, plan
    assert max(len(part) for part in out.rdd.glom().collect()) < 2 * 30000 / files
