"""Scans, writers and increments."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import functions as F

from sundial.checks.fixtures import EVENTS_SNAPSHOT, ORDERS_SNAPSHOT
from sundial.checks.registry import query
from sundial.operators import joins
from sundial.operators.columns import sorted_columns
from sundial.session import dealt_by_key
from sundial.sources import scans, sinks
from sundial.streaming import increments

SNAP = f"DATE '{ORDERS_SNAPSHOT}'"
ESNAP = f"DATE '{EVENTS_SNAPSHOT}'"
PER_DAY = "SELECT date, count(*) AS n, count(DISTINCT phone_number) AS phones FROM {table} WHERE {test} GROUP BY 1"


def per_day(df):
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("phone_number").alias("phones"))


def scratch(f) -> str:
    """A fresh folder on the cluster's shared storage; a temporary one in local tests only."""
    shared = f.spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared}/{uuid.uuid4().hex}"
    if not f.spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return f"{tempfile.mkdtemp(prefix='spark-')}/out"


@query("S1_after_until", PER_DAY.format(table="recharge", test=f"date > {SNAP} - 84 AND date <= {SNAP}"), "recharge", texts="date")
def s1(f):
    return per_day(scans.after_until(f.recharge(), ORDERS_SNAPSHOT - dt.timedelta(weeks=12), ORDERS_SNAPSHOT))


@query("S2_closed_range", PER_DAY.format(table="recharge", test=f"date BETWEEN {SNAP} - 27 AND {SNAP}"), "recharge", texts="date")
def s2(f):
    return per_day(scans.last_weeks(f.recharge(), ORDERS_SNAPSHOT, 4))


@query("S3_single_day", PER_DAY.format(table="imei_weekly", test=f"date = {SNAP}"), "imei_weekly", texts="date")
def s3(f):
    return per_day(scans.on_day(f.imei_weekly(), ORDERS_SNAPSHOT))


@query("S4_table_of_any_format", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1", texts="o_orderstatus")
def s4(f):
    table = scans.read_table(f.spark, f"{f.folder}/orders.parquet", "parquet", columns=["o_orderstatus"])
    return table.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("S5_without_days", PER_DAY.format(table="recharge", test="date NOT IN (DATE '2001-07-04', DATE '2001-06-01')"), "recharge", texts="date")
def s5(f):
    return per_day(scans.without_days(f.recharge(), ["2001-07-04", "2001-06-01"]))


@query("S6_first_of_months", PER_DAY.format(table="usage_pre", test="date IN (DATE '2001-07-01', DATE '2001-06-01', DATE '2001-05-01')"), "usage_pre", texts="date")
def s6(f):
    return per_day(scans.first_of_months(f.usage_pre(), ORDERS_SNAPSHOT, 3))


@query("S10_new_days", PER_DAY.format(table="recharge", test="date NOT IN (SELECT date FROM balance_txn WHERE phone_number % 2 = 0)"), "recharge balance_txn", texts="date")
def s10(f):
    return per_day(increments.new_days(f.recharge(), f.balance_txn().filter("phone_number % 2 = 0")))


@query("S11_skip_corrupt", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1", texts="l_returnflag")
def s11(f):
    return scans.read_table(f.spark, f"{f.folder}/lineitem.parquet", skip_corrupt=True).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("S11_skipped_files", "SELECT o_orderstatus, count(*) AS n, 0 AS skipped FROM orders GROUP BY 1", texts="o_orderstatus")
def s11b(f):
    """A sound folder: all rows are there and no file is named."""
    path = scratch(f)
    sinks.write_files(f.orders, path)
    skipped = scans.skipped_files(f.spark, path).agg(F.count(F.lit(1)).alias("skipped"))
    counts = scans.read_table(f.spark, path, skip_corrupt=True).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(skipped))  # one row


@query("S12_calendar", "SELECT ticker, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM series GROUP BY 1", "series", texts="ticker|date", whole=False)
def s12(f):
    return scans.calendar(f.series(), keys=["ticker"])


@query("S12_sundays", "SELECT * FROM (SELECT ticker, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS snap FROM series GROUP BY 1) WHERE isodow(snap) = 7", "series", texts="ticker|snap", whole=False)
def s12b(f):
    return scans.calendar(f.series(), keys=["ticker"], sundays=True, name="snap")


EVERY = "SELECT phone_number, imei, tac, device_num_day_l1w, date FROM imei_weekly"


def both(name: str, sql: str, **options):
    """Registered under its name and, as in earlier versions, under its name with _whole: the same query."""

    def add(build):
        for each in (name, f"{name}_whole"):
            query(each, sql, "imei_weekly", **options)(build)
        return build

    return add


@both("K1_overwrite_one_partition", EVERY.replace("device_num_day_l1w,", f"device_num_day_l1w + CASE WHEN date = {SNAP} THEN 10 ELSE 0 END AS device_num_day_l1w,"), texts="date")
def k1(f):
    path = scratch(f)
    sinks.write_partitions(f.imei_weekly(), path, cluster=True)
    newest = scans.on_day(f.imei_weekly(), ORDERS_SNAPSHOT).withColumn("device_num_day_l1w", F.col("device_num_day_l1w") + 10).drop("date")
    sinks.write_snapshot(newest, path, ORDERS_SNAPSHOT)
    return f.spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))


@query("K2_clustered_partitions", "SELECT mother_system, count(*) AS n, max(mobile_id) AS top FROM wallet_daily GROUP BY 1", "wallet_daily", texts="mother_system")
def k2(f):
    path = scratch(f)
    sinks.write_partitions(f.wallet_daily().select("mobile_id", "mother_system"), path, "mother_system", cluster=True)
    return f.spark.read.parquet(path).groupBy("mother_system").agg(F.count(F.lit(1)).alias("n"), F.max("mobile_id").alias("top"))


@both("K3_incremental_update", EVERY, texts="date")
def k3(f):
    """All weeks but the newest, then everything: the second run adds what is missing, a third one nothing."""
    raw, path = scratch(f), scratch(f)
    sinks.write_partitions(f.imei_weekly(), raw, cluster=True)
    whole = f.spark.read.parquet(raw)
    increments.append_new_days(whole.where(F.col("date") <= F.lit(ORDERS_SNAPSHOT)), path)
    increments.update_features(whole, path, lambda raw: raw)
    increments.append_new_days(whole, path)
    return f.spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))


ROLLING = ("SELECT s.date, w.phone_number, sum(w.device_num_day_l1w) AS days_l4w, count(DISTINCT w.imei) AS imeis_l4w FROM (SELECT DISTINCT date FROM imei_weekly) s "
           "JOIN imei_weekly w ON w.date > s.date - 28 AND w.date <= s.date GROUP BY 1, 2")


@query("K3_update_snapshots", ROLLING, "imei_weekly", texts="date")
def k3_snapshots(f):
    """Four-week features of every Sunday: half of the snapshots first, then the others from their own look-back only."""
    path, features = scratch(f), scratch(f)
    sinks.write_partitions(f.imei_weekly(), path, cluster=True)
    source = f.spark.read.parquet(path)
    sundays = sorted(r.date for r in source.select("date").distinct().collect())

    def build(rows, snapshots):
        # rows move once, before each is there for four Sundays; features then go to their snapshot, as many as are built at once
        spread = joins.last_days_per_sunday(dealt_by_key(rows, "phone_number"), 4, snap="snap").filter(F.col("snap").isin(snapshots))
        features = spread.groupBy(F.col("snap").alias("date"), "phone_number").agg(F.sum("device_num_day_l1w").alias("days_l4w"), F.count_distinct("imei").alias("imeis_l4w"))
        return features.repartition(len(snapshots), "date")

    for part in (sundays[:len(sundays) // 2], sundays):
        increments.update_snapshots(source, features, part, 27, build)
    return f.spark.read.parquet(features)


@both("K4_bounded_sorted_files", EVERY, texts="date")
def k4(f):
    path = scratch(f)
    sinks.write_files(f.imei_weekly(), path, 2, ["phone_number", "imei"])
    return f.spark.read.parquet(path)


@both("K5_compressed_files", EVERY, texts="date")
def k5(f):
    path = scratch(f)
    sinks.write_files(f.imei_weekly(), path, compression="snappy")
    return f.spark.read.parquet(path)


@query("K6_several_outputs", "SELECT 'tac' AS kind, tac AS key, count(*) AS n FROM imei_weekly GROUP BY 2 UNION ALL SELECT 'naid', phone_number % 9, count(*) FROM imei_weekly GROUP BY 2", "imei_weekly", texts="kind")
def k6(f):
    path = scratch(f)
    sinks.write_all(f.imei_weekly(), {
        f"{path}/tac": (lambda df: df.groupBy(F.col("tac").alias("key")).agg(F.count(F.lit(1)).alias("n")), None),
        f"{path}/naid": (lambda df: df.groupBy((F.col("phone_number") % 9).alias("key")).agg(F.count(F.lit(1)).alias("n")), None)})
    parts = [f.spark.read.parquet(f"{path}/{kind}").select(F.lit(kind).alias("kind"), "key", "n") for kind in ("tac", "naid")]
    return parts[0].unionByName(parts[1])


@query("K7_result_csv", "SELECT n_regionkey, count(*) AS n, DATE '2001-07-29' AS day FROM nation GROUP BY 1", texts="day")
def k7(f):
    path = scratch(f)
    sinks.write_csv(f.nation.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n")).withColumn("day", F.lit(ORDERS_SNAPSHOT)), path)
    return f.spark.read.option("header", True).schema("n_regionkey int, n bigint, day string").csv(path)


@query("K8_sorted_columns", "SELECT c_custkey, c_acctbal, c_mktsegment, c_name, c_nationkey FROM customer", doubles="c_acctbal", texts="c_mktsegment|c_name")
def k8(f):
    return sorted_columns(f.customer, ["c_custkey"])
