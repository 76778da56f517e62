"""Airtime credit: borrowed airtime and airtime sent to friends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, add_months, as_date, is_weekend
from sundial.operators.aggregates import count_where, sum_where
from sundial.operators.columns import fill_missing
from sundial.operators.distincts import Part, aggregated
from sundial.operators.joins import current_activation, lookup, outer_on
from sundial.sources.scans import after_until, between, last_weeks

PHONE, RECEIVER, FRIEND = "phone_number", "receive_phone_number", "2FRIEND"


def credit_features(transfers: DataFrame, snapshot: DateLike, weeks: int) -> DataFrame:
    """Own transactions, credit received (gifts count for the receiver) and gifts received.

    Every transfer is read once and counted under both subscribers it concerns.
    """
    w = f"l{weeks}w"
    gift = F.col("service_name") == FRIEND
    sent = F.struct(F.col(PHONE).alias("who"), F.lit(1).alias("sent"), F.lit(0).alias("credit"), F.lit(0).alias("gift"))
    taken = F.struct(F.when(gift, F.col(RECEIVER)).otherwise(F.col(PHONE)).alias("who"), F.lit(0).alias("sent"),
                     F.when(gift.isNotNull(), 1).otherwise(0).alias("credit"), F.when(gift, 1).otherwise(0).alias("gift"))
    roles = last_weeks(transfers, snapshot, weeks).select("date", "amount", F.inline(F.array(sent, taken)))
    parts = {"sent": "", "credit": "credit_", "gift": "2friend_"}
    daily = roles.groupBy("who", "date").agg(
        *[F.sum(p).alias(p) for p in parts], *[sum_where(F.col(p) == 1, F.col("amount")).alias(f"amt_{p}") for p in parts])
    columns = []
    for part, name in parts.items():
        count = "vasc_2friend_num" if part == "gift" else f"vasc_{name}txn_num"
        columns += [F.nullif(F.sum(part), F.lit(0)).alias(f"{count}_{w}"),
                    F.nullif(count_where(F.col(part) > 0), F.lit(0)).alias(f"vasc_{name}day_num_{w}")]
        if part != "sent":
            columns.append(F.sum(f"amt_{part}").alias(f"vasc_{name}amt_{w}"))
    return daily.groupBy(F.col("who").alias(PHONE)).agg(*columns).filter(
        f"vasc_txn_num_{w} IS NOT NULL OR vasc_credit_txn_num_{w} IS NOT NULL OR vasc_2friend_num_{w} IS NOT NULL")


# Amount classes as upper (le) or lower (ge) limits.
AMOUNT_LIMITS = {"le5k": 5_000, "le10k": 10_000, "le17k": 17_000, "le27k": 27_000, "le50k": 50_000, "ge100k": 100_000}
SERVICES = ["UTN", "2FRIEND", "UDV"]


def monthly_features(transfers: DataFrame, hours: DataFrame, snapshot: DateLike, months: int) -> DataFrame:
    """Counts and amounts by time of day, weekend, service and amount, for senders and receivers."""
    w = f"l{months}m"
    start = add_months(snapshot, -months) - dt.timedelta(days=1)
    rows = between(transfers, start, snapshot).distinct().withColumns({
        "service_name": F.upper("service_name"), "hour": F.hour("transaction_time"), "weekend": is_weekend(F.col("date"))})
    rows = lookup(rows, hours.select("hour", "hour_range_level2"), "hour")
    amount, daytime, weekend = F.col("amount"), F.col("hour_range_level2") == "daytime", F.col("weekend") == 1
    groups = {"daytime": daytime, "weekend": weekend}
    groups |= {s.lower(): F.col("service_name") == s for s in SERVICES}
    groups |= {f"{name}_service": amount <= limit if name.startswith("le") else amount >= limit for name, limit in AMOUNT_LIMITS.items()}
    gift = groups["2friend"]
    service, date, receiver, phone = F.col("service_name"), F.col("date"), F.col(RECEIVER), F.col(PHONE)
    sender = aggregated(rows, [PHONE], [
        Part(f"vasc_txn_num_{w}", "count"), Part(f"vasc_amt_total_{w}", "sum", amount),
        *[Part(f"vasc_txn_{name}_num_{w}", "count", None, test) for name, test in groups.items()],
        *[Part(f"vasc_amt_{name}_total_{w}", "sum", amount, test) for name, test in groups.items()],
        Part(f"vasc_service_num_{w}", "count_distinct", service), Part(f"vasc_receiver2f_num_{w}", "count_distinct", receiver, gift),
        Part(f"vasc_active_day_num_{w}", "count_distinct", date),
        *[Part(f"vasc_{s.lower()}_active_day_num_{w}", "count_distinct", date, groups[s.lower()]) for s in SERVICES]])
    received = aggregated(rows.filter(gift), [RECEIVER], [
        Part(f"vasc_txn_receivce2f_num_{w}", "count"), Part(f"vasc_sender2f_num_{w}", "count_distinct", phone),
        Part(f"vasc_amt_receiver2f_total_{w}", "sum", amount),
        Part(f"vasc_txn_receivce2f_daytime_num_{w}", "count", None, daytime), Part(f"vasc_receivcer2f_daytime_{w}", "count_distinct", phone, daytime),
        Part(f"vasc_amt_receivce2f_daytime_total_{w}", "sum", amount, daytime),
        Part(f"vasc_txn_receivce2f_weekend_num_{w}", "count", None, weekend), Part(f"vasc_receivcer2f_weekend_num_{w}", "count_distinct", phone, weekend),
        Part(f"vasc_amt_receivce2f_weekend_total_{w}", "sum", amount, weekend), Part(f"vasc_receivce2f_active_day_num_{w}", "count_distinct", date)])
    both = outer_on(sender, received, PHONE, RECEIVER)
    opposite = {"nighttime": "daytime", "weekday": "weekend"}
    return both.withColumns({
        **{f"vasc_txn_{new}_num_{w}": F.col(f"vasc_txn_num_{w}") - F.col(f"vasc_txn_{old}_num_{w}") for new, old in opposite.items()},
        **{f"vasc_amt_{new}_total_{w}": F.col(f"vasc_amt_total_{w}") - F.col(f"vasc_amt_{old}_total_{w}") for new, old in opposite.items()}})


def use_features(transfers: DataFrame, activated: DataFrame, snapshot: DateLike, days: int = 59) -> DataFrame:
    """Days, times and amount of borrowed airtime and of gifts sent, current activation only."""
    start = as_date(snapshot) - dt.timedelta(days=days)
    dated = transfers.withColumn("date", F.to_date("transaction_time"))
    own = current_activation(after_until(dated, start, snapshot), activated).distinct()
    kinds = {"UNGTIEN": F.col("service_name") != FRIEND, FRIEND: F.col("service_name") == FRIEND}
    amount = F.col("amount")
    daily = own.filter("service_name IS NOT NULL").groupBy(PHONE, "date").agg(
        *[count_where(t).alias(f"rows_{k}") for k, t in kinds.items()], *[F.count(F.when(t, amount)).alias(f"n_{k}") for k, t in kinds.items()],
        *[sum_where(t, amount).alias(f"a_{k}") for k, t in kinds.items()])
    columns = []
    for k in kinds:
        columns += [count_where(F.col(f"rows_{k}") > 0).alias(f"vasc_num_days_uses_{k}"), F.sum(f"n_{k}").alias(f"vasc_num_times_uses_{k}"),
                    F.sum(f"a_{k}").alias(f"vasc_amount_expence_{k}")]
    return fill_missing(daily.groupBy(PHONE).agg(*columns), 0, keys=[PHONE])
