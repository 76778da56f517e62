"""Calendars, series, indicators and their joins to labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from sundial.checks.device_queries import shape_sql
from sundial.checks.fixtures import ORDERS_SNAPSHOT
from sundial.checks.registry import query
from sundial.plans import calendars, markets, training
from sundial.sources import feeds

SNAP = f"DATE '{ORDERS_SNAPSHOT}'"
START, END = "1996-01-01", "2001-06-30"

HOLIDAY_DAYS = ("hol AS (SELECT CAST(unnest(generate_series(h.date, h.end_date, INTERVAL 1 DAY)) AS DATE) AS date, holiday, contains(lower(holiday), 'lunar new year')::INT AS is_tet "
                "FROM holidays h WHERE scope = 'national')")


@query("S9_holiday_days", f"WITH {HOLIDAY_DAYS} SELECT *, 1 AS is_national_holiday FROM hol", "holidays", texts="date|holiday")
def holiday_days(f):
    return feeds.holidays(f.holidays())


def holiday_sql(spans=(7, 30), weekly: bool = True) -> str:
    parts = []
    for n in spans:
        for name, low, high in ((f"next_{n}d", "c.date + 1", f"c.date + {n}"), (f"last_{n}d", f"c.date - {n}", "c.date - 1")):
            parts += [f"(SELECT count(DISTINCT h.date) FROM hol h WHERE h.date BETWEEN {low} AND {high} AND h.date BETWEEN DATE '{START}' AND DATE '{END}') AS holiday_day_{name}",
                      f"(SELECT count(DISTINCT h.holiday) FROM hol h WHERE h.date BETWEEN {low} AND {high}) AS holiday_event_{name}"]
    for tet, name in (("", "national_holiday"), ("h.is_tet = 1 AND ", "tet")):
        ahead, behind = ("days_to_next_national_holiday", "days_since_last_national_holiday") if not tet else ("days_to_tet", "days_since_tet")
        parts += [f"coalesce((SELECT min(h.date) FROM hol h WHERE {tet}h.date >= c.date) - c.date, 0) AS {ahead}",
                  f"coalesce(c.date - (SELECT max(h.date) FROM hol h WHERE {tet}h.date <= c.date), 0) AS {behind}"]
    inside = f"FROM hol h WHERE h.date BETWEEN DATE '{START}' AND DATE '{END}'"
    parts += [f"(SELECT count(DISTINCT h.date) {inside} AND h.date = c.date) AS is_national_holiday",
              f"(SELECT count(DISTINCT h.date) {inside} AND h.is_tet = 1 AND h.date = c.date) AS is_tet",
              f"(SELECT count(DISTINCT h.date) {inside} AND date_trunc('month', h.date) = date_trunc('month', c.date)) AS holidays_this_month",
              f"(SELECT count(DISTINCT h.date) {inside} AND h.is_tet = 1 AND date_trunc('month', h.date) = date_trunc('month', c.date)) AS tet_this_month",
              f"(SELECT count(DISTINCT h.date) {inside} AND date_trunc('week', h.date) = date_trunc('week', c.date)) AS holidays_this_week",
              "(isodow(c.date) >= 6)::INT AS is_weekend"]
    where = " WHERE isodow(c.date) = 7" if weekly else ""
    return (f"WITH {HOLIDAY_DAYS}, cal AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS date) "
            f"SELECT *, (holidays_this_week > 0)::INT AS is_holiday_week FROM (SELECT c.date, {', '.join(parts)} FROM cal c{where})")


@query("FP36_holiday_features", holiday_sql(), "holidays", texts="date")
def holiday(f):
    return calendars.holiday_features(feeds.holidays(f.holidays()), START, END)


@query("FP36_holiday_features_daily", holiday_sql(weekly=False), "holidays", texts="date")
def holiday_daily(f):
    return calendars.holiday_features(feeds.holidays(f.holidays()), START, END, weekly=False)


PUBLISHED = f"SELECT {', '.join(calendars.PUBLISHED)} FROM ({holiday_sql()})"


@query("FP36_holiday_published", PUBLISHED, "holidays", texts="date")
def holiday_published(f):
    return calendars.published(holiday(f))


# assets

SPINE = ("bounds AS (SELECT ticker, min(date) AS lo, max(date) AS hi FROM series GROUP BY 1), "
         "spine AS (SELECT ticker, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds), "
         "daily AS (SELECT ticker, date, close, volume, close / lag(close) OVER w - 1 AS daily_return FROM spine LEFT JOIN series USING (ticker, date) WINDOW w AS (PARTITION BY ticker ORDER BY date))")


def asset_sql() -> str:
    frames, names = [], []
    for n in markets.WINDOWS:
        w = f"l{n}w"
        frames.append(
            f"j{n} AS (SELECT s.ticker, s.date AS snap, r.date, r.close, r.volume, r.daily_return, max(r.close) OVER (PARTITION BY s.ticker, s.date ORDER BY r.date ROWS UNBOUNDED PRECEDING) AS peak "
            f"FROM spine s JOIN daily r ON s.ticker = r.ticker AND r.date > s.date - {7 * n} AND r.date <= s.date WHERE isodow(s.date) = 7), "
            f"a{n} AS (SELECT ticker, snap, max_by(close, date) FILTER (close IS NOT NULL) AS last_close_{w}, min_by(close, date) FILTER (close IS NOT NULL) AS first_close_{w}, stddev_samp(close) AS std_close_{w}, "
            f"min(close / peak - 1) AS max_drawdown_{w}, quantile_disc(daily_return, 0.05) AS return_var95_{w}, avg(daily_return) AS return_mean_{w}, stddev_samp(daily_return) AS return_std_{w}, "
            f"min(daily_return) AS return_min_{w}, max(daily_return) AS return_max_{w}, avg(volume) AS volume_mean_{w}, stddev_samp(volume) AS volume_std_{w}, {shape_sql('volume', 'skewness')} AS volume_skew_{w}, "
            f"max(volume) AS volume_max_{w}, min(close) AS price_min_{w}, max(close) AS price_max_{w} FROM j{n} GROUP BY 1, 2), "
            f"c{n} AS (SELECT j.ticker, j.snap, avg(daily_return) AS return_cvar95_{w} FROM j{n} j JOIN a{n} a ON j.ticker = a.ticker AND j.snap = a.snap WHERE daily_return <= return_var95_{w} GROUP BY 1, 2)")
        low, high, newest = f"price_min_{w}", f"price_max_{w}", f"last_close_{w}"
        names += [f"{newest} / {high} - 1 AS distance_to_high_{w}", f"CASE WHEN {low} > 0 THEN {newest} / {low} - 1 END AS distance_to_low_{w}",
                  f"({newest} - {low}) / nullif({high} - {low}, 0) AS price_percentile_{w}", f"{newest} / first_close_{w} - 1 AS price_return_{w}",
                  f"return_mean_{w} / nullif(return_std_{w}, 0) * sqrt(252) AS return_sharpe_{w}"]
        names += [f"{newest} / lag({newest}, {k}) OVER (PARTITION BY ticker ORDER BY snap) - 1 AS price_circle_growth_{w}_c{k}w" for k in markets.GROWTH_STEPS]
    pairs = []
    for a, b in markets.PAIRS:
        s = f"l{a}w_l{b}w"
        pairs += [f"return_std_l{a}w - return_std_l{b}w AS vol_diff_{s}", f"return_sharpe_l{a}w - return_sharpe_l{b}w AS sharpe_diff_{s}", f"volume_mean_l{a}w - volume_mean_l{b}w AS volume_diff_{s}",
                  f"return_std_l{a}w / nullif(return_std_l{b}w, 0) AS vol_ratio_{s}", f"return_mean_l{a}w / nullif(return_mean_l{b}w, 0) AS return_mean_ratio_{s}"]
    joins = "a1" + "".join(f" LEFT JOIN {t} USING (ticker, snap)" for t in ("a4", "a24", "c1", "c4", "c24"))
    return f"WITH {SPINE}, {', '.join(frames)}, derived AS (SELECT *, {', '.join(names)} FROM {joins}) SELECT *, {', '.join(pairs)} FROM derived"


@query("FP37_asset_features", asset_sql(), "series", ".*_.*", "ticker|snap", whole=False, digits=5)
def assets(f):
    return markets.asset_features(f.series())


KEPT = [f"{c}_l4w" for c in markets.KEPT_4W] + [f"{c}_l24w" for c in markets.KEPT_24W] + [f"{c}_l4w_l24w" for c in markets.KEPT_PAIRS] + [
    f"price_circle_growth_l{n}w_c{k}w" for n in markets.WINDOWS for k in markets.GROWTH_STEPS]


@query("FP37_asset_published", f"SELECT ticker, snap, {', '.join(KEPT)} FROM ({asset_sql()})", "series", ".*_.*", "ticker|snap", whole=False, digits=5)
def assets_published(f):
    return markets.published_asset_columns(assets(f))


def indicator_sql(by_month: bool) -> str:
    spine = ("bounds AS (SELECT indicator, min(date) AS lo, max(date) AS hi FROM indicator GROUP BY 1), "
             "sundays AS (SELECT * FROM (SELECT indicator, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS snap FROM bounds) WHERE isodow(snap) = 7)")
    if by_month:
        value = "SELECT s.indicator, snap, percentage AS value FROM sundays s JOIN indicator i ON i.indicator = s.indicator AND strftime(i.date, '%Y-%m') = strftime(snap, '%Y-%m')"
    else:
        value = "SELECT s.indicator, snap, percentage AS value FROM sundays s ASOF JOIN indicator i ON i.indicator = s.indicator AND i.date <= s.snap"
    growth = ", ".join(f"value / lag(value, {k}) OVER (PARTITION BY indicator ORDER BY snap) - 1 AS circle_growth_c{k}w" for k in markets.GROWTH_STEPS)
    return f"WITH {spine} SELECT *, {growth} FROM ({value})"


@query("FP38_indicator_features", indicator_sql(False), "indicator", "value|circle.*", "indicator|snap", whole=False)
def indicators(f):
    return markets.indicator_features(f.indicator())


@query("FP38_indicator_features_by_month", indicator_sql(True), "indicator", "value|circle.*", "indicator|snap", whole=False)
def indicators_by_month(f):
    return markets.indicator_features(f.indicator(), by_month=True)


TICKERS, INDICATORS = ["f", "o", "p"], ["a", "n", "r"]
SIDE = ["price_return_l4w", "return_cvar95_l4w", "price_circle_growth_l1w_c4w"]


def external_sql() -> str:
    asset = ", ".join(f"max({c}) FILTER (ticker = '{t}') AS {t}_{c}" for t in TICKERS for c in SIDE)
    macro = ", ".join(f"max({c}) FILTER (indicator = '{i}') AS {i}_{c}" for i in INDICATORS for c in ("value", *[f"circle_growth_c{k}w" for k in markets.GROWTH_STEPS]))
    return (f"SELECT * FROM ({PUBLISHED}) FULL JOIN (SELECT snap AS date, {asset} FROM ({asset_sql()}) GROUP BY 1) USING (date) "
            f"FULL JOIN (SELECT snap AS date, {macro} FROM ({indicator_sql(False)}) GROUP BY 1) USING (date)")


def external(f):
    asset = markets.one_row_per_snapshot(assets(f).select("ticker", "snap", *SIDE), "ticker", TICKERS)
    macro = markets.one_row_per_snapshot(indicators(f), "indicator", INDICATORS)
    return training.external_table(holiday_published(f), asset, macro)


EXTERNAL_DOUBLES = "[a-z]_(price|return|value|circle).*"


@query("FP39_external_table", external_sql(), "holidays series indicator", EXTERNAL_DOUBLES, "date", digits=5)
def external_table(f):
    return external(f)


@query("FP39_external_on_labels",
       f"WITH ext AS ({external_sql()}) SELECT l.*, e.* FROM label l LEFT JOIN ext e ON e.date = l.disburse_date - (isodow(l.disburse_date) + CASE WHEN isodow(l.disburse_date) <= 3 THEN 7 ELSE 0 END)::INT",
       "label holidays series indicator", EXTERNAL_DOUBLES, "date|disburse_date|product", digits=5)
def external_on_labels(f):
    return training.with_external(f.label(), external(f))


# training table: two weekly families

SUNDAY = "CAST(date + (7 - isodow(date))::INT AS DATE)"
ACTIVITY = f"activity AS (SELECT phone_number, {SUNDAY} AS date, count(*) AS n, CAST(sum(amount) AS DECIMAL(18, 2)) AS amount FROM balance_txn GROUP BY 1, 2)"
DEVICE = "device AS (SELECT phone_number, date, count(*) AS n, sum(device_num_day_l1w) AS days FROM imei_weekly GROUP BY 1, 2)"


def families(f):
    sunday = F.expr("date_add(date, 6 - weekday(date))")
    activity = f.balance_txn().groupBy("phone_number", sunday.alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))
    device = f.imei_weekly().groupBy("phone_number", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("device_num_day_l1w").alias("days"))
    return {"activity": activity, "device": device}


@query("FP40_training_table",
       f"WITH {ACTIVITY}, {DEVICE} SELECT l.*, a.n AS n_activity, a.amount AS amount_activity, d.n AS n_device, d.days AS days_device FROM label l "
       "LEFT JOIN activity a ON a.phone_number = l.phone_number AND l.disburse_date - a.date BETWEEN 3 AND 9 "
       "LEFT JOIN device d ON d.phone_number = l.phone_number AND l.disburse_date - d.date BETWEEN 3 AND 9",
       "label balance_txn imei_weekly", "amount_activity", "disburse_date|product", digits=2)
def master(f):
    return training.master_table(f.label(), families(f))


# feeds as text, derived from the series

@query("S7_price_feed", "SELECT ticker, date, close, close + 1.5 AS open, volume FROM series", "series", "close|open|volume", "ticker|date", whole=False, digits=2)
def price_feed(f):
    volume = F.when(F.col("volume") >= 2000, F.format_string("%.3fK", F.col("volume") / 1000)).otherwise(F.format_number("volume", 0))
    raw = f.series().select("ticker", F.date_format("date", "dd/MM/yyyy").alias("Date"), F.format_number("close", 2).alias("Price"),
                            F.format_number(F.col("close") + 1.5, 2).alias("Open"), volume.alias("Vol."))
    broken = raw.filter("ticker = 'p'").withColumn("Date", F.lit("no day"))
    return feeds.prices(raw.unionByName(broken))


@query("S8_percent_feed", "SELECT date, percentage, indicator FROM indicator", "indicator", "percentage", "date|indicator", whole=False)
def percent_feed(f):
    raw = f.indicator().select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.format_string("%.2f%%", "percentage").alias("percentage"), F.col("indicator").alias("feed"))
    return feeds.percentages(raw, F.col("feed"))
