"""Device history: weekly sightings, sharing and diversity, current device, switches and streaks."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sundial.functions.dates import DateLike, as_date, days_since
from sundial.functions.numbers import safe_ratio
from sundial.functions.texts import category_or_unmapped
from sundial.operators.aggregates import latest_value
from sundial.operators.joins import HOT_ROWS, current_activation, hot_key_join, lookup, present_in
from sundial.operators.sequences import previous_marked_date, recent_rows, switches, top_per_group
from sundial.operators.sets import statistic_columns
from sundial.operators.windows import last, last_and_previous
from sundial.session import KEY_PARTS, cut_lineage, dealt_by_key
from sundial.sources.scans import after_until, last_weeks, without_days

PHONE = "phone_number"
WINDOW_WEEKS = (12, 24, 48, 96)
HISTORY_WEEKS = 104
CURRENT_WEEKS = 2
RANKS = {1: "device_current", 2: "device_2nd"}
# Days whose call records are known to be broken.
BROKEN_CALL_DAYS = ("2022-11-16", "2023-01-07", "2023-08-03")


def weekly_sightings(messages: DataFrame, calls: DataFrame, snapshot: DateLike,
                     subscribers: DataFrame | None = None, broken_call_days=BROKEN_CALL_DAYS) -> DataFrame:
    """Distinct days each (SIM, device) pair was seen in the week that ends on the snapshot."""
    columns = [PHONE, "imei", "tac", "date"]
    week = last_weeks(messages, snapshot, 1).select(*columns).unionByName(
        last_weeks(without_days(calls, broken_call_days), snapshot, 1).select(*columns))
    days = week.distinct()
    if subscribers is not None:
        days = present_in(days, subscribers, [PHONE])
    return days.groupBy(PHONE, "imei", "tac").agg(F.count("date").alias("device_num_day_l1w"))


def activation_dates(activated: DataFrame, snapshot: DateLike) -> DataFrame:
    """Newest activation per subscriber, from the last two weeks of activation snapshots."""
    since = as_date(snapshot) - dt.timedelta(weeks=2)
    return latest_value(activated, [PHONE], "last_activated_date", "date", since, as_date(snapshot))


def activated_history(table: DataFrame, activated: DataFrame, snapshot: DateLike, weeks: int = HISTORY_WEEKS,
                      strict: bool = True, bounded: bool = False) -> DataFrame:
    """Rows of the look-back that belong to the subscriber's current activation.

    Those of `bounded` tables are dealt by subscriber, for the join and for the windows behind it.
    """
    rows = after_until(table, as_date(snapshot) - dt.timedelta(weeks=weeks), snapshot)
    if bounded:
        rows = dealt_by_key(rows, PHONE)
    return current_activation(rows, activation_dates(activated, snapshot), strict=strict, bounded=bounded)


@dataclass(frozen=True)
class EntityNames:
    """Column names of one entity family."""

    entity: str
    shared: str
    distinct: str
    weeks: str
    events: str | None = None
    days: str | None = None
    sets: str | None = None
    entropy: bool = True


IMEI = EntityNames("imei", "device_imei_distinct_pn_count", "device_pn_imei_distinct_count",
                   "device_pn_imei_distinct_weeks_count", "device_pn_imei_events_count",
                   "device_pn_imei_distinct_days_count", "device_imei_set")
TAC = EntityNames("tac", "device_tac_distinct_pn_count", "device_pn_tac_distinct_count",
                  "device_pn_tac_distinct_weeks_count", "device_pn_tac_events_count",
                  "device_pn_tac_distinct_days_count", "device_tac_set")
NATIONAL_ID = EntityNames("naid", "nid_distinct_pn_count", "nid_distinct_nid_count",
                          "nid_distinct_weeks_count", entropy=False)


def pair_activity(history: DataFrame, names: EntityNames, snapshot: DateLike,
                  weeks: tuple[int, ...] = WINDOW_WEEKS) -> DataFrame:
    """One row per (subscriber, entity): events, distinct weeks and active days for every window.

    Rows are first brought to one per (subscriber, entity, day), so distinct days become a count.
    """
    partial = [F.count(PHONE).alias("__events")]
    if names.days:
        partial.append(F.sum("device_num_day_l1w").alias("__days"))
    daily = history.groupBy(PHONE, names.entity, "date").agg(*partial)
    aggregates = []
    for window in last(*weeks):
        inside, w = window.sql("date", snapshot), window.name
        aggregates.append(f"coalesce(sum(__events) FILTER (WHERE {inside}), 0) AS {names.events or '__events'}_{w}")
        aggregates.append(f"count(date) FILTER (WHERE {inside}) AS {names.weeks}_{w}")
        if names.days:
            aggregates.append(f"sum(__days) FILTER (WHERE {inside}) AS {names.days}_{w}")
    if names.sets:
        for window in last_and_previous(*weeks[:-1]):
            aggregates.append(f"coalesce(max({window.sql('date', snapshot)}), false) AS __in_{window.name}")
    return daily.groupBy(PHONE, names.entity).agg(*map(F.expr, aggregates))


def shared_counts(pairs: DataFrame, names: EntityNames, weeks: tuple[int, ...] = WINDOW_WEEKS) -> DataFrame:
    """Subscribers per entity for every window, from the pair table."""
    events = names.events or "__events"
    counts = [f"count({PHONE}) FILTER (WHERE {events}_{w.name} > 0) AS {names.shared}_{w.name}" for w in last(*weeks)]
    return pairs.groupBy(names.entity).agg(*map(F.expr, counts), F.count(F.lit(1)).alias("__pairs"))


def entity_features(history: DataFrame, names: EntityNames, snapshot: DateLike,
                    weeks: tuple[int, ...] = WINDOW_WEEKS) -> DataFrame:
    """Sharing, activity, diversity, overlap and entropy of a subscriber's devices (or ids).

    One aggregate per grain: (subscriber, entity, day) -> (subscriber, entity) -> subscriber. The
    pair table is kept, as both the subscriber counts and the features read it. The
    overlap ratios are counts of entities present in both, either or only the current span, so no
    set is ever collected. The last shuffle moves pairs, as the buffers of all statistics are
    many times wider than a pair.
    """
    pairs = cut_lineage(pair_activity(history, names, snapshot, weeks))
    shared = shared_counts(pairs, names, weeks)
    hot = shared.filter(F.col("__pairs") > HOT_ROWS).select(names.entity)
    rows = hot_key_join(pairs, shared.drop("__pairs"), names.entity, [PHONE], "left", hot=hot)
    windowed = [f"{base}_{w.name}" for w in last(*weeks)
                for base in (names.events, names.weeks, names.days, names.shared) if base]
    if names.events:
        statistics = {"min": [names.events, names.shared], "max": [], "avg": [names.shared]}
    else:
        statistics = {"min": [], "max": [], "avg": []}
    statistics |= {"std": [], "skewness": [], "kurtosis": []}
    if names.entropy:
        statistics["entropy"] = []
    aggregates = statistic_columns(windowed, statistics)
    events = names.events or "__events"
    aggregates += [F.expr(f"count({names.entity}) FILTER (WHERE {events}_{w.name} > 0) AS {names.distinct}_{w.name}") for w in last(*weeks)]
    if names.sets:
        aggregates += _overlap_counts(names, weeks[:-1])
    return dealt_by_key(rows, PHONE, parts=KEY_PARTS // 2).groupBy(PHONE).agg(*aggregates)


def _overlap_counts(names: EntityNames, weeks: tuple[int, ...]) -> list[Column]:
    result = []
    for n in weeks:
        known, current, history = f"{names.entity} IS NOT NULL", f"__in_l{n}w", f"__in_l{2 * n}w_to_l{n}w"
        either = f"count_if({known} AND ({current} OR {history}))"
        for label, part in (("intersection_ratio", f"{current} AND {history}"), ("except_ratio", f"{current} AND NOT {history}")):
            share = f"try_divide(CAST(count_if({known} AND {part}) AS DOUBLE), {either})"
            result.append(F.expr(f"round(coalesce({share}, 0D), 6) AS {names.sets}_{label}_l{n}w"))
    return result


def current_devices(weekly: DataFrame, activated: DataFrame, tac_map: DataFrame, snapshot: DateLike,
                    weeks: int = CURRENT_WEEKS) -> DataFrame:
    """The subscriber's main and second device in the last weeks of own activity."""
    suffix = f"l{weeks}w"
    rows = after_until(weekly, as_date(snapshot) - dt.timedelta(weeks=12), snapshot).filter("imei IS NOT NULL")
    own = current_activation(rows, activation_dates(activated, snapshot), strict=False).distinct()
    # subscriber-days, far fewer than sightings: kept, as what follows reads them four times
    daily = cut_lineage(own.groupBy(PHONE, "tac", "date").agg(F.count(F.lit(1)).alias("__events")))
    daily = recent_rows(daily, [PHONE], "date", weeks * 7)
    totals = daily.groupBy(PHONE).agg(
        F.sum("__events").alias(f"device_active_events_{suffix}"),
        F.count_distinct("date").alias(f"device_active_days_{suffix}"))
    inside = last(weeks)[0].contains(F.col("date"), snapshot)
    per_tac = daily.groupBy(PHONE, "tac").agg(
        F.count(F.when(inside, F.col("date"))).alias("__active_days"),
        F.max(F.when(inside, F.col("date"))).alias("__last_seen_date"),
        F.coalesce(F.sum(F.when(inside, F.col("__events"))), F.lit(0)).alias("__events_count"))
    ranked = top_per_group(per_tac, [PHONE], [F.col("__active_days").desc(), F.col("__last_seen_date").desc(), F.col("tac").asc()], max(RANKS))
    columns = [(rank, prefix, c) for rank, prefix in RANKS.items() for c in ("active_days", "last_seen_date", "events_count")]
    devices = ranked.groupBy(PHONE).agg(
        *[F.max(F.when(F.col("rank") == rank, F.col("tac"))).alias(f"{prefix}_tac_{suffix}") for rank, prefix in RANKS.items()],
        *[F.max(F.when(F.col("rank") == rank, F.col(f"__{c}"))).alias(f"{prefix}_tac_{c}_{suffix}") for rank, prefix, c in columns])
    result = totals.join(devices, PHONE, "left")
    for prefix in RANKS.values():
        result = result.withColumns({
            f"{prefix}_dominant_day_ratio_{suffix}": safe_ratio(
                F.col(f"{prefix}_tac_active_days_{suffix}"), F.col(f"device_active_days_{suffix}")),
            f"{prefix}_days_since_last_seen_{suffix}": days_since(F.col(f"{prefix}_tac_last_seen_date_{suffix}"), snapshot),
            f"{prefix}_dominant_events_ratio_{suffix}": safe_ratio(
                F.col(f"{prefix}_tac_events_count_{suffix}"), F.col(f"device_active_events_{suffix}")),
        })
        result = describe_device(result, tac_map, f"{prefix}_tac_{suffix}", prefix, suffix)
    return result


def describe_device(df: DataFrame, tac_map: DataFrame, tac: str, prefix: str, suffix: str) -> DataFrame:
    """Brand, model, system and type of a device code; 'unmapped' when the code is unknown."""
    parts = {"brand": "device_brand", "model": "device_model", "os": "device_os", "type": "device_type"}
    dimension = tac_map.select(F.col("tac").alias(tac), *[F.col(c).alias(f"__{name}") for name, c in parts.items()])
    joined = lookup(df, dimension, tac)
    named = {f"{prefix}_{name}_{suffix}": category_or_unmapped(F.col(tac), F.col(f"__{name}")) for name in parts}
    return joined.withColumns(named).drop(*[f"__{name}" for name in parts])


def device_sequence(history: DataFrame, device: str) -> DataFrame:
    """Switch flags, groups, gaps to the previous switch and the newest device per subscriber row.

    `history` holds one row per subscriber and snapshot, so a subscriber has at most as many rows
    as there are snapshots in the look-back.
    """
    rows = history.select(PHONE, "date", F.col(device).alias("device")).filter(f"{PHONE} IS NOT NULL AND device IS NOT NULL")
    marked = switches(rows, PHONE, "device", "date")
    return marked.withColumns({
        "current_device": F.max_by("device", "date").over(Window.partitionBy(PHONE)),
        "previous_switch": previous_marked_date(PHONE, "date", F.col("is_switch") == 1),
        "newest_of_device": F.col("date") == F.max("date").over(Window.partitionBy(PHONE, "device")),
    })


def behaviour_features(history: DataFrame, device: str, label: str, snapshot: DateLike,
                       weeks: tuple[int, ...] = WINDOW_WEEKS, since_first_seen: bool = False) -> DataFrame:
    """Loyalty, switches, gaps and streaks of the subscriber's device (or brand) over time.

    All rows of one switch group share a device and hold at most one switch, so a group row
    carries what every statistic needs. A device counts in the windows that hold its newest row.
    Window, group and subscriber levels use one shuffle.
    """
    rows = device_sequence(history, device)
    group, final = [], []
    for window in last(*weeks):
        w, inside = window.name, window.sql("date", snapshot)
        current = f"{inside} AND device = current_device"
        gap = f"CASE WHEN {inside} AND is_switch = 1 AND {window.sql('previous_switch', snapshot)} THEN datediff(date, previous_switch) / 7.0D END"
        group += [
            f"count(date) FILTER (WHERE {inside}) AS __rows_{w}", f"count(date) FILTER (WHERE {current}) AS __current_{w}",
            f"min(date) FILTER (WHERE {current}) AS __first_{w}", f"max(date) FILTER (WHERE {current}) AS __last_{w}",
            f"count(date) FILTER (WHERE {inside} AND newest_of_device) AS __devices_{w}",
            f"sum(is_switch) FILTER (WHERE {inside}) AS __switches_{w}", f"max({gap}) AS switch_{label}_gap_{w}"]
        active, seen = f"sum(__current_{w})", f"sum(__rows_{w})"
        name = f"device_current_{label}"
        final += [
            f"{active} AS {name}_active_weeks_{w}",
            f"sum(__devices_{w}) AS {name}_distinct_count_{w}",
            f"round(try_divide(CAST({active} AS DOUBLE), {seen}), 6) AS {name}_active_ratio_{w}",
            f"datediff(max(__last_{w}), min(__first_{w})) AS {name}_active_span_{w}",
            f"datediff(DATE'{as_date(snapshot)}', max(__last_{w})) AS {name}_days_since_last_seen_{w}",
            f"sum(__switches_{w}) AS device_switch_{label}_count_{w}",
            f"max(__rows_{w}) AS device_max_streak_any_{label}_week_{w}", f"max(__current_{w}) AS device_max_streak_current_{label}_week_{w}"]
        if since_first_seen:
            final.append(f"datediff(DATE'{as_date(snapshot)}', min(__first_{w})) AS {name}_days_since_first_seen_{w}")
    gaps = [f"switch_{label}_gap_{w.name}" for w in last(*weeks)]
    shapes = statistic_columns(gaps, {s: [] for s in ("min", "max", "avg", "std", "skewness", "kurtosis")})
    groups = rows.groupBy(PHONE, "switch_group").agg(*map(F.expr, group))
    features = groups.groupBy(PHONE).agg(*map(F.expr, final), *shapes)
    return features.toDF(*[f"device_{c}" if c.startswith("switch_") else c for c in features.columns])


def switch_features(history: DataFrame, device: str, snapshot: DateLike,
                    weeks: tuple[int, ...] = WINDOW_WEEKS) -> DataFrame:
    """The earlier, smaller form: switch counts, gap statistics and the newest streak's length."""
    rows = device_sequence(history, device)
    aggregates: list[Column] = []
    group = [F.max("date").alias("__last"), F.count(F.lit(1)).alias("__length")]
    for window in last(*weeks):
        w = window.name
        inside = window.contains(F.col("date"), snapshot)
        gap = F.when(inside & (F.col("is_switch") == 1) & window.contains(F.col("previous_switch"), snapshot),
                     F.datediff("date", "previous_switch") / 7.0)
        group += [F.sum(F.when(inside, F.col("is_switch"))).alias(f"__switches_{w}"), F.max(gap).alias(f"__gap_{w}")]
        aggregates += [
            F.sum(f"__switches_{w}").alias(f"device_switch_count_{w}"),
            F.avg(f"__gap_{w}").alias(f"device_switch_tac_gap_avg_{w}"),
            F.max(f"__gap_{w}").alias(f"device_switch_tac_gap_max_{w}"),
            F.min(f"__gap_{w}").alias(f"device_switch_tac_gap_min_{w}"),
        ]
    groups = rows.groupBy(PHONE, "switch_group").agg(*group)
    return groups.groupBy(PHONE).agg(*aggregates, F.max_by("__length", "__last").alias("streak_length"))
