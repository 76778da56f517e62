"""Device history families."""

from __future__ import annotations

from pyspark.sql import functions as F

from sundial.checks.fixtures import ORDERS_SNAPSHOT
from sundial.checks.registry import query
from sundial.plans import devices

SNAP = f"DATE '{ORDERS_SNAPSHOT}'"
WEEKS = devices.WINDOW_WEEKS

ACTIVATED = f"(SELECT phone_number, max(last_activated_date) AS lad FROM activation WHERE date > {SNAP} - 14 AND date <= {SNAP} GROUP BY 1)"


def history_sql(table: str, test: str, weeks: int = 104) -> str:
    return (f"SELECT t.* FROM {table} t JOIN {ACTIVATED} a USING (phone_number) "
            f"WHERE t.date > {SNAP} - {7 * weeks} AND t.date <= {SNAP} AND t.date {test} a.lad")


def since(n: int, until: int = 0) -> str:
    return f"date > {SNAP} - {7 * n} AND date <= {SNAP} - {7 * until}"


def shape_sql(column: str, func: str) -> str:
    """Population skewness and excess kurtosis, null where the spread is zero."""
    n, m = f"count({column})", f"avg({column})"
    if func == "kurtosis":
        return f"CASE WHEN var_pop({column}) > 0 THEN kurtosis_pop({column}) END"
    central = (f"(avg({column} * {column} * {column}::DOUBLE) - 3 * {m} * avg({column} * {column}::DOUBLE) + 2 * {m} * {m} * {m})")
    return f"CASE WHEN {n} > 0 AND var_pop({column}) > 0 THEN {central} / pow(var_pop({column}), 1.5) END"


def statistic_sql(column: str, func: str) -> str:
    if func in ("skewness", "kurtosis"):
        return shape_sql(column, func)
    return f"{ {'std': 'stddev_samp'}.get(func, func)}({column})"


def entity_sql(names: devices.EntityNames, table: str) -> str:
    e = names.entity
    pair, shared = [], []
    for n in WEEKS:
        if names.events:
            pair.append(f"count(phone_number) FILTER ({since(n)}) AS {names.events}_l{n}w")
        pair.append(f"count(DISTINCT date) FILTER ({since(n)}) AS {names.weeks}_l{n}w")
        if names.days:
            pair.append(f"sum(device_num_day_l1w) FILTER ({since(n)}) AS {names.days}_l{n}w")
        shared.append(f"count(DISTINCT phone_number) FILTER ({since(n)}) AS {names.shared}_l{n}w")
    bases = [b for b in (names.events, names.weeks, names.days, names.shared) if b]
    stats, shares = [], []
    for b in bases:
        for n in WEEKS:
            for func in ("min", "max", "avg", "std", "skewness", "kurtosis"):
                if names.events and func == "min" and b in (names.events, names.shared):
                    continue
                if names.events and func == "avg" and b == names.shared:
                    continue
                stats.append(f"{statistic_sql(f'{b}_l{n}w', func)} AS {b}_{func}_l{n}w")
            if names.entropy:
                p = f"p_{b}_l{n}w"
                shares.append(f"{b}_l{n}w::DOUBLE / nullif(sum({b}_l{n}w) OVER (PARTITION BY phone_number), 0) AS {p}")
                stats.append(f"round(-sum(CASE WHEN {p} > 0 THEN {p} * log2({p}) ELSE 0 END), 6) AS {b}_entropy_l{n}w")
    fans = [f"count(DISTINCT {e}) FILTER ({since(n)}) AS {names.distinct}_l{n}w" for n in WEEKS]
    inner = f"SELECT * {''.join(', ' + s for s in shares)} FROM pairs LEFT JOIN shared USING ({e})"
    sql = (f"WITH history AS ({history_sql(table, '>')}), "
           f"pairs AS (SELECT phone_number, {e}, {', '.join(pair)} FROM history GROUP BY 1, 2), "
           f"shared AS (SELECT {e}, {', '.join(shared)} FROM history GROUP BY 1), "
           f"dist AS (SELECT phone_number, {', '.join(stats)} FROM ({inner}) GROUP BY 1), "
           f"fan AS (SELECT phone_number, {', '.join(fans)} FROM history GROUP BY 1)")
    if not names.sets:
        return sql + " SELECT * FROM dist JOIN fan USING (phone_number)"
    sets, ratios = [], []
    for n in WEEKS[:-1]:
        sets.append(f"coalesce(list(DISTINCT {e}) FILTER ({since(n)}), []) AS c{n}")
        sets.append(f"coalesce(list(DISTINCT {e}) FILTER ({since(2 * n, n)}), []) AS h{n}")
        either = f"nullif(len(list_distinct(list_concat(c{n}, h{n}))), 0)"
        both = f"len(list_intersect(c{n}, h{n}))"
        ratios.append(f"round(coalesce({both} / {either}, 0), 6) AS {names.sets}_intersection_ratio_l{n}w")
        ratios.append(f"round(coalesce((len(c{n}) - {both}) / {either}, 0), 6) AS {names.sets}_except_ratio_l{n}w")
    return (sql + f", sets AS (SELECT phone_number, {', '.join(sets)} FROM history GROUP BY 1)"
            f" SELECT * EXCLUDE ({', '.join(f'c{n}, h{n}' for n in WEEKS[:-1])}), {', '.join(ratios)}"
            " FROM dist JOIN fan USING (phone_number) JOIN sets USING (phone_number)")


SHAPES = ".*_(avg|std|skewness|kurtosis|entropy|ratio)_l.*"
WEEKLY_SQL = ("SELECT phone_number, imei, tac, count(DISTINCT date) AS device_num_day_l1w FROM sightings "
              f"WHERE date > {SNAP} - 7 AND date <= {SNAP} AND NOT (channel = 1 AND date = DATE '2001-07-25') "
              "AND phone_number IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1, 2, 3")


@query("FP1_weekly_sightings", WEEKLY_SQL, "sightings")
def weekly(f):
    seen = f.sightings()
    sample = f.orders.filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "phone_number")
    return devices.weekly_sightings(seen.filter("channel = 0"), seen.filter("channel = 1"), ORDERS_SNAPSHOT,
                                    sample, ["2001-07-25"])


@query("FP2_imei_features", entity_sql(devices.IMEI, "imei_weekly"), "imei_weekly activation", SHAPES)
def imei(f):
    history = devices.activated_history(f.imei_weekly(), f.activation(), ORDERS_SNAPSHOT)
    return devices.entity_features(history, devices.IMEI, ORDERS_SNAPSHOT)


@query("FP3_tac_features", entity_sql(devices.TAC, "imei_weekly"), "imei_weekly activation", SHAPES)
def tac(f):
    history = devices.activated_history(f.imei_weekly(), f.activation(), ORDERS_SNAPSHOT)
    return devices.entity_features(history, devices.TAC, ORDERS_SNAPSHOT)


@query("FP4_national_id_features", entity_sql(devices.NATIONAL_ID, "naid_monthly"), "naid_monthly activation", SHAPES)
def national_id(f):
    history = devices.activated_history(f.naid_monthly(), f.activation(), ORDERS_SNAPSHOT)
    return devices.entity_features(history, devices.NATIONAL_ID, ORDERS_SNAPSHOT)


def current_sql() -> str:
    parts = []
    for rank, p in devices.RANKS.items():
        one = f"max({{}}) FILTER (rn = {rank})"
        parts += [f"{one.format('tac')} AS {p}_tac_l2w", f"{one.format('days')} AS {p}_tac_active_days_l2w",
                  f"{one.format('seen')} AS {p}_tac_last_seen_date_l2w", f"{one.format('events')} AS {p}_tac_events_count_l2w"]
    derived, joins = [], ""
    for p in devices.RANKS.values():
        derived += [
            f"round({p}_tac_active_days_l2w / nullif(device_active_days_l2w, 0), 6) AS {p}_dominant_day_ratio_l2w",
            f"{SNAP} - {p}_tac_last_seen_date_l2w AS {p}_days_since_last_seen_l2w",
            f"round({p}_tac_events_count_l2w / nullif(device_active_events_l2w, 0), 6) AS {p}_dominant_events_ratio_l2w"]
        for c in ("brand", "model", "os", "type"):
            derived.append(f"CASE WHEN {p}_tac_l2w IS NULL THEN NULL ELSE coalesce(lower({p}.device_{c}), 'unmapped') END AS {p}_{c}_l2w")
        joins += f" LEFT JOIN tac_map {p} ON {p}.tac = {p}_tac_l2w"
    return (f"WITH own AS (SELECT * FROM ({history_sql('imei_weekly', '>=', 12)}) QUALIFY max(date) OVER (PARTITION BY phone_number) - date < 14), "
            "totals AS (SELECT phone_number, count(imei) AS device_active_events_l2w, count(DISTINCT date) AS device_active_days_l2w FROM own GROUP BY 1), "
            f"per_tac AS (SELECT phone_number, tac, count(*) FILTER ({since(2)}) AS events, count(DISTINCT date) FILTER ({since(2)}) AS days, max(date) FILTER ({since(2)}) AS seen FROM own GROUP BY 1, 2), "
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY phone_number ORDER BY days DESC, seen DESC NULLS LAST, tac) AS rn FROM per_tac), "
            f"wide AS (SELECT phone_number, {', '.join(parts)} FROM ranked GROUP BY 1) "
            f"SELECT wide.*, device_active_events_l2w, device_active_days_l2w, {', '.join(derived)} FROM totals JOIN wide USING (phone_number){joins}")


@query("FP5_current_device", current_sql(), "imei_weekly activation tac_map", ".*_ratio_l2w",
       ".*_(brand|model|os|type|last_seen_date)_l2w")
def current(f):
    return devices.current_devices(f.imei_weekly(), f.activation(), f.tac_map(), ORDERS_SNAPSHOT)


def sequence_sql(device: str) -> str:
    return (f"WITH history AS (SELECT phone_number, date, {device} AS device FROM ({history_sql('device_current', '>=')})), "
            "marked AS (SELECT *, coalesce((device <> lag(device) OVER w)::INT, 0) AS is_switch, "
            "first_value(device) OVER (PARTITION BY phone_number ORDER BY date DESC) AS current_device "
            "FROM history WINDOW w AS (PARTITION BY phone_number ORDER BY date)), "
            "grouped AS (SELECT *, sum(is_switch) OVER (PARTITION BY phone_number ORDER BY date) AS switch_group FROM marked)")


def gaps_sql() -> str:
    """Gap columns straight from the definition: per window, with the window start as a floor."""
    marks = ", ".join(f"CASE WHEN is_switch = 1 AND {since(n)} THEN date END AS sw{n}" for n in WEEKS)
    prevs = ", ".join(f"last_value(sw{n} IGNORE NULLS) OVER (PARTITION BY phone_number ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pr{n}" for n in WEEKS)
    gaps = ", ".join(f"CASE WHEN sw{n} IS NOT NULL AND pr{n} IS NOT NULL THEN (date - greatest(pr{n}, {SNAP} - {7 * n})) / 7.0::DOUBLE END AS gap{n}" for n in WEEKS)
    return (f", base AS (SELECT *, {gaps} FROM (SELECT *, {prevs} FROM (SELECT *, {marks} FROM grouped)))")


def behaviour_sql(device: str, label: str, first_seen: bool) -> str:
    parts, streak, longest = [], [], []
    for n in WEEKS:
        inside, current = since(n), f"{since(n)} AND device = current_device"
        parts += [
            f"count(*) FILTER ({current}) AS device_current_{label}_active_weeks_l{n}w",
            f"count(DISTINCT device) FILTER ({inside}) AS device_current_{label}_distinct_count_l{n}w",
            f"round(count(*) FILTER ({current}) / nullif(count(DISTINCT date) FILTER ({inside}), 0), 6) AS device_current_{label}_active_ratio_l{n}w",
            f"max(date) FILTER ({current}) - min(date) FILTER ({current}) AS device_current_{label}_active_span_l{n}w",
            f"{SNAP} - max(date) FILTER ({current}) AS device_current_{label}_days_since_last_seen_l{n}w",
            f"sum(is_switch) FILTER ({inside}) AS device_switch_{label}_count_l{n}w"]
        if first_seen:
            parts.append(f"{SNAP} - min(date) FILTER ({current}) AS device_current_{label}_days_since_first_seen_l{n}w")
        parts += [f"{statistic_sql(f'gap{n}', func)} AS device_switch_{label}_gap_{func}_l{n}w"
                  for func in ("min", "max", "avg", "std", "skewness", "kurtosis")]
        streak += [f"count(*) FILTER ({inside}) AS any{n}", f"count(*) FILTER ({current}) AS cur{n}"]
        longest += [f"max(any{n}) AS device_max_streak_any_{label}_week_l{n}w", f"max(cur{n}) AS device_max_streak_current_{label}_week_l{n}w"]
    return (sequence_sql(device) + gaps_sql() + f", features AS (SELECT phone_number, {', '.join(parts)} FROM base GROUP BY 1), "
            f"streaks AS (SELECT phone_number, switch_group, {', '.join(streak)} FROM base GROUP BY 1, 2), "
            f"longest AS (SELECT phone_number, {', '.join(longest)} FROM streaks GROUP BY 1) "
            "SELECT * FROM features JOIN longest USING (phone_number)")


GAPS = ".*(_gap_|_ratio_).*"


@query("FP6_tac_behaviour", behaviour_sql("device_current_tac_l2w", "tac", False), "device_current activation", GAPS)
def tac_behaviour(f):
    history = devices.activated_history(f.device_current(), f.activation(), ORDERS_SNAPSHOT, strict=False, bounded=True)
    return devices.behaviour_features(history, "device_current_tac_l2w", "tac", ORDERS_SNAPSHOT)


@query("FP7_brand_behaviour", behaviour_sql("device_current_brand_l2w", "brand", True), "device_current activation", GAPS)
def brand_behaviour(f):
    history = devices.activated_history(f.device_current(), f.activation(), ORDERS_SNAPSHOT, strict=False, bounded=True)
    return devices.behaviour_features(history, "device_current_brand_l2w", "brand", ORDERS_SNAPSHOT, since_first_seen=True)


def switch_sql() -> str:
    parts = []
    for n in WEEKS:
        parts += [f"sum(is_switch) FILTER ({since(n)}) AS device_switch_count_l{n}w"]
        parts += [f"{func}(gap{n}) AS device_switch_tac_gap_{func}_l{n}w" for func in ("avg", "max", "min")]
    return (sequence_sql("device_current_tac_l2w") + gaps_sql() +
            f", features AS (SELECT phone_number, {', '.join(parts)} FROM base GROUP BY 1), "
            "lengths AS (SELECT phone_number, date, count(*) OVER (PARTITION BY phone_number, switch_group) AS streak_length FROM base) "
            "SELECT features.*, streak_length FROM features JOIN (SELECT * FROM lengths QUALIFY row_number() OVER (PARTITION BY phone_number ORDER BY date DESC) = 1) USING (phone_number)")


@query("FP8_switch_features", switch_sql(), "device_current activation", GAPS)
def switches(f):
    history = devices.activated_history(f.device_current(), f.activation(), ORDERS_SNAPSHOT, strict=False, bounded=True)
    return devices.switch_features(history, "device_current_tac_l2w", ORDERS_SNAPSHOT)
