import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from sundial.operators import aggregates, columns, joins, quality, ranges, sequences, sets
from sundial.plans import device_names, devices, lift


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def many_ranges(spark):
    """Small tables would come as one range: adaptive execution joins small partitions."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    for c, value in before.items():
        spark.conf.set(c, value)


def test_overlap_and_novelty(spark):
    df = frame(spark, [(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "x_l12w array<string>, x_l24w_to_l12w array<string>")
    got = df.select(*sets.set_ratio_columns(df.columns)).collect()
    assert [tuple(r) for r in got] == [(0.333333, 0.333333), (0.0, 0.0), (0.0, 1.0)]


def test_entropy_bounds_and_values(spark):
    df = frame(spark, [("a", 1), ("a", 1), ("b", 5), ("c", 0), ("d", None), ("e", 1), ("e", 1), ("e", 2)], "k string, x int")
    got = {r.k: r.h for r in df.groupBy("k").agg(sets.entropy("x").alias("h")).collect()}
    assert got == {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": 1.5}


def test_dominant_value(spark):
    rows = [(1, "p", 90), (1, "q", 10), (2, "p", 89), (2, "q", 10), (3, "p", 5), (3, "q", 5), (4, "p", 1)]
    got = sequences.dominant_value(frame(spark, rows, "k int, v string, w int"), "k", "v", "w", 9).collect()
    assert sorted(tuple(r) for r in got) == [(1, "p", 90), (4, "p", 1)]


def test_switches_gaps_and_streaks(spark):
    values = "AABBAACC"
    start = dt.date(2024, 1, 7)
    history = frame(spark, [("p", start + dt.timedelta(weeks=i), v) for i, v in enumerate(values)], "phone_number string, date date, tac string")
    snap = start + dt.timedelta(weeks=len(values) - 1)
    row = devices.behaviour_features(history, "tac", "tac", snap, (4, 12)).first()
    assert (row.device_switch_tac_count_l12w, row.device_switch_tac_count_l4w) == (3, 2)
    assert (row.device_switch_tac_gap_avg_l12w, row.device_switch_tac_gap_max_l4w) == (2.0, 2.0)
    assert row.device_current_tac_active_weeks_l12w == 2 and row.device_current_tac_active_ratio_l12w == 0.25
    assert row.device_current_tac_distinct_count_l12w == 3 and row.device_current_tac_distinct_count_l4w == 2
    assert row.device_max_streak_any_tac_week_l12w == 2 and row.device_current_tac_days_since_last_seen_l12w == 0


def test_zero_filled_mean_and_deviation(spark):
    df = frame(spark, [("a", 4.0), ("a", 2.0), ("b", None)], "k string, x double")
    got = {r.k: r for r in aggregates.zero_filled_mean_std(df, ["k"], {"x": ("m", "s")}, 4).collect()}
    assert got["a"].m == pytest.approx(1.5) and got["a"].s == pytest.approx(math.sqrt((6.25 + 0.25 + 2 * 2.25) / 3))
    assert (got["b"].m, got["b"].s) == (0.0, 0.0)


def test_hot_key_join_equals_plain_join(spark):
    random.seed(1)
    left = frame(spark, [(random.choice([1, 1, 1, 2, 3, 4]), i) for i in range(400)], "k int, i int")
    right = frame(spark, [(1, "a"), (2, "b"), (5, "e")], "k int, v string")
    for how in ("inner", "left"):
        got = joins.hot_key_join(left, right, "k", ["i"], how, hot_rows=50)
        assert sorted(map(tuple, got.select("k", "i", "v").collect()), key=str) == sorted(map(tuple, left.join(right, "k", how).collect()), key=str)


def test_as_of_takes_newest_earlier_row_across_months(spark, many_ranges):
    right = frame(spark, [("a", dt.date(2024, 1, 10), 1), ("a", dt.date(2024, 3, 5), 2), ("b", dt.date(2024, 5, 1), 9)], "k string, t date, v int")
    left = frame(spark, [("a", dt.date(2024, 1, 9)), ("a", dt.date(2024, 1, 10)), ("a", dt.date(2024, 2, 28)), ("a", dt.date(2024, 3, 31)), ("b", dt.date(2024, 4, 30))], "k string, at date")
    got = {(r.k, r["at"]): r.v for r in joins.as_of(left, right, ["k"], "at", "t", ["v"]).collect()}
    assert [got[k] for k in sorted(got)] == [None, 1, 1, 2, None]


def test_as_of_with_one_hot_key_on_one_day(spark, many_ranges):
    """One key has nine tenths of the rows, all on one day; keys without values, null keys and times, and equal times."""
    random.seed(4)
    moment = lambda: dt.datetime(2024, 1, 3, random.randrange(24), random.randrange(60))
    right = [("hot" if random.random() < 0.9 else random.choice("ab"), moment(), random.randrange(99)) for _ in range(700)] + [(None, moment(), 1), ("a", None, 2)]
    left = [("hot" if random.random() < 0.9 else random.choice("abc"), moment(), i) for i in range(900)] + [(None, moment(), 900), ("a", None, 901)]
    got = joins.as_of(frame(spark, left, "k string, at timestamp, i int").repartition(5), frame(spark, right, "k string, t timestamp, v int").repartition(3), ["k"], "at", "t", ["t", "v"])
    assert got.columns == ["k", "at", "i", "t", "v"] and got.count() == len(left)
    for r in got.collect():
        earlier = [(t, v) for k, t, v in right if k == r.k and t and r["at"] and t <= r["at"]] if r.k else []
        assert (r.t, r.v) == (max(earlier) if earlier else (None, None))


def test_ranges_cut_a_hot_key_evenly(spark, many_ranges):
    df = frame(spark, [("hot" if i % 10 else "cold", i) for i in range(20_000)], "k string, o int")
    parts = [r["count"] for r in ranges.in_ranges(df, ["k", "o"]).groupBy("k", ranges.RANGE).count().collect()]
    assert len(parts) >= 9 and max(parts) < 2 * 20_000 / 9


def test_carried_ranks_and_rotation(spark, many_ranges):
    random.seed(8)
    rows = [(random.choice("ab"), i, random.choice([None, None, i])) for i in range(400)]
    random.shuffle(rows)
    df = frame(spark, rows, "k string, o int, v int").repartition(6)
    for r in ranges.carried(df, ["k"], ["o"], "v").collect():
        known = [(o, v) for k, o, v in rows if k == r.k and o <= r.o and v is not None]
        assert r.v == (max(known)[1] if known else None)
    for r in ranges.running_totals(df.fillna(0), ["k"], "o", {"v": "before"}).collect():
        assert r.before == sum(v or 0 for k, o, v in rows if k == r.k and o < r.o)
    assert all(r["rank"] == r.o for r in ranges.ranks(df, "o").collect())
    turned = ranges.rotated(df, "o", ["o", "k"], 7).collect()
    assert len(turned) == 400 and all(r.partner.o == (r.o + 7) % 400 for r in turned)
    assert ranges.rotated(df.limit(0), "o", ["o"], 7).collect() == []


def test_validity_blocks_hold_each_day_once(spark):
    random.seed(9)
    first = dt.date(2020, 2, 1)
    when = lambda: None if random.random() < 0.1 else first + dt.timedelta(days=random.randint(-40, 240))
    spans = [(i, when(), when()) for i in range(300)]
    days = [first + dt.timedelta(days=d) for d in {0, 1, 2, 63, 64, 127, 128, 200, *[random.randint(0, 200) for _ in range(40)]}]
    table = [(d, j) for d in days for j in range(1 + d.day % 2)]
    got = joins.valid_on_days(frame(spark, spans, "i int, date_start date, date_end date"), frame(spark, table, "date date, j int"))
    want = sorted((i, d, j) for i, s, e in spans for d, j in table if (s is None or s <= d) and (e is None or d <= e))
    assert sorted((r.i, r.date, r.j) for r in got.collect()) == want
    assert joins.valid_on_days(frame(spark, spans, "i int, date_start date, date_end date"), frame(spark, [], "date date")).count() == 0


def test_validity_join_makes_only_rows_of_the_result(spark):
    """A hundred thousand intervals that start in one month against a year of days: the join itself makes what is returned."""
    spans = spark.range(100_000).selectExpr("id", "date_add(DATE'2024-03-01', CAST(id % 31 AS INT)) AS date_start", "date_add(DATE'2024-03-01', CAST(id % 31 + id % 5 AS INT)) AS date_end")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS date")
    joined = joins.valid_on_days(spans, days)
    assert joined.count() == 20_000 * (1 + 2 + 3 + 4 + 5)
    assert "__month" not in joined._jdf.queryExecution().toString()


def test_point_in_time_policies(spark):
    label = frame(spark, [("a", dt.date(2024, 1, 24), "p", 1)], "phone_number string, disburse_date date, product string, label_value int")  # a Wednesday
    features = frame(spark, [("a", dt.date(2024, 1, d), d) for d in (7, 14, 21)], "phone_number string, date date, x int")
    assert joins.point_in_time(label, features, weekly=True).first().x == 21
    assert joins.point_in_time(label, features).first().x == 21
    assert joins.snapped_merge(label, features, by_key=True).first().x == 14


def test_running_totals_equal_a_window(spark):
    random.seed(3)
    rows = [(random.choice("aaab"), i, random.randint(0, 9)) for i in range(300)]
    got = sequences.running_totals(frame(spark, rows, "k string, o int, x int"), ["k"], "o", {"x": "before"}, slices=7).collect()
    for r in got:
        assert r.before == sum(x for k, o, x in rows if k == r.k and o < r.o)


def test_two_levels_without_grand_total(spark):
    df = frame(spark, [(1, "p", 10), (1, "p", 10), (1, "q", 10), (2, "p", 11)], "c int, p string, d int")
    got = aggregates.two_levels(df, "c", "p", [F.count_distinct("d").alias("n")], {"n": ("n_in", "n_out")}).collect()
    assert sorted(map(tuple, got)) == [(1, "p", 1, 1), (1, "q", 1, 1), (2, "p", 1, 1)]


def test_nan_only_on_floats(spark):
    df = frame(spark, [(float("nan"), dt.date(2024, 1, 1), ["x"], "abc")], "a double, b date, c array<string>, d string")
    assert tuple(columns.nan_to_null(df).first()) == (None, dt.date(2024, 1, 1), ["x"], "abc")


def test_gates(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-06')) AS date")
    with pytest.raises(quality.IncompleteData):
        quality.require_days(df, 7)
    with pytest.raises(quality.TryLater):
        quality.require_days(df, 9, retry=True)
    assert quality.require_days(df, 7, tolerance=1) is df
    with pytest.raises(ValueError):
        quality.require_unique(df.unionAll(df), ["date"])
    with pytest.raises(ValueError):
        quality.require_rows(df.filter("false"))


def test_near_duplicates_against_brute_force(spark):
    words = ["a", "b", "cc", "5g"]
    random.seed(5)
    names = {(k, " ".join(random.choice(words) for _ in range(random.randint(1, 4)))) for k in range(6) for _ in range(7)}

    def redundant(key, name):
        mine = name.split()
        for k, other in names:
            theirs = other.split()
            if k != key or other == name:
                continue
            if len(theirs) > len(mine) and theirs[: len(mine)] == mine:
                return True
            if len(theirs) == len(mine) > 1 and theirs[:-1] == mine[:-1] and len(other) >= len(name):
                return True
        return False

    got = device_names.without_near_duplicates(frame(spark, sorted(names), "tac int, device_name string")).collect()
    assert {tuple(r.asDict()[c] for c in ("tac", "device_name")) for r in got} == {n for n in names if not redundant(*n)}


@pytest.mark.parametrize("brand, model, name", [
    ("Apple Inc", "iPhone 15 Pro Max", "apple iphone 15 promax"), ("apple", "Watch 9 45mm", "apple watch 9"),
    ("Apple", "ipad pro 11 4", "apple ipad pro 11 gen4"), ("Samsung Korea", "SM-A505F Galaxy A 50 LTE", "samsung galaxy a50 4g"),
    ("samsung", "S21FE 5G", "samsung galaxy s21 fe 5g"), ("Redmi", "Note 9 Pro+", "xiaomi redmi note 9 pro plus"),
    ("Vivo", "vivo Y 21", "vivo y21"), ("Huawei Technologies Co Ltd", "Mate 20 X 5G", "huawei mate 20x"),
    ("google inc", "pixel 3xl", "google pixel 3 xl"), ("nokia", None, "nokia unknown"), (None, "x", "other x")])
def test_device_names(spark, brand, model, name):
    row = device_names.clean_devices(frame(spark, [(1, brand, model)], "tac int, device_brand string, device_model string")).first()
    assert row.device_name == name


def test_p_values(spark):
    rows = frame(spark, [(2.0, 9, 3.0, 33.0, 8, 8, 0.0)], "t double, f int, wp double, wm double, nz int, n int, ties double")
    c = F.col
    got = rows.select(lift.t_p_value(c("t"), c("f")).alias("t"), lift.sign_p_value(F.expr("transform(sequence(1, nz), i -> 2 * i)"), c("wp")).alias("w"),
                      lift.normal_p_value(c("wp"), c("nz"), c("ties")).alias("z")).first()
    # closed form for nine degrees of freedom
    u = math.atan(2 / 3)
    inside = math.cos(u) * (1 + 2 / 3 * math.cos(u) ** 2 + 8 / 15 * math.cos(u) ** 4 + 48 / 105 * math.cos(u) ** 6)
    assert got.t == pytest.approx(1 - 2 / math.pi * (u + math.sin(u) * inside), abs=1e-9)
    assert got.w == pytest.approx(10 / 256)
    assert got.z == pytest.approx(math.erfc(15 / math.sqrt(51) / math.sqrt(2)), abs=1e-6)


@pytest.mark.parametrize("gaps", [[1, 1, 1, -1, 2, 2, -3, 4], [1, -1, 1, -1, 1, -1, 1, 1], [5, 5, 5, 5], [0, 0, 3, -2, 2], [7], [-1, -2, -3, -4, -5, -6, -7, -7], list(range(1, 61))])
def test_rank_test_equals_all_sign_patterns(spark, gaps):
    results = frame(spark, [("f", i, 0.5, 0.5, float(g)) for i, g in enumerate(gaps)], "feature string, experiment_id int, auc_base double, auc_new double, gap double")
    got = lift.p_values(results).first().p_value_wilcoxon
    sizes = sorted(abs(g) for g in gaps if g)
    rank = {s: sizes.index(s) + (sizes.count(s) + 1) / 2 for s in sizes}
    below = min(sum(rank[abs(g)] for g in gaps if g > 0), sum(rank[abs(g)] for g in gaps if g < 0))
    if len(set(gaps)) == 1:
        assert got is None
    elif len(sizes) > 20:
        assert got == pytest.approx(2.0 ** (1 - len(sizes)))
    else:
        sums = [sum(r for r, up in zip((rank[s] for s in sizes), signs) if up) for signs in itertools.product((0, 1), repeat=len(sizes))]
        assert got == pytest.approx(min(1.0, 2 * sum(s <= below for s in sums) / len(sums)))


def test_bootstrap_interval_has_the_expected_width(spark):
    random.seed(11)
    gaps = [random.gauss(0.01, 0.02) for _ in range(30)]
    results = frame(spark, [("f", i, 0.5, 0.5 + g, g) for i, g in enumerate(gaps)], "feature string, experiment_id int, auc_base double, auc_new double, gap double")
    row = lift.bootstrap_interval(results, 4_000).first()
    mean = sum(gaps) / 30
    spread = math.sqrt(sum((g - mean) ** 2 for g in gaps) / 30) / math.sqrt(30)
    assert row.ci_hi - row.ci_lo == pytest.approx(2 * 1.96 * spread, rel=0.08)
    assert row.ci_lo < mean < row.ci_hi


def test_auc_with_ties(spark):
    rows = [("f", 0, y, p, 1 - p) for y, p in [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]]
    got = lift.auc(frame(spark, rows, "feature string, experiment_id int, y_true int, p_base double, p_new double")).first()
    assert got.auc_base == pytest.approx((2 + 1.5 + 0.5) / 6) and got.auc_new == pytest.approx(1 - 4 / 6)


def test_literal_and_signed_p_values(spark):
    metrics = frame(spark, [("f", 0.05, 0.01, 1.0, 0.9, 0.03)], "feature string, mean_gap double, std_gap double, win_rate double, dominance double, p double")
    metrics = metrics.withColumnsRenamed({"p": "p_value_ttest"}).withColumn("p_value_wilcoxon", F.col("p_value_ttest"))
    assert lift.decide(metrics).first().score == 95.0
    assert lift.decide(metrics, lift.Profile(literal_p=True)).first().score == 100.0


def test_sampling_is_repeatable(spark):
    df = spark.range(2_000).withColumnRenamed("id", "k")
    first = {r.k for r in lift.sampled_rows(df, ["k"], 7, fraction=0.25).collect()}
    assert first == {r.k for r in lift.sampled_rows(df.repartition(7), ["k"], 7, fraction=0.25).collect()}
    assert 400 < len(first) < 600 and lift.sampled_rows(df, ["k"], 7, rows=100).count() == 100


@pytest.mark.parametrize("model, name", [
    ("ipad pro 11 11", "apple ipad pro 11 gen11"), ("ipad pro 13 13", "apple ipad pro 13 gen13"), ("ipad air 5 5", "apple ipad air 5 gen5"),
    ("Watch 42 42mm", "apple watch 42"), ("iphone iphone 12", "apple iphone 12")])
def test_an_equal_generation_is_no_repetition(spark, model, name):
    row = device_names.clean_devices(frame(spark, [(1, "apple", model)], "tac int, device_brand string, device_model string")).first()
    assert row.device_name == name


def test_wide_aggregates_and_windows_on_subscribers_are_dealt_over_many_tasks(spark):
    """The rows are few enough for one task, into which adaptive execution would join them."""
    snapshot = dt.date(2024, 1, 28)
    weekly = spark.range(0, 3000, 1, 3).selectExpr("id % 100 AS phone_number", "id % 500 AS imei", "id % 7 AS tac", "id % 3 + 1 AS device_num_day_l1w",
                                                   "date_sub(DATE'2024-01-28', CAST(7 * (id % 90) AS INT)) AS date")
    pairs = devices.entity_features(weekly, devices.IMEI, snapshot)
    assert pairs.count() == 100 and pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 20
    # the last shuffle moves pairs, not the buffers of all statistics
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert "REPARTITION_BY_NUM" in exchanges[0], plan
    current = weekly.groupBy("phone_number", "date").agg(F.max("tac").alias("tac"))
    activation = weekly.select("phone_number").distinct().selectExpr("phone_number", "DATE'2020-01-01' AS last_activated_date", "DATE'2024-01-27' AS date")
    history = devices.activated_history(current, activation, snapshot, strict=False, bounded=True)
    rows = devices.behaviour_features(history, "tac", "tac", snapshot)
    assert rows.count() == 100 and rows.select(F.spark_partition_id().alias("p")).distinct().count() > 20
