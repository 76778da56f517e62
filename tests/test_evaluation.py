"""The bulk run: draws, encodings, fits that stop, restarts, importances."""

import random

import pytest
from pyspark.sql import functions as F

from sundial.operators import sampling
from sundial.plans import evaluation, lift

KEYS = ["k", "day"]
QUICK = evaluation.ModelOptions(trees=8, first=4, patience=2, depth=2)


@pytest.fixture(scope="module")
def rows(spark):
    """`good` decides the class, `poor` does nothing, `colour` helps a little."""
    random.seed(5)
    out = []
    for i in range(1500):
        y = int(random.random() < 0.4)
        colour = random.choice(["red", "red", "red", "blue", None]) if y else random.choice(["red", "blue", "green"])
        out.append((i, f"2024-0{1 + i % 6}-01", y, random.random(), random.random(), colour, y + random.gauss(0, 0.4), random.random()))
    return spark.createDataFrame(out, "k long, day string, y int, a double, b double, colour string, good double, poor double").withColumn("day", F.col("day").cast("date")).repartition(3)


def a_run(spark, store, **options):
    chosen = evaluation.RunOptions(**({"base_size": 2, "experiments": 2, "fraction": 0.9, "workers": 2, "noise": True, "model": QUICK} | options))
    return evaluation.Run(spark, str(store), KEYS, "y", ["a", "b", "colour"], ["good", "poor"], ["colour"], chosen)


def on_test():
    return F.month("day") > 4


def test_draws_agree_with_whole_numbers(spark):
    df = spark.createDataFrame([(7, None), (None, 3), (-5, 2**40)], "k long, m long")
    for r in df.select("k", "m", sampling.row_draw(df, ["k", "m"], 42).alias("d")).collect():
        assert r.d == sampling.draw_of([(r.k or 0) % sampling.PRIME, (r.m or 0) % sampling.PRIME], 42)
    draws = sorted(r[0] for r in spark.range(4000).select(sampling.row_draw(spark.range(1), ["id"], 1)).collect())
    assert all(abs(d / sampling.PRIME - i / 4000) < 0.04 for i, d in enumerate(draws)) and len(set(draws)) > 3990


@pytest.mark.parametrize("n", [0, 1, 7, 150, 299, 300, 400])
def test_caps_are_exact(spark, n):
    df = spark.range(300).selectExpr("id % 100 AS k", "id AS i")  # every draw three times
    got = [tuple(r) for r in sampling.capped(df, ["k"], 3, n).select("k", "i").collect()]
    draw = {k: sampling.draw_of([k], 3) for k in range(100)}
    assert len(got) == min(n, 300)
    assert sorted(draw[k] for k, _ in got) == sorted(draw[i % 100] for i in range(300))[:n]


def test_nth_smallest_by_class(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 2, i * 7919 % 10_007) for i in range(1000)], "g int, d long")
    got = sampling.nth_smallest(df, F.col("d"), lambda size: size // 3, by="g")
    for g in (None, 0, 1):
        own = sorted(r.d for r in df.where(F.col("g").eqNullSafe(F.lit(g))).collect())
        assert got[g] == (own[len(own) // 3 - 1], 1)
    assert sampling.nth_smallest(df.limit(0), F.col("d"), lambda size: 5) == {}


def counting(spark):
    """A column function that changes nothing, and the number of its calls."""
    calls = spark.sparkContext.accumulator(0)

    def same(x):
        calls.add(1)
        return x

    return F.udf(same, "double"), calls


def test_rows_are_drawn_once(spark):
    same, calls = counting(spark)
    df = spark.range(1000, numPartitions=2).selectExpr("id % 2 AS g", "CAST(id * 7919 % 10007 AS DOUBLE) AS d")
    got = sampling.nth_smallest(df, same("d").cast("long"), lambda size: size // 3, by="g")
    assert got == {g: (sorted(i * 7919 % 10_007 for i in range(g, 1000, 2))[165], 1) for g in (0, 1)}
    assert calls.value == 1000


def test_a_fit_reads_its_rows_once(spark, rows):
    same, calls = counting(spark)
    train = rows.select(*KEYS, same(F.col("y").cast("double")).alias("y"), "good", "poor")
    model = evaluation.fit_model(train, ["good", "poor"], "y", KEYS, QUICK)
    assert calls.value == 1500 and model.getNumTrees > 0


def test_strategies(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    take = lambda e, **o: {r.k for r in sampling.experiment_rows(df, ["k"], 5, e, **o).collect()}
    assert take(0, strategy="fixed", rows=50) == take(3, strategy="fixed", rows=50)
    assert take(0, strategy="random", rows=50) != take(3, strategy="random", rows=50)
    assert all(k < 100 for k in take(1, strategy="filter", filters=["k > 5", "k < 100"], rows=50)) and len(take(1, strategy="filter", filters=[None, "k < 100"], rows=50)) == 50
    assert len(take(2, strategy="filter", filters=["k < 10"])) == 1000
    assert len(take(0, strategy="fixed", fraction=0.5, rows=20)) == 20
    with pytest.raises(ValueError):
        take(0, strategy="other")


def test_target_statistics_by_hand(spark, rows):
    got = {r.k: r.colour for r in evaluation.target_statistics(rows, ["colour"], "y", KEYS, ~on_test()).collect()}
    data = rows.withColumn("late", on_test()).withColumn("d", sampling.row_draw(rows, KEYS, 42)).collect()
    overall = sum(r.y for r in data if not r.late) / sum(not r.late for r in data)
    for r in data:
        earlier = [x.y for x in data if x.colour == r.colour and not x.late and (r.late or (x.d, x.k) < (r.d, r.k))]
        assert got[r.k] == pytest.approx((sum(earlier) + overall) / (len(earlier) + 1))


def test_patience():
    assert evaluation.best_size([5, 4, 3, 3.5, 3.6, 2], 2) == (3, True)
    assert evaluation.best_size([5, 4, 3, 3.5, 2], 2) == (5, False)
    assert evaluation.best_size([1], 3) == (1, False) and evaluation.best_size([1, 2, 3, 4], 3) == (1, True)


def test_a_killed_run_fits_only_what_is_left(spark, rows, tmp_path):
    fits, real = [], evaluation.fit_model

    def counted(train, features, *rest):
        fits.append(tuple(features))
        if len(fits) == 3:
            raise RuntimeError("killed")
        return real(train, features, *rest)

    run = a_run(spark, tmp_path / "store", workers=1)
    assert run.pending().count() == 6
    run.fit = counted
    with pytest.raises(RuntimeError, match="killed"):
        run.fit_pending(rows, on_test())
    assert len(fits) == 3 and run.pending().count() == 4
    again = a_run(spark, tmp_path / "store")
    again.fit, fits[:] = counted, [None] * 10
    assert again.fit_pending(rows, on_test()) == 4 and len(fits) == 14
    assert again.fit_pending(rows, on_test()) == 0
    results = {(r.feature, r.experiment_id): r for r in again.results().collect()}
    assert set(results) == {(f, e) for f in ("good", "poor") for e in (0, 1)}
    assert all(results["good", e].gap > 0.1 and results["poor", e].gap < results["good", e].gap / 2 for e in (0, 1)), results
    # the same areas as from predictions of the stored model
    from pyspark.ml.classification import GBTClassificationModel

    model = GBTClassificationModel.load(again._path("good", 1, "model"))
    needed = again._sample(spark.read.parquet(f"{again.store}/rows").where("__test"), 1)
    p = evaluation.scored(model, needed, again.features_of("good", 1), ["y"]).selectExpr("'f' AS feature", "1 AS experiment_id", "y AS y_true", "score AS p_base", "score AS p_new")
    assert lift.auc(p).first().auc_new == pytest.approx(results["good", 1].auc_new)
    decisions = {r.feature: r.decision for r in again.decisions(resamples=200).collect()}
    assert decisions["good"] != "reject" and set(decisions) == {"good", "poor"}
    found = again.accepted_importances(again.decisions(resamples=200), 1).where("model = 'new' AND kind = 'rotation'").collect()
    assert {r.candidate for r in found} == {"good"} and [r.feature for r in found if r["rank"] == 1] == ["good"]


def test_noise_ranks_last(spark, rows, tmp_path):
    options = evaluation.RunOptions(base_size=2, experiments=1, noise=True, workers=2, model=evaluation.ModelOptions(trees=12, first=6, patience=3, depth=3))
    run = evaluation.Run(spark, str(tmp_path / "noise"), KEYS, "y", ["good", "colour"], ["a"], ["colour"], options)
    run.fit_pending(rows, on_test())
    for kind in ("rotation", "split"):
        summary = lift.importance_summary(run.importances("a").where(F.col("kind") == kind).where("model = 'baseline'"))
        ranks = {r.feature: r["rank"] for r in summary.collect()}
        assert ranks["good"] == 1 and ranks[lift.NOISE] == 3


def test_names_that_a_run_needs_itself_are_refused(spark):
    for base, new in ((["k"], []), (["a"], ["a"]), (["__partner"], ["b"]), (["a"], [lift.NOISE])):
        with pytest.raises(ValueError):
            evaluation.Run(spark, "x", KEYS, "y", base, new)
