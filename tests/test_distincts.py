"""Distinct counts in two levels and on nested levels, against plain ones."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sundial.operators.distincts import Part, aggregated, nested_levels
from sundial.plans import provinces


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    out = [(random.choice(["hot", "hot", "hot", "a", None]), random.choice([1, 2, 3, None]), random.choice([0.0, -0.0, 1.5, None, float("nan")]),
            random.choice(["x", "y", None]), random.choice([None, random.gauss(1e3, 1)]), random.random() < 0.5) for _ in range(600)]
    return spark.createDataFrame(out + [("single", 1, 2.0, "x", 5.0, True), ("empty", None, None, None, None, False)], "k string, i int, d double, s string, v double, ok boolean").repartition(4)


PARTS = [("n", "count", None, None), ("n_ok", "count", None, "ok"), ("n_v", "count", "v", "ok"), ("di", "count_distinct", "i", None), ("dd", "count_distinct", "d", "ok"), ("ds", "count_distinct", "s", None),
         ("ds_ok", "count_distinct", "s", "ok"), ("total", "sum", "v", "ok"), ("low", "min", "v", None), ("high", "max", "s", "NOT ok"), ("mean", "avg", "v", "ok"), ("sd", "stddev", "v", None), ("sd_ok", "stddev", "i", "ok")]


@pytest.mark.parametrize("distinct", [0, 1, 2, 3])
def test_aggregated_equals_plain_aggregates(spark, rows, distinct):
    allowed = ["i", "d", "s"][:distinct]
    parts = [p for p in PARTS if p[1] != "count_distinct" or p[2] in allowed]
    got = aggregated(rows, ["k"], [Part(a, f, v and F.col(v), c and F.expr(c)) for a, f, v, c in parts])
    plain = {"count": "count", "sum": "sum", "min": "min", "max": "max", "avg": "avg", "stddev": "stddev"}
    sql = ", ".join(f"{'count(DISTINCT ' + v + ')' if f == 'count_distinct' else plain[f] + '(' + (v or '*') + ')'} {'FILTER (WHERE ' + c + ')' if c else ''} AS {a}" for a, f, v, c in parts)
    rows.createOrReplaceTempView("plain_rows")
    want = {r.k: r for r in spark.sql(f"SELECT k, {sql} FROM plain_rows GROUP BY k").collect()}
    assert got.columns == ["k", *[p[0] for p in parts]] and got.count() == len(want)
    for r in got.collect():
        for a, *_ in parts:
            x, y = r[a], want[r.k][a]
            assert x == y or math.isclose(x, y, rel_tol=1e-6), (r.k, a, x, y)
    assert "Expand" not in plan_of(got)


def test_aggregates_that_cannot_be_merged_are_refused(rows):
    with pytest.raises(ValueError):
        aggregated(rows, ["k"], [Part("x", "skewness", F.col("v"))])
    with pytest.raises(ValueError):
        aggregated(rows, ["k"], [Part("x", "count_distinct")])


@pytest.mark.parametrize("members", [[], ["m"], ["m", "j"]])
def test_nested_levels(spark, members):
    random.seed(7)
    data = [(random.choice([1, 1, 1, 2, None]), random.choice(["p", "q", None]), random.choice([1, 2, 3, 4, 5, None]), random.choice("abc"), random.randrange(9)) for _ in range(200)]
    df = spark.createDataFrame(data, "o int, i string, m int, j string, x long").repartition(3)
    got = nested_levels(df, "o", "i", {"x": ("x_in", "x_out")}, {c: (f"{c}_in", f"{c}_out") for c in members})
    assert len(got.columns) == 4 + 2 * len(members) and "Expand" not in plan_of(got)
    rows = got.collect()
    assert {(r.o, r.i) for r in rows} == {(d[0], d[1]) for d in data if d[0] is not None} and len(rows) == len({(r.o, r.i) for r in rows})
    for r in rows:
        wide = [d for d in data if d[0] == r.o]
        near = [d for d in wide if d[1] == r.i]
        assert (r.x_in, r.x_out) == (sum(d[4] for d in near), sum(d[4] for d in wide))
        for c in members:
            at = {"m": 2, "j": 3}[c]
            assert (r[f"{c}_in"], r[f"{c}_out"]) == (len({d[at] for d in near} - {None}), len({d[at] for d in wide} - {None}))


def test_monthly_days_merge_sets_of_days(spark):
    random.seed(2)
    data = [("2024-02", c, p, f"2024-01-{random.randint(1, 31):02d}") for c in (1, 2, 3) for p in "ab" for _ in range(9)]
    seeds = spark.createDataFrame(data, "month string, cell_id long, ref_province_name string, date string").withColumn("date", F.col("date").cast("date"))
    got = {(r.cell_id, r.ref_province_name): r.count_date for r in provinces.monthly_days(seeds).collect()}
    for (cell, province), n in got.items():
        assert n == len({d for _, c, p, d in data if (cell is None or c == cell) and (province is None or p == province)})
    assert len(got) == 10
    assert statistics.mean(got.values()) > 1
