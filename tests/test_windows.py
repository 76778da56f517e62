import datetime as dt

import pytest

from sundial.functions import dates
from sundial.operators import windows
from sundial.operators.windows import LookBack, Measure, Offset, last, parse_window, windowed_aggregate


def test_name_grammar():
    assert parse_window("last 12 weeks").name == "l12w"
    assert parse_window("last 24 weeks", "last 12 weeks").name == "l24w_to_l12w"
    assert parse_window("last 1 day").name == "l1d"
    assert LookBack().name == "current"
    assert windows.split_window("x_total_l12w") == ("x_total", "l12w")
    assert windows.split_window("x_l24w_to_l12w") is None
    assert windows.previous_span("x_l12w") == "x_l24w_to_l12w"
    with pytest.raises(ValueError):
        parse_window("some time ago")


def test_columns_containing_to_are_kept(spark):
    df = spark.createDataFrame([(1, 2, 3)], "total_l12w int, x_l24w_to_l12w int, k int")
    assert windows.plain_columns(df, ["k"]) == ["total_l12w"]


def test_offsets():
    day = dt.date(2024, 3, 31)
    assert Offset(1, "m").before(day) == dt.date(2024, 2, 29)
    assert Offset(2, "w").before(day) == dt.date(2024, 3, 17)
    assert dates.add_months("2024-01-31", 1) == dt.date(2024, 2, 29)
    assert dates.month_starts("2024-02-10", 3) == [dt.date(2024, 2, 1), dt.date(2024, 1, 1), dt.date(2023, 12, 1)]


def test_gates():
    assert dates.require_sunday("2024-01-28") == dt.date(2024, 1, 28)
    with pytest.raises(ValueError):
        dates.require_sunday("2024-01-29")
    with pytest.raises(ValueError):
        dates.require_new_year("2024-01-02")


def test_window_edges_and_empty_groups(spark):
    snap = "2024-01-28"
    rows = [("a", "2024-01-28", "x"), ("a", "2024-01-21", "x"), ("a", "2024-01-14", "y"), ("b", "2023-01-01", "z"), ("a", "2024-02-01", "q")]
    df = spark.createDataFrame(rows, "k string, d string, v string").selectExpr("k", "to_date(d) AS date", "v")
    measures = [Measure("count_distinct", "v", "n"), Measure("count", "*", "rows")]
    got = {r.k: r for r in windowed_aggregate(df, ["k"], measures, last(1, 2), snap, keep_empty=True).collect()}
    assert (got["a"].n_l1w, got["a"].rows_l1w) == (1, 1)
    assert (got["a"].n_l2w, got["a"].rows_l2w) == (1, 2)
    assert (got["b"].n_l2w, got["b"].rows_l2w) == (0, 0)
    assert "b" not in {r.k for r in windowed_aggregate(df, ["k"], measures, last(1, 2), snap).collect()}


def test_widest_window_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-12-31')) AS date, 1 AS k, 2.0D AS x").write.parquet(str(tmp_path / "t"))
    df = windowed_aggregate(spark.read.parquet(str(tmp_path / "t")), ["k"], [Measure("sum", "x", "x")], last(2, 4), "2020-06-28")
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(date), GreaterThan(date,2020-05-31), LessThanOrEqual(date,2020-06-28)]" in plan


@pytest.mark.parametrize("day, sunday", [
    ("2024-01-22", "2024-01-14"), ("2024-01-24", "2024-01-14"), ("2024-01-25", "2024-01-21"), ("2024-01-28", "2024-01-21")])
def test_eligible_sunday(spark, day, sunday):
    from pyspark.sql import functions as F

    row = spark.range(1).select(dates.eligible_sunday(F.to_date(F.lit(day))).alias("s")).first()
    assert row.s == dt.date.fromisoformat(sunday)
