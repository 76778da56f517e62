"""A few registered queries of every kind against DuckDB; scripts/check_queries.py compares them all."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHOSEN = [
    "A1_windowed_aggregate", "A2_windowed_distinct", "A20_two_levels", "J7_point_in_time_any_day", "J12_as_of", "W3_dominant_value",
    "Q8_wrong_types", "K1_overwrite_one_partition", "FP2_imei_features", "FP6_tac_behaviour", "FP9_province_seed_day",
    "FP15_bank_features", "FP18_data_4_weeks", "FP22_recharge_features", "FP32_airtime_features_2m", "FP36_holiday_features",
    "FP37_asset_features", "FP40_training_table", "DC6_DC7_clean_devices", "DC10_near_duplicates", "EV8_auc", "RG2_model_family"]


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return db


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(clean, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = database.execute(entry.oracle_sql()[name])
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 220
