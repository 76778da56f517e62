"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

usage: check_queries.py [--sf 0.01] [name-part ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from sundial.checks import registry  # noqa: E402
from sundial.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--errors", action="store_true", help="stop at the first error with a traceback")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                  "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    bad = 0
    for name in registry.load_all():
        if args.names and not any(part.lower() in name.lower() for part in args.names):
            continue
        start = time.time()
        try:
            df = registry.run(name, spark, folder)
            got_columns, got = normal(df.columns, [tuple(r) for r in df.collect()])
            spent = time.time() - start
            sql = registry.REGISTRY[name].sql
            if sql is None:
                print(f"rows  {name}: {len(got)} rows {spent:.1f}s")
                continue
            cursor = db.execute(sql)
            want_columns, want = normal([d[0] for d in cursor.description], cursor.fetchall())
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {str(error)[:600]}")
            if args.errors:
                raise
            continue
        if got_columns != want_columns:
            bad += 1
            print(f"COLS  {name}: only spark {set(got_columns) - set(want_columns)} only sql {set(want_columns) - set(got_columns)}")
        elif got != want:
            bad += 1
            diff = [(g, w) for g, w in zip(got, want) if g != w]
            print(f"DIFF  {name}: {len(got)} vs {len(want)} rows, {len(diff)} differ")
            if diff:
                for column, g, w in zip(got_columns, *diff[0]):
                    if g != w:
                        print(f"        {column}: spark {g!r} sql {w!r}")
        else:
            empty = [c for i, c in enumerate(got_columns) if all(r[i] is None for r in got)]
            note = f" ALL NULL: {empty}" if empty and got else ""
            print(f"ok    {name}: {len(got)} rows {spent:.1f}s{note}")
    print("bad", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
