from collections import Counter

import pytest

import __spark_entry__ as entry
from sundial.checks.fixtures import ORDERS_SNAPSHOT, Fixtures
from sundial.streaming import increments

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["K1_overwrite_one_partition", "K3_incremental_update", "K4_bounded_sorted_files", "K5_compressed_files"])
def test_every_week_is_written_and_read_back(spark, name):
    table = Fixtures(spark, FOLDER).imei_weekly().collect()
    added = lambda r: 10 if name.startswith("K1") and r.date == ORDERS_SNAPSHOT else 0
    want = Counter((r.phone_number, r.imei, r.tac, r.device_num_day_l1w + added(r), str(r.date)) for r in table)
    got = entry.queries()[f"{name}_whole"](spark, FOLDER).collect()
    assert Counter((r.phone_number, r.imei, r.tac, r.device_num_day_l1w, r.date) for r in got) == want
    assert len({r.date for r in table}) > 3


def test_increments_read_the_stored_history(spark, monkeypatch):
    """The history is derived and written once; each step reads what is stored."""
    seen, append = [], increments.append_new_days
    monkeypatch.setattr(increments, "append_new_days", lambda df, path, date="date": (seen.append(df.inputFiles()), append(df, path, date)))
    assert entry.queries()["K3_incremental_update"](spark, FOLDER).count() == Fixtures(spark, FOLDER).imei_weekly().count()
    assert len(seen) == 3 and not [f for files in seen for f in files if "testdata" in f]


def test_snapshots_move_rows_before_they_are_copied(spark, monkeypatch):
    built = []
    monkeypatch.setattr(increments, "update_snapshots", lambda source, path, snapshots, look_back, build: (
        built.append((build(source, snapshots), len(snapshots))), spark.range(1).write.parquet(path, mode="overwrite")))
    try:
        entry.queries()["K3_update_snapshots"](spark, FOLDER)
    except Exception as error:  # nothing was stored, so the columns are not there
        assert "UNRESOLVED_COLUMN" in str(error)
    for features, snapshots in built:
        lines = features._jdf.queryExecution().sparkPlan().toString().splitlines()
        copied = next(i for i, line in enumerate(lines) if "Generate" in line)
        assert any("Exchange" in line for line in lines[copied:]), lines
        assert features.rdd.getNumPartitions() == snapshots
    assert len(built) == 2
