"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sundial.checks import registry  # noqa: E402
from sundial.session import build_session  # noqa: E402

QUERIES = [
    "A1_windowed_aggregate", "A2_windowed_distinct", "J7_point_in_time_weekly", "J12_as_of", "FP2_imei_features", "FP3_tac_features",
    "FP5_current_device", "FP6_tac_behaviour", "FP9_province_seed_day", "FP16_cross_features", "FP18_data_4_weeks", "FP22_recharge_features",
    "FP27_usage_8_weeks", "FP28_balance_4_weeks", "FP32_airtime_features_3m", "FP37_asset_features", "FP40_training_table", "DC6_DC7_clean_devices", "EV8_auc",
    "DC10_near_duplicates", "EV10_dominance", "FP12_yearly_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    chosen = sys.argv[1:] or QUERIES
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(repeats):
            spark.catalog.clearCache()
            start = time.perf_counter()
            registry.run(name, spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    print(json.dumps({"metric": "sum of median query seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
