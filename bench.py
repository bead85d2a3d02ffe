"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of local cores. Every
row of every result is computed and discarded (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from skyrisk.session import local_session  # noqa: E402

HEADLINE = [
    "danger_with_weather",
    "stage_weather",
    "stage_bulletins",
    "fact_weather",
    "area_day_weather",
    "unpivot_horizons",
    "asof_weather",
    "rolling_7d",
    "features",
    "training_table",
    "dim_date",
    "bulletin_validation",
    "weather_validation",
    "merge_upsert",
    "batch_fallback",
    "flatten_daily",
    "crosstab_pct",
    "rank_areas",
    "horizon_evolution",
    "null_profile",
    "latest_complete_snapshot",
    "classification_report",
    "contract_report",
    "temporal_contract",
    "state_weather",
    "incomplete_days",
    "summary",
    "feature_medians",
    "landed_bulletins",
    "validity_overlaps",
    "area_day_deciles",
    "merged_sketches",
    "forest_metrics",
    "scored_features",
]
LIMIT = 300  # seconds after which the jobs of a query are cancelled


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    # The first build compiles the plans that most queries share.
    QUERIES["rank_areas"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds, errors = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        alarm = threading.Timer(LIMIT, spark.sparkContext.cancelAllJobs)
        alarm.start()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # one query must not lose the timings of the others
            errors[name] = f"{type(error).__name__}: {str(error)[:200]}"
        finally:
            alarm.cancel()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
            | ({"errors": errors} if errors else {})
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
