"""Headline queries on the tables in ``$BENCH_SF_DIR``; prints one JSON line.

Every query is run to the end (``noop`` sink) twice: ``first`` holds the cold times, ``queries``
the warm ones, and ``value`` is the sum of the latter.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from velogrid.registry.queries import queries  # noqa: E402
from velogrid.session import local_session  # noqa: E402

HEADLINE = [
    "station_grid",
    "station_grid_with_lags",
    "departures_per_slot",
    "arrivals_per_slot",
    "trips_with_users",
    "clean_trips_packed_coordinates",
    "first_seen_stations",
    "station_catalog",
    "training_and_validation_rows",
    "standardised_parts",
    "active_intervals",
    "profile_predictions",
    "regression_metrics",
    "station_metrics",
    "station_comparison",
    "demand_score",
    "duration_profile",
    "duration_histogram",
    "trips_per_period",
    "traffic_percentiles",
    "id_profile",
    "station_models",
    "boosted_tree_predictions",
    "live_counts_complete",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    first, warm = {}, {}
    for name in HEADLINE:
        for times in (first, warm):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(warm.values()), 3)
    print(
        json.dumps(
            {
                "metric": f"{len(HEADLINE)} headline queries, warm, total",
                "value": total,
                "unit": "sec",
                "queries": warm,
                "first": first,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
