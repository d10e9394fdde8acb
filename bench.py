"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from seamark.plans import catalog
from seamark.session import local_session

HEADLINE = [
    "agg13_skill_scalar",
    "agg14_skill_speed",
    "agg15_skill_direction",
    "agg08_max_positive_duration",
    "joi01_pair_scalar",
    "joi02_pair_vector",
    "joi05_asof_nearest",
    "joi07_nearest_node",
    "joi09_nearest_depth_layer",
    "joi18_event_pairing",
    "flt07_point_in_polygon",
    "grd02_idw_grid",
    "grd07_station_extraction",
    "agg20_frame_statistics",
    "agg21_pixel_statistics",
    "agg26_ice_contingency",
    "agg32_horizon_scores",
    "agg34_system_rollup",
    "win01_bounded_gap_fill",
    "win03_equal_interval",
    "win06_water_level_extrema",
    "win09_persistence_forecast",
    "har01_harmonic_analysis_full",
    "har04_tide_prediction",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["agg01_rmse"](spark, sf_dir).collect()  # JVM and session start-up
    took = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
