"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from placeweave.queries import QUERIES
from placeweave.session import local_session

HEADLINE = [
    # scans and sinks
    "typed_scan_cast", "skip_preamble_scan", "vintage_scan", "distinct_ordered_dims",
    # keys and joins
    "membership_flag_rate", "geoid_coverage", "geoid_resolve", "many_to_one_join", "semi_latest_vintage",
    "name_drift_fix", "unique_names_highest_code", "duplicate_keys", "quality_report",
    # summaries
    "coverage_pivot", "frequency_of_frequencies", "ordered_text_by_key", "profile_table", "lump_top_levels",
    "flow_counts", "histogram_bins", "box_stats", "zscore_points",
    # dataset builds
    "coal_closures_flow", "employment_status_flow", "designation_flow", "facility_flow", "capacity_flow",
    "conformed_investment_flow", "consolidated_observations", "point_layer",
    # geometry and regions
    "wkt_roundtrip", "triangle_intersects", "point_in_triangle", "cbsa_crosswalk", "edd_crosswalk",
    "metric_rollup", "region_rank", "competitive_regions", "dyad_within_radius",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": cores, "spark.driver.memory": "8g"})
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # warm the session
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # Every row and column is produced; nothing is collected.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cores,
    }))


if __name__ == "__main__":
    main()
