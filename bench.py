"""Time headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyloom.plans.catalogue import QUERIES
from tallyloom.runtime import local_session

HEADLINE = [
    "flag_counts", "flag_combinations", "flag_counts_by_population", "overlap_regions", "flag_intersections", "headline_counts",
    "category_cross_tab", "multi_answer_cross_tab", "multi_counted_cross_tab", "answer_cleaning", "combo_groups",
    "first_seen_year", "cumulative_entities", "periods", "years_of_data", "years_stats", "domain_cross_tab", "diversity_cross_tab",
    "site_domain_matrix", "site_vocabulary_matrix", "case_control_five_sets", "measure_counts", "site_statistics",
    "global_statistics", "hot_group_statistics", "box_stats", "histogram", "latest_value", "latest_with_unit_list",
    "entity_summary", "entity_range", "measure_qc_values", "clean_measure", "drop_extremes", "unit_distribution",
    "ancestor_extract", "concept_name_map", "allocate_plates", "final_samples", "sample_qc", "suppressed_report",
    "threshold_dimension",
    "demographic_report", "record_history", "group_history_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    QUERIES["flag_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # start the engine
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
