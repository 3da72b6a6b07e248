"""Headline timings: prints one JSON line. Scale and cores come from BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import sys
import time

from checks import registry
from marlstone import build_session

HEADLINE = (
    "ag3_day_hour_counts", "ag2_hotspots", "ag22_cleaning_audit", "pf8_pf9_st1_clean_vehicles", "ag23_t13_t16_engineered",
    "ag16_missing_counts", "ag29_correlation", "ag30_histogram", "ag31_density", "ag33_describe_exact",
    "m3_stratified_split", "m18_m19_binary_metrics", "j11_m17_threshold_table", "j12_ag25_risk_band_summary",
    "ag28_rk2_term_statistics", "j6_sl1_rk4_search", "rk4_search_many", "j8_merge", "x8_slug", "hx3_hx5_publications",
    "m31_tfidf", "m36_gram_matrix", "m39_cooks_distance", "wn7_autocorrelation",
    "m7_forest_metrics",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
           "spark.ui.showConsoleProgress": "false"},
    )
    queries = registry.queries()
    names = sys.argv[1:] or HEADLINE
    queries["ag3_day_hour_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
