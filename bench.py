"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is run once to warm up, then timed ``BENCH_REPS`` times (median);
timing covers planning plus a full materialisation of the result
(``write.format('noop')``), so no rows are pulled to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scoutlens.plans import QUERIES  # noqa: E402
from scoutlens.session import build_session  # noqa: E402

HEADLINE = [
    "peer_zscores",            # features end to end: participation, aggregate, z-scores
    "player_split_stats",
    "dated_target",
    "impute_group_median",     # exact distributed medians
    "validation_report",
    "top_players",
    "score_percentile",        # distributed average ranks
    "top_per_group",
    "shortlist",
    "best_match_lookup",
    "boxplot_summary",
    "describe_numeric",
    "corr_matrix_long",
    "average_precision",
    "roc_auc",
    "precision_at_k",
    "cluster_profiles",
    "silhouette_squared",
    "similar_players",
    "appearance_extract",
    "score_all_players",       # model training: calibrated scores of every document
    "kmeans_k_sweep",          # k 3..11, 10 restarts, all dimensions, every position
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    times = {}
    failed = []
    for name in only or HEADLINE:
        fn = QUERIES[name]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            runs = []
            for _ in range(reps):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 4)
        except Exception as e:  # noqa: BLE001 - report, keep benchmarking the rest
            failed.append(name)
            print(f"bench: {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
        spark.catalog.clearCache()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_median_query_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "failed": failed,
    }))


if __name__ == "__main__":
    main()
