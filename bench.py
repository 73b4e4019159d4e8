"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion with the ``noop`` sink (all rows
produced, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "m08_roc_auc_by_group", "m07_roc_curve", "m11_threshold_sweep", "r04_vfold", "q02_summary_stats",
    "q13_leakage_scan", "a06_boxplot_stats", "w06_rolling", "e01_rfm_features", "f01_formula_recipe",
    "g07_group_threshold_sweep", "t11_tf_idf", "t12_distinctive_terms", "t13_lexicon_sentiment",
    "c07_silhouette", "k07_best_split_gini", "n14_retrieve_build_context", "v10_gram_by_fold",
    "v05_penalised_cv", "f08_impute_knn", "i02_permutation_linear", "k06_node_counts", "t16_em_topic_terms",
]


def main() -> None:
    from faro.plans.registry import all_queries
    from faro.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="faro-bench")
    qs = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    # warm-up (untimed): the same queries once on the smoke tables, so JIT and codegen caches are hot
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for n in names:
            qs[n].spark(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
