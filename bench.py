"""Wall time of the headline queries, as one JSON line. Every result is computed in full and thrown away."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import all_queries
from marquee.session import local_session

HEADLINE = [
    "rating_stats",
    "year_rank",
    "year_zscore",
    "role_counts",
    "type_flags",
    "pedigree_director",
    "pedigree_cast",
    "pedigree_hub",
    "pedigree_many_hubs",
    "coworkers_director",
    "feature_table",
    "split_train",
    "score_features",
    "score_features_fractional",
    "score_features_hub",
    "dedupe_first",
    "insert_ignore",
    "dim_people",
    "load_people",
    "catalogue_assembly",
    "payload_fields",
    "page_scores",
    "describe_lines",
    "by_class",
    "corr_matrix",
    "missing_summary",
    "pr_curve_orders",
    "roc_auc_orders",
    "impute_scale",
    "stream_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = all_queries()
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM's work
    seconds = {}
    for name in wanted:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
