"""Time the headline queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from parcelspark.session import build_session
from suite import load
from suite.registry import QUERIES

HEADLINE = [
    "photo_scores", "join_star_left", "guarded_percentages", "read_listings", "filter_bounds", "keyword_flags",
    "array_to_text", "join_dimensions_left", "join_not_in", "join_full_chain", "join_time_trend", "backfill_latest",
    "spatial_join", "key_else_spatial", "nearest_in_group", "nearest_school_in_state", "contains_or_nearest",
    "enrich_location", "assign_schools", "top1_best_metric", "dedupe_by_id", "latest_per_key", "append_new_only",
    "segment_by_metro", "split_tvh", "train_price_model", "strip_html", "scrub_text", "word_ngrams", "tfidf",
    "before_after_kpi", "ratio_kpi", "build_sold_features", "build_notsold_features",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    load()
    spark.read.parquet(f"{root}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the executors
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(root.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
