"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs once to warm up and three times for its median; results are written to nowhere.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from sortwell.operators import neardup
from sortwell.plans.queries import QUERIES, hashed
from sortwell.session import build_session, settled

HEADLINE = [
    "text_hash64", "near_duplicates", "near_dup_summary", "near_dup_candidates", "near_dup_leakage",
    "hash_groups", "exact_duplicates", "content_digest", "duplicate_keys", "audit_summary",
    "reconcile_summary", "missing_refs", "attach_metadata", "vocabulary_diff", "null_counts",
    "class_percentages", "top_combinations", "canonicalise_labels", "encode_labels",
    "stratified_split", "split_overlap", "split_distribution", "sample_per_class", "assign_batches",
    "image_hash64", "preprocess_eval", "vector_stats", "channel_normalise", "augmentation_plan", "validation_report", "precision_recall",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "sortwell-bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g", spark_ui_enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = {name: (lambda q=QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE}

    # The near-duplicate join alone, on settled hashes, in each band mode.
    hashes = settled(hashed(spark, sf_dir))
    for bands in ("8", "t+1", "triples", "auto"):
        work[f"near_join_bands_{bands}"] = lambda b=bands: neardup.near_duplicates(
            hashes, key="doc_id", hash_col="fp", bands=b
        )

    seconds = {}
    for name, run in work.items():
        times = []
        for _ in range(4):
            start = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
