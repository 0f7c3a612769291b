"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Stored stages that several
queries read (corpus, index, vocabulary, tag index) are timed as entries of their own, before the
queries, so no query time hides or repeats a build. Every query runs to its last row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
MEMORY = os.environ.get("BENCH_MEMORY", "12g")

STAGES = (
    "corpus", "index", "query_terms", "label_vocabulary", "tfidf", "tagger", "tag_index", "cells",
    "mapped_judgments", "evaluation_judgments", "evaluation_run", "training_table", "fitted",
)
QUERIES = (
    "acts_clean", "tokens", "ngrams", "postings", "postings_dup", "corpus_stats", "doc_freq",
    "union_retrieval", "bm25_scores", "bm25_topk", "search_hits", "bm25_label_restricted",
    "label_freq", "top_labels", "train_test_split", "tfidf_vocab", "tfidf_weights",
    "tfidf_transform", "svc_margin", "label_index", "query_tags", "search_batch",
    "clf_report_labels", "clf_report_avgs", "hamming_loss", "qrels_filtered", "ir_metrics",
    "profile_nulls", "profile_describe", "acts_from_csv", "svc_report",
)


def main() -> None:
    from docquarry.plans import catalog
    from docquarry.plans.pipeline import stages
    from docquarry.session import build_session

    scratch = tempfile.mkdtemp(prefix="docquarry-bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": MEMORY,
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    shared = stages(spark, SF_DIR)
    seconds: dict[str, float] = {}
    for name in STAGES:
        start = time.time()
        getattr(shared, name)
        seconds[f"build_{name}"] = round(time.time() - start, 3)
    for name in QUERIES:
        start = time.time()
        catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "documents": documents,
        "cpus": CPUS,
        "driver_memory": MEMORY,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
