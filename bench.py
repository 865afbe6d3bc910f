"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from labelscope.plans.catalog import QUERIES
from labelscope.runtime import local_session, scratch

HEADLINE = [
    "profile_corpus", "class_distribution", "text_lengths", "vocabulary_counts", "top_words_by_class",
    "class_vocab_overlap", "exact_duplicates", "split_leakage", "stratified_split", "tfidf",
    "tfidf_bigrams", "bayes_class_report", "complement_nb", "tune_tfidf", "embed_corpus_cached",
    "knn_classify", "misfits", "class_report", "confusion_matrix", "bootstrap_ci", "mcnemar_pairs",
    "reliability_bins", "topk_accuracy", "risk_coverage", "cached_completion", "parse_label",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").count()  # start the executors
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        with scratch(spark):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
