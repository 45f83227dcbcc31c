"""Headline queries, each run to its last row and thrown away. Prints one JSON line; progress goes to stderr.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark import InheritableThread

from staymill.catalog import QUERIES
from staymill.functions.session import session

QUERY_LIMIT, TOTAL_LIMIT = 300, 1500  # seconds

HEADLINES = [
    "rate_by", "clean_audit", "numeric_summary", "missing_share", "form_options", "corr_matrix", "duplicate_rows",
    "split_stratified", "fold_assign", "rare_fit", "rare_transform", "onehot_long", "preprocess_transform",
    "evaluate_models", "roc_curve", "qq_points", "bag_of_words", "tfidf", "knn_classify", "dbscan_core",
    "fit_logreg", "fit_tree", "fit_forest", "fit_mlp", "score_batch", "score_stream", "fit_gbt", "shap_global",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().write.format("noop").mode("overwrite").save()
    times, stopped, begun = {}, [], time.perf_counter()
    for name in HEADLINES:
        left = TOTAL_LIMIT - (time.perf_counter() - begun)
        seconds = run(spark, name, folder, min(QUERY_LIMIT, left)) if left > 0 else None
        if seconds is None:
            stopped.append(name)
        else:
            times[name] = seconds
        print(f"{name}: {seconds if seconds is not None else 'stopped'}", file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "stopped": stopped, "sf": sf}), flush=True)
    os._exit(0)  # a stopped query may still hold a thread


def run(spark, name: str, folder: str, limit: float) -> float | None:
    """Seconds of one query, or None if it was stopped at its limit; the others go on."""
    result = {}

    def work() -> None:
        spark.sparkContext.addJobTag(name)
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        result["seconds"] = round(time.perf_counter() - start, 3)

    thread = InheritableThread(target=work, daemon=True)
    thread.start()
    thread.join(limit)
    if thread.is_alive():
        spark.sparkContext.cancelJobsWithTag(name)
        thread.join(20)
    return result.get("seconds")


if __name__ == "__main__":
    main()
