"""Time the headline queries; print one JSON line.

Every query is run to the end into a sink that throws its rows away. Each is
timed with the building of its plan and with everything it stores on the way.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnrisk.operators import model, split  # noqa: E402
from txnrisk.plans import catalog, session, stages, workdir  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "raw_scan",
    "json_ingest",
    "stg_dedup_latest",
    "quarantine",
    "enriched",
    "enriched_by_shuffle",
    "enriched_bucketed",
    "dq_report",
    "layer_counts",
    "ingestion_summary",
    "class_distribution",
    "proxy_alerts",
    "queue_append_twice",
    "queue_append_pruned",
    "alerts_by_country",
    "alerts_by_method",
    "queue_filter",
    "stage_counts",
    "stored_counts",
    "layer_sample_gold",
    "category_index",
    "category_ranks",
    "exact_medians",
    "stratified_split",
    "roc_auc",
    "roc_curve",
    "avg_precision",
    "classification_report",
    "train_eval",
    "score_unlabeled",
    "review_queue",
]
# What is stored before a query's clock starts: its input lines, and a fitted model, whose
# training train_eval times. The stages that store the layers are timed in stage_counts.
PREPARED = {"json_ingest": "lines", "score_unlabeled": "trained"}

BASELINE_FOLDER, BASELINE_CPUS, BASELINE_SECONDS = "/root/testdata/sf0.01", 4, 14.1


def fit_like_baseline() -> dict[str, float]:
    """Seconds of the forest's fit on the baseline's rows and cores, and their ratio to its own."""
    if not os.path.isdir(BASELINE_FOLDER):
        return {}
    spark = (
        session.builder("bench-fit", shuffle_partitions=8)
        .master(f"local[{BASELINE_CPUS}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    v = catalog.views(spark.sparkContext.applicationId, spark, BASELINE_FOLDER)
    rows, _ = split.split_frames(stages.labeled_gold(spark, v.layers))
    start = time.perf_counter()
    model.fit(rows)
    seconds = time.perf_counter() - start
    workdir.remove_folders(spark)
    spark.stop()
    return {"seconds": round(seconds, 3), "ratio": round(seconds / BASELINE_SECONDS, 3)}


def main() -> None:
    spark = (
        session.builder("bench", shuffle_partitions=int(CPUS))
        .master(f"local[{CPUS}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    # Start the JVM's file and codegen classes before the clock.
    queries["class_distribution"](spark, FOLDER).collect()
    views = catalog.views(spark.sparkContext.applicationId, spark, FOLDER)
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        if name in PREPARED:
            getattr(views, PREPARED[name])
        start = time.perf_counter()
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    workdir.remove_folders(spark)
    spark.stop()
    fits = {} if sys.argv[1:] else fit_like_baseline()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(FOLDER.rstrip("/").rsplit("sf", 1)[-1]),
    }
    if fits:
        result["fit_like_baseline"] = fits
    print(json.dumps(result))


if __name__ == "__main__":
    main()
