"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one
JSON line. Every result is computed in full and thrown away (``noop`` sink)."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from reviewlib.plans.queries import QUERIES

HEADLINE = (
    "label_reviews",
    "label_distribution",
    "preprocess_reviews",
    "clean_message",
    "clean_model_text",
    "eda_features",
    "parse_dumps",
    "parse_comments",
    "dump_file_pieces",
    "read_reviews",
    "null_counts",
    "describe_reviews",
    "words_histogram",
    "words_box_by_rating",
    "top_authors",
    "duplicate_messages",
    "stratified_split",
    "class_weights",
    "build_vocabulary",
    "encode_sequences",
    "eval_accuracy_loss",
    "classification_report",
    "train_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewlib-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the text tables come as single files; deal them over files, as large tables are stored
    dealt = tempfile.mkdtemp(prefix="reviewlib-bench-")
    for file in os.listdir(sf_dir):
        if file not in ("documents.parquet", "pages.parquet", "labels.parquet"):
            os.symlink(os.path.join(sf_dir, file), os.path.join(dealt, file))
            continue
        key = "page_id" if file == "pages.parquet" else "doc_id"
        rows = spark.read.parquet(os.path.join(sf_dir, file))
        rows.repartition(int(cpus), key).write.parquet(os.path.join(dealt, file))
    name_of_sf, sf_dir = os.path.basename(sf_dir.rstrip("/")), dealt
    # start-up of JVM, Python workers and code generation is not what is measured
    QUERIES["clean_model_text"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": name_of_sf.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
