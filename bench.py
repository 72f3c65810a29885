"""Headline queries, timed; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.checks import all_checks  # noqa: E402
from tallyspark.session import local_session  # noqa: E402

HEADLINE = [
    "P4_production_projection",
    "P8_normalize_evidence_documents",
    "A1_monthly_summary",
    "A3_consumer_summary",
    "A5_financial_kpis",
    "A7_category_summary",
    "Q1_validate_table",
    "M7_cascade_resolve",
    "M8_coverage_report",
    "M10_category_family_matrix",
    "T3_proposal_groups",
    "E1_historical_fit",
    "E3_char_ngrams_documents",
    "E4_knn_vote",
    "E5_embedding_knn_vote",
    "E12_evaluate_overall",
    "I1_detect_new",
    "K4_idempotent_insert",
    "L3_training_set",
    "L6_threshold_grid",
    "snk_upsert",
]


# Tables that come as one file with one row group, hence as one task; a table of any size has many files.
SPLIT = ["orders", "lineitem", "documents"]


def laid_out(spark, folder: str, files: int) -> str:
    """A folder with the given tables, the large ones written anew as several files (not timed)."""
    out = tempfile.mkdtemp(prefix="bench-")
    for name in sorted(os.listdir(folder)):
        if name.removesuffix(".parquet") in SPLIT:
            spark.read.parquet(f"{folder}/{name}").repartition(files).write.parquet(f"{out}/{name}")
        else:
            os.symlink(os.path.abspath(f"{folder}/{name}"), f"{out}/{name}")
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    only = os.environ.get("BENCH_QUERIES")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = all_checks()
    given, folder = folder, laid_out(spark, folder, int(cores))
    seconds: dict[str, float] = {}
    for name in only.split(",") if only else HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
