"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and then $BENCH_RUNS times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from scoreloom.plans import parsing, planning, scores  # noqa: F401 - registers the queries
from scoreloom.plans.catalog import CATALOG
from scoreloom.session import build_session

QUERIES = [
    "lmeval_group_stats",
    "lighteval_group_stats",
    "mixed_framework_union",
    "stderr_lookup",
    "first_run_params",
    "reject_codes",
    "auto_metrics",
    "nonfinite_metrics",
    "grouped_report_rows",
    "report_line_counts",
    "report_metadata",
    "run_list_ordered",
    "custom_registry",
    "large_registry",
    "harness_roundtrip",
    "scan_files",
    "incremental_ingest",
    "run_plan",
    "run_gaps",
    "model_comparison",
    "fewshot_prompts",
    "exemplars_by_language",
    "strip_reasoning",
    "extract_exact_match",
    "inst_level_strict",
    "pass_at_k",
    "codegen_pass_at_k",
    "length_auc",
    "batch_generate",
    "details_sink",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or QUERIES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
        spark__scoreloom__pieces=cpus,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds, cold = {}, {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            CATALOG[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        cold[name], seconds[name] = round(taken[0], 3), round(statistics.median(taken[1:]), 3)
    documents = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    flagship = seconds.get("lmeval_group_stats")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of medians over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "documents_per_second": round(documents / flagship) if flagship else None,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
