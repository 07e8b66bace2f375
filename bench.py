"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local threads),
BENCH_RUNS (timed runs after one warm-up, median is reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairforge import build_session  # noqa: E402
from pairforge.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "length_report",
    "valid_pairs",
    "recipe_questions",
    "question_summary",
    "parse_question_array",
    "attach_votes",
    "word_frequency",
    "extractive_summary",
    "recipe_records",
    "train_test_split",
    "pack_sequences",
    "job_length_curation",
    "job_build_pairs",
    "job_question_bank",
    "job_pages_to_recipes",
    "job_video_enrichment",
    "job_preference_train_set",
    "job_sft_train_set",
    "job_flatten_to_parquet",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            # no call-site lookup per column expression
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
