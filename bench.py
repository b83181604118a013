"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES  # noqa: E402
from kinfold.session import build_session  # noqa: E402

HEADLINE = (
    "clean_voter_records",
    "names_in_several_sources",
    "prepare_files",
    "sample_exactly",
    "fold_profiles",
    "estimate_prior",
    "candidate_pairs_by_first_rule",
    "compare_candidates",
    "train_model",
    "predictions",
    "connected_components",
    "multi_source_people",
    "file_states",
    "read_delimited_files",
    "explode_api_records",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "kinfold-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "6g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor before timing
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
