"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Every query is
run in full (all rows and columns are produced, none are kept). The test files have one row
group each, which one task reads however many cores are free; the tables are
written anew with a file for each core first, as a large table has them, and that is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "flow_collection_stats",
    "chunk_by_title",
    "chunk_element_rows",
    "partition_html",
    "embed_hashed",
    "strip_images",
    "extract_entities",
    "entity_gazetteer",
    "hybrid_corpus",
    "knn_top10",
    "collection_stats",
    "profile_multi",
    "named_counts",
    "readiness",
    "match_any",
    "terms_brand",
    "stats_price",
    "date_histogram_gapfill",
    "latest_n",
    "generate_records",
    "upsert_last_wins",
    "split_valid",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]

    from corpusmill.session import scratch_path, session
    from corpusmill.workload import REGISTRY

    spark = session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("OFF")

    stored = scratch_path(spark, "bench")
    for t in sorted(os.listdir(sf_dir)):
        if t.endswith(".parquet"):
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}").repartition(int(cpus)).write.parquet(f"{stored}/{t}")

    def run(name: str) -> float:
        began = time.perf_counter()
        REGISTRY[name].run(spark, stored).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    times = {}
    for name in HEADLINE if not only else only:
        run(name)  # warm-up
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
