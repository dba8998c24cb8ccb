"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads. Every query is
run once to warm up (class loading, Python workers) and then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from embedlift.queries import load_all  # noqa: E402
from embedlift.workspace import build_session  # noqa: E402

HEADLINES = [
    "flagship_migration", "run_migration", "validation_summary", "validation_errors", "reconcile_status",
    "metadata_completeness", "content_checksum", "cosine_pairs", "vector_search_topk", "recall_at_10", "map_records",
    "migrate_records", "flatten_metadata", "infer_schema", "create_mapping", "create_mapping_fuzzy", "recommend_schema",
    "upsert_merge", "collection_upsert", "assign_batches", "migration_status", "list_migrations", "transition_violations",
    "throughput_eta", "audit_rollup", "rate_limit", "pinecone_round_trip", "migrate_stream", "cdc_sync",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = load_all()
    wanted = [n for n in HEADLINES if len(sys.argv) < 2 or n in sys.argv[1:]]

    def run(name: str) -> float:
        begun = time.perf_counter()
        catalogue[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    times = {}
    for name in wanted:
        run(name)
        times[name] = round(run(name), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    extra = {}
    if "run_migration" in times:
        n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
        extra["run_migration_records_per_sec"] = round(n / times["run_migration"], 1)
    if "cosine_pairs" in times:
        n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
        extra["validation_pairs_per_sec"] = round(n / times["cosine_pairs"], 1)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
