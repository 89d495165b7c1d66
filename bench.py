"""Benchmark: the reference's three programs at one data scale.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is forced end to end with the ``noop`` sink (every row computed,
nothing collected). Timings are wall-clock seconds, taken after the whole
query set ran once on sf0.001 (JIT, generated code, Python workers).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from roundstats.operators import numbers as N  # noqa: E402
from roundstats.operators import words as W  # noqa: E402
from roundstats.operators.parts import spread  # noqa: E402
from roundstats.plans import clustering as C  # noqa: E402
from roundstats.plans import reports as R  # noqa: E402
from roundstats.session import get_session  # noqa: E402
from roundstats.sources import documents_from, points_from, table  # noqa: E402

K_WORDS = 12      # K = 12 parts: the reference's best setting on 12 cores
SEED = 7
REPLICAS = 100    # embeddings replicated (with a small shift) for load
WARMUP_DIR = "/root/testdata/sf0.001"


def _sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="roundstats-bench")

    def build(d: str) -> dict:
        docs = spread(documents_from(table(spark, d, "documents"), "text", "doc_id"), "doc_id")
        lines = documents_from(docs, "text", "doc_id", per_line=True)
        price = table(spark, d, "lineitem").select(
            F.monotonically_increasing_id().alias("id"), F.col("l_extendedprice").alias("v"))
        emb = points_from(table(spark, d, "embeddings"), "vec_id", "embedding")
        # Load version of the points: each point plus REPLICAS-1 shifted copies
        # (derived by Spark from the table; ids stay unique).
        big = (emb.select(F.explode(F.sequence(F.lit(0), F.lit(REPLICAS - 1))).alias("r"), "id", "v")
               .select((F.col("id") * REPLICAS + F.col("r")).alias("id"),
                       F.transform("v", lambda x, j: x + F.col("r") * F.lit(1e-3) * F.sin(j))
                       .cast("array<float>").alias("v"),
                       F.lit(1).cast("long").alias("w")))
        emb = spread(emb, "id")
        return {
            "word_count": lambda: _sink(W.word_count(docs)),
            "word_count_salted": lambda: _sink(W.word_count_salted(docs, K_WORDS, SEED)),
            "word_count_by_part": lambda: _sink(W.word_count_by_part(docs, K_WORDS)),
            "doc_word_counts": lambda: _sink(W.doc_word_counts(docs)),
            "word_count_lines": lambda: _sink(W.word_count(lines)),
            "compare_word_counts": lambda: _sink(W.compare_word_counts(docs, K_WORDS, SEED)),
            "number_report": lambda: _sink(R.number_report(price, "v")),
            "sort_with_index": lambda: _sink(N.sort_with_index(price, ["v", "id"])),
            "cluster": lambda: _sink(C.cluster(emb, 8, 3, SEED)),
            "mr_cluster": lambda: _sink(C.mr_cluster(emb, 3, 4, 1, SEED)),
            "mr_cluster_x100": lambda: _sink(C.mr_cluster(big, 8, 8, 3, SEED)),
        }

    # Warm-up: the same queries once on the smallest data (JIT, generated
    # code, Python workers), so timings below are the data work.
    for run in build(WARMUP_DIR).values():
        run()
    queries = build(sf_dir)

    times: dict[str, float] = {}
    for name, run in queries.items():
        t = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
