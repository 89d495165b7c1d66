"""Run in a subprocess by test_retries.py: a session that retries failed
tasks (local[4,2]); the first attempt of every even partition of each Arrow
kernel fails on purpose. Prints the results as one JSON line."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import roundstats.operators.sampling as S  # noqa: E402
import roundstats.operators.vectors as V  # noqa: E402
from roundstats.operators import words as W  # noqa: E402
from roundstats.plans import clustering as C  # noqa: E402
from roundstats.sources import documents_from, points_from, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def flaky(fn):
    def run(batch, *a, **k):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected failure")
        return fn(batch, *a, **k)
    return run


def main():
    inject = sys.argv[1] == "inject"
    spark = (SparkSession.builder.master("local[4,2]" if inject else "local[4]")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retry-ckpt-"))
    if inject:
        # Kernels are pickled by value, so the patched helper travels with them.
        S._matrix = flaky(S._matrix)
        V._matrix = flaky(V._matrix)
    pts = points_from(table(spark, SF, "embeddings"), "vec_id", "embedding").repartition(4, "vec_id")
    r = C.mr_cluster(pts, 3, 4, 2, seed=5).first()
    seeds = [row[2] for row in C.seed_rows(pts, 4, seed=9)]
    docs = documents_from(table(spark, SF, "documents"))
    wc = sorted(tuple(x) for x in W.word_count_salted(docs, 3, 2).collect())
    print(json.dumps({"objective": r["objective"], "n": r["n_points"], "seeds": seeds,
                      "words": len(wc), "total": sum(n for _, n in wc)}))


if __name__ == "__main__":
    main()
