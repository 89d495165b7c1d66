"""Command line: the four batch programs over text files.

    python -m roundstats numbers PATH                  statistics of non-negative numbers
    python -m roundstats words K PATH                  three word counts compared
    python -m roundstats cluster PATH K ITERS          seeding + Lloyd, mean distance
    python -m roundstats mr-cluster PATH K PARTS ITERS three-round coreset clustering

Each prints its one-row (or three-row) result; ``--out DIR`` also writes it
as parquet. Runs on the session ``spark-submit`` provides (or local[*]).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from roundstats.plans import clustering as C
from roundstats.plans import reports as R
from roundstats.session import ensure_checkpoint_dir
from roundstats.sources import read_documents, read_numbers, read_points


def _positive(name: str, v: int, low: int) -> int:
    if v < low:
        raise SystemExit(f"{name} must be >= {low}, got {v}")
    return v


def build(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="roundstats")
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--out", default=None, help="also write the result here (parquet)")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("numbers")
    a.add_argument("path")
    a = sub.add_parser("words")
    a.add_argument("k", type=int)
    a.add_argument("path")
    a = sub.add_parser("cluster")
    a.add_argument("path")
    a.add_argument("k", type=int)
    a.add_argument("iters", type=int)
    a = sub.add_parser("mr-cluster")
    a.add_argument("path")
    a.add_argument("k", type=int)
    a.add_argument("parts", type=int)
    a.add_argument("iters", type=int)
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace):
    if args.cmd == "numbers":
        vals = read_numbers(spark, args.path)
        return R.number_report(vals, "v", mean_places=None)
    if args.cmd == "words":
        docs = read_documents(spark, args.path)
        return R.word_report(docs, _positive("K", args.k, 1), args.seed)
    if args.cmd == "cluster":
        pts = read_points(spark, args.path)
        centers = C.cluster(pts, _positive("k", args.k, 1), _positive("iters", args.iters, 0), args.seed)
        return C.objective(pts, centers)
    pts = read_points(spark, args.path)
    return C.mr_cluster(pts, _positive("k", args.k, 1), _positive("parts", args.parts, 1),
                        _positive("iters", args.iters, 0), args.seed)


def main(argv: list[str] | None = None) -> int:
    args = build(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"roundstats {args.cmd}").getOrCreate()
    # A local run without a configured folder gets a scratch one; a cluster
    # must name a shared folder in spark.checkpoint.dir.
    ensure_checkpoint_dir(spark, allow_local=True)
    result = run(spark, args)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    result.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
