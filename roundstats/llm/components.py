"""Connected components of an edge table by alternating stars.

Edges are pairs of long node numbers. A large-star step links every larger
neighbour of a node to the least node of its neighbourhood, a small-star step
does the same for the smaller ones; the two repeat until no edge changes, when
every node points straight at the least node of its component. Each round is
a few aggregations and joins on the node: the least neighbour comes from a
partial aggregate, so a node with very many edges sends one row per task, and
its join can be split by adaptive execution. Every round is written to the
shared folder; the driver only sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundstats.llm.common import Stage


def _least(pairs: DataFrame) -> DataFrame:
    """The least of a node and its neighbours."""
    return pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return (down.join(_least(down), "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u != v").distinct())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, root`` for every node of ``edges`` (root: the least node of its
    component, itself included). Null ends and loops are left out; a node
    without any other edge has no row."""
    stage = Stage(edges.sparkSession, "components")
    now = stage.write(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
                      .where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct())

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = mark(now)
    while before[0]:
        new = stage.write(_small_star(_large_star(now)))
        stage.drop(now)
        now, after = new, mark(new)
        if tuple(after) == tuple(before):
            break
        before = after
    root = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(root)
