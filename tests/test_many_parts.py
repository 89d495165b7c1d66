"""Clustering whose centers stay in Spark against the broadcast way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundstats.plans import clustering as C
from roundstats.plans import many_parts as M


def points(spark, n=700, parts=6):
    # A third of all points in part 0; ids repeat between parts; part 99 has two points.
    part = F.when(F.col("i") % 3 == 0, 0).otherwise(F.col("i") % parts).cast("int")
    v = F.array(*[(F.sin(F.col("i") * (j + 1)) * 10).cast("float") for j in range(5)])
    df = spark.range(n).withColumnRenamed("id", "i").select(
        part.alias("part"), (F.col("i") % 400).alias("id"), v.alias("v"), (1 + F.col("i") % 3).cast("double").alias("w"))
    few = spark.createDataFrame([(99, 1, [0.0] * 5, 1.0), (99, 2, [1.0] * 5, 2.0)], "part int, id long, v array<float>, w double")
    return df.unionByName(few).dropDuplicates(["part", "id"])


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(M, "GROUP_ROWS", 40)
    monkeypatch.setattr(C, "REFRESH_EVERY", 3)


def test_seeds_equal_the_broadcast_way(spark, small, monkeypatch):
    pts = points(spark).cache()
    want = C.seed_rows(pts, 9, 5, refresh_every=3)
    monkeypatch.setattr(C, "MAX_DRIVER_BYTES", 0)
    got = sorted((r.part, r.center_id, r.id, list(r.v)) for r in C.seed_centers(pts, 9, 5).collect())
    assert got == want
    assert [r[0] for r in got].count(99) == 2


def test_lloyd_and_coreset_equal_the_broadcast_way(spark, small, monkeypatch):
    pts = points(spark).drop("part").dropDuplicates(["id"]).cache()
    def rows():
        return {(r.part, r.center_id): (r.id, r.w, list(r.v)) for r in C.coreset(pts, 4, 3, 2, seed=2).collect()}
    def centers():
        return {r.center_id: list(r.v) for r in C.cluster(pts, 7, 3, seed=4).collect()}
    want, wanted = rows(), centers()
    score = C.mr_cluster(pts, 4, 3, 2, seed=2).first()
    monkeypatch.setattr(C, "MAX_DRIVER_BYTES", 0)
    got, have = rows(), centers()
    assert got.keys() == want.keys() and have.keys() == wanted.keys()
    assert all(got[k][:2] == want[k][:2] and np.allclose(got[k][2], want[k][2], atol=1e-9) for k in want)
    assert all(np.allclose(have[k], wanted[k], atol=1e-9) for k in wanted)
    again = C.mr_cluster(pts, 4, 3, 2, seed=2).first()
    assert again[:4] == score[:4] and abs(again.objective - score.objective) < 1e-9
    with pytest.raises(ValueError):
        C.cluster(pts.limit(3), 4, 1)


def test_points_are_not_shuffled_in_a_step(spark, small):
    g = M.group_points(C._as_parted(points(spark)), 4)
    try:
        sizes = [r["n"] for r in g.points.groupBy("part", "salt").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(sizes) <= 80 and len(sizes) > 7      # the large part is cut
        centers = M.seed(g, 4, 1, 2)
        step = M._meet(g, M._beside(g, centers), M._sums, M._SUMS_SCHEMA)
        plan = step._jdf.queryExecution().executedPlan().toString()
        left = plan.split("InMemoryTableScan")[0]
        assert "FlatMapCoGroupsInArrow" in left and "Exchange" not in left
        # Running distances: one row a group, eight bytes a point.
        d = M._meet(g, M._beside(g, centers), M._pack, "part int, salt int, d binary")
        assert d.select(F.sum(F.length("d"))).first()[0] == 8 * g.points.count()
        assert d.count() == len(sizes)
    finally:
        g.release()


def test_thousands_of_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "MAX_DRIVER_BYTES", 0)
    pts = spark.range(9000).select((F.col("id") % 3000).cast("int").alias("part"), "id",
                                   F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"), F.lit(1.0).alias("w"))
    out = C.seed_centers(pts, 2, 1)
    assert out.groupBy("part").count().where("count = 2").count() == 3000


def test_no_points(spark):
    with pytest.raises(ValueError):
        M.group_points(C._as_parted(points(spark).where("part < 0")), 2)
