import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from roundstats.operators import sampling as S
from roundstats.plans import clustering as C
from roundstats.sources import points_from, read_points, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def emb(spark):
    e = table(spark, SF, "embeddings").withColumn("w", F.col("label") + 1)
    pts = points_from(e, "vec_id", "embedding", "w")
    rows = sorted(pts.collect(), key=lambda r: r["id"])
    ids = [r["id"] for r in rows]
    X = np.array([r["v"] for r in rows])
    w = np.array([float(r["w"]) for r in rows])
    return pts, ids, X, w


def test_seeds_match_brute_force(spark, emb):
    pts, ids, X, w = emb
    got = [r[2] for r in C.seed_rows(pts, 5, seed=11)]
    want = [ids[i] for i in brute.seeds(ids, X, w, 5, 11)]
    assert got == want


def test_lloyd_matches_brute_force(spark, emb):
    pts, ids, X, w = emb
    got = C.run_clustering(pts, 4, 3, seed=5)
    want = brute.lloyd(X, w, X[brute.seeds(ids, X, w, 4, 5)], 3)
    assert np.allclose(got.vecs[0], want, atol=1e-9)


def test_seeds_do_not_depend_on_layout(spark, emb):
    pts = emb[0]
    a = [r[2] for r in C.seed_rows(pts.repartition(1), 4, seed=3)]
    b = [r[2] for r in C.seed_rows(pts.repartition(7), 4, seed=3)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        c = [r[2] for r in C.seed_rows(pts.repartition(3), 4, seed=3)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert a == b == c


def test_all_zero_weighted_distance_falls_back(spark):
    # Duplicates only: after the first pick every w*d is 0, so the rest come
    # by the smallest draw among the remaining points.
    rows = [(i, [1.0, 1.0], 1) for i in range(5)]
    pts = spark.createDataFrame(rows, "id long, v array<double>, w long")
    got = [r[2] for r in C.seed_rows(pts, 3, seed=2)]
    X = np.ones((5, 2))
    want = brute.seeds(list(range(5)), X, np.ones(5), 3, 2)
    assert got == want and len(set(got)) == 3


def test_cluster_needs_k_points(spark):
    pts = spark.createDataFrame([(1, [0.0], 1)], "id long, v array<double>, w long")
    with pytest.raises(ValueError):
        C.cluster(pts, 2, 1)


def test_objective_zero_when_k_equals_n(spark):
    rows = [(i, [float(i), float(i * i)], 1) for i in range(6)]
    pts = spark.createDataFrame(rows, "id long, v array<double>, w long")
    centers = C.cluster(pts, 6, 2, seed=1)
    assert C.objective(pts, centers).first()["objective"] == 0.0


def test_coreset_weights_sum_to_n(spark, emb):
    pts = emb[0].drop("w")
    cs = C.coreset(pts, 3, 4, 1, seed=7)
    assert cs.agg(F.sum("w")).first()[0] == pts.count()
    assert cs.select("part").distinct().count() == 4


def test_small_part_keeps_all_points(spark):
    rows = [(i, [float(i), 0.0], 1) for i in range(10)]
    pts = spark.createDataFrame(rows, "id long, v array<double>, w long")
    cs = C.coreset(pts, 4, 5, 2, seed=1, method="mod")   # 2 points per part
    per = {r["part"]: r["n"] for r in cs.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {p: 2 for p in range(5)}
    assert all(r["w"] == 1 for r in cs.collect())


def test_mr_cluster_row(spark, emb):
    r = C.mr_cluster(emb[0].drop("w"), 3, 4, 1, seed=7).collect()
    assert len(r) == 1 and r[0]["n_points"] == 500 and r[0]["objective"] > 0


def test_pick_weighted_equals_brute_force(spark):
    rows = [(i, [float(i)], w) for i, w in enumerate([1, 2, 3, 4, 10])]
    pts = spark.createDataFrame(rows, "id long, v array<double>, w long")
    for seed in range(5):
        got = S.pick_weighted(pts, "w", seed, 1).first()["id"]
        want = min(range(5), key=lambda i: (-math.log(brute.u(seed, 1, i)) / rows[i][2], i))
        assert got == want


def test_race_follows_the_weights():
    # Sampling law of the md5 race: frequencies proportional to weight.
    w = np.array([1, 2, 3, 4, 10], dtype=float)
    n = 4000
    counts = np.zeros(5)
    for seed in range(n):
        keys = [-math.log(brute.u(seed, 1, i)) / w[i] for i in range(5)]
        counts[int(np.argmin(keys))] += 1
    expect = n * w / w.sum()
    chi2 = ((counts - expect) ** 2 / expect).sum()
    assert chi2 < 18.47   # 4 degrees of freedom, p = 0.001


def test_seeding_beyond_the_driver_bound_matches(spark, emb, monkeypatch):
    pts = emb[0].withColumn("part", (F.col("id") % 5).cast("int"))
    whole = C.seed_rows(pts, 3, seed=4)
    monkeypatch.setattr(C, "MAX_DRIVER_BYTES", 64 * 8 * 3 * 2)   # two parts' centers
    spark_side = sorted((r.part, r.center_id, r.id) for r in C.seed_centers(pts, 3, seed=4).collect())
    assert [r[:3] for r in whole] == spark_side
    assert len({r[0] for r in whole}) == 5


def test_three_rounds_do_not_depend_on_layout(spark, emb):
    pts = emb[0].drop("w")
    a = C.mr_cluster(pts.repartition(1), 3, 4, 1, seed=7, method="mod").first()["objective"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        b = C.mr_cluster(pts.repartition(7), 3, 4, 1, seed=7, method="mod").first()["objective"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert abs(a - b) < 1e-12


def test_seeding_across_refreshes_matches_brute_force(spark, emb):
    # k = 12 crosses the stored-distance refresh (every 8, and every 3).
    pts, ids, X, w = emb
    want = [ids[i] for i in brute.seeds(ids, X, w, 12, 21)]
    assert [r[2] for r in C.seed_rows(pts, 12, seed=21)] == want
    assert [r[2] for r in C.seed_rows(pts, 12, seed=21, refresh_every=3)] == want
    # Every 2: five refreshes, the fourth is written to the checkpoint folder.
    assert [r[2] for r in C.seed_rows(pts, 12, seed=21, refresh_every=2)] == want


def test_text_points_do_not_follow_the_splits(spark, tmpdir_text):
    lines = [f"{(i * 37) % 101} {(i * 53) % 97}" for i in range(400)] + ["7 7"] * 150
    path = tmpdir_text("points.txt", "\n".join(lines) + "\n")

    def run(size):
        held = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            pts = read_points(spark, path)
            assert pts.count() == 550 and pts.select("id").distinct().count() == 550
            seeds = [(r[1], r[2]) for r in C.seed_rows(pts, 5, seed=7)]
            cs = sorted((r["id"], r["w"], tuple(round(x, 9) for x in r["v"])) for r in C.coreset(pts, 3, 4, 1, seed=7).collect())
            return seeds, cs, round(C.mr_cluster(pts, 3, 4, 1, seed=7).first()["objective"], 9)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", held)

    assert run(128 << 20) == run(1000)
