import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roundstats.functions import distance
from roundstats.operators import sampling as S
from roundstats.operators import vectors as V
from roundstats.sources import points_from_lines, read_points

PTS = [(1, [0.0, 1.0], 1), (2, [2.0, 0.0], 1), (3, [4.0, 3.0], 1)]
CENTERS = [(0, [0.0, 0.0]), (1, [4.0, 0.0])]


@pytest.fixture()
def pts(spark):
    return spark.createDataFrame(PTS, "id long, v array<double>, w long")


@pytest.fixture()
def centers(spark):
    return spark.createDataFrame(CENTERS, "center_id int, v array<double>")


def test_assign_fixture(pts, centers):
    got = {r["id"]: (r["d"], r["center_id"]) for r in V.assign(pts, centers).collect()}
    assert got == {1: (1.0, 0), 2: (2.0, 0), 3: (3.0, 1)}   # (2,0): tie, first wins


def test_weights_objective_centroids(pts, centers, spark):
    w = {r["center_id"]: r["n"] for r in V.cluster_weights(pts, centers).collect()}
    assert w == {0: 2, 1: 1}
    assert V.avg_distance(pts, centers).first()["objective"] == 2.0
    cen = {r["center_id"]: r["v"] for r in V.weighted_centroids(pts, centers).collect()}
    assert cen == {0: [1.0, 0.5], 1: [4.0, 3.0]}


def test_empty_center_gets_zero_weight(pts, spark):
    cs = spark.createDataFrame(CENTERS + [(2, [100.0, 100.0])], "center_id int, v array<double>")
    w = {r["center_id"]: r["n"] for r in V.cluster_weights(pts, cs).collect()}
    assert w == {0: 2, 1: 1, 2: 0}


def test_column_distance(pts):
    r = pts.select(distance(F.col("v"), F.array(F.lit(0.0), F.lit(0.0))).alias("d")).collect()
    assert sorted(x["d"] for x in r) == [1.0, 2.0, 5.0]


def test_chunked_broadcast_matches(spark):
    rows = [(p * 100 + i, p, [float(i), float(p)], 1) for p in range(6) for i in range(20)]
    pts = spark.createDataFrame(rows, "id long, part int, v array<double>, w long")
    cs = spark.createDataFrame([(p, j, [float(j * 7), float(p)]) for p in range(6) for j in range(3)],
                               "part int, center_id int, v array<double>")
    whole = sorted(tuple(r) for r in V.assign(pts, cs).select("id", "center_id", "d").collect())
    tiny = sorted(tuple(r) for r in V.assign(pts, cs, max_bytes=64).select("id", "center_id", "d").collect())
    assert whole == tiny


def test_points_text_rules(spark, tmpdir_text):
    path = tmpdir_text("p.txt", "1.0 2.0\n3 4\n")
    got = sorted(r["v"] for r in read_points(spark, path).collect())
    assert got == [[1.0, 2.0], [3.0, 4.0]]
    bad = spark.createDataFrame([(1, "1.0  2.0"), (2, "5 6")], "id long, line string")
    with pytest.raises(Exception):
        points_from_lines(bad, "line", "id", strict=True).collect()
    kept = points_from_lines(bad, "line", "id", strict=False).collect()
    assert [r["id"] for r in kept] == [2]


def test_ragged_vectors_refused(spark, centers):
    pts = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [1.0], 1)], "id long, v array<double>, w long")
    with pytest.raises(Exception):
        V.assign(pts.coalesce(1), centers).collect()


def test_oversized_global_centers_take_the_exact_fallback(spark):
    rows = [(i, [float(i % 9), float(i % 4)], 1 + i % 3) for i in range(60)]
    pts = spark.createDataFrame(rows, "id long, v array<double>, w long")
    cs = spark.createDataFrame([(j, [float(j), float(j % 2)]) for j in range(6)], "center_id int, v array<double>")
    whole = sorted(tuple(r) for r in V.assign(pts, cs).select("id", "center_id", "d").collect())
    tiny = sorted(tuple(r) for r in V.assign(pts, cs, max_bytes=20).select("id", "center_id", "d").collect())
    assert whole == tiny
    c = V.collect_centers(cs)
    big = {(r["center_id"], r["pos"]): (r["sw"], r["sx"]) for r in V.centroid_sums(pts, c, by_part=False).collect()}
    small = {(r["center_id"], r["pos"]): (r["sw"], r["sx"])
             for r in V.centroid_sums(pts, c, by_part=False, max_bytes=20).collect()}
    assert big.keys() == small.keys()
    assert all(abs(big[k][0] - small[k][0]) < 1e-9 and abs(big[k][1] - small[k][1]) < 1e-9 for k in big)


def test_one_part_too_large_is_cut_by_center(spark):
    rows = [(i, i % 2, [float(i % 9), float(i % 4)], 1) for i in range(50)]
    pts = spark.createDataFrame(rows, "id long, part int, v array<double>, w long")
    cs = spark.createDataFrame([(p, j, [float(j + p), float(j % 2)]) for p in range(2) for j in range(5)],
                               "part int, center_id int, v array<double>")
    whole = sorted(tuple(r) for r in V.assign(pts, cs).select("id", "center_id", "d").collect())
    tiny = sorted(tuple(r) for r in V.assign(pts, cs, max_bytes=40).select("id", "center_id", "d").collect())
    assert whole == tiny
    c = V.collect_centers(cs)
    a = {(r["part"], r["center_id"], r["pos"]): r["sx"] for r in V.centroid_sums(pts, c).collect()}
    b = {(r["part"], r["center_id"], r["pos"]): r["sx"] for r in V.centroid_sums(pts, c, max_bytes=40).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_row_blocks_do_not_change_results(spark, monkeypatch):
    from roundstats.plans import clustering as C

    rows = [(i, [float(i % 9), float(i % 4), float(i % 5)], 1 + i % 3) for i in range(80)]
    pts = spark.createDataFrame(rows, "id long, v array<float>, w long")
    cs = spark.createDataFrame([(j, [float(j), float(j % 2), 1.0]) for j in range(5)],
                               "center_id int, v array<double>")
    whole = sorted(tuple(r) for r in V.assign(pts, cs).select("id", "center_id", "d").collect())
    seeds = C.seed_rows(pts, 4, seed=3)
    lloyd = C.run_clustering(pts, 4, 2, seed=3).vecs
    monkeypatch.setattr(V, "BLOCK_ELEMS", 7)        # two rows per block
    tiny = sorted(tuple(r) for r in V.assign(pts, cs).select("id", "center_id", "d").collect())
    assert whole == tiny
    assert C.seed_rows(pts, 4, seed=3) == seeds
    import numpy as np
    assert np.allclose(C.run_clustering(pts, 4, 2, seed=3).vecs, lloyd, atol=1e-12)


def test_rejected_point_lines_are_reported(spark):
    from roundstats.sources import rejected_point_lines

    lines = spark.createDataFrame([(1, "1.0  2.0"), (2, "5 6"), (3, "inf 1"), (4, "")], "id long, line string")
    assert sorted(r["id"] for r in rejected_point_lines(lines, "line", "id").collect()) == [1, 3, 4]
    kept = points_from_lines(lines, "line", "id", strict=False).collect()
    assert [r["id"] for r in kept] == [2]


def test_column_kernel_matches_arrow_kernel(pts, centers, spark):
    a = sorted(tuple(r) for r in V.assign(pts, centers).select("id", "center_id", "d").collect())
    b = sorted(tuple(r) for r in V.assign(pts, centers, kernel="columns").select("id", "center_id", "d").collect())
    assert a == b == [(1, 0, 1.0), (2, 0, 2.0), (3, 1, 3.0)]   # (2,0): tie, first wins
    from roundstats.sources import points_from, table
    emb = points_from(table(spark, "/root/testdata/sf0.001", "embeddings"), "vec_id", "embedding")
    cs = emb.where(F.col("id") < 5).select(F.col("id").cast("int").alias("center_id"), "v")
    x = {r["id"]: (r["center_id"], round(r["d"], 9)) for r in V.assign(emb, cs).collect()}
    y = {r["id"]: (r["center_id"], round(r["d"], 9)) for r in V.assign(emb, cs, kernel="columns").collect()}
    assert x == y


@pytest.mark.parametrize("max_bytes", [1, 20, 64, V.MAX_CENTER_BYTES])
def test_any_slice_size_gives_the_same_rows(spark, max_bytes):
    """Equal ids, no id at all, a part's center that is NaN: no row is lost or moved."""
    nan = float("nan")
    rows = [(0, 1, [0.0, 1.0]), (0, 1, [0.0, 1.0]), (0, 2, [9.0, 0.0]), (1, 1, [5.0, 5.0])]
    pts = spark.createDataFrame(rows, "part int, id long, v array<double>")
    cs = spark.createDataFrame([(0, 0, [nan, nan]), (0, 1, [0.0, 0.0]), (0, 2, [10.0, 0.0]), (0, 3, [0.0, 2.0]),
                                (1, 0, [nan, nan])], "part int, center_id int, v array<double>")
    got = V.assign(pts, cs, max_bytes=max_bytes).select("part", "id", "center_id", "d").collect()
    assert sorted(str(tuple(r)) for r in got) == [
        "(0, 1, 1, 1.0)", "(0, 1, 1, 1.0)", "(0, 2, 2, 1.0)", "(1, 1, 0, nan)"]
    glob = cs.where("part = 0").drop("part")
    held = V.collect_centers(glob)
    for c in (glob, held):
        got = V.assign(pts.select("v"), c, max_bytes=max_bytes).select("center_id").collect()
        assert sorted(r[0] for r in got) == [1, 1, 2, 3]     # (5, 5) is nearest to (0, 2)
    sums = V.centroid_sums(pts, held, w_col=None, by_part=False, max_bytes=max_bytes).where("pos = 0").collect()
    assert sorted((r["center_id"], r["cnt"], r["sx"]) for r in sums) == [(1, 2, 0.0), (2, 1, 9.0), (3, 1, 5.0)]


@pytest.mark.parametrize("max_bytes", [1, 64, V.MAX_CENTER_BYTES])
def test_part_without_centers_fails_at_any_slice_size(spark, max_bytes):
    pts = spark.createDataFrame([(0, 1, [0.0]), (7, 2, [1.0])], "part int, id long, v array<double>")
    cs = spark.createDataFrame([(0, 0, [0.0]), (0, 1, [3.0])], "part int, center_id int, v array<double>")
    with pytest.raises(Exception, match="no centers"):
        V.assign(pts, cs, max_bytes=max_bytes).collect()


class _Held:
    def __init__(self, value):
        self.value = value


def test_kernels_emit_once_per_task():
    rng = np.random.default_rng(3)
    batches = [pa.RecordBatch.from_pydict({
        "part": pa.array([0, 1] * 50, pa.int32()), "id": pa.array(range(b * 100, b * 100 + 100), pa.int64()),
        "v": pa.array(rng.random((100, 3)).tolist(), pa.list_(pa.float64())), "w": [1.0] * 100,
        "d": [1.0] * 100, "u": rng.random(100)}) for b in range(5)]
    c = V.Centers.from_rows([(p, j, rng.random(3).tolist()) for p in (0, 1) for j in range(4)])
    points = [b.select(["part", "id", "v", "w"]) for b in batches]
    fold = V._fold_kernel(_Held(c.arrays()), "v", "part", True, True)
    out = list(V._sums_kernel(fold, "v", "part", "w")(iter(points)))
    assert sum(b.num_rows for b in out) == 8 and sum(sum(b.column(3).to_pylist()) for b in out) == 500
    taken = [(0, 0), (0, 1)]          # id 1 is free in part 1
    recent = S._center_table([(0, 0, [0.0] * 3), (1, 0, [0.0] * 3)])
    out = list(S._draw_kernel(_Held(recent + (taken,)), "d")(iter(batches)))
    assert sum(b.num_rows for b in out) == 4
    u = np.concatenate([b.column(5).to_numpy() for b in batches])
    best = {r["part"]: r["id"] for b in out for r in b.to_pylist() if r["kind"] == 1}
    assert best == {p: min((i for i in range(500) if i % 2 == p and (p, i) not in taken), key=u.__getitem__)
                    for p in (0, 1)}


def test_sums_are_merged_by_element(spark):
    """Sums of many tasks, equal to NumPy's; the shuffle carries a row per task and center."""
    import numpy as np
    from roundstats.operators import vectors as V

    rng = np.random.default_rng(7)
    x = rng.integers(-50, 50, (900, 12)).astype(float)
    part, w = rng.integers(0, 3, 900), rng.integers(0, 4, 900)
    rows = [(int(p), i, v.tolist(), float(u)) for i, (p, v, u) in enumerate(zip(part, x, w))]
    pts = spark.createDataFrame(rows, "part int, id long, v array<double>, w double").repartition(7)
    cs = [(p, c, x[p * 40 + c * 7].tolist()) for p in range(3) for c in range(5)]
    table = V.Centers.from_rows(cs)
    got = {(r["part"], r["center_id"]): r for r in V.center_sums(pts, table).collect()}
    d = np.array([[((v - np.array(c)) ** 2).sum() if p == q else np.inf for q, _, c in cs] for p, v in zip(part, x)])
    best = d.argmin(axis=1)
    assert len(got) == len(set(best.tolist()))
    for k in set(best.tolist()):
        own = best == k
        r = got[cs[k][0], cs[k][1]]
        assert r["cnt"] == own.sum() and r["sw"] == w[own].sum()
        assert r["sx"] == (x[own] * w[own][:, None]).sum(axis=0).tolist()
    plan = V.center_sums(pts, table)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "pos" not in plan
