"""Seeding and Lloyd rounds whose centers stay in Spark (M3-M5, M7).

:mod:`roundstats.plans.clustering` broadcasts the centers while all of them
(parts x k vectors) are small enough for the driver. Beyond that bound it calls
this module, in which neither centers nor chosen ids leave Spark:

* points are laid out once by ``(part, salt)`` and kept. A salt cuts a part into
  groups of about ``GROUP_ROWS`` points, so a part with a third of all points is
  many groups; small parts are one group each;
* every step is a cogroup of the kept points with a narrow table: the centers of
  each group's part and, once there is one, the group's running distance. Only
  the narrow side is shuffled. A group has at least four points per center of
  its part, so the centers sent to all groups are at most a quarter of the points;
* the running distance (M3) is one row of packed doubles per group, 8 bytes a
  point whatever the vectors' length, in (id, content) order. Groups are met by
  part, so ids may repeat between parts;
* the new centers of a step or round, and each rewritten running distance, are
  written to the checkpoint folder: lineage ends there.

Draws and distances use the same seeded columns and kernels as the broadcast
way, so both give the same seeds; Lloyd sums differ by the order of addition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundstats.functions.columns import uniform
from roundstats.operators.parts import cut_lineage, keep
from roundstats.operators.sampling import _min_distance, pick_uniform, winners
from roundstats.operators.vectors import (
    _SUMS_SCHEMA,
    Centers,
    _add,
    _matrix,
    _number,
    _sum_rows,
    merge_sums,
    nearest,
    row_blocks,
)

GROUP_ROWS = 1 << 16      # points of a part in one group, at most four times k
TASK_ROWS = 1 << 20       # points to a task


@dataclass
class Groups:
    """Points ``part, salt, id, h, v, w`` kept by group, and the groups' keys."""

    points: DataFrame
    keys: DataFrame
    tasks: int

    def release(self) -> None:
        self.points.unpersist()


def group_points(points: DataFrame, k: int) -> Groups:
    """Lay out ``part, id, v, w`` for the steps below (one shuffle)."""
    spark = points.sparkSession
    rows = max(GROUP_ROWS, 4 * k)
    counts = cut_lineage(points.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        raise ValueError("no points to seed from")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism,
                -(-total // TASK_ROWS))
    large = counts.where(F.col("n") > rows).select("part", F.ceil(F.col("n") / rows).alias("salts"))
    # The literal keeps salts apart from parts that are hashes of the id too.
    salt = F.pmod(F.xxhash64(F.lit("salt"), F.col("id")), F.coalesce("salts", F.lit(1))).cast("int")
    pts = keep(points.join(large, "part", "left")
               .select("part", salt.alias("salt"), "id", F.xxhash64("v", "w").alias("h"), "v", "w")
               .repartition(tasks, "part", "salt").sortWithinPartitions("part", "salt"))
    return Groups(pts, cut_lineage(pts.select("part", "salt").distinct()), tasks)


def _beside(g: Groups, centers: DataFrame, state: DataFrame | None = None, folded: int = 0) -> DataFrame:
    """What each group meets: its part's centers (those numbered below ``folded``
    by id alone, as the running distance holds them) and its running distance."""
    v = F.when(F.col("center_id") >= folded, F.col("v"))
    rows = g.keys.join(centers, "part").select(
        "part", "salt", "center_id", "id", v.alias("v"), F.lit(None).cast("binary").alias("d"))
    if state is not None:
        rows = rows.unionByName(state.select(
            "part", "salt", F.lit(-1).alias("center_id"), F.lit(None).cast("long").alias("id"),
            F.lit(None).cast("array<double>").alias("v"), "d"))
    return rows.repartition(g.tasks, "part", "salt")


def _meet(g: Groups, beside: DataFrame, kernel, schema: str, u: Column | None = None) -> DataFrame:
    points = g.points if u is None else g.points.withColumn("u", u)
    return points.groupBy("part", "salt").cogroup(beside.groupBy("part", "salt")).applyInArrow(
        _whole(kernel, schema), schema)


def _whole(kernel, schema: str):
    """A cogroup function on record batches; a group without points gives no row."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            names = [f.split()[0] for f in schema.split(", ")]
            return pa.table({n: pa.nulls(0) for n in names})
        one = [t.combine_chunks().to_batches()[0] for t in (left, right)]
        return pa.Table.from_batches([kernel(*one)])
    return run


def _running(points: pa.RecordBatch, beside: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The order of the packed distances, and the distance of each point to the
    nearest center met so far."""
    order = np.lexsort((_number(points, "h"), _number(points, "id")))
    d = np.full(points.num_rows, np.inf)
    for packed in beside.column(5).drop_null().to_pylist():
        d[order] = np.frombuffer(packed, "<f8")
    new = beside.filter(beside.column(4).is_valid())
    if new.num_rows:
        vecs = _matrix(new, "v")[None]
        d = _min_distance(_matrix(points, "v"), np.zeros(len(d), np.int64), np.zeros(1, np.int64), vecs,
                          np.ones(vecs.shape[:2], bool), d)
    return order, d


def _draw(points: pa.RecordBatch, beside: pa.RecordBatch) -> pa.RecordBatch:
    """The group's best candidates of the race and of the fallback draw."""
    ids, u = _number(points, "id"), _number(points, "u")
    _, d = _running(points, beside)
    wd = _number(points, "w").astype(np.float64) * d
    free = ~np.isin(ids, beside.column(3).drop_null().to_numpy(zero_copy_only=False))
    with np.errstate(divide="ignore", invalid="ignore"):
        race = np.where(free & (wd > 0), -np.log(u) / wd, np.inf)
    kinds, keys, at = [], [], []
    for kind, key in ((0, race), (1, np.where(free, u, np.inf))):
        ok = np.flatnonzero(np.isfinite(key))
        if len(ok):
            best = ok[np.lexsort((ids[ok], key[ok]))[0]]
            kinds.append(kind), keys.append(float(key[best])), at.append(int(best))
    at = pa.array(at, pa.int64())
    own = [points.column(points.schema.get_field_index(c)).take(at) for c in ("part", "id", "v")]
    return pa.RecordBatch.from_arrays([own[0], pa.array(kinds, pa.int8()), pa.array(keys, pa.float64()), *own[1:]],
                                      names=["part", "kind", "key", "id", "v"])


def _pack(points: pa.RecordBatch, beside: pa.RecordBatch) -> pa.RecordBatch:
    order, d = _running(points, beside)
    return pa.RecordBatch.from_arrays(
        [points.column(0).slice(0, 1), points.column(1).slice(0, 1), pa.array([d[order].astype("<f8").tobytes()], pa.binary())],
        names=["part", "salt", "d"])


def seed(g: Groups, k: int, seed: int, refresh_every: int) -> DataFrame:
    """M4: ``part, center_id, id, v``, k per part (fewer if a part has fewer)."""
    vector = F.col("v").cast("array<double>").alias("v")

    def picked(rows: DataFrame, t: int) -> DataFrame:
        return cut_lineage(rows.select("part", F.lit(t).alias("center_id"), "id", vector))

    vtype = g.points.schema["v"].dataType.simpleString()
    centers, state, folded = picked(pick_uniform(g.points, seed, 0, by_part=True), 0), None, 0
    for t in range(1, k):
        cands = _meet(g, _beside(g, centers, state, folded), _draw,
                      f"part int, kind tinyint, key double, id long, v {vtype}", uniform(seed, t, "id"))
        new = picked(winners(cands), t)
        if new.isEmpty():
            break
        centers = centers.unionByName(new)
        if (t + 1) % refresh_every == 0 and t < k - 1:
            centers = cut_lineage(centers)
            state = cut_lineage(_meet(g, _beside(g, centers, state, folded), _pack, "part int, salt int, d binary"))
            folded = t + 1
    return cut_lineage(centers)


def _sums(points: pa.RecordBatch, beside: pa.RecordBatch) -> pa.RecordBatch:
    """Sums of the group's points by nearest center of its part."""
    beside = beside.sort_by("center_id")
    ids, vecs = _number(beside, "center_id").astype(np.int32), _matrix(beside, "v")
    part = _number(points, "part")[:1].astype(np.int64)
    c = Centers(part, vecs[None], np.ones((1, len(ids)), bool), ids[None])
    X, w = _matrix(points, "v"), _number(points, "w").astype(np.float64)
    keys = np.zeros((len(w), 2), np.int64)
    keys[:, 0], keys[:, 1] = part[0], ids[nearest(X, np.zeros(len(w), np.int64), c)[1]]
    held = None
    for blk in row_blocks(*X.shape):
        new = _add(keys[blk], w[blk], np.ones(len(w[blk]), np.int64), X[blk].astype(np.float64) * w[blk][:, None])
        held = new if held is None else _add(*(np.concatenate(x) for x in zip(held, new)))
    return _sum_rows(*held)


def sums(g: Groups, centers: DataFrame) -> DataFrame:
    """``part, center_id, sw, cnt, sx`` by nearest center of the point's part."""
    return merge_sums(_meet(g, _beside(g, centers), _sums, _SUMS_SCHEMA))


def lloyd(g: Groups, centers: DataFrame, iters: int) -> DataFrame:
    """M5: a center without points (or weight) stays."""
    for _ in range(iters):
        moved = sums(g, centers).where("sw > 0").select(
            "part", "center_id", F.transform("sx", lambda x: x / F.col("sw")).alias("to"))
        centers = cut_lineage(centers.join(moved, ["part", "center_id"], "left")
                              .select("part", "center_id", "id", F.coalesce("to", "v").alias("v")))
    return centers
