"""Clustering of weighted points (M4-M10) as Spark jobs.

Every routine works on points ``part, id, v, w`` and treats each part as an
independent problem, all parts advancing together, one pass over the data
per step. A plain run is the one-part case (``part = 0``). So the
three-round method's first round -- "cluster every part on its own" --
never holds a part in one task: each step is a scan plus a small aggregate
with one row per (part, center). While all centers (parts x k vectors) take at
most ``MAX_DRIVER_BYTES`` they are broadcast; beyond that they stay in Spark
(:mod:`roundstats.plans.many_parts`), with the same seeds.

Semantics kept from the reference: seeding draws the first center
uniformly and each next one with probability proportional to ``w * d``
(distance, not squared), never re-drawing a chosen point; Lloyd runs a fixed
number of weighted rounds; the score is the mean plain distance. Decisions
where the reference breaks: an empty cluster keeps its previous center; if
every remaining ``w * d`` is 0 the next center is the remaining point with
the smallest draw; a part with at most k points keeps them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundstats.operators.numbers import merge_means
from roundstats.operators.parts import cut_lineage, keep, spread, with_parts
from roundstats.operators.sampling import (
    draw_next,
    pick_uniform,
    start_nearest,
    update_nearest,
)
from roundstats.plans import many_parts
from roundstats.sources.text import vector_col
from roundstats.operators.vectors import (
    Centers,
    assign,
    centers_frame,
    center_sums,
)

SMALL_ROWS = 1 << 16   # points of a bounded set that one task takes a step over
REFRESH_EVERY = 8      # centers folded into the stored running distance
CHECKPOINT_EVERY = 4   # refreshes between writes to the checkpoint folder
MAX_DRIVER_BYTES = 32 << 20   # all centers of a clustering (doubles) that may pass the driver


def _check(k: int, iters: int, parts: int = 1) -> None:
    if k < 1 or iters < 0 or parts < 1:
        raise ValueError(f"need k >= 1, iters >= 0, parts >= 1 (got {k}, {iters}, {parts})")


def _as_parted(points: DataFrame) -> DataFrame:
    cols = points.columns
    base = points if "part" in cols else points.withColumn("part", F.lit(0))
    w = F.col("w") if "w" in cols else F.lit(1)
    return base.select(F.col("part").cast("int").alias("part"), F.col("id").cast("long").alias("id"),
                       vector_col(base, "v").alias("v"), w.cast("double").alias("w"))


def _fits_driver(pts: DataFrame, k: int, parts: int | None = None) -> bool:
    """Whether all centers of ``pts`` are within ``MAX_DRIVER_BYTES``. ``parts``:
    upper bound of the number of parts (counted when not given)."""
    row = pts.select(F.size("v").alias("n")).head()
    if row is None:
        return True
    if parts is None:
        parts = pts.select("part").distinct().count()
    return parts * k * row["n"] * 8 <= MAX_DRIVER_BYTES


# ---------------------------------------------------------------- seeding --

def seed_rows(points: DataFrame, k: int, seed: int,
              refresh_every: int = REFRESH_EVERY) -> list[tuple[int, int, int, list[float]]]:
    """M4 (driver loop of k small aggregates): ``(part, center_id, id, v)``, for
    center sets that may pass the driver.

    Each step is one pass over the kept points (:func:`draw_next`): an Arrow
    kernel computes every point's nearest distance to the centers drawn so
    far -- a stored running distance ``d`` (M3) folded with the few centers
    drawn since it was stored -- and sends on only its best candidates; one
    ``min_by`` aggregate per part draws the next center (exponential race on
    ``w*d``, or the smallest draw among the remaining points when every
    ``w*d`` is 0). Every ``refresh_every`` centers the running distance is
    rewritten and kept; every ``CHECKPOINT_EVERY``-th rewrite also goes to
    the checkpoint folder, keeping each pass's work and the lineage short.
    """
    pts = _as_parted(points)
    first = pick_uniform(pts, seed, 0, by_part=True).collect()
    if not first:
        raise ValueError("no points to seed from")
    picked = [(int(r["part"]), 0, int(r["id"]), list(r["v"])) for r in first]
    recent = [(p, i, v) for p, _, i, v in picked]
    state = start_nearest(pts)
    held: DataFrame | None = None
    refreshes = 0
    try:
        for t in range(1, k):
            draws = draw_next(state, recent, [(p, i) for p, _, i, _ in picked], seed, t).collect()
            if not draws:
                break
            new = [(int(r["part"]), int(r["id"]), list(r["v"])) for r in draws]
            picked += [(p, t, i, v) for p, i, v in new]
            recent += new
            # Every ``refresh_every`` centers of a part, whatever the parts.
            if len(recent) >= refresh_every * len(new) and t < k - 1:
                refreshes += 1
                nxt = update_nearest(state, recent)
                # Kept for the next passes; every CHECKPOINT_EVERY-th refresh is
                # also written to the checkpoint folder, so a lost executor costs
                # at most that many fold passes to rebuild.
                if refreshes % CHECKPOINT_EVERY == 0:
                    nxt = cut_lineage(nxt)
                else:
                    nxt = keep(nxt)
                    # Filled from the state held so far, before that is let go.
                    nxt.count()
                if held is not None:
                    held.unpersist()
                held, state, recent = nxt, nxt, []
    finally:
        if held is not None:
            held.unpersist()
    return sorted(picked)


def seed_centers(points: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """M4: ``part, center_id, id, v`` -- k seeds per part (fewer if a part
    has fewer points)."""
    _check(k, 0)
    pts = _as_parted(points)
    if not _fits_driver(pts, k, None if "part" in points.columns else 1):
        g = many_parts.group_points(pts, k)
        try:
            return many_parts.seed(g, k, seed, REFRESH_EVERY)
        finally:
            g.release()
    rows = seed_rows(pts, k, seed)
    return points.sparkSession.createDataFrame(
        rows, "part int, center_id int, id long, v array<double>")


# ------------------------------------------------------------------ Lloyd --

def lloyd_step(points: DataFrame, centers: Centers) -> Centers:
    """One weighted Lloyd round: every center moves to the weighted mean of
    the points nearest to it; a center without points (or weight) stays.

    One row of sums per center comes back (:func:`center_sums`).
    """
    sums = center_sums(_as_parted(points), centers, "v", "w", by_part=True).where("sw > 0").toArrow()
    new = Centers(centers.parts.copy(), centers.vecs.copy(), centers.valid.copy(), centers.ids.copy())
    if sums.num_rows == 0:
        return new
    part, cid, sw = (sums.column(c).to_numpy() for c in ("part", "center_id", "sw"))
    sx = pc.list_flatten(sums.column("sx")).to_numpy().reshape(sums.num_rows, -1)
    pi = np.searchsorted(new.parts, part)
    # Slot of (part, center_id) in the table: a sorted-key lookup.
    m = int(new.ids.max()) + 1
    rows, cols = np.nonzero(new.valid)
    keys = rows.astype(np.int64) * m + new.ids[rows, cols]
    order = np.argsort(keys)
    j = cols[order][np.searchsorted(keys[order], pi.astype(np.int64) * m + cid)]
    new.vecs[pi, j] = sx / sw[:, None]
    return new


def lloyd(points: DataFrame, centers: Centers, iters: int) -> Centers:
    """M5: ``iters`` weighted Lloyd rounds (no convergence test). Each round
    is one pass over the (kept) points; only centers come back."""
    for _ in range(iters):
        centers = lloyd_step(points, centers)
    return centers


def _centers_from_seeds(rows) -> Centers:
    return Centers.from_rows([(p, c, v) for p, c, _, v in rows])


def run_clustering(points: DataFrame, k: int, iters: int, seed: int = 0,
                   rows: int | None = None) -> Centers:
    """Seeding then Lloyd for every part of ``points`` (kept while it runs).

    ``rows``: the points are at most that many (a coreset: k x parts); they
    are laid out ``SMALL_ROWS`` to a task, so that each of the k + iters steps
    over a small set is one task and over a large one as many as it needs.
    """
    _check(k, iters)
    pts = _as_parted(points)
    pts = spread(pts, "id") if rows is None else pts.repartition(max(1, -(-rows // SMALL_ROWS)), "id")
    pts = keep(pts)
    try:
        centers = _centers_from_seeds(seed_rows(pts, k, seed))
        return lloyd(pts, centers, iters)
    finally:
        pts.unpersist()


def cluster(points: DataFrame, k: int, iters: int, seed: int = 0, rows: int | None = None) -> DataFrame:
    """M6: ``center_id, v`` -- k centers for all points (one problem).

    Raises ``ValueError`` when there are fewer points than k. ``rows`` bounds
    the number of points, if known (see :func:`run_clustering`).
    """
    _check(k, iters)
    pts = _as_parted(points.drop("part") if "part" in points.columns else points)
    if _fits_driver(pts, k, 1):
        c = run_clustering(pts, k, iters, seed, rows)
        n, centers = int(c.valid.sum()), centers_frame(points.sparkSession, c, with_part=False)
    else:
        g = many_parts.group_points(pts, k)
        try:
            centers = many_parts.lloyd(g, many_parts.seed(g, k, seed, REFRESH_EVERY), iters).select("center_id", "v")
        finally:
            g.release()
        n = centers.count()
    # Seeding stops early only when it runs out of points.
    if n < k:
        raise ValueError(f"{n} points cannot give {k} centers")
    return centers


def objective(points: DataFrame, centers: DataFrame) -> DataFrame:
    """V5 over all points for a center set: one row ``objective``."""
    pts = _as_parted(points.drop("part") if "part" in points.columns else points)
    return assign(pts.drop("part"), centers.drop("part") if "part" in centers.columns else centers,
                  by_part=False).agg(F.avg("d").alias("objective"))


# -------------------------------------------------------- three rounds --

def _coreset(pts: DataFrame, k: int, parts: int, iters: int, seed: int) -> DataFrame:
    """Round 1 on points that already carry ``part`` (kept by the caller),
    written to the checkpoint folder."""
    if _fits_driver(pts, k, parts):
        centers = lloyd(pts, _centers_from_seeds(seed_rows(pts, k, seed)), iters)
        counts = (assign(pts, centers, by_part=True).groupBy("part", "center_id")
                  .agg(F.count(F.lit(1)).alias("n")))
        return _weighted(centers_frame(pts.sparkSession, centers), counts, k)
    g = many_parts.group_points(_as_parted(pts), k)
    try:
        rows = many_parts.lloyd(g, many_parts.seed(g, k, seed, REFRESH_EVERY), iters)
        counts = many_parts.sums(g, rows).select("part", "center_id", F.col("cnt").alias("n"))
        return _weighted(rows, counts, k)
    finally:
        g.release()


def _weighted(centers: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    w = F.coalesce("n", F.lit(0)).cast("long")
    return cut_lineage(
        centers.join(counts, ["part", "center_id"], "left")
        .select("part", "center_id", (F.col("part").cast("long") * k + F.col("center_id")).alias("id"), "v", w.alias("w")))


def _parted(points: DataFrame, parts: int, method: str) -> DataFrame:
    base = points.drop("part") if "part" in points.columns else points
    return spread(_as_parted(with_parts(base, parts, "id", method)), "id")


def coreset(points: DataFrame, k: int, parts: int, iters: int, seed: int = 0,
            method: str = "hash") -> DataFrame:
    """M7, round 1: ``part, center_id, id, v, w`` -- each part clustered on
    its own; w = how many of the part's points are nearest to the center.

    ``part`` comes from the point id (:func:`with_parts`); ``id`` of a
    coreset row is ``part * k + center_id``. Zero weights are kept here.
    """
    _check(k, iters, parts)
    pts = keep(_parted(points, parts, method))
    try:
        return _coreset(pts, k, parts, iters, seed)
    finally:
        pts.unpersist()


def objective_by_part(points: DataFrame, centers: DataFrame) -> DataFrame:
    """M9, round 3: mean distance to the nearest (global) center inside each
    part, then the partial means merged (A17): one row ``objective, n``."""
    c = centers.drop("part") if "part" in centers.columns else centers
    per = (assign(points, c, by_part=False).groupBy("part")
           .agg(F.avg("d").alias("avg"), F.count(F.lit(1)).alias("n")))
    return merge_means(per, "avg", "n").withColumnRenamed("avg", "objective")


def mr_cluster(points: DataFrame, k: int, parts: int, iters: int, seed: int = 0,
               method: str = "hash") -> DataFrame:
    """The three rounds end to end; one row
    ``n_points, k, parts, iters, objective``.

    1. coreset: each part clustered alone, k weighted centers per part;
    2. the weighted coreset (zero weights dropped) clustered into k centers;
    3. mean distance of every point to its nearest final center, per part,
       merged.

    The parted points are kept for all three rounds; the score's one row is
    written to the checkpoint folder before they are let go.
    """
    _check(k, iters, parts)
    pts = keep(_parted(points, parts, method))
    try:
        cs = _coreset(pts, k, parts, iters, seed).where(F.col("w") > 0).select("id", "v", "w")
        final = cluster(cs, k, iters, seed, rows=k * parts)
        obj = cut_lineage(objective_by_part(pts, final))
    finally:
        pts.unpersist()
    return obj.select(F.col("n").alias("n_points"), F.lit(k).alias("k"),
                      F.lit(parts).alias("parts"), F.lit(iters).alias("iters"), "objective")
