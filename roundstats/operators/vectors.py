"""Vector operators over weighted points (V1-V6).

Points are rows ``[part,] id, v array<float|double>, w``; a center set is rows
``[part,] center_id, v``. Without a ``part`` column a center set applies to
every point; with one, each point only sees its own part's centers (many
independent clusterings in one pass, as the per-part coreset needs).

The nearest-center search runs in ``mapInArrow`` with NumPy: Arrow batches
of points meet a slice of the centers held in a broadcast variable, and fold
it into the best ``(d, center_id)`` found so far. The order of the slices does
not matter (the smaller distance wins, then the smaller id; NaN is worse than
any number), so a table of any size is cut into slices of bounded bytes. Up to
the bound there is one slice and one pass; beyond it the points are written
to the checkpoint folder after each slice, a cost far below that of meeting it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.functions.columns import nearest_center
from roundstats.operators.parts import cut_lineage


# Largest slice of a center table sent as one broadcast (bytes of doubles).
MAX_CENTER_BYTES = 256 << 20
# Largest sums a task holds before it sends them on (bytes of doubles).
MAX_SUM_BYTES = 64 << 20


@dataclass
class Centers:
    """Driver-side copy of a small center set, grouped by part.

    ``parts``: sorted part numbers (P,); ``vecs``: (P, K, D) with padding;
    ``valid``: (P, K) mask of real centers; ``ids``: (P, K) center numbers.
    """

    parts: np.ndarray
    vecs: np.ndarray
    valid: np.ndarray
    ids: np.ndarray

    @property
    def nbytes(self) -> int:
        return int(self.vecs.nbytes)

    @staticmethod
    def from_rows(rows: list[tuple[int, int, list[float]]]) -> "Centers":
        """From ``(part, center_id, v)`` tuples."""
        if not rows:
            raise ValueError("empty center set")
        by_part: dict[int, list[tuple[int, list[float]]]] = {}
        for part, cid, v in rows:
            by_part.setdefault(int(part), []).append((int(cid), v))
        parts = np.array(sorted(by_part), dtype=np.int64)
        k = max(len(x) for x in by_part.values())
        dims = {len(v) for _, _, v in rows}
        if len(dims) != 1:
            raise ValueError(f"centers of different dimensions: {sorted(dims)}")
        d = dims.pop()
        vecs = np.zeros((len(parts), k, d))
        valid = np.zeros((len(parts), k), dtype=bool)
        ids = np.full((len(parts), k), -1, dtype=np.int32)
        for pi, p in enumerate(parts):
            for j, (cid, v) in enumerate(sorted(by_part[int(p)])):
                vecs[pi, j] = v
                valid[pi, j] = True
                ids[pi, j] = cid
        return Centers(parts, vecs, valid, ids)

    def arrays(self) -> tuple:
        """Plain arrays for a broadcast (broadcasts use plain pickle)."""
        return (self.parts, self.vecs, self.valid, self.ids)

    def slices(self, max_bytes: int) -> list["Centers"]:
        """Cut into tables of at most ``max_bytes`` (one center at least):
        by part while a part fits, else also by position."""
        p, k, d = self.vecs.shape
        cols = min(k, max(1, max_bytes // (d * 8 or 1)))
        rows = max(1, max_bytes // (cols * d * 8 or 1))
        return [Centers(self.parts[i:i + rows], self.vecs[i:i + rows, j:j + cols],
                        self.valid[i:i + rows, j:j + cols], self.ids[i:i + rows, j:j + cols])
                for i in range(0, p, rows) for j in range(0, k, cols)]

    def rows(self) -> list[tuple[int, int, list[float]]]:
        out = []
        for pi, p in enumerate(self.parts):
            for j in range(self.vecs.shape[1]):
                if self.valid[pi, j]:
                    out.append((int(p), int(self.ids[pi, j]), self.vecs[pi, j].tolist()))
        return out


def _center_rows(centers: DataFrame, vec_col: str) -> DataFrame:
    part = F.col("part") if "part" in centers.columns else F.lit(0)
    return centers.select(part.alias("part"), F.col("center_id"), F.col(vec_col).cast("array<double>").alias("v"))


def collect_centers(centers: DataFrame, vec_col: str = "v") -> Centers:
    """Bring a center set that the caller holds in memory (k rows per part of
    a clustering) to the driver; sets of any size go through :func:`assign`."""
    return Centers.from_rows([tuple(r) for r in _center_rows(centers, vec_col).collect()])


def center_slices(centers: "DataFrame | Centers", vec_col: str = "v",
                  max_bytes: int = MAX_CENTER_BYTES) -> Iterator[tuple[Centers, bool]]:
    """``(slice, whether it is the last)``, each of at most about ``max_bytes``.

    A frame is counted first; only one slice of it, picked by a hash of part
    and id, is on the driver at a time.
    """
    if isinstance(centers, Centers):
        cut = centers.slices(max_bytes)
        yield from ((c, i == len(cut) - 1) for i, c in enumerate(cut))
        return
    rows = _center_rows(centers, vec_col)
    n, lo, hi = rows.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
    if not n:
        raise ValueError("empty center set")
    if lo != hi:
        raise ValueError(f"centers of different dimensions: {[lo, hi]}")
    cut = -(-n * hi * 8 // max_bytes)
    if cut <= 1:
        yield from center_slices(collect_centers(centers, vec_col), vec_col, max_bytes)
        return
    of = F.pmod(F.xxhash64("part", "center_id"), F.lit(cut))
    held = None
    for i in range(cut):
        got = [tuple(r) for r in rows.where(of == i).collect()]
        if not got:
            continue
        # A slice padded to its widest part may have to be cut again.
        for c in Centers.from_rows(got).slices(max_bytes):
            if held is not None:
                yield held, False
            held = c
    yield held, True


def centers_frame(spark: SparkSession, c: Centers, with_part: bool = True) -> DataFrame:
    schema = "part int, center_id int, v array<double>"
    df = spark.createDataFrame([(int(p), int(i), v) for p, i, v in c.rows()], schema)
    return df if with_part else df.drop("part")


# ------------------------------------------------------------ Arrow side --

def _matrix(batch: pa.RecordBatch, vec_col: str) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(vec_col))
    n = batch.num_rows
    if n == 0:
        return np.zeros((0, 0))
    if col.null_count:
        raise ValueError("null vector")
    lens = pc.list_value_length(col)
    lo, hi = pc.min_max(lens).values()
    if lo.as_py() != hi.as_py():
        raise ValueError("vectors of different dimensions")
    # Native element type (float32 stays float32): callers widen one row
    # block at a time, see :func:`row_blocks`.
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, hi.as_py())


# Doubles per row block: bounds a Python worker's temporaries (~8 MB) for
# any vector length.
BLOCK_ELEMS = 1 << 20


def row_blocks(n: int, dim: int):
    """Slices of at most ``BLOCK_ELEMS`` doubles' worth of rows."""
    step = max(1, BLOCK_ELEMS // max(1, dim))
    for s in range(0, n, step):
        yield slice(s, min(n, s + step))


def nearest(X: np.ndarray, pidx: np.ndarray, c: Centers) -> tuple[np.ndarray, np.ndarray]:
    """Distance to and position of the nearest valid center of each row's
    part; the first position wins ties, and NaN is worse than any number.

    Works one row block and one center position at a time (rows are
    widened to float64 per block), so memory stays at one block.
    """
    n = X.shape[0]
    best_d = np.full(n, np.inf)
    best_j = np.zeros(n, dtype=np.int32)
    one = len(c.parts) == 1
    for blk in row_blocks(n, X.shape[1] if X.ndim == 2 else 0):
        xb = X[blk].astype(np.float64, copy=False)
        pb = pidx[blk]
        bd, bj = None, np.full(xb.shape[0], -1, dtype=np.int32)
        for j in range(c.vecs.shape[1]):
            diff = xb - (c.vecs[0, j] if one else c.vecs[pb, j])
            d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            valid = c.valid[pb, j]
            if bd is None:
                bd, bj = np.where(valid, d, np.inf), np.where(valid, j, bj)
                continue
            better = valid & ((bj < 0) | (d < bd) | (np.isnan(bd) & ~np.isnan(d)))
            bd = np.where(better, d, bd)
            bj = np.where(better, j, bj)
        best_d[blk] = bd
        best_j[blk] = bj
    return best_d, best_j


def _fold_kernel(bc, vec_col: str, part_col: str | None, first: bool, last: bool):
    """Fold one slice of the centers into the last two columns, ``center_id``
    (null: none met yet) and ``d``, which the first slice adds."""
    def run(batches):
        c = Centers(*bc.value)
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            cols, names = list(b.columns), list(b.schema.names)
            if first:
                cid, d, met = np.zeros(n, np.int32), np.full(n, np.inf), np.zeros(n, bool)
                names += ["center_id", "d"]
            else:
                met = pc.is_valid(cols[-2]).to_numpy(zero_copy_only=False)
                cid = pc.fill_null(cols[-2], 0).to_numpy(zero_copy_only=False)
                d = pc.fill_null(cols[-1], np.inf).to_numpy(zero_copy_only=False)
                cols = cols[:-2]
            X = _matrix(b, vec_col)
            if part_col is None:
                pidx, here = np.zeros(n, np.int64), np.ones(n, bool)
            else:
                p = b.column(b.schema.get_field_index(part_col)).to_numpy(zero_copy_only=False)
                pidx = np.clip(np.searchsorted(c.parts, p), 0, len(c.parts) - 1)
                here = c.parts[pidx] == p
            nd, j = nearest(X, pidx, c)
            nid = c.ids[pidx, j]
            here &= j >= 0
            gap, ngap = np.isnan(d), np.isnan(nd)
            nearer = (nd < d) | (gap & ~ngap) | (((nd == d) | (gap & ngap)) & (nid < cid))
            new = here & (~met | nearer)
            cid, d, met = np.where(new, nid, cid), np.where(new, nd, d), met | here
            if last and not met.all():
                raise ValueError("a point's part has no centers")
            cols += [pa.array(cid, pa.int32(), mask=~met), pa.array(d, pa.float64(), mask=~met)]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


_SUM_NAMES = ["part", "center_id", "sw", "cnt", "sx"]


def _sum_rows(keys, sw, cnt, sx) -> pa.RecordBatch:
    flat = pa.array(sx.reshape(-1))
    offs = pa.array(np.arange(0, sx.size + 1, max(1, sx.shape[1]), dtype=np.int32)[:len(keys) + 1])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[:, 0].astype(np.int32)), pa.array(keys[:, 1].astype(np.int32)), pa.array(sw),
         pa.array(cnt.astype(np.int64)), pa.ListArray.from_arrays(offs, flat)], names=_SUM_NAMES)


def _add(keys, sw, cnt, sx):
    """Sum rows of equal keys."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    return keys[starts], *(np.add.reduceat(x[order], starts, axis=0) for x in (sw, cnt, sx))


def _sums_kernel(fold, vec_col: str, part_col: str | None, w_col: str | None):
    """After the last fold: weight sum, point count and weighted coordinate
    sums, one row per (part, center) and task (more only if a task's sums
    outgrow ``MAX_SUM_BYTES``)."""
    def run(batches):
        held = None
        for b in fold(batches):
            X, n = _matrix(b, vec_col), b.num_rows
            keys = np.zeros((n, 2), np.int64)
            keys[:, 1] = b.column(b.num_columns - 2).to_numpy(zero_copy_only=False)
            if part_col is not None:
                keys[:, 0] = b.column(b.schema.get_field_index(part_col)).to_numpy(zero_copy_only=False)
            w_all = (np.ones(n) if w_col is None else
                     b.column(b.schema.get_field_index(w_col)).to_numpy(zero_copy_only=False)
                     .astype(np.float64))
            for blk in row_blocks(n, X.shape[1]):
                w = w_all[blk]
                new = _add(keys[blk], w, np.ones(len(w), np.int64), X[blk].astype(np.float64) * w[:, None])
                held = new if held is None else _add(*(np.concatenate(x) for x in zip(held, new)))
                if held[3].nbytes > MAX_SUM_BYTES:
                    yield _sum_rows(*held)
                    held = None
        if held is not None:
            yield _sum_rows(*held)
    return run


def _merge_kernel(batches):
    """Add up rows of sums that come sorted by (part, center): the last key of a
    block is held back, as it may go on in the next."""
    held = None
    for b in batches:
        for blk in row_blocks(b.num_rows, len(b.column(4)[0]) if b.num_rows else 1):
            part = b.slice(blk.start, blk.stop - blk.start)
            keys = np.stack([_number(part, c) for c in ("part", "center_id")], axis=1).astype(np.int64)
            new = (keys, _number(part, "sw"), _number(part, "cnt"), _matrix(part, "sx"))
            held = _add(*new) if held is None else _add(*(np.concatenate(x) for x in zip(held, new)))
            if len(held[0]) > 1:
                yield _sum_rows(*(x[:-1] for x in held))
                held = tuple(x[-1:] for x in held)
    if held is not None:
        yield _sum_rows(*held)


def _number(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


_SUMS_SCHEMA = "part int, center_id int, sw double, cnt long, sx array<double>"


def _fold_slices(points: DataFrame, centers: "DataFrame | Centers", part_col: str | None, vec_col: str,
                 max_bytes: int):
    """Fold all slices but the last, each written to the checkpoint folder;
    returns the points so far, the kernel of the last fold and its schema."""
    schema = T.StructType(points.schema.fields + [
        T.StructField("center_id", T.IntegerType()), T.StructField("d", T.DoubleType())])
    first = True
    for c, last in center_slices(centers, vec_col, max_bytes):
        bc = points.sparkSession.sparkContext.broadcast(c.arrays())
        fold = _fold_kernel(bc, vec_col, part_col, first, last)
        if last:
            return points, fold, schema
        points, first = cut_lineage(points.mapInArrow(fold, schema)), False
        bc.destroy()


def assign(points: DataFrame, centers, vec_col: str = "v", by_part: bool | None = None,
           max_bytes: int = MAX_CENTER_BYTES, kernel: str = "arrow") -> DataFrame:
    """V3: add ``center_id`` (nearest center, first wins ties) and ``d``.

    ``centers``: a DataFrame ``[part,] center_id, v`` or a :class:`Centers`.
    ``by_part``: match points to their own part's centers (default: when
    both sides have a ``part`` column). ``kernel="columns"`` uses the
    JVM-only higher-order-function form for one small global center set
    (slower; no Python worker).
    """
    if isinstance(centers, DataFrame):
        if by_part is None:
            by_part = "part" in centers.columns and "part" in points.columns
        if not by_part and "part" in centers.columns:
            centers = centers.drop("part")
    elif by_part is None:
        by_part = "part" in points.columns and len(centers.parts) > 1
    part_col = "part" if by_part else None
    if kernel == "columns":
        c = collect_centers(centers, vec_col) if isinstance(centers, DataFrame) else centers
        if part_col is not None or c.nbytes > max_bytes:
            raise ValueError("the column kernel takes one global center set within the size limit")
        vecs = [c.vecs[0, j].tolist() for j in range(c.vecs.shape[1]) if c.valid[0, j]]
        ids = [int(c.ids[0, j]) for j in range(c.vecs.shape[1]) if c.valid[0, j]]
        best = nearest_center(F.col(vec_col), vecs)
        id_of = F.element_at(F.array(*[F.lit(i) for i in ids]), best["i"] + 1)
        return points.select("*", id_of.cast("int").alias("center_id"), best["d"].alias("d"))
    if kernel != "arrow":
        raise ValueError(f"unknown kernel {kernel!r}")
    points, fold, schema = _fold_slices(points, centers, part_col, vec_col, max_bytes)
    return points.mapInArrow(fold, schema)


def nearest_distance(points: DataFrame, centers, vec_col: str = "v", **kw) -> DataFrame:
    """V2: distance of each point to the nearest center (column ``d``)."""
    return assign(points, centers, vec_col, **kw).drop("center_id")


def cluster_weights(points: DataFrame, centers: DataFrame, vec_col: str = "v",
                    by_part: bool | None = None) -> DataFrame:
    """V4: ``[part,] center_id, n`` -- points nearest to each center; a
    center nobody is nearest to gets 0 (centers left-joined to counts)."""
    if by_part is None:
        by_part = "part" in centers.columns and "part" in points.columns
    keys = ["part", "center_id"] if by_part else ["center_id"]
    counts = (assign(points, centers, vec_col, by_part=by_part)
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    cs = centers.select(*keys)
    return (cs.join(counts, keys, "left")
            .select(*keys, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def avg_distance(points: DataFrame, centers, vec_col: str = "v", **kw) -> DataFrame:
    """V5: one row ``objective`` = mean (unweighted, not squared) distance
    of the points to their nearest center."""
    return assign(points, centers, vec_col, **kw).agg(F.avg("d").alias("objective"))


def center_sums(points: DataFrame, c: "DataFrame | Centers", vec_col: str = "v", w_col: str | None = "w",
                  by_part: bool = True, max_bytes: int = MAX_CENTER_BYTES) -> DataFrame:
    """``part, center_id, sw, cnt, sx``: weight sum, point count and the array of
    weighted coordinate sums of the points nearest to each center. Two levels of
    element-wise sums: each task emits one row per center, and after a shuffle
    of those rows (tasks x centers, whatever the vectors' length) each center's rows
    are added up, one block at a time."""
    part_col = "part" if by_part and "part" in points.columns else None
    need = [vec_col] + [c for c in (part_col, w_col) if c is not None]
    folded, fold, _ = _fold_slices(points.select(*dict.fromkeys(need)), c, part_col, vec_col, max_bytes)
    sums = folded.mapInArrow(_sums_kernel(fold, vec_col, part_col, w_col), _SUMS_SCHEMA)
    return merge_sums(sums)


def merge_sums(sums: DataFrame) -> DataFrame:
    """Partial ``part, center_id, sw, cnt, sx`` rows added up, one row a center."""
    return sums.repartition("part", "center_id").sortWithinPartitions("part", "center_id") \
        .mapInArrow(_merge_kernel, _SUMS_SCHEMA)


def centroid_sums(points: DataFrame, c: "DataFrame | Centers", vec_col: str = "v", w_col: str | None = "w",
                  by_part: bool = True, max_bytes: int = MAX_CENTER_BYTES) -> DataFrame:
    """:func:`center_sums` with one row per coordinate (``pos, sx``)."""
    return center_sums(points, c, vec_col, w_col, by_part, max_bytes) \
        .select("part", "center_id", "sw", "cnt", F.posexplode("sx").alias("pos", "sx"))


def weighted_centroids(points: DataFrame, centers, vec_col: str = "v", w_col: str | None = "w",
                       by_part: bool | None = None) -> DataFrame:
    """V6: ``[part,] center_id, w, v`` -- the weighted centroid sum(w*p)/sum(w)
    of the points nearest to each center (clusters without points are
    absent). One pass; partial sums per task, merged by Spark."""
    if isinstance(centers, DataFrame):
        if by_part is None:
            by_part = "part" in centers.columns and "part" in points.columns
        if not by_part and "part" in centers.columns:
            centers = centers.drop("part")
    else:
        by_part = bool(by_part)
    sums = center_sums(points, centers, vec_col, w_col, by_part)
    sw = F.col("sw")
    out = sums.select("part", "center_id", sw.alias("w"), F.transform("sx", lambda x: x / sw).alias("v"))
    return out if by_part else out.drop("part")
