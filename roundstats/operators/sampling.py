"""Seeded sampling over points (M1-M3).

Randomness is a pure function of (seed, step, id) -- see
:func:`roundstats.functions.uniform` -- so a draw does not depend on
partition layout, AQE or task retries, and SQL can reproduce it.
A pick is one ``min_by`` aggregate: every task keeps its best candidate,
the driver receives one row per part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.functions.columns import uniform
from roundstats.operators.vectors import _matrix, row_blocks


def _key_cols(by_part: bool) -> list[str]:
    return ["part"] if by_part else []


def _best(df: DataFrame, order: Column, by_part: bool, cond: Column | None = None,
          cols: tuple[str, ...] = ("id", "v")) -> DataFrame:
    row = F.struct(*[F.col(c) for c in cols])
    if cond is not None:
        row, order = F.when(cond, row), F.when(cond, order)
    agg = F.min_by(row, order).alias("pick")
    g = df.groupBy(*_key_cols(by_part)) if by_part else df.groupBy()
    out = g.agg(agg)
    return out.where(F.col("pick").isNotNull()).select(*_key_cols(by_part), "pick.*")


def pick_uniform(points: DataFrame, seed: int, step: int = 0, by_part: bool = False) -> DataFrame:
    """M1: one point per part, uniformly (weights ignored): the smallest
    draw u(seed, step, id), ties by id."""
    order = F.struct(uniform(seed, step, "id").alias("u"), F.col("id"))
    return _best(points, order, by_part)


def race_key(weight: Column, seed: int, step: int) -> Column:
    """Exponential race: the smallest ``-ln(u) / weight`` is drawn with
    probability proportional to weight (Efraimidis & Spirakis, 2006) -- a
    weighted draw in one aggregate, no cumulative sums."""
    return -F.log(uniform(seed, step, "id")) / weight


def pick_weighted(points: DataFrame, weight, seed: int, step: int = 1,
                  by_part: bool = False) -> DataFrame:
    """M2: one point per part with probability proportional to ``weight``
    (rows with weight <= 0 never win)."""
    w = F.col(weight) if isinstance(weight, str) else weight
    order = F.struct(race_key(w, seed, step).alias("key"), F.col("id"))
    return _best(points, order, by_part, cond=w > 0)


# ------------------------------------------------------ running nearest --

def _center_table(rows: list[tuple[int, int, list[float]]]):
    """(parts, vecs (P, R, D), valid (P, R)) from (part, id, v) rows."""
    by_part: dict[int, list[list[float]]] = {}
    for p, _, v in sorted(rows):
        by_part.setdefault(int(p), []).append(v)
    parts = np.array(sorted(by_part), dtype=np.int64)
    r = max((len(x) for x in by_part.values()), default=0)
    d = len(rows[0][2]) if rows else 0
    vecs = np.zeros((len(parts), r, d))
    valid = np.zeros((len(parts), r), dtype=bool)
    for i, p in enumerate(parts):
        for j, v in enumerate(by_part[int(p)]):
            vecs[i, j] = v
            valid[i, j] = True
    return parts, vecs, valid


def _min_distance(X, p, parts, vecs, valid, d_old):
    """min(d_old, distance to every valid center of the row's part)."""
    d = d_old.astype(np.float64, copy=True)
    if not len(parts):
        return d
    pidx = np.clip(np.searchsorted(parts, p), 0, len(parts) - 1)
    has = parts[pidx] == p
    for blk in row_blocks(X.shape[0], X.shape[1]):
        xb = X[blk].astype(np.float64, copy=False)
        pb, hb, db = pidx[blk], has[blk], d[blk]
        for j in range(vecs.shape[1]):
            diff = xb - vecs[pb, j]
            dn = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            db = np.where(hb & valid[pb, j], np.minimum(db, dn), db)
        d[blk] = db
    return d


def _col(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _fold_kernel(bc, d_col: str):
    def run(batches):
        parts, vecs, valid = bc.value
        for b in batches:
            if b.num_rows == 0:
                continue
            d = _min_distance(_matrix(b, "v"), _col(b, "part"), parts, vecs, valid, _col(b, d_col))
            cols = list(b.columns)
            cols[b.schema.get_field_index(d_col)] = pa.array(d, pa.float64())
            yield pa.RecordBatch.from_arrays(cols, names=list(b.schema.names))
    return run


def start_nearest(points: DataFrame, d_col: str = "d") -> DataFrame:
    """State for M3: points ``part, id, v, w`` plus ``d`` = +inf (no center yet)."""
    return points.withColumn(d_col, F.lit(float("inf")).cast("double"))


def update_nearest(state: DataFrame, newest: list[tuple[int, int, list[float]]],
                   d_col: str = "d") -> DataFrame:
    """M3: ``d = min(d, distance to the new centers of the point's part)``.

    ``newest`` holds ``(part, id, v)`` rows (a few per part): broadcast,
    bounded by parts x rows x dims. Rows keep all their columns.
    """
    bc = state.sparkSession.sparkContext.broadcast(_center_table(newest))
    return state.mapInArrow(_fold_kernel(bc, d_col), T.StructType(list(state.schema.fields)))


def _first_of_part(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The smallest (key, id) of each part and kind."""
    part, kind = _col(rows, "part"), _col(rows, "kind")
    order = np.lexsort((_col(rows, "id"), _col(rows, "key"), kind, part))
    p, k = part[order], kind[order]
    return rows.take(pa.array(order[np.r_[True, (p[1:] != p[:-1]) | (k[1:] != k[:-1])]]))


def _draw_kernel(bc, d_col: str):
    """Per task and part: the best race candidate (smallest -ln(u)/(w*d)
    among unchosen rows with w*d > 0) and the best fallback (smallest u
    among unchosen rows), ties by id -- at most two rows per part leave."""
    def run(batches):
        parts, vecs, valid, chosen = bc.value
        pairs, chosen_ids = set(chosen), np.array([i for _, i in chosen], dtype=np.int64)
        held = None
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = _col(b, "id")
            part = _col(b, "part")
            d = _min_distance(_matrix(b, "v"), part, parts, vecs, valid, _col(b, d_col))
            wd = _col(b, "w").astype(np.float64) * d
            u = _col(b, "u")
            free = ~np.isin(ids, chosen_ids)
            for i in np.flatnonzero(~free):
                free[i] = (int(part[i]), int(ids[i])) not in pairs
            with np.errstate(divide="ignore", invalid="ignore"):
                race = np.where(free & (wd > 0), -np.log(u) / wd, np.inf)
            for kind, key in ((0, race), (1, np.where(free, u, np.inf))):
                ok = np.flatnonzero(np.isfinite(key))
                if not len(ok):
                    continue
                order = ok[np.lexsort((ids[ok], key[ok], part[ok]))]
                sel = order[np.unique(part[order], return_index=True)[1]]
                new = pa.RecordBatch.from_arrays(
                    [pa.array(part[sel].astype(np.int32)), pa.array(np.full(len(sel), kind, np.int8)),
                     pa.array(key[sel], pa.float64()), pa.array(ids[sel], pa.int64()),
                     b.column(b.schema.get_field_index("v")).take(pa.array(sel))],
                    names=["part", "kind", "key", "id", "v"])
                held = new if held is None else _first_of_part(pa.concat_batches([held, new]))
        if held is not None:
            yield held
    return run


def draw_next(state: DataFrame, recent: list[tuple[int, int, list[float]]],
              chosen: list[tuple[int, int]], seed: int, step: int, d_col: str = "d") -> DataFrame:
    """M2 + M3 in one pass: ``part, id, v`` of the next center of each part.

    The nearest distance is ``min(d, distance to the recent centers)``; the
    draw is the exponential race on ``w * d`` with u(seed, step, id) (computed
    by the JVM), or -- when every remaining ``w * d`` is 0 -- the remaining
    point with the smallest u. ``chosen`` holds ``(part, id)`` pairs: ids may
    repeat between parts. The kernel sends at most two candidates per part and
    task; one ``min_by`` aggregate picks the winners.
    """
    table = _center_table(recent) + (chosen,)
    bc = state.sparkSession.sparkContext.broadcast(table)
    vtype = state.schema["v"].dataType.simpleString()
    cands = (state.select("part", "id", "v", "w", d_col, uniform(seed, step, "id").alias("u"))
             .mapInArrow(_draw_kernel(bc, d_col),
                         f"part int, kind tinyint, key double, id long, v {vtype}"))
    return winners(cands)


def winners(cands: DataFrame) -> DataFrame:
    """``part, id, v`` of the best candidate of each part, from rows
    ``part, kind, key, id, v``: kind 0 runs the race, kind 1 stands in."""
    row, order = F.struct("id", "v"), F.struct("key", "id")
    race, rest = F.col("kind") == 0, F.col("kind") == 1
    return (cands.groupBy("part")
            .agg(F.min_by(F.when(race, row), F.when(race, order)).alias("race"),
                 F.min_by(F.when(rest, row), F.when(rest, order)).alias("rest"))
            .select("part", F.coalesce("race", "rest").alias("pick"))
            .where(F.col("pick").isNotNull())
            .select("part", "pick.id", "pick.v"))
