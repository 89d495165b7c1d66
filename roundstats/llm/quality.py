"""Quality classifier: a factorisation machine (operator 7).

Inputs of a score are the text's hashed words (logarithms of counts, unit
length) and its structure statistics; with ``metadata`` also numeric columns of
the table. The machine adds to a linear score the weight <v_i, v_j> of every
pair of inputs, of low rank ``RANK``, and gets the sum over all pairs in linear
time as half of (sum of v_i x_i)^2 - sum of (v_i x_i)^2, per factor.

Training (logistic loss, Adam, fixed order) reads a bounded sample of
``max_train`` labelled rows, in one task; scoring covers every whole text.

Edge cases: a null text is empty and scores as an empty text does; null or
non-finite metadata count as 0; labels other than 0 and 1 or without an id are
left out; an id labelled twice takes its largest label; without any training
row every score is 0.5 (predicted 0). Repeated rows stay repeated, equal rows
score alike. Other columns are neither read nor needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import blocks, text_bytes
from roundstats.llm.features import STATS, TextBlock, labelled_sample

DIMS = 4096
RANK = 8
MAX_TRAIN = 8192
STEPS = 600
BATCH = 256
RATE = 0.02
DECAY = 1e-3
SEED = 11


def word_counts(t: TextBlock) -> np.ndarray:
    cell = t.row * DIMS + (t.hashes >> np.uint64(52)).astype(np.int64)
    return np.bincount(cell, minlength=len(t.n_words) * DIMS).reshape(-1, DIMS)


class Machine:
    """Weights of a factorisation machine; their size does not depend on the input."""

    def __init__(self, mean, std, bias, linear, factors):
        self.mean, self.std, self.bias, self.linear, self.factors = mean, std, bias, linear, factors

    def inputs(self, counts: np.ndarray, dense: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32))
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        z = np.clip((dense - self.mean) / self.std, -4, 4).astype(np.float32)
        return np.concatenate([x, z], axis=1)

    def margin(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic, and the factor sums."""
        s = x @ self.factors
        pairs = 0.5 * (s * s - (x * x) @ (self.factors * self.factors)).sum(axis=1)
        return self.bias + x @ self.linear + pairs, s

    def score(self, x: np.ndarray) -> np.ndarray:
        m = np.clip(self.margin(x)[0].astype(np.float64), -30, 30)
        return 1.0 / (1.0 + np.exp(-m))


def train(rows: list[tuple[np.ndarray, np.ndarray]], dense: np.ndarray, y: np.ndarray) -> Machine:
    """Fit by Adam over batches in a fixed shuffled order. ``rows``: sparse
    counts (positions, values); ``dense``: structure and metadata."""
    rng = np.random.default_rng(SEED)
    n_in = DIMS + dense.shape[1]
    m = Machine(dense.mean(axis=0), dense.std(axis=0) + 1e-6, np.zeros(1, np.float32),
                np.zeros(n_in, np.float32), (rng.standard_normal((n_in, RANK)) * 0.01).astype(np.float32))
    params = [m.bias, m.linear, m.factors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    while step < STEPS:
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            pick = order[a: a + BATCH]
            counts = np.zeros((len(pick), DIMS))
            for k, i in enumerate(pick):
                counts[k, rows[i][0]] = rows[i][1]
            x = m.inputs(counts, dense[pick])
            margin, s = m.margin(x)
            g = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[pick]) / len(pick)).astype(np.float32)
            grads = [g.sum(keepdims=True), x.T @ g + DECAY * m.linear,
                     x.T @ (g[:, None] * s) - ((x * x).T @ g)[:, None] * m.factors + DECAY * m.factors]
            step += 1
            for p, f, q, d in zip(params, first, second, grads):
                f += 0.1 * (d - f)
                q += 0.001 * (d * d - q)
                p -= RATE * (f / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.999 ** step)) + 1e-8)
    return m


def _metadata(names: tuple[str, ...]) -> tuple:
    """Numeric columns as log(1 + size), 0 where there is no finite number."""
    value = [F.abs(F.col(c).cast("double")) for c in names]
    return tuple(F.coalesce(F.when(v < 1e300, F.log1p(v)), F.lit(0.0)) for v in value)


def _dense(t: TextBlock, meta: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([t.stats(), *(m[:, None] for m in meta)], axis=1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN,
        metadata: tuple[str, ...] = ()) -> Machine | None:
    """Fit on ``labels`` (doc_id, label) joined to the texts; None without rows."""
    sample = labelled_sample(docs, labels, F.when(F.col(label).isin(0, 1), F.col(label).cast("int")), max_train,
                             _metadata(metadata))
    width = STATS + len(metadata)

    def vectors(batches):
        for b in batches:
            meta = [c.to_numpy(zero_copy_only=False) for c in b.columns[3:]]
            for i, j, data, offs in blocks(b.column(2)):
                t = TextBlock(data, offs)
                out = []
                for c, d in zip(word_counts(t), _dense(t, [m[i:j] for m in meta])):
                    k = np.flatnonzero(c)
                    out.append(d.astype("<f8").tobytes() + k.astype("<u2").tobytes() + c[k].astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                                                  pa.array(out, pa.binary())], names=["h", "label", "vec"])

    # One task learns from at most max_train sparse rows.
    bounded = sample.mapInArrow(vectors, "h long, label int, vec binary").orderBy("h", "vec").limit(max_train)

    def learn(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("vec", "ascending")])
        dense, rows = [], []
        for v in t.column("vec").to_pylist():
            dense.append(np.frombuffer(v, "<f8", width))
            k = (len(v) - 8 * width) // 6
            rows.append((np.frombuffer(v, "<u2", k, 8 * width), np.frombuffer(v, "<u4", k, 8 * width + 2 * k)))
        m = train(rows, np.stack(dense), t.column("label").to_numpy())
        parts = [m.mean, m.std, m.bias, m.linear, m.factors]
        return pa.table({"part": pa.array([np.asarray(p, "<f8").tobytes() for p in parts], pa.binary()),
                         "at": pa.array(range(len(parts)), pa.int32())})

    got = bounded.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(learn, "part binary, at int").collect()
    if not got:
        return None
    mean, std, bias, linear, factors = (np.frombuffer(r["part"], "<f8") for r in sorted(got, key=lambda r: r["at"]))
    return Machine(mean, std, bias.astype(np.float32), linear.astype(np.float32),
                   factors.reshape(-1, RANK).astype(np.float32))


def score(docs: DataFrame, machine: Machine | None, metadata: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (``metadata`` as in the fit)."""
    def kernel(batches):
        for b in batches:
            out = [np.zeros(0)]
            meta = [c.to_numpy(zero_copy_only=False) for c in b.columns[2:]]
            for i, j, data, offs in blocks(b.column(1)):
                if machine is None:
                    out.append(np.full(j - i, 0.5))
                    continue
                t = TextBlock(data, offs)
                out.append(machine.score(machine.inputs(word_counts(t), _dense(t, [m[i:j] for m in meta]))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out), pa.float64())],
                                             names=["doc_id", "score"])

    more = [c.alias(f"more{i}") for i, c in enumerate(_metadata(metadata))]
    schema = T.StructType([docs.schema["doc_id"]]).add("score", "double")
    return docs.select("doc_id", text_bytes().alias("text"), *more).mapInArrow(kernel, schema)
