"""Language identification by nearest centroids (operator 9).

Texts become normalised TF-IDF vectors of hashed letter n-grams (lengths 1 to
3 over lower-cased letters, everything else a blank). Each language has
several centroids, found by clustering its training vectors by cosine; a text
takes the language of the centroid with the largest cosine. A text whose
cosine falls below what the training texts of that language and length
showed is rejected (its distance is too large). For lengths that few training
texts have, pieces cut from them and joins of several stand in.

Training reads a bounded sample: at most ``max_train`` texts per language,
those with the smallest hash of (id, text). Everything else covers all rows
and whole texts.

Edge cases: a null or empty text, or one without a letter, has no vector:
``und``, score 0, rejected. Without training rows every text is ``und``.
Equal texts get equal results; repeated rows stay repeated; a null id counts
as ''. Other columns are neither read nor needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import MASK, Stage, blocks, hash_cut, mix, text_bytes

DIMS = 4096
CENTROIDS = 4
MAX_TRAIN = 1500
ROUNDS = 8
LOW = 0.05           # quantile of the training cosines of a language and length
SLACK = 0.65         # share of that quantile below which a text is rejected
LENGTH_BINS = 24     # by log2 of the number of n-grams
BIN_LEAST = 100      # training vectors that set a floor; a thin bin takes the nearest in length
PIECES = 4           # pieces cut from each training text


def letter_table() -> np.ndarray:
    """Which of the first 65,536 code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def gram_counts(texts: list[bytes], table: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Counts of hashed letter n-grams, one row per text."""
    joined = "\0".join(t.decode("utf-8", "replace").replace("\0", " ").lower() for t in texts)
    cp = np.frombuffer(("\0" + joined + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = cp >= 0x10000
    letter = table[np.where(wide, 0, cp)]
    if wide.any():
        far = np.unique(cp[wide])
        letter |= np.isin(cp, far[[chr(c).isalpha() for c in far]])
    row = np.cumsum(cp == 0) - 1
    v = np.where(letter, cp, 0).astype(np.uint64)
    keep = letter.copy()                # letters, and one blank after each word
    keep[1:] |= letter[:-1]
    keep[0] = True
    v, row, letter = v[keep], row[keep], letter[keep]
    i = np.flatnonzero(letter)
    a, b, c = v[i - 1], v[i], v[np.minimum(i + 1, len(v) - 1)]
    one = b
    two = (b << np.uint64(21)) | c | np.uint64(1 << 62)
    three = (a << np.uint64(42)) | (b << np.uint64(21)) | c | np.uint64(1 << 63)
    shift = np.uint64(64 - int(dims).bit_length() + 1)
    cell = (row[i] * dims)
    out = np.zeros(len(texts) * dims, np.int64)
    for g in (one, two, three):
        out += np.bincount(cell + (mix(g) >> shift).astype(np.int64), minlength=len(out))
    return out.reshape(len(texts), dims)


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    np.log1p(x, out=x)
    x *= idf.astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return x


def length_bin(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), LENGTH_BINS - 1)


def cut_pieces(text: bytes, h: int, k: int = PIECES) -> list[bytes]:
    """Pieces of a text, from a word's start on, of lengths spread evenly over
    the powers of two below its own; drawn by the hash ``h``."""
    t, out = text.decode("utf-8", "replace"), []
    for i in range(k):
        a, b, c = (int(v) for v in mix(np.array([h & MASK, (h + i + 1) & MASK, (h ^ ~i) & MASK], np.uint64)) >> np.uint64(11))
        size = int(2.0 ** ((a / 2 ** 53 + i) / k * np.log2(max(len(t), 1))))
        at = t.find(" ", int(b / 2 ** 53 * max(len(t) - size, 0))) + 1
        out.append(t[at: at + size].encode("utf-8", "replace"))
    return out


def joined(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Counts of joins of 2, 4, ... neighbouring texts, up to all of them, one
    level at a time."""
    while len(counts) > 1:
        counts = np.add.reduceat(counts, np.arange(0, len(counts), 2), axis=0, dtype=np.int64)
        yield counts


def length_floors(n: np.ndarray, cos: np.ndarray) -> np.ndarray:
    """Least cosine by length bin: ``SLACK`` of the ``LOW`` quantile of the
    vectors in the bin, or of the ``BIN_LEAST`` nearest to its middle."""
    floor, at = np.zeros(LENGTH_BINS), np.log2(np.maximum(n, 1))
    if not len(n):
        return floor
    bins = length_bin(n)
    for b in range(LENGTH_BINS):
        own = np.flatnonzero(bins == b)
        if len(own) < BIN_LEAST:
            own = np.argsort(np.abs(at - (b + 0.5)), kind="stable")[:BIN_LEAST]
        floor[b] = SLACK * np.quantile(cos[own], LOW)
    return floor


def spherical_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows, by cosine. Starts from the
    mean direction's nearest row, then from rows far from those chosen; the
    farthest ``LOW`` of the rows (junk) start none and count in none."""
    first = int(np.argmax(x @ x.mean(axis=0)))
    picks, best = [first], x @ x[first]
    while len(picks) < min(k, len(x)):
        far = int(np.argsort(best, kind="stable")[int(LOW * len(x))])
        if best[far] > 1 - 1e-9:
            break
        picks.append(far)
        best = np.maximum(best, x @ x[far])
    c = x[picks]
    for _ in range(rounds):
        cos = x @ c.T
        own, best = np.argmax(cos, axis=1), cos.max(axis=1)
        own[best < np.sort(best)[int(LOW * len(x))]] = -1
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


@dataclass
class Centroids:
    """A fitted model; languages x centroids x dims floats, whatever the input."""

    langs: list[str] = field(default_factory=list)
    idf: np.ndarray | None = None
    centers: np.ndarray | None = None      # (m, dims)
    owner: np.ndarray | None = None        # language number of each centroid
    floors: np.ndarray | None = None       # (languages, LENGTH_BINS) least cosine

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number (-1: no vector), cosine and rejection per row."""
        n = counts.sum(axis=1)
        if not self.langs:
            return np.full(len(n), -1), np.zeros(len(n)), np.ones(len(n), bool)
        cos = unit_rows(counts, self.idf) @ self.centers.T
        at = np.argmax(cos, axis=1)
        score = np.clip(cos[np.arange(len(n)), at].astype(np.float64), 0.0, 1.0)
        lang = self.owner[at]
        rejected = (score <= self.floors[lang, length_bin(n)]) | (n == 0)
        return np.where(n > 0, lang, -1), np.where(n > 0, score, 0.0), rejected


def _sparse(counts: np.ndarray) -> list[bytes]:
    out = []
    for r in counts:
        i = np.flatnonzero(r)
        out.append(i.astype("<u4").tobytes() + r[i].astype("<u4").tobytes())
    return out


def _dense(rows, dims: int = DIMS) -> np.ndarray:
    """Counts from an Arrow array of :func:`_sparse` rows, one at a time."""
    out = np.zeros((len(rows), dims), np.uint32)
    for k, b in enumerate(rows):
        v = np.frombuffer(b.as_buffer(), "<u4")
        out[k, v[: len(v) // 2]] = v[len(v) // 2:]
    return out


def _block_texts(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offs[:-1], offs[1:])]


def fit(docs: DataFrame, label: str = "lang", max_train: int = MAX_TRAIN,
        centroids: int = CENTROIDS) -> Centroids:
    """Fit on rows of ``docs`` (doc_id, text, label) that have a label: at most
    ``max_train`` different texts per language. Two small jobs run on the sample's vectors."""
    spark = docs.sparkSession
    stage = Stage(spark, "langid")
    order = F.xxhash64("text")       # copies of a text are one training text
    rows = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull())
    counts = rows.select(label, order.alias("h")).distinct().groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return Centroids()
    # Rows whose hash lies in the lowest share of the range that holds about
    # 1.5 samples' worth: a filter in the scan, so that only a sample moves.
    cut = F.lit(None).cast("long")
    for r in counts:
        cut = F.when(F.col(label) == r[0], hash_cut(r["n"], max_train)).otherwise(cut)
    near = rows.select(F.col(label).cast("string").alias("lang"), order.alias("h"),
                       text_bytes().alias("text")).where(F.col("h") <= cut)

    def vectors(batches):
        table, met = letter_table(), set()     # of at most a sample's texts
        for b in batches:
            fresh = []
            for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fresh.append(pair not in met)
                met.add(pair)
            b = b.filter(pa.array(fresh, pa.bool_()))
            for i, j, data, offs in blocks(b.column(2)):
                texts = _block_texts(data, offs)
                c = gram_counts(texts, table)
                has = np.flatnonzero(c.sum(axis=1) > 0)
                h = b.column(1).slice(i, j - i).take(has)
                cuts = [_sparse(gram_counts(cut_pieces(texts[r], v), table)) for r, v in zip(has, h.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).take(has), h, pa.array(_sparse(c[has]), pa.binary()),
                     pa.array(cuts, pa.list_(pa.binary()))], names=["lang", "h", "vec", "cuts"])

    schema = "lang string, h long, vec binary, cuts array<binary>"
    w = Window.partitionBy("lang").orderBy("h", "vec")
    sample = stage.write(near.select("lang", "h", "text").mapInArrow(vectors, schema)
                         .withColumn("new", ~F.col("h").eqNullSafe(F.lag("h").over(w)))
                         .withColumn("rn", F.sum(F.col("new").cast("int")).over(w))
                         .where(F.col("new") & (F.col("rn") <= max_train)).drop("new", "rn"))

    def seen(batches):
        total, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for v in b.column(2).to_pylist():
                v = np.frombuffer(v, "<u4")
                total[v[: len(v) // 2]] += 1
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(DIMS), -1), pa.int64()), pa.array(np.append(total, n), pa.int64())],
            names=["dim", "n"])

    df = dict(sample.mapInArrow(seen, "dim long, n long").groupBy("dim").agg(F.sum("n")).collect())
    total = df.pop(-1, 0)
    if not total:
        return Centroids()
    idf = np.log((1.0 + total) / (1.0 + np.array([df[i] for i in range(DIMS)]))) + 1.0

    def cluster(t: pa.Table) -> pa.Table:
        t = t.take(np.argsort(t.column("h").to_numpy(), kind="stable"))     # one row a hash
        c = _dense(t.column("vec"))
        x = unit_rows(c, idf)
        m = spherical_means(x, centroids)
        n, cos = [c.sum(axis=1, dtype=np.int64)], [(x @ m.T).max(axis=1)]
        del x
        cuts = pc.list_flatten(t.column("cuts"))
        cuts = cuts.filter(pc.greater(pc.binary_length(cuts), 0))
        for d in chain((_dense(cuts[a: a + 512]) for a in range(0, len(cuts), 512)), joined(c)):
            n.append(d.sum(axis=1, dtype=np.int64)), cos.append((unit_rows(d, idf) @ m.T).max(axis=1))
        floor = length_floors(np.concatenate(n), np.concatenate(cos))
        return pa.table({"lang": pa.array([t.column("lang")[0].as_py()], pa.string()),
                         "centers": pa.array([m.astype("<f4").tobytes()], pa.binary()),
                         "floor": pa.array([floor.astype("<f8").tobytes()], pa.binary())})

    fitted = sorted(sample.groupBy("lang").applyInArrow(cluster, "lang string, centers binary, floor binary")
                    .collect(), key=lambda r: r["lang"])
    stage.drop(sample)
    mats = [np.frombuffer(r["centers"], "<f4").reshape(-1, DIMS) for r in fitted]
    return Centroids([r["lang"] for r in fitted], idf, np.concatenate(mats),
                     np.repeat(np.arange(len(mats)), [len(m) for m in mats]),
                     np.stack([np.frombuffer(r["floor"], "<f8") for r in fitted]))


def _predict_blocks(model: Centroids, table: np.ndarray, text) -> Iterator[tuple]:
    """``(first row, end row, language names, scores, rejections)`` of each block."""
    for i, j, data, offs in blocks(text.fill_null("") if text.null_count else text):
        lang, score, rejected = model.predict(gram_counts(_block_texts(data, offs), table))
        yield i, j, [model.langs[v] if v >= 0 else "und" for v in lang], score, rejected


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``."""
    def kernel(batches):
        table = letter_table()
        for b in batches:
            for i, j, names, score, rejected in _predict_blocks(model, table, b.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                     pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    schema = T.StructType([docs.schema["doc_id"]]).add("lang_pred", "string").add("score", "double") \
        .add("rejected", "boolean")
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(kernel, schema)


def keep_identified(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text is not rejected."""
    at = docs.columns.index("text")

    def kernel(batches):
        table = letter_table()
        for b in batches:
            for i, j, _, _, rejected in _predict_blocks(model, table, b.column(at)):
                yield b.slice(i, j - i).filter(pa.array(~rejected, pa.bool_()))

    return docs.mapInArrow(kernel, docs.schema)
