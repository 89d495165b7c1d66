"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 6).

Fingerprint: words are runs of anything but blank, tab and line ends, with A-Z
lower-cased; the shingles are runs of ``size`` words joined by one blank,
repeats included (a shorter text: all its words; none: zero). A bit is set
when over half of the shingles' XXH64 values (seed 42) have it.

Links: fingerprints that differ in at most two bits. The 64 bits are cut into
segments of 23, 23 and 18 bits. Two differing bits leave one segment equal
(pigeonhole), and the next segment differs in two bits at most. The perfect
Golay code [23, 12, 7] gives a segment the codeword numbers that the
neighbours within one bit decode to: one or six of them. Segments at most two
bits apart share a neighbour, hence a number. So (equal segment, a codeword
number of the next one) is a key that every linked pair shares: at most 18
keys of 30 to 35 bits per fingerprint.

Fingerprints that share a key are joined and verified by their distance.
A key held by more than ``MAX_BUCKET`` fingerprints is not paired: its
fingerprints are linked through midpoints instead. Two fingerprints are at most
two bits apart exactly when some value lies within one bit of both, and at
most 65 distinct fingerprints lie within one bit of any value, so those groups
stay small whatever the bucket held. No link is lost, no bucket is expanded
into all its pairs, and equal fingerprints are one node from the start.

Edge cases: a null or empty text has fingerprint zero and is linked like any
other. Repeated rows and ids stay repeated and share a component. A null id
never names a component, unless no member has an id (then null). An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import LOWER, Stage, blocks, find_words, text_bytes, unused
from roundstats.llm.components import connected_components

SIZE = 3
SEED = 42
MAX_BUCKET = 64

# The Golay code's generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011


# ------------------------------------------------------------- fingerprint --

def shingle_hashes(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a block, and the shingle offsets of its texts."""
    starts, ends, woff = find_words(data, offs)
    lens = ends - starts
    # The words of the block, each followed by one blank.
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lens + 1, out=at[1:])
    out = np.full(int(at[-1]), 32, np.uint8)
    step = np.ones(int(lens.sum()), np.int64)
    if len(step):
        head = np.cumsum(lens)[:-1]
        step[0] = starts[0]
        step[head] = starts[1:] - ends[:-1] + 1
        src = np.cumsum(step)
        step[:] = 1
        step[0] = 0
        step[head] = 2
        out[np.cumsum(step)] = LOWER[data[src]]
    n = np.diff(woff)
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    soff = np.zeros(len(n) + 1, np.int64)
    np.cumsum(per, out=soff[1:])
    first = np.arange(soff[-1]) + np.repeat(woff[:-1] - soff[:-1], per)
    last = np.minimum(first + size, np.repeat(woff[1:], per))
    raw, h = out.tobytes(), xxhash.xxh64_intdigest
    got = [h(raw[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())]
    return np.array(got, np.uint64), soff


def majority_bits(hashes: np.ndarray, soff: np.ndarray, rows: int = 1 << 16) -> np.ndarray:
    """Bits set in over half of each text's hashes, as unsigned 64-bit."""
    n = len(soff) - 1
    counts = np.zeros((n, 64), np.int64)
    owner = np.repeat(np.arange(n), np.diff(soff))
    for a in range(0, len(hashes), rows):
        part, own = hashes[a: a + rows], owner[a: a + rows]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.diff(own, prepend=-1))
        counts[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    on = counts * 2 > np.diff(soff)[:, None]
    return np.packbits(on, axis=1, bitorder="little").view("<u8").reshape(n)


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, fp`` (signed long) of every row of ``docs``."""
    def kernel(batches):
        for b in batches:
            out = [majority_bits(*shingle_hashes(data, offs, size)) for _, _, data, offs in blocks(b.column(1))]
            fp = np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    schema = T.StructType([docs.schema["doc_id"]]).add("fp", "long")
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(kernel, schema)


# -------------------------------------------------------------- Golay keys --

def _remainder(v: int) -> int:
    for shift in range(v.bit_length() - 12, -1, -1):
        if v >> (shift + 11) & 1:
            v ^= GENERATOR << shift
    return v


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits, and the error pattern (weight three at
    most) of each of the 2,048 remainders."""
    upper = np.array([_remainder(v << 11) for v in range(4096)], np.int64)
    error = np.zeros(2048, np.int64)
    bit = [1 << i for i in range(23)]
    for i in range(23):
        for j in range(i, 23):
            for k in range(j, 23):
                e = bit[i] | bit[j] | bit[k]
                error[_remainder(e)] = e
    return upper, error


def codeword_numbers(x: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codeword numbers that 23-bit values within one bit of each
    ``x`` decode to: ``(row, number)`` arrays."""
    upper, error = tables
    near = np.concatenate([x[:, None], x[:, None] ^ (1 << np.arange(23))], axis=1)
    near = near ^ error[upper[near >> 11] ^ (near & 2047)]
    numbers = np.sort(near >> 11, axis=1)
    new = np.ones(numbers.shape, bool)
    new[:, 1:] = numbers[:, 1:] != numbers[:, :-1]
    row, col = np.nonzero(new)
    return row, numbers[row, col]


def fuzzy_keys(fps: DataFrame) -> DataFrame:
    """``key, fp`` for distinct fingerprints ``fp``: one or six per segment."""
    def kernel(batches):
        tables = golay_tables()
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(fp), 1 << 14):
                part = fp[a: a + (1 << 14)]
                u = part.view(np.uint64)
                seg = [(u >> np.uint64(s)).astype(np.int64) & m for s, m in
                       ((0, 0x7FFFFF), (23, 0x7FFFFF), (46, 0x3FFFF))]
                keys, rows = [], []
                for i in range(3):
                    row, number = codeword_numbers(seg[(i + 1) % 3], tables)
                    keys.append((i << 35) | (seg[i][row] << 12) | number)
                    rows.append(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys), pa.int64()), pa.array(part[np.concatenate(rows)], pa.int64())],
                    names=["key", "fp"])

    return fps.select("fp").mapInArrow(kernel, "key long, fp long")


def links(fps: DataFrame, stage: Stage, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges ``u, v`` whose components are those of all pairs of distinct
    fingerprints ``fp`` at most ``max_bits`` (1 or 2) apart."""
    if max_bits not in (1, 2):
        raise ValueError("the Golay keys cover one or two differing bits")
    keys = fuzzy_keys(fps)
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage.write(keys.join(counts, "key"))
    small = shared.where(F.col("n") <= max_bucket).select("key", "fp")
    a, b = small.select("key", F.col("fp").alias("u")), small.select("key", F.col("fp").alias("v"))
    paired = a.join(b, "key").where((F.col("u") < F.col("v"))
                                    & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
    hot = shared.where(F.col("n") > max_bucket).select("fp").distinct()
    if max_bits == 2:
        flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")
                                                for i in range(64)])
        near = hot.select("fp", F.explode(flips).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("mid"))
        met = near.select(F.col("fp").alias("u"), F.min("fp").over(Window.partitionBy("mid")).alias("v"))
    else:
        flips = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
        near = hot.select("fp", F.explode(flips).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("v"))
        met = near.join(hot.select(F.col("fp").alias("v")), "v").select(F.col("fp").alias("u"), "v")
    return paired.select("u", "v").union(met.where("u != v")).distinct()


def _components(fp: DataFrame, first: Column, stage: Stage, max_bits: int, max_bucket: int) -> DataFrame:
    """``fp, first, root`` for every distinct fingerprint of the written table
    ``fp``: the aggregate ``first`` of its rows and its component's name."""
    firsts = stage.write(fp.groupBy("fp").agg(first.alias("first")))
    roots = stage.write(connected_components(links(firsts, stage, max_bits, max_bucket)))
    return firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, size: int = SIZE, max_bits: int = 2,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    stage = Stage(docs.sparkSession, "simhash")
    fp = stage.write(fingerprints(docs, size))
    linked = _components(fp, F.min("doc_id"), stage, max_bits, max_bucket)
    ids = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(ids, "root").select("fp", "component_id")
    return fp.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SIZE, max_bits: int = 2) -> DataFrame:
    """One row of each group of ``docs``, unchanged: that of the least id (a
    row without id only in groups without any), of equal ids that of the least
    hash of the text, then of the whole row. The rows are written with a number
    each, so ids may be null or repeated and equal rows are told apart."""
    stage = Stage(docs.sparkSession, "keep_one")
    fp, row = unused("__fp", docs), unused("__row", docs)
    at = docs.columns.index("text")

    def kernel(batches):
        for b in batches:
            text = b.column(at)
            for i, j, data, offs in blocks(text.fill_null("") if text.null_count else text):
                got = majority_bits(*shingle_hashes(data, offs, size)).view(np.int64)
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(got, pa.int64())],
                                                 names=[*b.schema.names, fp])

    schema = T.StructType(docs.schema.fields + [T.StructField(fp, T.LongType())])
    rows = stage.write(docs.mapInArrow(kernel, schema).withColumn(row, F.monotonically_increasing_id()))
    whole = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    keys = stage.write(rows.select(F.col(fp).alias("fp"), F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("h"), whole.alias("whole"),
        F.col(row).alias("row")).alias("key")))
    linked = _components(keys, F.min("key"), stage, max_bits, MAX_BUCKET)
    kept = linked.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept.hint("shuffle_hash"), row, "left_semi").select(*[f"`{c}`" for c in docs.columns])
