"""Near-duplicates by SetSketch registers (operator 11).

Words are runs of anything but blank, tab and line ends, with A-Z lower-cased;
a document's set holds its distinct shingles of ``size`` words (a shorter text:
its words as one; none: empty, linked with nothing). Documents link when
100 * shared >= percent * union. Shingles are 64-bit hashes.

A SetSketch register is the exponentially spaced, truncated minimum of one
hash over the set: ``floor(1 - log_b h)``, ``h`` exponential of rate ``a``, cut
to 0 .. q + 1. Registers of a union are the greater of both, so sketches
merge; equal registers are about as likely as the Jaccard likeness J is
large: the base is near 1, so that unlike sets hardly ever agree by chance
(a base of 1.05 has a 1.2% chance a register, so that keys shared by chance grow as
the square of the documents; 1.001 has 0.025%). 32 bands of four registers are the keys that candidates share: a pair at
J = 0.8 shares none with probability 5e-8, a pair at 0.85 with 2e-10. A key of more than
``MAX_BUCKET`` sets says little; its sets get 64 longer keys of eight registers
instead, which sets that merely share a passage seldom have in common.

Candidates of a key are not paired with each other. A set proposes at most
``PROPOSALS`` pairs: with the most central sets of its keys (those whose keys are met
most). So a group of n copies costs a few comparisons a member, and its members meet at
the text they derive from. Links lead to more central sets; followed ``HOPS`` times, twice
as far each time, they name a set's group. What is left are keys with sets of several
groups. There the sets outside the key's largest group are searched for links exactly, by
their rarest shingles: two sets of sizes m and n link only with t = ceil(80 (m + n) / 180)
shingles in common, so one of any m - t + 1 shingles of the first is in the second
(by classes of the second's size, 2% wide). Shingles of edits are rare, so sets
that differ too much from all others meet none. No link between groups is lost; the
components are those of both kinds of links.

A comparison is first estimated: the counts of greater, less and equal registers
and both set sizes give J's likelihood (Ertl, SetSketch, 2021); pairs for which
J >= 0.8 is less likely than the best fit by e^18 are let go (six standard
deviations). The others are verified on their whole sets.

Equal sets are one node from the start, met by partial aggregates. Joins to
keys and pivots that very many rows share are salted.

Edge cases: a null or empty text, or one of blanks, has the empty set: it is its own
component. Repeated rows and ids stay repeated and share a component. A
null id never names a component, unless no member has an id (then null, and
``kept``). An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import WORD_MULT, Stage, _ranges_hash, blocks, find_words, mix, text_bytes, word_hashes
from roundstats.llm.components import connected_components

SIZE = 4
PERCENT = 80
REGISTERS = 128
BAND = 4              # registers a key
LONG_BAND, LONG_KEYS = 8, 64
MAX_BUCKET = 64
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2     # b, a and q of the sketch
SLACK = 18.0          # log-likelihood by which a pair may miss the threshold
SALTS = 8
PROPOSALS = 3         # of a set, before the rest is searched
HOPS = 2
WIDTH = 1.02          # ratio of a size class
PARITY_BITS = 1024
CHUNK = 1 << 14       # hashes that a register's minimum is taken of at a time


# -------------------------------------------------------------- the sketch --

def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block's texts, sorted within a text, and
    their offsets by text."""
    starts, ends, woff = find_words(data, offs)
    words = word_hashes(data, starts, ends)
    n = np.diff(woff)
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), per)
    soff = np.concatenate([[0], np.cumsum(per)])
    first = np.arange(soff[-1]) - np.repeat(soff[:-1] - woff[:-1], per)
    last = np.minimum(first + size, np.repeat(woff[1:], per))
    h = mix(_ranges_hash(words, first, last, WORD_MULT)) if len(first) else np.zeros(0, np.uint64)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(len(n) + 1))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return raw[:n], raw[n:] | np.uint64(1)


def minima(hashes: np.ndarray, soff: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """(texts, registers): the least of each register's hash over each set, all
    ones for an empty one. Minima of parts of a set merge by ``np.minimum``."""
    xor, mult = _seeds(registers)
    out = np.full((len(soff) - 1, registers), ~np.uint64(0))
    owner = np.repeat(np.arange(len(soff) - 1), np.diff(soff))
    for a in range(0, len(hashes), CHUNK):
        part, own = hashes[a: a + CHUNK], owner[a: a + CHUNK]
        cut = np.flatnonzero(np.diff(own, prepend=-1))
        rows = own[cut]
        for j in range(registers):
            v = (part ^ xor[j]) * mult[j]
            v ^= v >> np.uint64(32)
            v *= mult[j]
            out[rows, j] = np.minimum(out[rows, j], np.minimum.reduceat(v, cut))
    return out


def register_values(least: np.ndarray) -> np.ndarray:
    """SetSketch registers of least hashes: their exponential, on the scale of
    powers of ``BASE``, truncated."""
    h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 64 * (1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def parities(hashes: np.ndarray, soff: np.ndarray, bits: int = PARITY_BITS) -> np.ndarray:
    """(texts, bits / 8): whether an odd number of a set's hashes fall on a bit.
    Two sets differ in at least as many shingles as these differ in bits."""
    out = np.zeros((len(soff) - 1, bits), np.uint8)
    owner = np.repeat(np.arange(len(soff) - 1), np.diff(soff))
    np.bitwise_xor.at(out, (owner, (hashes % np.uint64(bits)).astype(np.int64)), 1)
    return np.packbits(out, axis=1)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets (or of many: arrays of sketches)."""
    return np.maximum(a, b)


def likeness(greater: np.ndarray, less: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
             at: float, steps: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Most likely Jaccard likeness of pairs of sets of known sizes, and the
    log-likelihood by which ``at`` falls short of it (0 or more)."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.concatenate([np.linspace(0, 1, steps)[None, :] * most[:, None], np.minimum(at, most)[:, None]], axis=1)

    def step(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = step(u[:, None] - v[:, None] * grid), step(v[:, None] - u[:, None] * grid)
    tiny = 1e-12
    log = (greater[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny)
           + equal[:, None] * np.log(np.maximum(1 - up - down, 0) + tiny))
    best = log.argmax(axis=1)
    rows = np.arange(len(u))
    return grid[rows, best], log[rows, best] - log[:, -1]


# ------------------------------------------------------------- the kernels --

def sketches(rows: DataFrame, size: int = SIZE, registers: int = REGISTERS, sets: bool = True) -> DataFrame:
    """Every row of ``rows`` (the last column is the text) without its text but
    with ``n, h1, h2, sketch``: the size of its set, two hashes that equal sets share,
    registers (bytes, two each); if asked for, also ``parity`` and the set, ``shingles``."""
    keep = rows.columns[:-1]
    schema = T.StructType([rows.schema[c] for c in keep]).add("n", "long").add("h1", "long").add("h2", "long") \
        .add("sketch", "binary")
    if sets:
        schema = schema.add("parity", "binary").add("shingles", T.ArrayType(T.LongType()))

    def kernel(batches):
        for b in batches:
            for i, j, data, offs in blocks(b.column(len(keep))):
                h, soff = shingle_sets(data, offs, size)
                n = np.diff(soff)
                some = n > 0
                sums = np.zeros((2, j - i), np.uint64)
                if len(h):
                    for k, c in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                        sums[k, some] = np.add.reduceat(mix(h ^ np.uint64(c)), soff[:-1][some])
                values = register_values(minima(h, soff, registers))
                cols = [*(b.column(c).slice(i, j - i) for c in range(len(keep))), pa.array(n, pa.int64()),
                        pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                        pa.array([v.tobytes() for v in values], pa.binary())]
                if sets:
                    cols.append(pa.array([v.tobytes() for v in parities(h, soff)], pa.binary()))
                    cols.append(pa.ListArray.from_arrays(pa.array(soff.astype(np.int32)), pa.array(h.view(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return rows.mapInArrow(kernel, schema)


def _registers(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(len(col), -1)


def band_keys(own: DataFrame, groups: np.ndarray) -> DataFrame:
    """``key, node``: a hash of the registers of each group (rows of
    ``groups``: register numbers) for every ``node, sketch``."""
    def kernel(batches):
        salt = mix(np.arange(1, len(groups) + 1, dtype=np.uint64) * np.uint64(len(groups[0])))
        for b in batches:
            for a in range(0, b.num_rows, 1 << 10):
                part = b.slice(a, 1 << 10)
                values = _registers(part.column(1)).astype(np.uint64)
                key = np.tile(salt, (len(values), 1))
                for c in range(groups.shape[1]):
                    key = mix(key * np.uint64(WORD_MULT) + values[:, groups[:, c]])
                node = np.repeat(part.column(0).to_numpy(zero_copy_only=False), len(groups))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64).reshape(-1)), pa.array(node, pa.int64())], names=["key", "node"])

    return own.select("node", "sketch").mapInArrow(kernel, "key long, node long")


def _judged(pairs: DataFrame, percent: int, by: str) -> DataFrame:
    """The ``a, b`` of ``a, b, n_a, x, n_b, y`` that may link, as the registers'
    likelihood (``by`` = "sketch") or the parities' exact bound has it."""
    def kernel(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1 << 10):
                p = b.slice(i, 1 << 10)
                n_a, n_b = (p.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 4))
                if by == "sketch":
                    x, y = _registers(p.column(3)), _registers(p.column(5))
                    est, short = likeness((x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1), n_a, n_b, percent / 100)
                    keep = (est >= percent / 100) | (short <= SLACK)
                else:
                    x, y = (np.frombuffer(b"".join(p.column(c).to_pylist()), np.uint64).reshape(len(p), -1) for c in (3, 5))
                    common = -(-(n_a + n_b) * percent // (100 + percent))
                    keep = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= n_a + n_b - 2 * common
                yield pa.RecordBatch.from_arrays([p.column(0).filter(pa.array(keep)), p.column(1).filter(pa.array(keep))], names=["a", "b"])

    return pairs.select("a", "b", "n_a", "x", "n_b", "y").mapInArrow(kernel, "a long, b long")


# ----------------------------------------------------------------- linking --

def _copies(one: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every row once for each ``salt``."""
    return one.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))


def _salted(left: DataFrame, right: DataFrame, on: str, by: str, salts: int = SALTS) -> DataFrame:
    """Join where ``right`` has one row for a key and ``left`` may have very
    many: they are spread over ``salts`` copies of the key by the column ``by``."""
    many = left.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    return many.join(_copies(right, salts), [on, "salt"]).drop("salt")


def _shared(keys: DataFrame) -> DataFrame:
    """``key, node, size`` of the keys that several nodes have."""
    own = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return _salted(keys, own, "key", "node")


def _verify(pairs: DataFrame, own: DataFrame, percent: int, stage: Stage, by: str = "sketch") -> DataFrame:
    """The linked ones of distinct ``pairs`` (``a, b``; very many may share an ``a``)."""
    some = own.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    first = some.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col(by).alias("x"))
    second = own.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col(by).alias("y"))
    sized = _salted(pairs.join(second, "b"), first, "a", "b") \
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    likely = stage.write(_judged(sized, percent, by))
    one = own.select(F.col("node").alias("a"), F.col("shingles").alias("x")) \
        .join(likely.select("a").distinct(), "a", "left_semi")
    two = own.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    checked = _salted(likely.join(two, "b"), one, "a", "b") \
        .where(both * 100 >= (F.size("x") + F.size("y") - both) * percent)
    return checked.select("a", "b")


def _split(members: DataFrame, links: DataFrame, stage: Stage) -> DataFrame:
    """``node, root, minor`` of the ``members`` (``key, node``) of keys that hold several
    groups: the set that names its group, and whether it is outside the largest of a key."""
    up = links.groupBy("b").agg(F.max("a").alias("a"))
    for _ in range(HOPS):
        further = up.select(F.col("b").alias("a"), F.col("a").alias("end"))
        up = up.join(further, "a", "left").select("b", F.coalesce("end", "a").alias("a"))
    named = stage.write(members.select("key", "node").join(up.withColumnRenamed("b", "node"), "node", "left")
                        .select("key", "node", F.coalesce("a", "node").alias("root")))
    major = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")) \
        .groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    return stage.write(_salted(named, major, "key", "node").groupBy("node")
                       .agg(F.max("root").alias("root"), F.max(F.col("root") != F.col("major")).alias("minor")))


def _rest(left: DataFrame, own: DataFrame, percent: int, stage: Stage) -> DataFrame:
    """``a, b``: pairs that may link, of different groups, one of which is not
    the largest of a key (``left``: ``node, root, minor``)."""
    sets = own.select("node", "n", "shingles").join(left, "node")
    rows = stage.write(sets.select("node", "root", "minor", "n", F.explode("shingles").alias("g")))
    often = rows.groupBy("g").agg(F.count(F.lit(1)).alias("often"))
    ranked = stage.write(rows.join(often, "g").groupBy("node", "root", "minor", "n")
                         .agg(F.array_sort(F.collect_list(F.struct("often", "g"))).alias("gs")))
    stage.drop(rows)
    size_class = lambda n: F.floor(F.log(n) / F.log(F.lit(WIDTH)) + 1e-9).cast("int")
    n = F.col("n")
    first = lambda k: F.posexplode(F.slice("gs", F.lit(1), F.greatest(k, F.lit(1)).cast("int"))).alias("at", "x")
    index = ranked.select("node", "root", "n", size_class(n).alias("class"), first(n - F.ceil(n * percent / 100) + 2)) \
        .select("node", "root", "n", "class", "at", F.col("x.g").alias("g"))
    classes = F.sequence(size_class(F.greatest(n * percent / 100 - 1, F.lit(1))), size_class(n * 100 / percent + 1))
    least = F.greatest(F.floor(F.pow(F.lit(WIDTH), F.col("class"))) - 1, F.floor(n * percent / 100) - 1)
    common = F.ceil((n + least) * percent / (100 + percent))
    wanted = ranked.where("minor").select("node", "root", "n", "gs", F.explode(classes).alias("class")) \
        .select("node", "root", "n", "class", first(n - common + 2)) \
        .select(F.col("node").alias("a"), F.col("root").alias("a_root"), F.col("n").alias("n_a"), F.col("at").alias("at_a"),
                "class", F.col("x.g").alias("g"))
    # Not more than the shingles from the first common one on can be common.
    most = F.least(F.col("n_a") - F.col("at_a"), n - F.col("at"))
    met = index.join(wanted, ["g", "class"]).where(
        (F.col("root") != F.col("a_root")) & (most * (100 + percent) >= (F.col("n_a") + n) * percent))
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def _links(members: DataFrame, own: DataFrame, percent: int, stage: Stage) -> DataFrame:
    """``a, b``: links whose components are those of all links (``members``: ``key, node, size``)."""
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    members = stage.write(members.select("key", "node").join(score, "node"))
    central = members.groupBy("key").agg(F.max(F.struct("score", F.col("node").alias("a"))).alias("x"))
    offers = _salted(members.select("key", "node"), central, "key", "node").where("node != x.a")
    best = F.slice(F.sort_array(F.collect_set("x"), asc=False), 1, PROPOSALS)
    pairs = stage.write(offers.groupBy("node").agg(best.alias("xs")).select(F.explode("xs.a").alias("a"), F.col("node").alias("b")))
    links = stage.write(_verify(pairs, own, percent, stage))
    more = stage.write(_rest(_split(members, links, stage), own, percent, stage))
    return links.union(_verify(more, own, percent, stage, "parity"))


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int, stage: Stage) -> DataFrame:
    """``node, n, sketch, parity, shingles`` of the rows ``wanted`` (``id, text_hash,
    node``) of ``docs``, made once more from their texts: texts are smaller than sets, and
    only these are needed."""
    texts = docs.select(_id().alias("id"), F.xxhash64("text").alias("text_hash"), text_bytes().alias("text"),
                        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"))
    some = texts.join(_copies(wanted), ["id", "text_hash", "salt"]).select("node", "text")
    some = some.groupBy("node").agg(F.first("text").alias("text"))     # equal rows
    return stage.write(sketches(some, size).select("node", "n", "sketch", "parity", "shingles"))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    stage = Stage(docs.sparkSession, "setsketch")
    own_text = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text_bytes().alias("text"))
    rows = stage.write(sketches(own_text, size, sets=False).withColumn("node", F.monotonically_increasing_id()))
    same = stage.write(rows.where("n > 0").groupBy("h1", "h2", "n").agg(
        F.min("node").alias("node"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("first"),
        F.count(F.lit(1)).alias("copies")))
    one_each = same.select("node", "sketch")
    bands = np.arange(REGISTERS).reshape(-1, BAND)
    shared = stage.write(_shared(band_keys(one_each, bands)))
    often = shared.where(F.col("size") > max_bucket).select("node").distinct()
    rng = np.random.default_rng(1)
    longer = np.stack([rng.permutation(REGISTERS)[:LONG_BAND] for _ in range(LONG_KEYS)])
    hot = _shared(band_keys(one_each.join(often, "node", "left_semi"), longer))
    members = stage.write(shared.where(F.col("size") <= max_bucket).union(hot))
    wanted = rows.select(_id().alias("id"), "text_hash", "node").join(members.select("node").distinct(), "node", "left_semi")
    own = _sets_of(docs, wanted, size, stage)
    roots = connected_components(_links(members, own, percent, stage), "a", "b")

    # Only sets that others share or link with need a name.
    linked = same.join(roots, "node", "left").select("h1", "h2", "n", "first", "copies", "root")
    ids = linked.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    named = linked.where("root is not null or copies > 1").join(ids, "root", "left") \
        .select("h1", "h2", "n", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"),
                F.lit(True).alias("named"))
    out = rows.select("doc_id", "n", "h1", "h2", F.pmod("node", F.lit(SALTS)).alias("salt")) \
        .join(_copies(named), ["h1", "h2", "n", "salt"], "left")
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
