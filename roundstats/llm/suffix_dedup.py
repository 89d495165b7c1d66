"""Repeated passages by a sparse suffix array (operator 2).

Finds every passage of ``LEAST`` or more words that occurs at two or more
places (A-Z folded, words split at white space). Suffixes are retained only at
minimisers: of every ``LEAST - GRAM + 1`` consecutive runs of ``GRAM`` words,
the start of the run with the smallest hash. Equal passages of ``LEAST`` words
retain a suffix at the same offset, so comparing retained suffixes that start
with the same run loses no repeat.

1. Every text gives (hash of the run, text, position) of its retained suffixes.
2. Hashes met once go; the others' suffixes get their surroundings: the words
   before (nearest first) and after the run, as far as ``LEAST`` words reach.
3. Suffixes are sorted by run and what follows it, and compared with their
   neighbours of the same run: a match extends right and left as far as both
   texts agree, and counts when it reaches ``LEAST`` words.
4. A run that more than ``MAX_RUN`` suffixes share is not compared pair by pair.
   Suffixes with equal surroundings are first gathered by partial aggregates;
   the distinct surroundings are spread into the windows of ``LEAST`` words
   around the run, and equal windows (hash of run, offset and words) are met
   the same way. Both ways give the same words, and the second is linear.

Longer passages come out whole, as the union of the windows found at their
minimisers. A place is *later* if an equal passage occurs at a smaller (id,
text, position); cutting the later places leaves one copy of each.

Edge cases: null, empty and short texts hold no passage and have no row. Rows
equal in id and text are one document (their copies do not repeat each other).
A passage may repeat inside one text, also overlapping itself. Ties have
defined order (id, text hash, position; a null id first). Other columns are
neither read nor needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundstats.llm.common import Stage, blocks, find_words, gram_hashes, mix, powers, text_bytes, word_hashes

LEAST = 50
GRAM = 12
SIDE = LEAST - GRAM          # words around a run that can complete a passage
MAX_RUN = 64


def window_minima(words: np.ndarray, woff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of ``LEAST`` words of a block (none crosses a
    text's border), the minimiser of each, and the hashes of the runs."""
    grams = gram_hashes(words, GRAM)
    if len(grams) <= SIDE:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    row = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
    starts = np.flatnonzero(row[: len(words) - LEAST + 1] == row[LEAST - 1:])
    view = np.lib.stride_tricks.sliding_window_view(grams, SIDE + 1)
    at = [s + view[s].argmin(axis=1) for s in np.array_split(starts, len(starts) // 4096 + 1)]
    return starts, np.concatenate(at), grams


def minimisers(words: np.ndarray, woff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions (in the block) of the retained suffixes, and their runs' hashes."""
    _, at, grams = window_minima(words, woff)
    at = np.unique(at)
    return at, grams[at]


def retained(docs: DataFrame) -> DataFrame:
    """``key, d, pos`` of every retained suffix (``d``: the text's number)."""
    def kernel(batches):
        for b in batches:
            for i, j, data, offs in blocks(b.column(1)):
                starts, ends, woff = find_words(data, offs)
                at, key = minimisers(word_hashes(data, starts, ends), woff)
                row = np.searchsorted(woff, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), b.column(0).slice(i, j - i).take(pa.array(row)),
                     pa.array((at - woff[row]).astype(np.int32))], names=["key", "d", "pos"])

    return docs.select("d", "bytes").mapInArrow(kernel, "key long, d long, pos int")


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, ends, pa.py_buffer(rows.tobytes())])


def surroundings(docs: DataFrame) -> DataFrame:
    """``key, doc_id, d, pos, n_left, n_right, lo, hi, before, after`` of the given
    suffixes (columns ``doc_id, d, bytes, at, run``: positions and run hashes): 32 bits of each surrounding word's hash, nearest first."""
    def kernel(batches):
        reach = np.arange(SIDE)
        for b in batches:
            lists = [b.column(k) for k in (3, 4)]
            for i, j, data, offs in blocks(b.column(2)):
                starts, ends, woff = find_words(data, offs)
                words = word_hashes(data, starts, ends)
                first, least, _ = window_minima(words, woff)
                w = (words >> np.uint64(32)).astype("<u4")
                pos = lists[0].slice(i, j - i)
                row = np.repeat(np.arange(j - i), pos.value_lengths().to_numpy())
                pos = pos.flatten().to_numpy()
                at = pos + woff[row]
                hi = at - first[np.searchsorted(least, at)]
                lo = at - first[np.searchsorted(least, at, side="right") - 1]
                for a in range(0, len(at), 1 << 14):
                    s = slice(a, a + (1 << 14))
                    left, right = at[s, None] - 1 - reach, at[s, None] + GRAM + reach
                    in_left, in_right = left >= woff[row[s], None], right < woff[row[s] + 1, None]
                    take = pa.array(row[s] + i)
                    yield pa.RecordBatch.from_arrays(
                        [lists[1].slice(i, j - i).flatten().slice(a, 1 << 14),
                         b.column(0).take(take), b.column(1).take(take), pa.array(pos[s]),
                         pa.array(in_left.sum(axis=1), pa.int32()), pa.array(in_right.sum(axis=1), pa.int32()),
                         pa.array(lo[s], pa.int32()), pa.array(hi[s], pa.int32()),
                         _fixed(np.where(in_left, w[np.maximum(left, 0)], 0).astype("<u4")),
                         _fixed(np.where(in_right, w[np.minimum(right, len(w) - 1)], 0).astype("<u4"))], names=names)

    names = ["key", "doc_id", "d", "pos", "n_left", "n_right", "lo", "hi", "before", "after"]
    return docs.mapInArrow(kernel, "key long, doc_id long, d long, pos int, n_left int, n_right int, lo int, hi int, "
                                   "before binary, after binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, SIDE)


def _agree(m: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many leading words rows i and j share."""
    same = m[i] == m[j]
    same &= np.arange(SIDE) < np.minimum(n[i], n[j])[:, None]
    return np.where(same.all(axis=1), SIDE, same.argmin(axis=1))


def compare_run(t: pa.Table) -> pa.Table:
    """Spans of suffixes sorted by run: each is compared with its neighbours
    of the same run."""
    key, d, pos = (t.column(c).to_numpy() for c in ("key", "d", "pos"))
    order = [t.column("doc_id").fill_null(-(1 << 63)).to_numpy(), d, pos]
    n_left, n_right = t.column("n_left").to_numpy(), t.column("n_right").to_numpy()
    before, after = _matrix(t.column("before")), _matrix(t.column("after"))
    size = len(key)
    left, right, late_left, late_right = (np.full(size, -1) for _ in range(4))
    step, i = 1, np.arange(size)
    while True:
        i = i[i + step < size]
        i = i[key[i] == key[i + step]]
        if not len(i):
            break
        j = i + step
        apart = (d[i] != d[j]) | (pos[i] != pos[j])
        a, b = _agree(before, n_left, i, j), _agree(after, n_right, i, j)
        good = apart & (a + b + GRAM >= LEAST)
        first = np.zeros(len(i), bool)             # whether i comes before j
        tie = np.ones(len(i), bool)
        for o in order:
            first |= tie & (o[i] < o[j])
            tie &= o[i] == o[j]
        for me, later in ((i, ~first), (j, first)):
            for out, v, keep in ((left, a, good), (right, b, good), (late_left, a, good & later), (late_right, b, good & later)):
                np.maximum.at(out, me[keep], v[keep])
        step += 1
    hit = np.flatnonzero(left >= 0)
    late = late_left[hit] >= 0
    at = pos[hit]
    return pa.table({
        "doc_id": t.column("doc_id").take(pa.array(hit)), "d": pa.array(d[hit]),
        "a": pa.array((at - left[hit]).astype(np.int32)), "b": pa.array((at + GRAM + right[hit]).astype(np.int32)),
        "later_a": pa.array((at - late_left[hit]).astype(np.int32), mask=~late),
        "later_b": pa.array((at + GRAM + late_right[hit]).astype(np.int32), mask=~late)})


SPAN = "doc_id long, d long, a int, b int, later_a int, later_b int"


def compared(near: DataFrame) -> DataFrame:
    """Spans from neighbours, for runs of at most ``MAX_RUN`` suffixes."""
    def kernel(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            key = t.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0      # the last run may go on
            if cut:
                yield from compare_run(t.slice(0, cut).combine_chunks()).to_batches()
            rest = t.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from compare_run(rest).to_batches()

    return near.repartition("key").sortWithinPartitions("key", "after", "doc_id", "d", "pos").mapInArrow(kernel, SPAN)


def counted(near: DataFrame) -> DataFrame:
    """Spans from equal windows, for runs of any number of suffixes."""
    def kernel(batches):
        for b in batches:
            t = pa.Table.from_batches([b]).combine_chunks()
            key = t.column("key").to_numpy()
            sides = []
            for c in ("before", "after"):
                p = np.zeros((len(key), SIDE + 1), np.uint64)
                np.cumsum((_matrix(t.column(c)).astype(np.uint64) + np.uint64(1)) * powers(0x9E3779B97F4A7C15, SIDE),
                          axis=1, out=p[:, 1:])
                sides.append(mix(p))
            lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
            for a in range(SIDE + 1):
                ok = np.flatnonzero((lo <= a) & (a <= hi))
                h = mix(key[ok].view(np.uint64) ^ mix(sides[0][ok, a] + np.uint64(a)) + sides[1][ok, SIDE - a])
                own = t.select(["around", "least", "many"]).take(pa.array(ok))
                own = own.append_column("h", pa.array(h.view(np.int64)))
                yield from own.append_column("a", pa.array(np.full(len(ok), a, np.int32))).combine_chunks().to_batches()

    place = F.struct("doc_id", "d", "pos")
    rows = near.withColumn("around", F.xxhash64("key", "n_left", "n_right", "before", "after"))
    first = [F.first(c).alias(c) for c in ("key", "lo", "hi", "before", "after")]
    around = rows.groupBy("around").agg(F.min(place).alias("least"), F.max(place).alias("most"), *first) \
        .withColumn("many", ~F.col("least").eqNullSafe(F.col("most"))).drop("most")
    windows = around.mapInArrow(
        kernel, "around long, least struct<doc_id:bigint,d:bigint,pos:int>, many boolean, h long, a int")
    met = windows.groupBy("h").agg(F.min("least").alias("first"), F.max("least").alias("last"), F.max("many").alias("many")) \
        .where(F.col("many") | ~F.col("first").eqNullSafe(F.col("last"))).select("h", "first")
    # Of the places with equal surroundings only the least can be a first one.
    a, later = F.col("a"), ~F.col("first").eqNullSafe(F.col("least"))
    found = windows.drop("many").join(met, "h").groupBy("around").agg(
        F.first("least").alias("least"), F.min("a").alias("lo"), F.max("a").alias("hi"),
        F.min(F.when(later, a)).alias("later_lo"), F.max(F.when(later, a)).alias("later_hi"))
    mine = place.eqNullSafe(F.col("least"))
    pos, lo, hi = F.col("pos"), F.col("lo"), F.col("hi")
    later_lo, later_hi = (F.when(mine, F.col(f"later_{c}")).otherwise(F.col(c)) for c in ("lo", "hi"))
    return rows.select("around", "doc_id", "d", "pos").join(found, "around").select(
        "doc_id", "d", (pos - hi).alias("a"), (pos - lo + LEAST).alias("b"),
        (pos - later_hi).alias("later_a"), (pos - later_lo + LEAST).alias("later_b"))


def _merged(a: str, b: str):
    """Union of a list of word spans, ``array<struct<start,end>>``, in order."""
    spans = F.array_sort(F.collect_set(F.when(F.col(a).isNotNull(), F.struct(F.col(a).alias("start"), F.col(b).alias("end")))))
    last = lambda acc: F.element_at(acc, -1)
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(spans, empty, lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                 F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(acc, F.array(s))))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, repeated_words, later_words, spans, later_spans`` for every
    document that holds a repeated passage (spans: word numbers, end
    exclusive, in order and apart)."""
    stage = Stage(docs.sparkSession, "passages")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("d"),
                        text_bytes().alias("bytes"))
    suffixes = stage.write(retained(texts))
    # Written, so that the join below has an exchange of its own on each side and
    # the suffixes of a common run can be split over tasks.
    counts = stage.write(suffixes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    wanted = suffixes.join(counts, "key").groupBy("d").agg(
        F.collect_set(F.struct("pos", "key", (F.col("n") > MAX_RUN).alias("hot"))).alias("s"))
    found = texts.join(wanted, "d")

    def around(hot: bool) -> DataFrame:
        own = F.filter("s", lambda x: x["hot"] == hot)
        return surroundings(found.select("doc_id", "d", "bytes", own["pos"].alias("at"), own["key"].alias("run")))

    spans = compared(around(False)).union(counted(around(True)))
    out = spans.groupBy("doc_id", "d").agg(_merged("a", "b").alias("spans"), _merged("later_a", "later_b").alias("later_spans"))
    words = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", words(F.col("spans")).alias("repeated_words"),
                      words(F.col("later_spans")).alias("later_words"), "spans", "later_spans")
