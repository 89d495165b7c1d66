"""Benchmark decontamination by BM25 search with block-max WAND (operator 1).

The test items are indexed: the index terms are pairs of neighbouring words (of
a one-word text, the word), and Spark computes their document frequencies and
BM25 weights; a weight is divided by the item's score against
itself, so a score is the share of the item a passage holds and one threshold
serves long and short items. Every training text is cut into overlapping
passages and each passage is a query (items are banded by length; a band's
passages are twice as long as its items, so one holds any whole item). Block-max WAND walks the posting lists
of the passage's terms: it finds the next item whose terms' largest weights
can reach the threshold, checks the blocks' largest weights there and skips
whole blocks that cannot. Passages whose terms cannot reach the threshold for
any item by those largest weights are passed over before that. All items at or above the threshold are retrieved,
then verified: the word n-grams of the item's question and of its answer must
both be found in the text around the passage. Of the passages of a document
that verify for an item, the one of the highest score is reported.

Words are runs of ASCII letters, digits and other scripts' characters,
lower-cased. The question ends at the last question mark, or else the last
line break, or else after two thirds of the words; what follows is the answer
(an item of one word is question and answer).

The index is built and sent in blocks of items of about ``BLOCK_TEXT`` bytes
of text, one pass over the documents per block, so what is broadcast is
bounded for any benchmark; frequencies cover all items.

Edge cases: null or empty texts (on either side) match nothing, as do items
without words; an item repeated with the same id and text counts once, items
that share an id with other texts count one by one; a document that matches
several items has a row for each; repeated documents repeat their rows; empty
tables give an empty result. Other columns are neither read nor needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from roundstats.llm.common import MARKS, Stage, blocks, find_words, gram_hashes, mix, unused, word_hashes

LEAST_HALF = 16      # words that neighbouring passages share, at least
THRESHOLD = 0.7      # least share of the item's own BM25 score
QUESTION_SHARE = 0.6
ANSWER_SHARE = 0.5
GRAM = 3             # words of the n-grams that verify
K1, B = 1.2, 0.75    # BM25's usual constants
POSTING_BLOCK = 16   # postings per block of the index
BLOCK_TEXT = 8 << 20


def _lower(col: str):
    return F.lower(F.coalesce(F.col(col).cast("string"), F.lit(""))).cast("binary")


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item's text."""
    text = text.strip()
    for mark in ("?", "\n"):
        at = text.rfind(mark)
        if 0 <= at < len(text) - 1:
            return text[: at + 1], text[at + 1:]
    words = text.split()
    at = -(-2 * len(words) // 3)
    return " ".join(words[:at]), " ".join(words[at:])


def words_and_terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a block, the index term that starts at each word (0 where
    none does), and the word offsets of its texts."""
    starts, ends, woff = find_words(data, offs, MARKS)
    words = word_hashes(data, starts, ends, lower=False)
    terms = np.zeros(len(words), np.uint64)
    terms[:-1] = gram_hashes(words, 2)
    n = np.diff(woff)
    terms[woff[1:][n > 1] - 1] = 0
    one = woff[:-1][n == 1]
    terms[one] = mix(words[one])
    return words, terms, woff


def hashes_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_and_terms(raw, np.array([0, len(raw)]))[0]


def gram_set(words: np.ndarray, k: int = GRAM) -> tuple[int, np.ndarray]:
    """N-gram length and distinct n-grams of a word sequence (a shorter
    sequence than ``k``: all its words)."""
    k = max(1, min(k, len(words)))
    return k, np.unique(gram_hashes(words, k))


# -------------------------------------------------------------------- index --

@dataclass
class Band:
    """The items of one index block whose lengths lie within a factor of two,
    with passages long enough for them. Postings of term ``t`` are
    ``items[ptr[t]:ptr[t+1]]`` (ascending) with their ``weights``."""

    passage: int
    ptr: np.ndarray
    items: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        n = len(self.ptr) - 1
        self.most = np.zeros(n)
        np.maximum.at(self.most, np.repeat(np.arange(n), np.diff(self.ptr)), self.weights)
        self.lists: dict[int, tuple] = {}

    def postings(self, t: int) -> tuple[list, list, list, list]:
        """Items and weights of a term, last item and largest weight by block."""
        if t not in self.lists:
            it, w = self.items[self.ptr[t]: self.ptr[t + 1]], self.weights[self.ptr[t]: self.ptr[t + 1]]
            cut = range(0, len(it), POSTING_BLOCK)
            self.lists[t] = (it.tolist(), w.tolist(),
                             [int(it[min(i + POSTING_BLOCK, len(it)) - 1]) for i in cut],
                             [float(w[i: i + POSTING_BLOCK].max()) for i in cut])
        return self.lists[t]

    def hopeful(self, row: np.ndarray, term: np.ndarray, goal: float) -> np.ndarray:
        """Rows (sorted, with distinct terms each) that some item may reach the
        goal in. A row's terms of least weight that cannot reach it alone are
        set aside; an item must hold one of the others, and its weights there
        plus all that was set aside bound its score."""
        if not len(row):
            return row
        order = np.lexsort((self.most[term], row))
        row, term = row[order], term[order]
        top = self.most[term]
        run = np.cumsum(top)
        head = np.flatnonzero(np.diff(row, prepend=-1))
        run -= np.repeat(run[head] - top[head], np.diff(np.append(head, len(row))))
        need = run >= goal
        aside = np.zeros(int(row[-1]) + 1)
        np.maximum.at(aside, row[~need], run[~need])
        row, term = row[need], term[need]
        n = self.ptr[term + 1] - self.ptr[term]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.ptr[term], n)
        row = np.repeat(row, n)
        width = int(self.items.max()) + 1
        pair, back = np.unique(row * width + self.items[at], return_inverse=True)
        score = np.bincount(back, self.weights[at], minlength=len(pair))
        owner = pair // width
        return np.unique(owner[score + aside[owner] >= goal])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose weights over the distinct ``terms`` sum to the
        threshold or more, by block-max WAND."""
        cursors = [[0, t, 0] for t in terms]       # position, term, block
        lists, most, found = {t: self.postings(t) for t in terms}, self.most, []
        goal = threshold - 1e-9
        while cursors:
            cursors.sort(key=lambda c: lists[c[1]][0][c[0]])
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += most[c[1]]
                if total >= goal:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = lists[cursors[pivot][1]][0][cursors[pivot][0]]
            while pivot + 1 < len(cursors) and lists[cursors[pivot + 1][1]][0][cursors[pivot + 1][0]] == item:
                pivot += 1
            bound, stop = 0.0, None                # of the blocks that hold the pivot item
            for c in cursors[: pivot + 1]:
                ends, tops = lists[c[1]][2], lists[c[1]][3]
                b = c[2]
                while b < len(ends) and ends[b] < item:
                    b += 1
                c[2] = b
                if b < len(ends):
                    bound += tops[b]
                    stop = ends[b] if stop is None else min(stop, ends[b])
            if bound < goal:                       # no item up to the nearest block end can reach it
                to = stop + 1
                if pivot + 1 < len(cursors):
                    c = cursors[pivot + 1]
                    to = min(to, lists[c[1]][0][c[0]])
            elif lists[cursors[0][1]][0][cursors[0][0]] == item:
                score = sum(lists[c[1]][1][c[0]] for c in cursors[: pivot + 1])
                if score >= goal:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for c in cursors[: pivot + 1]:         # move up to the next possible item
                it, p = lists[c[1]][0], c[0]
                if it[p] < to:
                    while p < len(it) and it[p] < to:
                        p += 1
                    c[0] = p
                    c[2] = p // POSTING_BLOCK
            cursors = [c for c in cursors if c[0] < len(lists[c[1]][0])]
        return found


class Index:
    """One block of items: numbers of its terms' hashes, and bands by length."""

    def __init__(self, rows: list, item: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.ids = [r["item_id"] for r in rows]
        whole = [hashes_of(r["low"]) for r in rows]
        parts = [split_item(r["low"]) for r in rows]
        self.length = np.array([len(w) for w in whole], np.int64)
        # A part without words (a one-word item) is held to the whole item.
        self.question, self.answer = (
            [gram_set(h if len(h := hashes_of(p[side])) else w) for p, w in zip(parts, whole)] for side in (0, 1))
        self.terms, number = np.unique(term, return_inverse=True)
        # A first look by the hash's upper bits; most other words fail it.
        self.look = np.zeros(1 << 18, bool)
        self.look[(self.terms >> np.uint64(46)).astype(np.int64)] = True
        size = np.maximum(LEAST_HALF, 1 << np.ceil(np.log2(np.maximum(self.length, 1))).astype(np.int64))
        self.bands = []
        for half in np.unique(size[item]).tolist():
            own = np.flatnonzero(size[item] == half)
            own = own[np.lexsort((item[own], number[own]))]
            ptr = np.searchsorted(number[own], np.arange(len(self.terms) + 1))
            self.bands.append(Band(2 * half, ptr, item[own], weight[own]))

    def term_numbers(self, terms: np.ndarray) -> np.ndarray:
        """Term number of each hash, -1 if it is in no item."""
        out = np.full(len(terms), -1, np.int64)
        maybe = np.flatnonzero(self.look[(terms >> np.uint64(46)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, terms[maybe]), len(self.terms) - 1)
        good = self.terms[at] == terms[maybe]
        out[maybe[good]] = at[good]
        return out


def build_indexes(benchmark: DataFrame, block_text: int = BLOCK_TEXT) -> Iterator[tuple[Index, bool]]:
    """``(index, whether it is of the last block)`` over all items (item_id,
    text), in blocks bounded by their text. A caller that writes what it found
    with one index before it asks for the next holds one at a time."""
    stage = Stage(benchmark.sparkSession, "benchmark")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    items = stage.write(benchmark.select("item_id", text.alias("text")).distinct().select(
        "item_id", F.lower("text").alias("low"), F.xxhash64("item_id", "text").alias("key")))

    def words(batches):
        for b in batches:
            rows, lens, terms, tfs = [], [], [], []
            for i, _, data, offs in blocks(b.column(1)):
                _, h, woff = words_and_terms(data, offs)
                for r in range(len(woff) - 1):
                    own = h[woff[r]: woff[r + 1]]
                    t, n = np.unique(own[own != 0], return_counts=True)
                    rows.append(np.full(len(t), i + r))
                    lens.append(np.full(len(t), woff[r + 1] - woff[r]))
                    terms.append(t.view(np.int64)), tfs.append(n)
            cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (rows, lens, terms, tfs)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=["key", "len", "term", "tf"])

    posts = stage.write(items.select("key", F.col("low").cast("binary").alias("b"))
                        .mapInArrow(words, "key long, len long, term long, tf long"))
    # Counts and means cover all items, however the index is cut below.
    n, mean = posts.groupBy("key").agg(F.first("len").alias("len")).agg(F.count(F.lit(1)), F.avg("len")).first()
    if not n:
        return
    df = posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf")
    weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / mean))
    weighed = stage.write(posts.join(df, "term").select("key", "term", weight.alias("w")))
    total = items.agg(F.sum(F.octet_length("low"))).first()[0]
    n_blocks = max(1, -(-int(total) // block_text))
    block = F.pmod("key", F.lit(n_blocks))
    for k in range(n_blocks):
        rows = items.where(block == k).orderBy("item_id", "key").collect()
        number = {r["key"]: i for i, r in enumerate(rows)}
        own = weighed.where(block == k).toArrow().to_pydict()
        item = np.array([number[key] for key in own["key"]], np.int64)
        term = np.array(own["term"], np.int64).view(np.uint64)
        w = np.array(own["w"], float)
        w /= np.bincount(item, w, minlength=len(rows))[item]
        if len(item):
            yield Index(rows, item, term, w), k == n_blocks - 1


# ------------------------------------------------------------------- search --

def block_hits(index: Index, data: np.ndarray, offs: np.ndarray, threshold: float,
               question_share: float = QUESTION_SHARE, answer_share: float = ANSWER_SHARE) -> list[tuple]:
    """``(text, item, score, question share, answer share, first word)`` of
    the verified matches of a block of texts, best verified passage per item."""
    words, terms, woff = words_and_terms(data, offs)
    term = index.term_numbers(terms)
    goal, n = threshold - 1e-9, np.diff(woff)
    found: dict[tuple, list] = {}
    for band in index.bands:
        # The terms' largest weights, repeats included, bound any item's score.
        top = np.zeros(len(words) + 1)
        np.cumsum(np.where(term >= 0, band.most[term], 0.0), out=top[1:])
        half = band.passage // 2
        per = np.where(n > 0, np.maximum(1, -(-(n - half) // half)), 0)
        text = np.repeat(np.arange(len(n)), per)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        lo = woff[text] + nth * half
        hi = np.minimum(lo + band.passage, woff[text + 1])
        able = np.flatnonzero(top[hi] - top[lo] >= goal)
        size = hi[able] - lo[able]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[able], size)
        row, t = np.repeat(able, size), term[at]
        good = (t >= 0) & (band.most[t] > 0)
        pair = np.unique(row[good] * len(index.terms) + t[good])
        row, t = pair // len(index.terms), pair % len(index.terms)
        for p in band.hopeful(row, t, goal).tolist():
            own = t[np.searchsorted(row, p): np.searchsorted(row, p, side="right")]
            for item, score in band.search(own.tolist(), threshold):
                found.setdefault((int(text[p]), item), []).append((-score, int(lo[p]), int(hi[p])))
    out = []
    for (row, item), passages in sorted(found.items()):
        reach = int(index.length[item])
        for score, lo, hi in sorted(passages):     # the first that verifies is the best
            near = words[max(woff[row], lo - reach): min(woff[row + 1], hi + reach)]
            share = [float(np.isin(grams, gram_hashes(near, k)).mean())
                     for k, grams in (index.question[item], index.answer[item])]
            if share[0] >= question_share and share[1] >= answer_share:
                out.append((row, item, -score, *share, lo - int(woff[row])))
                break
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                  question_share: float = QUESTION_SHARE, answer_share: float = ANSWER_SHARE,
                  block_text: int = BLOCK_TEXT) -> DataFrame:
    """``doc_id, item_id, score, question_share, answer_share, first_word``
    for every document and item that match, by best verified passage. The matches
    of each block of items but the last are written before the next is indexed."""
    stage = Stage(docs.sparkSession, "contamination")
    item_type = benchmark.schema["item_id"].dataType
    schema = T.StructType([docs.schema["doc_id"]]).add("item_id", item_type).add("score", "double") \
        .add("question_share", "double").add("answer_share", "double").add("first_word", "long")
    src = docs.select("doc_id", _lower("text").alias("text"))
    id_type = to_arrow_type(item_type)
    out = None
    for index, last in build_indexes(benchmark, block_text):
        def kernel(batches, index=index):
            for b in batches:
                hits = [(i + h[0], *h[1:]) for i, _, data, offs in blocks(b.column(1))
                        for h in block_hits(index, data, offs, threshold, question_share, answer_share)]
                row, item, *shares, first = zip(*hits) if hits else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array([index.ids[i] for i in item], id_type),
                     *(pa.array(c, pa.float64()) for c in shares), pa.array(first, pa.int64())], names=schema.names)

        part = src.mapInArrow(kernel, schema)
        part = part if last else stage.write(part)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                      question_share: float = QUESTION_SHARE, answer_share: float = ANSWER_SHARE,
                      block_text: int = BLOCK_TEXT) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text matches no item. Whether it
    does depends on the text alone: each block of items but the last writes
    the digests of the texts that match, and rows with these go."""
    stage = Stage(docs.sparkSession, "contamination")
    low, key = unused("__lower", docs), unused("__digest", docs)
    digest = F.sha2(F.col("text").cast("binary"), 256)
    gone, out = None, docs
    for index, last in build_indexes(benchmark, block_text):
        def matched(batch, text, index=index):
            """Blocks of a batch with what matches in them."""
            for i, j, data, offs in blocks(text):
                hits = block_hits(index, data, offs, threshold, question_share, answer_share)
                yield i, j, sorted({h[0] for h in hits})

        def digests(batches, matched=matched):
            for b in batches:
                at = [i + r for i, _, rows in matched(b, b.column(1)) for r in rows]
                yield b.select([0]).take(pa.array(at, pa.int64()))

        def rest(batches, matched=matched):
            for b in batches:
                own = b.drop_columns([low])
                for i, j, rows in matched(b, b.column(b.num_columns - 1)):
                    keep = np.ones(j - i, bool)
                    keep[rows] = False
                    yield own.slice(i, j - i).filter(pa.array(keep))

        if last:
            out = out.withColumn(low, _lower("text")).mapInArrow(rest, docs.schema)
        else:
            found = stage.write(docs.where(F.col("text").isNotNull()).select(digest.alias(key), _lower("text").alias("text"))
                                .mapInArrow(digests, T.StructType([T.StructField(key, T.StringType())])))
            gone = found if gone is None else gone.union(found)
    if gone is not None:
        out = out.withColumn(key, digest).join(gone.distinct(), key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
    return out
