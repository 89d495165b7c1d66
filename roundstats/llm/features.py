"""Text features shared by the classifiers: hashed words and counts of the
text's structure, block by block, and a bounded sample of labelled texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundstats.llm.common import SPACE, find_words, hash_cut, text_bytes, word_hashes

_classes = []
for _bytes in (range(65, 91), range(48, 58), b"!%$#&*|", b".,;:?'\"()-", b"\n", range(128, 256)):
    _t = np.zeros(256, bool)
    _t[list(_bytes)] = True
    _classes.append(_t)
STATS = len(_classes) + 3


class TextBlock:
    """Words and structure of the texts of one block."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        self.starts, self.ends, self.woff = find_words(data, offs, SPACE)
        self.n_words = np.diff(self.woff)
        self.hashes = word_hashes(data, self.starts, self.ends)
        self.row = np.repeat(np.arange(len(self.n_words)), self.n_words)

    def stats(self) -> np.ndarray:
        """Shares of byte classes, mean word length, share of words that repeat
        the one before, and the logarithm of the word count, by text."""
        size = np.maximum(np.diff(self.offs), 1)
        cols = []
        for t in _classes:
            run = np.zeros(len(self.data) + 1, np.int64)
            np.cumsum(t[self.data], out=run[1:])
            cols.append((run[self.offs[1:]] - run[self.offs[:-1]]) / size)
        n = np.maximum(self.n_words, 1)
        again = (self.hashes[1:] == self.hashes[:-1]) & (self.row[1:] == self.row[:-1])
        rows = len(self.n_words)
        cols.append(np.bincount(self.row, self.ends - self.starts, minlength=rows) / n)
        cols.append(np.bincount(self.row[1:], again, minlength=rows) / n)
        cols.append(np.log1p(self.n_words))
        return np.stack(cols, axis=1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, max_rows: int,
                    more: tuple[Column, ...] = ()) -> DataFrame:
    """``h, label, text`` (bytes) and ``more`` of labelled documents: those of the at most
    ``max_rows`` labelled ids, among those with a document, with the smallest hash.
    An id labelled twice takes its largest label, an id of several rows the row whose text
    has the least hash. The ids are bounded, so they are broadcast and only a
    sample's texts leave the scan."""
    own = labels.select("doc_id", label.alias("label")).where("doc_id is not null and label is not null") \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    here = own.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    h = F.xxhash64("doc_id")
    ids = here.withColumn("h", h).where(F.col("h") <= hash_cut(here.count(), max_rows)).orderBy("h", "doc_id").limit(max_rows)
    names = [f"more{i}" for i in range(len(more))]
    rows = docs.select("doc_id", text_bytes().alias("text"), *(c.alias(n) for c, n in zip(more, names))) \
        .join(F.broadcast(ids), "doc_id")
    one = F.min_by(F.struct("label", "text", *names), F.struct(F.xxhash64("text"), F.xxhash64("text", *names)))
    return rows.groupBy("h", "doc_id").agg(one.alias("row")).select("h", "row.*")
