"""Word counting over document collections.

Documents are ``doc_id long, text string`` rows; words come from Java's
``split(" ")`` rules (:func:`roundstats.functions.java_split`). Every count
is an algebraic aggregate: Spark's partial aggregation combines map-side,
so a word that holds a third of all tokens still reaches the final
aggregate as one row per map task, never as one huge group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundstats.functions.columns import java_length, java_split, salt
from roundstats.operators.parts import by_part_and_key, part_of


def tokens(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """one row per word occurrence: ``doc_id, word``."""
    return docs.select(F.col(doc_col).alias("doc_id"),
                       F.explode(java_split(F.col(text_col))).alias("word"))


def doc_word_counts(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """``doc_id, word, c`` -- occurrences of each word in each document.

    A document's tokens all sit in one task, so the partial aggregate
    already finishes each document's counts map-side; the exchange only
    moves the final (doc, word) pairs. (Counting inside the row with sorted
    arrays avoids that exchange but measured 3x slower: lambdas run
    interpreted.)
    """
    return (tokens(docs, text_col, doc_col)
            .groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("c")))


def word_count(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """A9, one round: ``word, n``. partial count -> Exchange(word) -> count."""
    return (tokens(docs, text_col, doc_col)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def group_word_counts(docs: DataFrame, k: int, seed: int = 0, text_col: str = "text",
                      doc_col: str = "doc_id", reproducible: bool = True) -> DataFrame:
    """A10: ``group_id, word, c``: each (word, c_i(word)) pair of a document
    gets a seeded random group in [0, k); counts are summed per group. The
    group is an md5 that SQL engines can repeat, or (not ``reproducible``)
    Spark's own much cheaper 64-bit hash."""
    # The key is a function of (doc_id, word), so every occurrence of a
    # pair lands in the pair's group: counting tokens per (group, word)
    # equals summing the per-document counts, with one exchange, not two.
    return (tokens(docs, text_col, doc_col)
            .withColumn("group_id", salt(k, seed, "doc_id", "word") if reproducible else
                        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "word"), F.lit(k)).cast("int"))
            .groupBy("group_id", "word").agg(F.count(F.lit(1)).alias("c")))


def word_count_salted(docs: DataFrame, k: int, seed: int = 0, text_col: str = "text",
                      doc_col: str = "doc_id") -> DataFrame:
    """A11, two rounds with random keys: sum per (group, word), then per word."""
    return (group_word_counts(docs, k, seed, text_col, doc_col, reproducible=False)
            .groupBy("word").agg(F.sum("c").alias("n")))


def partition_word_counts(docs: DataFrame, k: int, method: str = "hash", text_col: str = "text",
                          doc_col: str = "doc_id", relayout: bool = False) -> DataFrame:
    """``part, word, c``: counts summed inside each of ``k`` document
    parts (part = a function of doc_id, see :func:`part_of`).

    ``relayout=True`` first lays the documents out by part and id (one shuffle
    of the texts, each part over many tasks); a task's counts then merge per
    (part, word). The default counts the documents where they are read.
    """
    base = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    base = base.withColumn("part", part_of("doc_id", k, method))
    if relayout:
        base = by_part_and_key(base, k, "part", "doc_id")
    return (base.select("part", F.explode(java_split(F.col("text"))).alias("word"))
            .groupBy("part", "word").agg(F.count(F.lit(1)).alias("c")))


def word_count_by_part(docs: DataFrame, k: int, method: str = "hash", text_col: str = "text",
                       doc_col: str = "doc_id", relayout: bool = False) -> DataFrame:
    """A13, two rounds by partition: sum per (part, word), then per word."""
    return (partition_word_counts(docs, k, method, text_col, doc_col, relayout)
            .groupBy("word").agg(F.sum("c").alias("n")))


def distinct_words(wc: DataFrame) -> DataFrame:
    """the keys of a word count."""
    return wc.select("word")


def word_lengths(wc: DataFrame, utf16: bool = False) -> DataFrame:
    """F8: ``word, len`` (code points, or UTF-16 units as Java counts)."""
    return wc.select("word", java_length("word", utf16).alias("len"))


def distinct_word_stats(wc: DataFrame, utf16: bool = False) -> DataFrame:
    """A14 + A15: one row ``n_words, avg_len`` over the distinct words."""
    return wc.agg(F.count(F.lit(1)).alias("n_words"),
                  (F.sum(java_length("word", utf16)) / F.count(F.lit(1))).alias("avg_len"))


def avg_word_length(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id",
                    utf16: bool = False) -> DataFrame:
    """A14/A15 for the one-round count: ``n_words, avg_len``."""
    return distinct_word_stats(word_count(docs, text_col, doc_col), utf16)


def compare_word_counts(docs: DataFrame, k: int, seed: int = 0, method: str = "hash",
                        text_col: str = "text", doc_col: str = "doc_id", utf16: bool = False) -> DataFrame:
    """``method, n_words, avg_len`` for the three ways of counting; all
    three rows agree when the methods are right.

    Each text is split once: one aggregate with three grouping sets counts by word,
    by (random key, word) and by (part, word), a second one sums the two-round
    methods' counts by word.
    """
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "word"), F.lit(k)).cast("int")
    words = tokens(docs, text_col, doc_col).select("word", group.alias("g"), part_of("doc_id", k, method).alias("p"))
    first = words.groupingSets([["word"], ["word", "g"], ["word", "p"]], "word", "g", "p") \
        .agg(F.count(F.lit(1)).alias("c"), F.grouping_id().alias("way"))
    size = java_length("word", utf16)
    counted = first.groupBy("way", "word").agg(F.sum("c").alias("n"))
    # Bits of the columns that a set leaves out: g and p, p, g.
    ways = {"one_round": 3, "random_keys": 1, "by_partition": 2}
    stats = counted.agg(*[x.alias(f"{name}_{i}") for name, w in ways.items() for i, x in enumerate((
        F.count_if(F.col("way") == w), F.sum(F.when(F.col("way") == w, size))))])
    rows = F.array(*[F.struct(F.lit(name).alias("method"), F.col(f"{name}_0").alias("n_words"),
                              (F.col(f"{name}_1") / F.nullif(F.col(f"{name}_0"), F.lit(0))).alias("avg_len")) for name in ways])
    return stats.select(F.inline(rows))
