"""Document fingerprints: Merkle trees over paragraphs and sections (operator 5).

A text is cut at blank lines into sections, these at line ends into paragraphs
and these into sentences (at most 160 characters without an end mark). The
leaves are the sentences' SHA-256 digests; a paragraph's digest is that of its
leaves, a section's that of its paragraphs, the root's that of the sections;
each level has a prefix of its own. A blank line that holds blanks, tabs or
carriage returns counts as one more paragraph of the section before it, so the
text can be rebuilt from the pieces: equal roots mean equal texts. Where roots
differ, the branches that differ locate the edit (``edited_paragraphs``).
``likeness`` compares the trees' leaves, copies counted, and their roots: twice
the shared ones over all, so it is 1 for equal roots only. Only DataFrame
functions are used.

Edge cases: a null text is empty; the empty text is one section of one empty
paragraph. Two texts without sentences in common have likeness 0, two empty
texts have equal roots. Other columns are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundstats.llm.common import Stage, once

SECTION = r"\n[ \t\r]*\n"
PLAIN = "\n\n"         # the separator that needs no digest
SENTENCE = r"[^.!?\n]{0,160}[.!?\n]+|[^.!?\n]{1,160}"


def _digest(level: str, of: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), of), 256)


def tree(text: Column) -> Column:
    """Leaf digests by section and paragraph: ``array<array<array<string>>>``. A
    section's last paragraph is the blank line after it, unless plain."""
    def leaves_of(paragraph: Column) -> Column:
        return F.transform(F.regexp_extract_all(paragraph, F.lit(SENTENCE), F.lit(0)), lambda x: _digest("l", x))

    def paragraphs(x: Column) -> Column:
        own = F.transform(F.split(x["own"], "\n", -1), leaves_of)
        return F.when(x["cut"] != PLAIN, F.concat(own, F.array(F.array(_digest("b", x["cut"]))))).otherwise(own)

    # Zipped, so that the pattern runs over the text twice, not once a section.
    return F.transform(F.arrays_zip(F.split(text, SECTION, -1).alias("own"),
                                    F.regexp_extract_all(text, F.lit(SECTION), F.lit(0)).alias("cut")), paragraphs)


def sections(tree: Column) -> Column:
    """Digests of the paragraphs, by section: ``array<array<string>>``."""
    return F.transform(tree, lambda s: F.transform(s, lambda p: _digest("p", F.array_join(p, ","))))


def root(sections: Column) -> Column:
    return _digest("r", F.array_join(F.transform(sections, lambda s: _digest("s", F.array_join(s, ","))), ","))


def leaves(tree: Column) -> Column:
    """One 64-bit mark per leaf of the tree: of its digest and of how many equal
    leaves come before it, so that copies count."""
    def marks(x: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | (x[i] != F.get(x, i - 1)))
        return once(starts, lambda at: F.flatten(F.transform(at, lambda i, m: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(at, m + 1), F.size(x)) - i - 1), lambda c: F.xxhash64(x[i], c)))))

    flat = F.sort_array(F.flatten(F.flatten(tree)))
    return F.when(F.size(flat) == 0, F.array().cast("array<bigint>")).otherwise(once(flat, marks))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """Twice the shared leaves over all leaves, the root being one more on each side."""
    both = F.size(F.array_intersect(leaves_a, leaves_b))
    return F.when(root_a == root_b, 1.0).otherwise(2.0 * both / (F.size(leaves_a) + F.size(leaves_b) + 2))


def edited_paragraphs(old: Column, new: Column) -> Column:
    """``(section, paragraph)`` numbers, from 0, of the new tree's paragraphs
    that the old tree does not hold."""
    hashes = lambda tree: F.transform(F.flatten(tree), lambda p: F.xxhash64(p))

    def located(lacking: Column) -> Column:
        return F.flatten(F.transform(new, lambda s, i: F.filter(
            F.transform(s, lambda p, j: F.when(F.array_contains(lacking, F.xxhash64(p)),
                                               F.struct(i.alias("section"), j.alias("paragraph")))),
            lambda x: x.isNotNull())))

    return once(F.array_except(hashes(new), hashes(old)), located)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, sections, leaves, fingerprint`` for every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), tree(text).alias("tree"))
    return d.select("doc_id", "n_chars", sections(F.col("tree")).alias("sections"), leaves(F.col("tree")).alias("leaves")) \
        .withColumn("fingerprint", root(F.col("sections")))


def followers(ids: DataFrame, order: list[Column], stage: Stage) -> DataFrame:
    """Each row of ``ids`` (distinct) with ``next``: the row after it in the
    given order, the first after the last. Rows are range-partitioned; only one
    row per partition crosses a border."""
    cols = ids.columns
    ranged = stage.write(ids.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    row = F.struct(*cols)
    w = Window.partitionBy("__part").orderBy(*order)
    inside = ranged.withColumn("next", F.lead(row).over(w)).withColumn("__head", F.row_number().over(w) == 1)
    inside = stage.write(inside)
    heads = inside.where("__head").select(F.col("__part").alias("__p"), row.alias("head"))
    # One row per partition of the range exchange, whatever the input.
    after = Window.orderBy("__p")
    whole = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = heads.select(F.col("__p").alias("__part"),
                           F.coalesce(F.lead("head").over(after), F.first("head").over(whole)).alias("border"))
    return inside.join(F.broadcast(borders), "__part") \
        .select(*cols, F.coalesce("next", "border").alias("next"))


def neighbours(docs: DataFrame, share: int = 3) -> DataFrame:
    """For every row of ``docs``: ``doc_id, text``, the text with its last
    floor(n / share) code points replaced by the first as many of the next
    document's (``edited``), and the next document's fingerprint and leaves.

    Documents follow each other by descending id (null ids last, then by the
    text's hash; rows equal in both are one document). A document's text moves
    once; to the document before it goes only the part that its edit needs."""
    stage = Stage(docs.sparkSession, "merkle")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), text.alias("text")) \
        .withColumn("h", F.xxhash64("text", F.col("doc_id").isNull()))
    ids = d.select("doc_id", "id", "h", F.length("text").alias("n")).distinct()
    pairs = stage.write(followers(ids, [F.col("doc_id").desc_nulls_last(), F.col("h")], stage))
    wanted = pairs.select(F.col("next.id").alias("id"), F.col("next.h").alias("h"), F.col("id").alias("to_id"),
                          F.col("h").alias("to_h"), F.floor(F.col("n") / share).cast("int").alias("need"))
    keyed = d.repartition("id", "h")
    once = Window.partitionBy("id", "h").orderBy("doc_id")
    sent = keyed.withColumn("nth", F.row_number().over(once)).where("nth = 1").join(wanted, ["id", "h"]) \
        .select(F.col("to_id").alias("id"), F.col("to_h").alias("h"),
                F.substring("text", F.lit(1), F.col("need")).alias("prefix"), tree(F.col("text")).alias("tree")) \
        .select("id", "h", "prefix", root(sections(F.col("tree"))).alias("next_fingerprint"),
                leaves(F.col("tree")).alias("next_leaves"))
    got = keyed.join(sent, ["id", "h"])
    n = F.length("text")
    kept = F.substring("text", F.lit(1), n - F.floor(n / share).cast("int"))
    return got.select("doc_id", "text", F.concat(kept, "prefix").alias("edited"), "next_fingerprint", "next_leaves")
