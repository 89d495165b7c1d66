"""Text-file sources: numbers (S1/S2), documents (S4) and points.

The reference reads these on the driver or with ``textFile``; here the
executors read and parse them in parallel. Each reader has a ``*_from``
twin that parses a string column of any DataFrame, so the same parse runs
on parquet tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.functions.columns import (
    java_split,
    number_token_ok,
    whitespace_tokens,
)
from roundstats.operators.parts import cut_lineage

# Hadoop's line reader ends a line at \n, \r or \r\n; a terminator at the
# very end does not open another (empty) line.
LINE_BREAK_RE = r"\r\n|\r|\n"
FINAL_BREAK_RE = r"(\r\n|\r|\n)\z"


# Copies of one line that a task numbers at a time.
COPY_BLOCK = 1 << 16
# Repeated lines whose marks (24 bytes each) are broadcast: 24 MB.
MAX_REPEATED = 1 << 20


def _line_ids(lines: DataFrame, id_col: str) -> DataFrame:
    # Partition index + position: a retried task reproduces the same ids, but
    # another split size gives others. For rows whose id nothing is drawn from.
    return lines.withColumn(id_col, F.monotonically_increasing_id())


def _marks(line: Column) -> list[Column]:
    """128 bits that equal lines (null ones too) share."""
    return [F.xxhash64(line, line.isNull()).alias("__a"), F.xxhash64(F.lit(1), line.isNull(), line).alias("__b")]


def repeated_marks(lines: DataFrame, text_col: str) -> DataFrame:
    """``__a, __b, __n``: the marks of the lines met more than once and how often,
    written to the checkpoint folder. Only marks are shuffled, after partial counts."""
    counts = lines.select(*_marks(F.col(text_col))).groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("__n"))
    return cut_lineage(counts.where("__n > 1"))


def content_ids(lines: DataFrame, text_col: str, id_col: str, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """``id_col long, text_col``: every line (null ones too) with an id made of
    its content and, among equal lines, its copy number, so that ids, and all
    draws from them, do not follow the split layout.

    A line met once is copy 0 and never leaves its scan: the marks of repeated lines
    (one pass over 16 bytes a line) are broadcast while there are at most
    ``max_repeated`` of them, else joined. Of the repeated lines one row a
    task and line travels and is written out again as that many copies; those of a
    hot line in blocks of ``COPY_BLOCK``, spread over the tasks. Ids are 64-bit hashes:
    among n lines about n^2 / 2^65 pairs share one.
    """
    line = F.col(text_col)
    again = repeated_marks(lines, text_col)
    repeated = again.count()
    if not repeated:
        return lines.select(F.xxhash64(line, F.lit(0).cast("long")).alias(id_col), line)
    marks = F.broadcast(again) if repeated <= max_repeated else again
    marked = lines.select(line, *_marks(line)).join(marks, ["__a", "__b"], "left")
    once = marked.where(F.col("__n").isNull()).select(F.xxhash64(line, F.lit(0).cast("long")).alias(id_col), line)
    # One row a mark: equal marks are equal lines.
    copies = marked.where(F.col("__n").isNotNull()).groupBy("__a", "__b", "__n").agg(F.first(line).alias(text_col)) \
        .select(line, "__n")
    few = (copies.where(F.col("__n") <= COPY_BLOCK)
           .select(line, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias("__copy")))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(COPY_BLOCK).cast("long")))
    last = F.least(F.col("__from") + COPY_BLOCK, F.col("__n")) - 1
    many = (copies.where(F.col("__n") > COPY_BLOCK).select(line, "__n", block.alias("__from"))
            .repartition(text_col, "__from")
            .select(line, F.explode(F.sequence(F.col("__from"), last)).alias("__copy")))
    return once.unionAll(few.unionAll(many).select(F.xxhash64(line, "__copy").alias(id_col), line))


# ---------------------------------------------------------------- numbers --

def numbers_from(df: DataFrame, text_col: str = "value", id_col: str | None = None,
                 strict: bool = False) -> DataFrame:
    """Parse whitespace-separated doubles out of a string column.

    Returns ``id long, pos int, v double`` (``id`` = the line's key, ``pos``
    = token position in the line).

    * ``strict=False`` (S1): tokens Java cannot parse are skipped, then
      negatives and NaN are dropped (Java's ``NaN >= 0`` is false).
    * ``strict=True`` (S2): every token must parse, else the job fails;
      nothing is filtered.
    """
    toks = _number_tokens(df, text_col, id_col)
    parsed = F.col("tok").try_cast("double")
    if strict:
        ok = parsed.isNotNull() & number_token_ok(F.col("tok"))
        v = F.when(ok, parsed).otherwise(
            F.raise_error(F.concat(F.lit("not a number: "), F.col("tok")))).cast("double")
        return toks.select("id", "pos", v.alias("v"))
    out = toks.select("id", "pos", F.when(number_token_ok(F.col("tok")), parsed).alias("v"))
    return out.where(F.col("v").isNotNull() & (F.col("v") >= 0) & ~F.isnan("v"))


def _number_tokens(df: DataFrame, text_col: str, id_col: str | None) -> DataFrame:
    if id_col is None:
        df = _line_ids(df, "__line_id")
        id_col = "__line_id"
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.posexplode(whitespace_tokens(F.col(text_col))).alias("pos", "tok"))


def rejected_number_tokens(df: DataFrame, text_col: str = "value",
                           id_col: str | None = None) -> DataFrame:
    """``id, pos, tok``: the tokens the lenient parse skips because Java
    cannot read them as numbers (the reference reports each one)."""
    toks = _number_tokens(df, text_col, id_col)
    ok = F.col("tok").try_cast("double").isNotNull() & number_token_ok(F.col("tok"))
    return toks.where(~ok)


def read_numbers(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Numbers of a text file, read by the executors."""
    return numbers_from(spark.read.text(path), "value", None, strict)


# -------------------------------------------------------------- documents --

def documents_from(df: DataFrame, text_col: str = "text", doc_col: str = "doc_id",
                   per_line: bool = False) -> DataFrame:
    """``doc_id long, text string`` documents from a string column.

    With ``per_line=True`` each text line is one document, as when the
    reference reads a file with ``textFile``: ids become ``(doc_id, line)``.
    """
    base = df.select(F.col(doc_col).cast("long").alias("doc_id"),
                     F.col(text_col).alias("text"))
    if not per_line:
        return base
    t = F.col("text")
    lines = F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(t, FINAL_BREAK_RE, ""), LINE_BREAK_RE, -1))
    return base.select("doc_id", F.posexplode(lines).alias("line", "text"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per text line of the file(s) at ``path``; ids by
    :func:`content_ids`."""
    return content_ids(spark.read.text(path), "value", "doc_id").select(
        "doc_id", F.col("value").alias("text"))


# ----------------------------------------------------------------- points --

def _vector_of(text: Column) -> Column:
    # A token Java refuses (including Spark-only "inf"/"nan" spellings) is NULL.
    return F.transform(java_split(text), lambda x: F.when(number_token_ok(x), x.try_cast("double")))


def points_from_lines(df: DataFrame, text_col: str = "value", id_col: str | None = None,
                      strict: bool = True) -> DataFrame:
    """``id long, v array<double>, w long`` from space-separated lines.

    Java splits on single blanks, so a doubled blank yields an empty token
    that fails to parse: ``strict=True`` fails the job on such a line,
    ``strict=False`` drops it. Without ``id_col`` ids come from the lines
    themselves (:func:`content_ids`, one shuffle).
    """
    if id_col is None:
        df = content_ids(df, text_col, "__line_id")
        id_col = "__line_id"
    v = _vector_of(F.col(text_col))
    bad = F.coalesce(F.exists(v, lambda x: x.isNull()) | (F.size(v) == 0), F.lit(True))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), bad.alias("bad"),
                     F.col(text_col).alias("line"))
    if strict:
        vv = F.when(F.col("bad"), F.raise_error(F.concat(F.lit("bad vector line: "), F.coalesce(F.col("line"), F.lit("NULL"))))) \
              .otherwise(F.col("v"))
        return rows.select("id", vv.cast("array<double>").alias("v"), F.lit(1).cast("long").alias("w"))
    return rows.where(~F.col("bad")).select("id", "v", F.lit(1).cast("long").alias("w"))


def rejected_point_lines(df: DataFrame, text_col: str = "value",
                         id_col: str | None = None) -> DataFrame:
    """``id, line``: the lines ``strict=False`` drops (a token Java cannot
    parse, e.g. from a doubled blank, or no token at all), with the ids that
    :func:`points_from_lines` gives."""
    if id_col is None:
        df = content_ids(df, text_col, "__line_id")
        id_col = "__line_id"
    v = _vector_of(F.col(text_col))
    bad = F.coalesce(F.exists(v, lambda x: x.isNull()) | (F.size(v) == 0), F.lit(True))
    return df.where(bad).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("line"))


def read_points(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Points of a text file, one vector per line."""
    return points_from_lines(spark.read.text(path), "value", None, strict)


def vector_col(df: DataFrame, vec_col: str) -> Column:
    """The vector column as ``array<float>`` (kept) or ``array<double>``."""
    t = df.schema[vec_col].dataType
    if getattr(t, "elementType", None) == T.FloatType():
        return F.col(vec_col)
    return F.col(vec_col).cast("array<double>")


def points_from(df: DataFrame, id_col: str, vec_col: str, weight_col: str | None = None,
                part_col: str | None = None) -> DataFrame:
    """Points from a table with an array column: ``[part,] id, v, w``.

    A float32 vector column stays float32 (half the bytes to cache and to
    ship to the kernels, which widen each batch exactly to float64); any
    other element type becomes double.
    """
    cols = []
    if part_col is not None:
        cols.append(F.col(part_col).cast("int").alias("part"))
    cols += [F.col(id_col).cast("long").alias("id"),
             vector_col(df, vec_col).alias("v"),
             (F.col(weight_col) if weight_col else F.lit(1)).cast("long").alias("w")]
    return df.select(*cols)
