"""End-to-end reports: each reference program's printed results as one
DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundstats.operators import numbers as N
from roundstats.operators import words as W


def number_report(df: DataFrame, col: str = "v", mean_places: int | None = 6) -> DataFrame:
    """Program 1: one row ``n, max_v, max_by_order, min_v, median_nv, mean_nv``.

    Non-negative values only; the maximum twice (plain aggregate and by an
    order key), then the lower median and the mean of the values normalised
    to [0, 1]. Normalising is monotonic, so the median of the normalised
    values is the normalised median, and the mean is normalised the same
    way: no normalised copy of the data is built. Jobs: the median's
    selection rounds (a few small aggregates) and one final aggregate.
    """
    vals = N.nonneg(df.select(F.col(col).cast("double").alias("v")), "v")
    med, n = N.lower_median_value(vals, "v")
    if n == 0:
        # As the reference: a run needs at least one non-negative number.
        raise ValueError("no non-negative numbers in the input")
    lo, hi = F.col("min_v"), F.col("max_v")
    span = F.when(hi > lo, hi - lo)
    mean_nv = (F.col("mean_v") - lo) / span
    if mean_places is not None:
        mean_nv = F.round(mean_nv, mean_places)
    return (vals.agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("max_v"),
                     F.max_by("v", "v").alias("max_by_order"), F.min("v").alias("min_v"),
                     F.avg("v").alias("mean_v"))
            .select("n", "max_v", "max_by_order", "min_v",
                    ((F.lit(med).cast("double") - lo) / span).alias("median_nv"),
                    mean_nv.alias("mean_nv")))


def word_report(docs: DataFrame, k: int, seed: int = 0, method: str = "hash",
                utf16: bool = False) -> DataFrame:
    """Program 2: ``method, n_docs, n_words, avg_len`` for the three word
    counts; the document count is one aggregate, used as a scalar."""
    n_docs = docs.agg(F.count(F.lit(1))).first()[0]
    rows = W.compare_word_counts(docs, k, seed, method, utf16=utf16)
    return rows.select("method", F.lit(n_docs).cast("long").alias("n_docs"), "n_words", "avg_len")
