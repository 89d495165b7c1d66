"""Word count over a growing folder of text files (one document per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundstats.functions.columns import java_split


def stream_word_count(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming ``word, n``: every line of every file under ``path`` is a
    document; counts are the running totals (use output mode ``complete``
    or ``update``). State is one row per distinct word, kept by Spark's
    state store and recovered from the query's checkpoint location."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(path)
    return (lines.select(F.explode(java_split(F.col("value"))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
