"""A corpus pipeline: five stages over ``documents``, each one operator of
``roundstats.llm`` applied to all that its predecessor kept.

1. language identification: documents whose language is rejected go;
2. SimHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents that hold a test item go;
4. mixing: documents are thinned at rates fitted to bring the domains' tokens
   to their targets; a document is taken once at most, so domains whose rates
   exceed 1 stay below theirs (totals reached and targets are logged);
5. sharding: every document gets a shard and a slot.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the session's shared folder and hands the reread table
on. All stages but the last return the columns of ``documents``; the last adds
``size, text_crc32, shard, slot``. Other columns of the input are kept.

No SQL twin: hashing, search and fitted models have none; the tests hold the
stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roundstats.llm import decontam, langid, mixing, sharding, simhash
from roundstats.llm.common import Stage, held_out
from roundstats.llm.queries import DOMAIN, LEAD, LIFT, SHARES
from roundstats.sources import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs.where(~held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.thin(docs, table(spark, sf_dir, "labels"), DOMAIN, SHARES, LEAD, LIFT)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, shards=16)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the ``documents`` table."""
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        new = stage.write(step(spark, docs, sf_dir))
        if i:
            stage.drop(docs)
        docs = new
    return docs
