"""Registered queries of the text operators: thin calls of the operators over
whole tables, with the columns the callers expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundstats.llm import (
    centroids, decontam, fill_middle, langid, merkle, mixing, quality, secret_scan, setsketch, sharding, simhash, suffix_dedup,
    surrogates,
)
from roundstats.llm.common import held_out
from roundstats.llm.oracle import ORACLE_SQL
from roundstats.sources import table


def op1_bm25_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_sparse_suffix_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    return surrogates.replace_personal_data(table(spark, sf, "documents"), key="corpus key 1")


def op4_linked_secrets(spark: SparkSession, sf: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex",
                      F.sha2(secret_scan.joined(F.col("base")), 256).alias("base_sha256"),
                      secret_scan.joined(F.col("all")).alias("spans"), "n_linked")


def op5_merkle_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    both = merkle.neighbours(table(spark, sf, "documents"))
    trees = both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        merkle.tree(F.col("text")).alias("own"), merkle.tree(F.col("edited")).alias("other"), "next_fingerprint", "next_leaves")
    roots = trees.select(
        "*", merkle.sections(F.col("own")).alias("tree"), merkle.sections(F.col("other")).alias("edited_tree"),
        merkle.leaves(F.col("own")).alias("leaves"), merkle.leaves(F.col("other")).alias("edited_leaves")) \
        .withColumn("fingerprint", merkle.root(F.col("tree"))) \
        .withColumn("edited_fingerprint", merkle.root(F.col("edited_tree")))
    c = F.col
    return roots.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        merkle.likeness(c("fingerprint"), c("leaves"), c("edited_fingerprint"), c("edited_leaves")).alias("near_edited"),
        merkle.likeness(c("fingerprint"), c("leaves"), c("next_fingerprint"), c("next_leaves")).alias("near_next"),
        F.size(merkle.edited_paragraphs(c("tree"), c("edited_tree"))).alias("edited_paragraphs"))


def op6_simhash_golay(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), size=3, max_bits=2)


def op7_factorisation_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    machine = quality.fit(docs, labels.where(~held_out()), "quality", metadata=("n_chars",))
    return quality.score(docs, machine, metadata=("n_chars",)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_bounded_ring_shards(spark: SparkSession, sf: str) -> DataFrame:
    out = sharding.assign_shards(table(spark, sf, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_centroid_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.where(~held_out()))
    out = langid.identify(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


# Domains: quality and toxicity as labelled. Good clean text keeps its tokens
# and makes up most of the mixture; the others are thinned to small shares.
DOMAIN = "concat('quality', quality, 'toxic', toxic)"
LEAD = "quality1toxic0"
LIFT = 1.02          # keeps the rates of clearly clean documents at 1 or above
SHARES = {"quality1toxic0": 0.93, "quality1toxic1": 0.02, "quality0toxic0": 0.04, "quality0toxic1": 0.01}


def op10_soft_membership_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "labels"), DOMAIN, SHARES, LEAD, LIFT)


def op11_setsketch_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf, "documents"), size=4, percent=80)


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    out = fill_middle.fill_in_middle(table(spark, sf, "documents"))
    restored = fill_middle.restore(F.col("form"), F.col("output"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored, 256).alias("restored_sha256"))


def op13_bisector_centroids(spark: SparkSession, sf: str) -> DataFrame:
    out = centroids.cluster(table(spark, sf, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_bm25_decontamination, op2_sparse_suffix_repeats, op3_pii_surrogates, op4_linked_secrets,
    op5_merkle_fingerprints, op6_simhash_golay, op7_factorisation_quality, op8_bounded_ring_shards,
    op9_centroid_language, op10_soft_membership_mixing, op11_setsketch_near_duplicates, op12_fill_in_middle,
    op13_bisector_centroids)}

__all__ = ["ORACLE_SQL", "QUERIES"]
