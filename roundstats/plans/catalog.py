"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed over whole tables. Their SQL twins live in :mod:`.oracle`.

Inputs (FIXTURES.md): numbers from ``customer.c_acctbal`` (id = c_custkey)
and ``lineitem.l_quantity``; number tokens from ``part`` rows; documents
from ``documents``; points from ``embeddings``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundstats.functions.columns import distance
from roundstats.operators import numbers as N
from roundstats.operators import sampling as S
from roundstats.operators import vectors as V
from roundstats.operators import words as W
from roundstats.operators.parts import spread
from roundstats.plans import clustering as C
from roundstats.plans import reports as R
from roundstats.sources import documents_from, numbers_from, points_from, points_from_lines, table

# Fixed parameters of the registered queries.
WORD_PARTS = 4       # K of the word counts
WORD_SEED = 7        # seed of the random group keys
PICK_AT = 100        # position picked from the numbered sort
N_CENTERS = 4        # fixed center set of the vector queries: ids below this
SEED = 7             # seed of every clustering query
CLUSTER_K = 4        # k of the one-problem clustering
CLUSTER_ITERS = 2    # Lloyd rounds of the one-problem clustering
MR_K = 3             # k of the three-round method
MR_PARTS = 4         # parts (L) of the three-round method
MR_ITERS = 1         # Lloyd rounds of the three-round method


def _acctbal(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"),
                                               F.col("c_acctbal").alias("v"))


def _nonneg_acctbal(spark, sf):
    return N.nonneg(_acctbal(spark, sf), "v")


def _docs(spark, sf):
    return spread(documents_from(table(spark, sf, "documents"), "text", "doc_id"), "doc_id")


def _part_lines(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    F.concat_ws(" ", F.col("p_size").cast("string"), F.col("p_name"),
                                F.col("p_retailprice").cast("string")).alias("line"))


# ---------------------------------------------------------------- numbers --

def q_nonneg_filter(spark, sf):
    return _nonneg_acctbal(spark, sf)


def q_parse_number_tokens(spark, sf):
    return numbers_from(_part_lines(spark, sf), "line", "id", strict=False)


def q_parse_numbers_strict(spark, sf):
    # Every token of these lines is a number; the line key is (order, line).
    li = table(spark, sf, "lineitem")
    lines = li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
                      F.concat_ws(" ", *[F.col(c).cast("string") for c in
                                         ("l_orderkey", "l_linenumber", "l_quantity", "l_discount")])
                      .alias("line"))
    return numbers_from(lines, "line", "id", strict=True)


def q_squares(spark, sf):
    return N.squares(_acctbal(spark, sf), "v", "sq")


def q_sum_of_squares(spark, sf):
    q = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("v"))
    return N.sum_of_squares(q, "v")


def q_max_value(spark, sf):
    return N.max_value(_acctbal(spark, sf), "v")


def q_min_value(spark, sf):
    return N.min_value(_acctbal(spark, sf), "v")


def q_mean_value(spark, sf):
    return N.mean_value(_acctbal(spark, sf), "v").select(F.round("mean_v", 6).alias("mean_v"))


def q_row_count(spark, sf):
    return N.row_count(table(spark, sf, "lineitem"))


def q_max_by_key(spark, sf):
    return N.max_by_key(_acctbal(spark, sf), ["v", "id"], ["id", "v"])


def q_min_by_key(spark, sf):
    return N.min_by_key(_acctbal(spark, sf), ["v", "id"], ["id", "v"])


def q_minmax_normalize(spark, sf):
    return N.minmax_normalize(_nonneg_acctbal(spark, sf), "v", "nv")


def q_sort_with_index(spark, sf):
    return N.sort_with_index(_nonneg_acctbal(spark, sf), ["v", "id"], "idx")


def q_pick_at(spark, sf):
    return N.pick_rank(_nonneg_acctbal(spark, sf), ["v", "id"], PICK_AT)


def q_lower_median(spark, sf):
    nv = N.minmax_normalize(_nonneg_acctbal(spark, sf), "v", "nv")
    return N.lower_median(nv, "nv", method="select")


def q_lower_median_sorted(spark, sf):
    nv = N.minmax_normalize(_nonneg_acctbal(spark, sf), "v", "nv")
    return N.lower_median(nv, "nv", method="sort")


def q_lower_median_quantity(spark, sf):
    q = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("v"))
    return N.lower_median(q, "v", method="select")


def q_merge_means(spark, sf):
    # Partial means of c_acctbal per nation, merged back into one mean.
    c = table(spark, sf, "customer")
    parts = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("avg"),
                                         F.count(F.lit(1)).alias("n"))
    m = N.merge_means(parts, "avg", "n")
    return m.select(F.round("avg", 6).alias("avg"), "n")


def q_number_report(spark, sf):
    return R.number_report(_acctbal(spark, sf), "v")


# ------------------------------------------------------------------ words --

def q_tokens(spark, sf):
    return W.tokens(_docs(spark, sf))


def q_doc_word_counts(spark, sf):
    return W.doc_word_counts(_docs(spark, sf))


def q_word_count(spark, sf):
    return W.word_count(_docs(spark, sf))


def q_group_word_counts(spark, sf):
    return W.group_word_counts(_docs(spark, sf), WORD_PARTS, WORD_SEED)


def q_word_count_salted(spark, sf):
    return W.word_count_salted(_docs(spark, sf), WORD_PARTS, WORD_SEED)


def q_partition_word_counts(spark, sf):
    return W.partition_word_counts(_docs(spark, sf), WORD_PARTS, "mod")


def q_word_count_by_part(spark, sf):
    return W.word_count_by_part(_docs(spark, sf), WORD_PARTS, "mod")


def q_word_count_by_part_local(spark, sf):
    return W.word_count_by_part(_docs(spark, sf), WORD_PARTS, "mod", relayout=True)


def q_distinct_words(spark, sf):
    return W.distinct_words(W.word_count(_docs(spark, sf)))


def q_word_count_lines(spark, sf):
    lines = documents_from(table(spark, sf, "documents"), "text", "doc_id", per_line=True)
    return W.word_count(lines)


def q_avg_word_length(spark, sf):
    return W.avg_word_length(_docs(spark, sf))


def q_word_lengths(spark, sf):
    return W.word_lengths(W.word_count(_docs(spark, sf)))


def q_word_report(spark, sf):
    return R.word_report(_docs(spark, sf), WORD_PARTS, WORD_SEED, "mod")


def q_compare_word_counts(spark, sf):
    return W.compare_word_counts(_docs(spark, sf), WORD_PARTS, WORD_SEED, "mod")


# ---------------------------------------------------------------- vectors --

def _points(spark, sf):
    return spread(points_from(table(spark, sf, "embeddings"), "vec_id", "embedding"), "id")


def _wpoints(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("w", F.col("label") + 1)
    return spread(points_from(e, "vec_id", "embedding", "w"), "id")


def _fixed_centers(pts):
    return pts.where(F.col("id") < N_CENTERS).select(F.col("id").cast("int").alias("center_id"), "v")


def _round_vec(c, places=6):
    return F.transform(c, lambda x: F.round(x, places))


def q_parse_points(spark, sf):
    e = table(spark, sf, "embeddings")
    lines = e.select(F.col("vec_id").alias("id"), F.concat_ws(" ", F.transform(
        F.col("embedding").cast("array<double>"), lambda x: x.cast("string"))).alias("line"))
    return points_from_lines(lines, "line", "id", strict=True)


def q_pair_distance(spark, sf):
    pts = _points(spark, sf)
    # The reference point is one row: its vector becomes a literal.
    ref = pts.where(F.col("id") == 0).select("v").first()["v"]
    lit = F.array(*[F.lit(float(x)) for x in ref])
    return pts.select("id", F.round(distance(F.col("v"), lit), 9).alias("d"))


def q_assign(spark, sf):
    pts = _points(spark, sf)
    return V.assign(pts, _fixed_centers(pts)).select("id", "center_id", F.round("d", 9).alias("d"))


def q_nearest_distance(spark, sf):
    pts = _points(spark, sf)
    return V.nearest_distance(pts, _fixed_centers(pts)).select("id", F.round("d", 9).alias("d"))


def q_cluster_weights(spark, sf):
    pts = _points(spark, sf)
    return V.cluster_weights(pts, _fixed_centers(pts))


def q_avg_distance(spark, sf):
    pts = _points(spark, sf)
    return V.avg_distance(pts, _fixed_centers(pts)).select(F.round("objective", 6).alias("objective"))


def q_weighted_centroids(spark, sf):
    pts = _wpoints(spark, sf)
    return V.weighted_centroids(pts, _fixed_centers(pts), w_col="w").select(
        "center_id", "w", _round_vec(F.col("v")).alias("v"))


def q_pick_uniform(spark, sf):
    return S.pick_uniform(_points(spark, sf), SEED, 0).select("id")


def q_pick_weighted(spark, sf):
    return S.pick_weighted(_wpoints(spark, sf), "w", SEED, 1).select("id")


def q_update_nearest(spark, sf):
    pts = _points(spark, sf).withColumn("part", F.lit(0))
    seeds = C.seed_rows(pts, 2, SEED)
    state = S.start_nearest(pts)
    for p, _, i, v in seeds:
        state = S.update_nearest(state, [(p, i, v)])
    chosen = [i for _, _, i, _ in seeds]
    return state.select("id", F.round("d", 9).alias("d"), F.col("id").isin(chosen).alias("chosen"))


def q_seed_centers(spark, sf):
    return C.seed_centers(_points(spark, sf), CLUSTER_K, SEED).select("center_id", "id")


def q_lloyd(spark, sf):
    pts = _wpoints(spark, sf)
    c = C.run_clustering(pts, CLUSTER_K, CLUSTER_ITERS, SEED)
    return V.centers_frame(spark, c, with_part=False).select("center_id", _round_vec(F.col("v")).alias("v"))


def q_cluster_objective(spark, sf):
    pts = _points(spark, sf)
    centers = C.cluster(pts, CLUSTER_K, CLUSTER_ITERS, SEED)
    return V.avg_distance(pts, centers).select(F.round("objective", 6).alias("objective"))


def q_coreset(spark, sf):
    cs = C.coreset(_points(spark, sf), MR_K, MR_PARTS, MR_ITERS, SEED, method="mod")
    return cs.select("part", "center_id", "id", "w", _round_vec(F.col("v")).alias("v"))


def q_coreset_iter0(spark, sf):
    cs = C.coreset(_points(spark, sf), MR_K, MR_PARTS, 0, SEED, method="mod")
    return cs.select("part", "center_id", "id", "w", _round_vec(F.col("v")).alias("v"))


def q_recluster_coreset(spark, sf):
    cs = C.coreset(_points(spark, sf), MR_K, MR_PARTS, MR_ITERS, SEED, method="mod").where(F.col("w") > 0)
    centers = C.cluster(cs.select("id", "v", "w"), MR_K, MR_ITERS, SEED, rows=MR_K * MR_PARTS)
    return centers.select("center_id", _round_vec(F.col("v")).alias("v"))


def q_objective_by_part(spark, sf):
    pts = _points(spark, sf)
    parted = pts.withColumn("part", F.pmod(F.col("id"), F.lit(MR_PARTS)).cast("int"))
    o = C.objective_by_part(parted, _fixed_centers(pts))
    return o.select(F.round("objective", 6).alias("objective"), "n")


def q_mr_cluster(spark, sf):
    r = C.mr_cluster(_points(spark, sf), MR_K, MR_PARTS, MR_ITERS, SEED, method="mod")
    return r.select("n_points", "k", "parts", "iters", F.round("objective", 6).alias("objective"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "nonneg_filter": q_nonneg_filter,
    "parse_number_tokens": q_parse_number_tokens,
    "parse_numbers_strict": q_parse_numbers_strict,
    "squares": q_squares,
    "sum_of_squares": q_sum_of_squares,
    "max_value": q_max_value,
    "min_value": q_min_value,
    "mean_value": q_mean_value,
    "row_count": q_row_count,
    "max_by_key": q_max_by_key,
    "min_by_key": q_min_by_key,
    "minmax_normalize": q_minmax_normalize,
    "sort_with_index": q_sort_with_index,
    "pick_at": q_pick_at,
    "lower_median": q_lower_median,
    "lower_median_sorted": q_lower_median_sorted,
    "lower_median_quantity": q_lower_median_quantity,
    "merge_means": q_merge_means,
    "number_report": q_number_report,
    "tokens": q_tokens,
    "doc_word_counts": q_doc_word_counts,
    "word_count": q_word_count,
    "group_word_counts": q_group_word_counts,
    "word_count_salted": q_word_count_salted,
    "partition_word_counts": q_partition_word_counts,
    "word_count_by_part": q_word_count_by_part,
    "word_count_by_part_local": q_word_count_by_part_local,
    "distinct_words": q_distinct_words,
    "word_count_lines": q_word_count_lines,
    "avg_word_length": q_avg_word_length,
    "word_lengths": q_word_lengths,
    "compare_word_counts": q_compare_word_counts,
    "word_report": q_word_report,
    "parse_points": q_parse_points,
    "pair_distance": q_pair_distance,
    "assign": q_assign,
    "nearest_distance": q_nearest_distance,
    "cluster_weights": q_cluster_weights,
    "avg_distance": q_avg_distance,
    "weighted_centroids": q_weighted_centroids,
    "pick_uniform": q_pick_uniform,
    "pick_weighted": q_pick_weighted,
    "update_nearest": q_update_nearest,
    "seed_centers": q_seed_centers,
    "lloyd": q_lloyd,
    "cluster_objective": q_cluster_objective,
    "coreset": q_coreset,
    "coreset_iter0": q_coreset_iter0,
    "recluster_coreset": q_recluster_coreset,
    "objective_by_part": q_objective_by_part,
    "mr_cluster": q_mr_cluster,
}
