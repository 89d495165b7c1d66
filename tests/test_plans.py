"""Plan properties the design relies on (checked on sf0.001 plans)."""

import __spark_entry__ as E
from conftest import SF_SMALL
from roundstats.operators import numbers as N
from roundstats.operators import words as W
from roundstats.sources import documents_from, table


def physical(df) -> str:
    # The plan AQE starts from (final plans only exist after execution).
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    plan = physical(E.queries()["nonneg_filter"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


def test_word_count_one_exchange_with_partial_aggregate(spark):
    docs = documents_from(table(spark, SF_SMALL, "documents"))
    plan = physical(W.word_count(docs))
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert "ReadSchema: struct<text:string>" in plan   # doc_id pruned


def test_two_round_methods_have_two_exchanges(spark):
    docs = documents_from(table(spark, SF_SMALL, "documents"))
    assert physical(W.word_count_salted(docs, 4, 1)).count("Exchange") == 2
    assert physical(W.word_count_by_part(docs, 4)).count("Exchange") == 2


def test_doc_counts_reuse_doc_partitioning(spark):
    docs = documents_from(table(spark, SF_SMALL, "documents")).repartition(4, "doc_id")
    assert physical(W.doc_word_counts(docs)).count("Exchange") == 1   # the repartition only


def test_no_cross_join_or_global_window(spark):
    q = E.queries()
    for name in ("minmax_normalize", "number_report", "lower_median", "sort_with_index", "pick_at",
                 "assign", "cluster_weights", "mr_cluster"):
        plan = physical(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    # sort_with_index's only window is over one row per partition (the
    # offsets), fed by an aggregate, never over the data itself.
    plan = physical(N.sort_with_index(table(spark, SF_SMALL, "customer")
                                      .selectExpr("c_custkey AS id", "c_acctbal AS v"), ["v", "id"]))
    assert "RangePartitioning" not in plan   # the range sort was checkpointed first
    assert "BroadcastHashJoin" in plan


def test_vector_kernels_are_arrow_batches(spark):
    plan = physical(E.queries()["assign"](spark, SF_SMALL))
    assert "MapInArrow" in plan or "PythonMapInArrow" in plan
    assert "BatchEvalPython" not in plan   # no row-at-a-time Python UDF
