import pytest

from pyspark.sql import functions as F

from roundstats.functions import java_length, java_split
from roundstats.operators import words as W
from roundstats.operators.parts import spread, with_parts
from roundstats.sources import documents_from, read_documents, text
from roundstats.sources.text import content_ids

EDGE = [(1, ""), (2, "  "), (3, "a  b  "), (4, " a"), (5, "x y x"), (6, None)]


def test_java_split_edge_rows(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    got = {r["doc_id"]: r["t"] for r in df.select("doc_id", java_split("text").alias("t")).collect()}
    assert got[1] == [""]
    assert got[2] == []
    assert got[3] == ["a", "", "b"]
    assert got[4] == ["", "a"]
    assert got[5] == ["x", "y", "x"]
    assert got[6] is None


def test_doc_word_counts(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    got = sorted(tuple(r) for r in W.doc_word_counts(df).collect())
    assert got == [(1, "", 1), (3, "", 1), (3, "a", 1), (3, "b", 1), (4, "", 1), (4, "a", 1),
                   (5, "x", 2), (5, "y", 1)]


@pytest.mark.parametrize("k", [1, 3, 12])
def test_three_methods_agree(spark, k):
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{(i * j) % 13}" for j in range(i % 9 + 1))) for i in range(50)],
        "doc_id long, text string")
    a = sorted(tuple(r) for r in W.word_count(docs).collect())
    b = sorted(tuple(r) for r in W.word_count_salted(docs, k, seed=3).collect())
    c = sorted(tuple(r) for r in W.word_count_by_part(docs, k).collect())
    assert a == b == c
    rep = W.compare_word_counts(docs, k, seed=3).collect()
    assert len({(r["n_words"], r["avg_len"]) for r in rep}) == 1
    groups = W.group_word_counts(docs, k, seed=3).collect()
    assert all(0 <= r["group_id"] < k for r in groups)


def test_lengths_code_points_and_utf16(spark):
    df = spark.createDataFrame([("a\U0001F600b",)], "word string")
    r = df.select(java_length("word").alias("cp"), java_length("word", utf16=True).alias("u")).first()
    assert (r["cp"], r["u"]) == (3, 4)


def test_documents_per_line_hadoop_rules(spark):
    df = spark.createDataFrame([(1, "a b\r\nc\n\nd\n"), (2, "")], "doc_id long, text string")
    got = [r["text"] for r in documents_from(df, per_line=True).orderBy("doc_id", "line").collect()]
    assert got == ["a b", "c", "", "d"]


def test_read_documents_text_file(spark, tmpdir_text):
    path = tmpdir_text("d.txt", "the cat\nthe dog the\n")
    wc = {r["word"]: r["n"] for r in W.word_count(read_documents(spark, path)).collect()}
    assert wc == {"the": 3, "cat": 1, "dog": 1}
    st = W.avg_word_length(read_documents(spark, path)).first()
    assert st["n_words"] == 3 and st["avg_len"] == pytest.approx(3.0)


def test_salted_groups_stable_across_layouts(spark):
    docs = spark.createDataFrame([(i, f"a b c{i % 4}") for i in range(40)], "doc_id long, text string")
    one = sorted(tuple(r) for r in W.group_word_counts(docs.repartition(1), 5, 9).collect())
    many = sorted(tuple(r) for r in W.group_word_counts(docs.repartition(7), 5, 9).collect())
    assert one == many


def test_partition_counts_sum_to_total(spark):
    docs = spark.createDataFrame([(i, "x " * (i % 5) + "y") for i in range(30)], "doc_id long, text string")
    tot = W.partition_word_counts(docs, 4).agg(F.sum("c")).first()[0]
    assert tot == W.tokens(docs).count()


def test_relayout_spreads_each_part(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3}") for i in range(400)], "doc_id long, text string")
    plan = W.partition_word_counts(docs, 4, relayout=True)._jdf.queryExecution().executedPlan().toString()
    # The texts move once, then a task's counts merge per (part, word).
    assert plan.count("Exchange") == 2 and "partial_count" in plan
    laid = with_parts(docs, 4, "doc_id", relayout=True)
    at = laid.select("part", F.spark_partition_id().alias("task")).distinct().collect()
    width = max(4, spark.sparkContext.defaultParallelism)
    assert len({r["task"] for r in at}) >= width
    assert all(len({r["task"] for r in at if r["part"] == p}) > 1 for p in range(4))
    one, two = (sorted(tuple(r) for r in W.partition_word_counts(docs, 4, relayout=x).collect()) for x in (False, True))
    assert one == two
    a = sorted(tuple(r) for r in W.word_count_by_part(docs, 4, relayout=True).collect())
    assert a == sorted(tuple(r) for r in W.word_count(docs).collect())


def test_spread_only_when_needed(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, "id", 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert spread(many, "id", 4) is many


def jobs_of(spark, group, fn):
    """Spark jobs that ``fn`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_spread_runs_no_job(spark):
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("id")).count()
    assert jobs_of(spark, "spread-agg", lambda: spread(counted, "id", 64)) == 0
    laid = spread(spark.range(100).coalesce(1), "id", 4)
    assert jobs_of(spark, "spread-twice", lambda: spread(laid, "id", 64)) == 0
    assert spread(laid, "id", 64) is laid
    assert jobs_of(spark, "spread-sees-jobs", lambda: counted.count()) > 0


def test_document_ids_do_not_follow_the_splits(spark, tmpdir_text):
    path = tmpdir_text("docs.txt", "".join(f"word{i % 300} and\n" for i in range(2000)) + "\n" + "same line\n" * 1500)

    def read(size):
        held = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            return sorted(tuple(r) for r in read_documents(spark, path).collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", held)

    whole, cut = read(128 << 20), read(2000)
    assert whole == cut and len(whole) == 3501 and len({i for i, _ in whole}) == 3501


def test_hot_lines_are_numbered_in_blocks(spark, monkeypatch):
    lines = spark.createDataFrame([("a",)] * 25 + [("b",)] * 4 + [("c",), (None,), (None,)], "value string").repartition(3)
    whole = sorted(map(str, content_ids(lines, "value", "id").collect()))
    monkeypatch.setattr(text, "COPY_BLOCK", 4)
    blocks = content_ids(lines, "value", "id").collect()
    assert sorted(map(str, blocks)) == whole
    assert len({r["id"] for r in blocks}) == len(blocks) == 32
    assert content_ids(lines.limit(0), "value", "id").count() == 0


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_only_repeated_lines_leave_their_scan(spark, most):
    from collections import Counter

    rows = [f"line {i}" for i in range(500)] + ["twice"] * 2 + [None] * 3 + ["hot"] * 400 + ["", " "]
    lines = spark.createDataFrame([(r,) for r in rows], "value string").repartition(5)
    got = [tuple(r) for r in content_ids(lines, "value", "id", most).collect()]
    assert Counter(v for _, v in got) == Counter(rows) and len({i for i, _ in got}) == len(rows)
    again = content_ids(lines.repartition(2, "value"), "value", "id", most).collect()
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in again)
    # A line met once is not in any exchange: those carry marks and repeated lines.
    from roundstats.sources.text import repeated_marks
    assert sorted(r["__n"] for r in repeated_marks(lines, "value").collect()) == [2, 3, 400]
    single = spark.range(1000).selectExpr("cast(id as string) AS value")
    plan = content_ids(single, "value", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_unique_lines_are_not_shuffled(spark, tmp_path):
    """Of the plan over repeated lines, the branch of the unique ones has no exchange but the broadcast marks."""
    path = tmp_path / "l.txt"
    path.write_text("\n".join([f"line {i}" for i in range(300)] + ["same"] * 50))
    df = content_ids(spark.read.text(str(path)), "value", "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    once = plan.split("HashAggregate")[0].split("SortAggregate")[0]
    assert "hashpartitioning" not in once and "BroadcastHashJoin" in once


def test_comparison_splits_each_text_once(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3} c {'x ' * (i % 4)}z") for i in range(40)], "doc_id long, text string")
    out = W.compare_word_counts(docs, 4, 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("Expand") == 1
    one = W.avg_word_length(docs).first()
    assert [(r["method"], r["n_words"], r["avg_len"]) for r in out.collect()] == [
        (m, one["n_words"], one["avg_len"]) for m in ("one_round", "random_keys", "by_partition")]
    assert [tuple(r) for r in W.compare_word_counts(docs.limit(0), 4).collect()] == [
        (m, 0, None) for m in ("one_round", "random_keys", "by_partition")]


def test_spread_reads_the_plan_not_its_columns(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(100).select("id", F.lit("x").alias("Exchange")).coalesce(1).write.parquet(path)
    assert spread(spark.read.parquet(path), "id", 4).rdd.getNumPartitions() == 4
    shuffled = spark.range(100).repartition(2, "id")
    assert spread(shuffled, "id", 4) is shuffled
