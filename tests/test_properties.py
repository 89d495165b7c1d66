"""Property tests (hypothesis): Java split rules, the three word counts,
merged means and normalisation bounds on generated inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundstats.functions import java_split
from roundstats.operators import numbers as N
from roundstats.operators import words as W


def java_split_model(s: str) -> list[str]:
    """Java's String.split(" "): no match gives the string itself; trailing
    empty strings are removed."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


texts = st.lists(st.text(alphabet="ab é\U0001F600", max_size=12), min_size=1, max_size=15)


@settings(max_examples=15, deadline=None)
@given(texts)
def test_java_split_matches_model(spark, ts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "doc_id long, text string")
    got = {r["doc_id"]: r["t"] for r in df.select("doc_id", java_split("text").alias("t")).collect()}
    assert all(got[i] == java_split_model(t) for i, t in enumerate(ts))


@settings(max_examples=8, deadline=None)
@given(texts, st.integers(1, 9), st.integers(0, 5))
def test_word_counts_agree(spark, ts, k, seed):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "doc_id long, text string")
    model: dict[str, int] = {}
    for t in ts:
        for w in java_split_model(t):
            model[w] = model.get(w, 0) + 1
    for wc in (W.word_count(docs), W.word_count_salted(docs, k, seed), W.word_count_by_part(docs, k)):
        assert {r["word"]: r["n"] for r in wc.collect()} == model


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=2, max_size=40), st.integers(1, 6))
def test_merge_means_and_bounds(spark, xs, groups):
    df = spark.createDataFrame([(i, x, i % groups) for i, x in enumerate(xs)], "id long, v double, g long")
    parts = df.groupBy("g").agg(F.avg("v").alias("avg"), F.count(F.lit(1)).alias("n"))
    r = N.merge_means(parts).first()
    assert abs(r["avg"] - sum(xs) / len(xs)) <= 1e-9 * max(1.0, max(xs))
    nv = [row["nv"] for row in N.minmax_normalize(df, "v").collect()]
    assert all(x is None or 0.0 <= x <= 1.0 for x in nv)
    med = N.lower_median(df, "v").first()["median"]
    assert med == sorted(xs)[(len(xs) - 1) // 2]


points_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)),
                     min_size=3, max_size=25)


@settings(max_examples=8, deadline=None)
@given(points_st, st.integers(1, 4), st.integers(0, 2), st.integers(0, 50))
def test_clustering_matches_brute_force_on_grids(spark, pts, k, iters, seed):
    # Integer grids: duplicate points, zero weights and exact distance ties.
    import numpy as np

    import brute
    from roundstats.plans import clustering as C

    rows = [(i, [float(x), float(y)], w) for i, (x, y, w) in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, v array<double>, w long")
    ids = [r[0] for r in rows]
    X = np.array([r[1] for r in rows])
    w = np.array([float(r[2]) for r in rows])
    got = [r[2] for r in C.seed_rows(df, k, seed)]
    want = [ids[i] for i in brute.seeds(ids, X, w, k, seed)]
    assert got == want
    c = C.run_clustering(df, k, iters, seed)
    ref = brute.lloyd(X, w, X[[ids.index(i) for i in want]], iters)
    assert np.allclose(c.vecs[0][: len(want)], ref, atol=1e-12)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=50, max_size=400), st.data())
def test_selection_over_many_rounds(spark, xs, data):
    # Few buckets force several rounds; small
    # integer values give many duplicates (hot values).
    import roundstats.operators.numbers as NM

    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, v double").repartition(3)
    s = sorted(float(x) for x in xs)
    for r in data.draw(st.lists(st.integers(0, len(xs) - 1), min_size=1, max_size=3)):
        assert NM.kth_smallest(df, "v", r, buckets=8) == s[r]
    assert NM.lower_median_value(df, "v", buckets=8)[0] == s[(len(s) - 1) // 2]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=100, max_size=500, unique=True), st.data())
def test_selection_over_many_rounds_distinct(spark, xs, data):
    import roundstats.operators.numbers as NM

    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id long, v double").repartition(4)
    s = sorted(xs)
    for r in data.draw(st.lists(st.integers(0, len(xs) - 1), min_size=1, max_size=3)):
        assert NM.kth_smallest(df, "v", r, buckets=10) == s[r]


def hadoop_lines_model(t: str) -> list[str]:
    """Lines as Hadoop's reader yields them: \\n, \\r\\n or \\r end a line;
    a terminator at the very end opens no further line; '' has none."""
    import re

    if t == "":
        return []
    parts = re.split(r"\r\n|\r|\n", t)
    if re.search(r"(\r\n|\r|\n)\Z", t):
        parts = parts[:-1]
    return parts


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="a \n\r", max_size=10), min_size=1, max_size=12))
def test_per_line_documents_match_model(spark, ts):
    from roundstats.sources import documents_from

    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "doc_id long, text string")
    got = [(r["doc_id"], r["text"]) for r in documents_from(df, per_line=True).orderBy("doc_id", "line").collect()]
    want = [(i, line) for i, t in enumerate(ts) for line in hadoop_lines_model(t)]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=120), st.integers(1, 9), st.data())
def test_sort_with_index_matches_sorted(spark, xs, parts, data):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, v double").repartition(parts)
    got = sorted((r["idx"], r["id"]) for r in N.sort_with_index(df, ["v", "id"], num_partitions=parts).collect())
    want = sorted(range(len(xs)), key=lambda i: (xs[i], i))
    assert got == list(enumerate(want))
    i = data.draw(st.integers(0, len(xs) - 1))
    assert [r["id"] for r in N.pick_at(N.sort_with_index(df, ["v", "id"]), i).collect()] == [want[i]]
