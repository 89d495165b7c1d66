import math

import pytest
from pyspark.sql import functions as F

from roundstats.operators import numbers as N
from roundstats.sources import numbers_from, read_numbers

TEN = [float(i) for i in range(1, 11)]


def nums(spark, values, parts=3):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double").repartition(parts)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_hand_goldens(spark):
    df = nums(spark, TEN)
    assert one(N.sum_of_squares(df))["sum_sq"] == 385.0
    assert one(N.max_value(df))["max_v"] == 10.0
    assert one(N.min_value(df))["min_v"] == 1.0
    assert one(N.row_count(df))["n"] == 10
    assert one(N.mean_value(df))["mean_v"] == 5.5
    assert one(N.max_by_key(df, ["v"], ["v"]))["v"] == 10.0
    assert one(N.min_by_key(df, ["v"], ["v"]))["v"] == 1.0


def test_normalize_median_mean(spark):
    nv = N.minmax_normalize(nums(spark, TEN), "v", "nv")
    got = sorted((r["v"], r["nv"]) for r in nv.collect())
    assert all(abs(b - (a - 1) / 9) < 1e-15 for a, b in got)
    assert all(0.0 <= b <= 1.0 for _, b in got)
    for method in ("select", "sort"):
        assert one(N.lower_median(nv, "nv", method=method))["median"] == pytest.approx(4 / 9)
    assert one(N.mean_value(nv, "nv"))["mean_v"] == pytest.approx(0.5)


def test_odd_count_median_is_the_middle(spark):
    # The reference returns the maximum here; the true lower median is 0.5.
    nv = N.minmax_normalize(nums(spark, [float(i) for i in range(1, 10)]), "v", "nv")
    for method in ("select", "sort"):
        assert one(N.lower_median(nv, "nv", method=method))["median"] == pytest.approx(0.5)


def test_all_equal_normalizes_to_null(spark):
    nv = N.minmax_normalize(nums(spark, [3.0, 3.0, 3.0]), "v", "nv")
    assert [r["nv"] for r in nv.collect()] == [None, None, None]


def test_read_numbers_rules(spark, tmpdir_text):
    path = tmpdir_text("n.txt", "1.0 2.0\n-3 x\tNaN\n\n4.5\n  7  \n")
    got = sorted(r["v"] for r in read_numbers(spark, path).collect())
    assert got == [1.0, 2.0, 4.5, 7.0]


def test_java_number_grammar(spark):
    lines = spark.createDataFrame(
        [(1, "1.0d 0x1p3 inf nan Infinity +NaN infinity 1_0 1e3 .5 5.  7")], "id long, line string")
    got = [r["v"] for r in numbers_from(lines, "line", "id").orderBy("pos").collect()]
    # Java accepts 1.0d, 0x1p3, Infinity, 1e3, .5, 5.; refuses inf, nan,
    # infinity (lower case) and 1_0; NaN is dropped by the >= 0 filter.
    assert got == [1.0, 8.0, math.inf, 1000.0, 0.5, 5.0, 7.0]


def test_strict_numbers_fail_on_bad_token(spark):
    lines = spark.createDataFrame([(1, "1.0 x")], "id long, line string")
    with pytest.raises(Exception):
        numbers_from(lines, "line", "id", strict=True).collect()
    ok = spark.createDataFrame([(1, "1.0 -2")], "id long, line string")
    assert [r["v"] for r in numbers_from(ok, "line", "id", strict=True).orderBy("pos").collect()] == [1.0, -2.0]


def test_nonneg_drops_nan_and_negatives(spark):
    df = spark.createDataFrame([(1, -1.0), (2, float("nan")), (3, 0.0), (4, 2.0)], "id long, v double")
    assert sorted(r["id"] for r in N.nonneg(df).collect()) == [3, 4]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_sort_with_index_any_layout(spark, parts):
    vals = [float((i * 37) % 11) for i in range(60)]
    df = nums(spark, vals, parts)
    got = N.sort_with_index(df, ["v", "id"], num_partitions=parts).collect()
    want = sorted(range(60), key=lambda i: (vals[i], i))
    assert sorted((r["idx"], r["id"]) for r in got) == list(enumerate(want))
    assert one(N.pick_at(N.sort_with_index(df, ["v", "id"]), 5))["id"] == want[5]


def test_sort_is_as_wide_as_its_rows_need(spark, monkeypatch):
    monkeypatch.setattr(N, "RANGE_ROWS", 10)
    df = nums(spark, [float(i * 7 % 200) for i in range(200)], 2)
    got = N.sort_with_index(df, ["v", "id"])
    assert got.rdd.getNumPartitions() == 20     # more than the session's 8
    assert [r["v"] for r in got.orderBy("idx").collect()] == [float(i) for i in range(200)]


def test_kth_smallest_with_a_hot_value(spark):
    # A third of the rows share one value; ranks on both sides and inside it.
    vals = [5.0] * 400 + [float(i) for i in range(800)]
    df = nums(spark, vals, 5)
    s = sorted(vals)
    for r in (0, 1, 5, 399, 400, 700, 1199):
        assert N.kth_smallest(df, "v", r, buckets=5) == s[r]


def test_kth_smallest_nan_ranks_last(spark):
    df = nums(spark, [1.0, float("nan"), 2.0])
    assert N.kth_smallest(df, "v", 1) == 2.0
    assert math.isnan(N.kth_smallest(df, "v", 2))


def test_merge_means_equals_plain_mean(spark):
    vals = [float(i * i % 17) for i in range(100)]
    df = nums(spark, vals).withColumn("g", F.col("id") % 7)
    parts = df.groupBy("g").agg(F.avg("v").alias("avg"), F.count(F.lit(1)).alias("n"))
    r = one(N.merge_means(parts))
    assert r["avg"] == pytest.approx(sum(vals) / len(vals))
    assert r["n"] == 100
    # Partial means (2.0, n=1) and (5.0, n=2) -> 4.0, n=3.
    pm = spark.createDataFrame([(2.0, 1), (5.0, 2)], "avg double, n long")
    assert tuple(one(N.merge_means(pm))) == (4.0, 3)


def test_java_whitespace_splits_unicode_spaces(spark):
    lines = spark.createDataFrame([(1, "1\u20032\t\u00a0 3\u00a04")], "id long, line string")
    # U+2003 is Java whitespace; U+00A0 (no-break space) is not, so "3 4"
    # is one token that is not a number.
    assert [r["v"] for r in numbers_from(lines, "line", "id").orderBy("pos").collect()] == [1.0, 2.0]


def test_nulls_are_ignored(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 1.0), (4, None), (5, 7.0)], "id long, v double")
    assert one(N.lower_median(df, "v"))["median"] == 4.0
    assert sorted(r["id"] for r in N.nonneg(df).collect()) == [2, 3, 5]
    nv = {r["id"]: r["nv"] for r in N.minmax_normalize(df, "v").collect()}
    assert nv == {1: None, 2: 0.5, 3: 0.0, 4: None, 5: 1.0}
    lines = spark.createDataFrame([(1, None), (2, "3 x 4")], "id long, line string")
    assert [r["v"] for r in numbers_from(lines, "line", "id").orderBy("pos").collect()] == [3.0, 4.0]


def test_rejected_tokens_are_reported(spark):
    from roundstats.sources import rejected_number_tokens

    lines = spark.createDataFrame([(1, "1.0 x inf -2"), (2, "NaN 3 1_0")], "id long, line string")
    got = sorted((r["id"], r["tok"]) for r in rejected_number_tokens(lines, "line", "id").collect())
    assert got == [(1, "inf"), (1, "x"), (2, "1_0")]


def test_kth_smallest_over_heavy_tails(spark):
    inf = float("inf")
    vals = [-inf, -1e308, -3.5, -1e-300, -5e-324, 0.0, -0.0, 5e-324, 1e-310, 1e-300, 1.0, 1.0 + 2**-52, 1.0, 1e17,
            1.7976931348623157e308, inf, inf]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for r, want in enumerate(sorted(vals)):
        assert N.kth_smallest(df, "v", r) == want
    assert N.lower_median_value(df, "v") == (sorted(vals)[8], len(vals))


def test_a_selection_round_sends_one_row_a_bucket_and_task(spark, monkeypatch):
    """Rows that reach the driver do not grow with the distinct values."""
    frame, seen = type(spark.range(1)), []
    collect = frame.collect

    def watch(self):
        seen.append(collect(self))
        return seen[-1]

    monkeypatch.setattr(frame, "collect", watch)
    df = spark.range(200_000).selectExpr("cast(id * 7919 % 200003 as double) / 3 as v")
    assert N.lower_median_value(df, "v", buckets=64)[1] == 200_000
    assert seen and max(map(len, seen)) <= 2 * 64 + 4


def _ordered(rows):
    nan = float("nan")
    key = lambda v: (v is not None, v != v if v is not None else False, 0 if v is None or v != v else v)
    return sorted(rows, key=lambda r: tuple(map(key, r)))


def test_pick_rank_equals_the_sorted_row(spark):
    import random

    from roundstats.operators import numbers as N

    rng = random.Random(11)
    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, -1.5, 2.0, 2.0, 1e-300, 7e18]
    ids = [None, 0, -1, 2 ** 62, -(2 ** 63), 2 ** 53 + 1, 2 ** 53, 5]
    rows = [(rng.choice(values), rng.choice(ids)) for _ in range(120)] + [(2.0, i) for i in range(60)]
    df = spark.createDataFrame(rows, "v double, id long").repartition(3)
    want = _ordered(rows)
    for i in (0, 5, 30, 77, 130, 179):
        got = N.pick_rank(df, ["v", "id"], i).collect()
        assert str([(r["v"], r["id"], r["idx"]) for r in got]) == str([(*want[i], i)])
    assert N.pick_rank(df, ["v", "id"], 180).count() == 0 and N.pick_rank(df, ["v", "id"], -1).count() == 0
    plan = N.pick_rank(df, ["v", "id"], 30)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("values", [[1.0] * 500 + [2.0, 3.0], [i ** 3 / 7 for i in range(-300, 300)], [5e-324, 1e308, 3.0, 3.0]])
def test_selection_reads_its_input_twice_at_most(spark, values):
    from roundstats.operators import numbers as N

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3).mapInArrow(count, "v double")
    for r in (0, len(values) // 2, len(values) - 1):
        before = seen.value
        assert N.kth_smallest(df, "v", r, buckets=8) == sorted(values)[r]
        assert seen.value - before <= 2 * len(values)
