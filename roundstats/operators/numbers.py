"""Statistics over a numeric column.

All aggregates are single ``agg`` calls: Spark computes them partially in
every task and merges one small row per task, so nothing but scalars
reaches the driver. Order statistics (lower median, rank lookup) avoid the
single-task ``percentile_disc`` buffer: they either select by exact
counting (a few small aggregates) or number a range-partitioned sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundstats.operators.parts import cut_lineage


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------ projections --

def nonneg(df: DataFrame, col: str = "v") -> DataFrame:
    """keep values >= 0. NaN is dropped too: Java's ``NaN >= 0`` is
    false, while Spark orders NaN above everything (so ``NaN >= 0`` holds)."""
    c = F.col(col)
    return df.where((c >= 0) & ~F.isnan(c))


def squares(df: DataFrame, col: str = "v", out: str = "sq") -> DataFrame:
    """the square of each value."""
    return df.withColumn(out, F.col(col) * F.col(col))


def minmax_normalize(df: DataFrame, col: str = "v", out: str = "nv") -> DataFrame:
    """``(x - min) / (max - min)`` into [0, 1].

    One aggregate brings (min, max) to the driver -- two scalars -- and the
    projection uses them as literals: no window (one task) and no join.
    All-equal input gives NULL, not NaN (0/0).
    """
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    c = F.col(col)
    if lo is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    span = hi - lo
    if span == 0 or math.isnan(span):
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (c - F.lit(float(lo))) / F.lit(float(span)))


# ----------------------------------------------------------- aggregations --

def sum_of_squares(df: DataFrame, col: str = "v") -> DataFrame:
    """A1: one row ``sum_sq``."""
    return df.agg(F.sum(F.col(col) * F.col(col)).alias("sum_sq"))


def max_value(df: DataFrame, col: str = "v") -> DataFrame:
    """A2: one row ``max_v``."""
    return df.agg(F.max(col).alias("max_v"))


def min_value(df: DataFrame, col: str = "v") -> DataFrame:
    """A4: one row ``min_v``."""
    return df.agg(F.min(col).alias("min_v"))


def row_count(df: DataFrame) -> DataFrame:
    """One row ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def mean_value(df: DataFrame, col: str = "v") -> DataFrame:
    """One row ``mean_v``."""
    return df.agg(F.avg(col).alias("mean_v"))


def max_by_key(df: DataFrame, key, cols: list[str] | None = None) -> DataFrame:
    """A3: the row whose order key is largest (a user ordering given as a
    key expression or a list of columns, compared left to right).

    ``max_by`` is a partial aggregate: each task keeps its best row only.
    """
    cols = cols or df.columns
    k = F.struct(*[_c(c) for c in key]) if isinstance(key, (list, tuple)) else _c(key)
    best = df.agg(F.max_by(F.struct(*[F.col(c) for c in cols]), k).alias("__r"))
    return best.select("__r.*")


def min_by_key(df: DataFrame, key, cols: list[str] | None = None) -> DataFrame:
    """A4 with a user ordering: the row whose order key is smallest."""
    cols = cols or df.columns
    k = F.struct(*[_c(c) for c in key]) if isinstance(key, (list, tuple)) else _c(key)
    best = df.agg(F.min_by(F.struct(*[F.col(c) for c in cols]), k).alias("__r"))
    return best.select("__r.*")


def merge_means(df: DataFrame, avg_col: str = "avg", n_col: str = "n") -> DataFrame:
    """Merge partial means ``(avg, n)`` into one ``avg, n`` row:
    ``sum(avg * n) / sum(n)``."""
    a, n = F.col(avg_col), F.col(n_col)
    return df.agg((F.sum(a * n) / F.sum(n)).alias(avg_col), F.sum(n).cast("long").alias(n_col))


# ------------------------------------------------------- order statistics --

# Rows of a range of the global sort.
RANGE_ROWS = 1 << 20


def sort_with_index(df: DataFrame, order_cols: list[str], idx: str = "idx",
                    num_partitions: int | None = None) -> DataFrame:
    """F4 + F5: global ascending sort with a 0-based row number (what
    ``sortBy`` + ``zipWithIndex`` give), without an unpartitioned window.

    1. range-partition on the order columns and sort inside partitions;
    2. write it to the reliable checkpoint folder, fixing the layout;
    3. count rows per partition (one row per partition) and turn them into
       offsets -- a table the size of the partition count, broadcast;
    4. idx = offset of the partition + position inside it.
    """
    spark = df.sparkSession
    if num_partitions is None:
        # As many ranges as the rows need, at least one per core.
        num_partitions = max(-(-df.count() // RANGE_ROWS), spark.sparkContext.defaultParallelism)
    n = num_partitions
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    ranged = cut_lineage(ranged)
    pid = F.spark_partition_id()
    tagged = (ranged.withColumn("__pid", pid)
              .withColumn("__pos", F.monotonically_increasing_id()
                          - F.shiftleft(pid.cast("long"), 33)))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # Unpartitioned window over one row per partition: bounded by n.
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(idx, (F.col("__off") + F.col("__pos")).cast("long"))
            .drop("__pid", "__pos", "__off"))


def pick_at(indexed: DataFrame, i: int, idx: str = "idx") -> DataFrame:
    """the row at 0-based position ``i`` of :func:`sort_with_index`. For one
    position of a frame that is not numbered, see :func:`pick_rank`."""
    return indexed.where(F.col(idx) == F.lit(i))


# Buckets a selection round counts into (on each side of zero in the first).
BUCKETS = 1024


def select_rank(df: DataFrame, col: str, rank, buckets: int = BUCKETS) -> tuple[float | None, int]:
    """Exact value at a 0-based rank among the non-null values of ``col``;
    returns ``(value, n)`` where ``rank(n)`` gave the rank.

    Selection by counting. A round counts the rows of each bucket and keeps
    the smallest and largest value in it; the next round only looks into the
    bucket that holds the rank, until all its values are equal. The first
    round's buckets are cut by sign and logarithm, so heavy tails and
    infinities do not slow it down; the later ones by equal width between the
    window's ends, which land in different buckets, so each window is
    smaller. A few rounds reach the last bit of a double. A task
    sends on at most one row per bucket, however many values it holds. NaN
    ranks above every number, as in Spark's ordering.

    The input is read twice at most: the second pass writes the values of the
    bucket that holds the rank (8 bytes each) to the checkpoint folder, and later
    rounds read only those.
    """
    value, n, _, _ = _select_double(df, col, rank, buckets)
    return value, n


def _select_double(df: DataFrame, col: str, rank, buckets: int = BUCKETS) -> tuple[float | None, int, int, int]:
    """Value, n, and the numbers of smaller and of equal values."""
    x = F.col("v")
    data = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    top = buckets + 1
    # Logarithms of finite doubles lie between -745 and 710.
    size = F.floor((F.log(F.abs(x)) + 746) * (buckets / 1456)) + 1
    bucket = F.when(F.isnan(x), top + 1).when(x == 0, 0) \
        .otherwise(F.signum(x).cast("long") * F.when(F.abs(x) == float("inf"), top).otherwise(size))
    n, r, at, window = None, None, None, data
    while True:
        found = sorted(window.groupBy(bucket.cast("long").alias("b"))
                       .agg(F.count(F.lit(1)), F.min(x), F.max(x)).collect())
        if n is None:
            n = sum(row[1] for row in found)
            r = at = rank(n)
            if r is None or r < 0 or r >= n:
                return None, n, 0, 0
            source = data
        for _, count, lo, hi in found:
            if r < count:
                break
            r -= count
        if lo == hi or lo != lo:
            return lo + 0.0, n, at - r, count
        window = data.where((x >= F.lit(lo)) & (x <= F.lit(hi)))
        if data is source:
            window = data = cut_lineage(window)
        bucket = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * buckets)


def _select_long(df: DataFrame, col: str, rank) -> tuple[int | None, int, int, int]:
    """As :func:`_select_double` for integers, ten bits a round."""
    x = F.col("x")
    data = df.select(F.col(col).cast("long").alias("x")).where(F.col("x").isNotNull())
    n, r, at, window, shift = None, None, None, data, 54
    while True:
        found = sorted(window.groupBy(F.shiftright(x, shift).alias("b"))
                       .agg(F.count(F.lit(1)), F.min(x), F.max(x)).collect())
        if n is None:
            n = sum(row[1] for row in found)
            r = at = rank(n)
            if r is None or r < 0 or r >= n:
                return None, n, 0, 0
        for _, count, lo, hi in found:
            if r < count:
                break
            r -= count
        if lo == hi:
            return lo, n, at - r, count
        kept = data.where(x.between(lo, hi))
        window = data = cut_lineage(kept) if window is data and shift == 54 else kept
        shift = max(0, shift - 10)


def pick_rank(df: DataFrame, order_cols: list[str], i: int, idx: str = "idx") -> DataFrame:
    """F6 without a sort: the row at 0-based position ``i`` of ``df`` in
    ascending order of ``order_cols`` (numbers; nulls first, NaN last), with
    ``idx`` = ``i``; no row if there is none.

    Selection by counting, one order column after the other: the value at the
    rank, then among its ties the next column's, so nothing is shuffled but counts
    of buckets. Ties of the first column are written to the checkpoint folder
    when another has to part them. Rows equal in all order columns are
    alike for a position: one of them is picked.
    """
    window, r = df, i
    for at, c in enumerate(order_cols):
        col = F.col(c)
        nulls = window.where(col.isNull()).count() if window.schema[c].nullable else 0
        if 0 <= r < nulls:
            window, equal = window.where(col.isNull()), nulls
        else:
            integral = window.schema[c].dataType.typeName() in ("byte", "short", "integer", "long")
            if not integral and window.schema[c].dataType.typeName() not in ("double", "float"):
                raise TypeError(f"cannot rank by {c}: {window.schema[c].dataType.simpleString()}")
            pick = _select_long if integral else _select_double
            value, n, below, equal = pick(window, c, lambda n: r - nulls)   # noqa: B023
            if value is None:
                return df.where(F.lit(False)).withColumn(idx, F.lit(i).cast("long"))
            r -= nulls + below
            window = window.where(F.isnan(col) if value != value else col == F.lit(value))
        if equal == 1:
            break
        if at + 1 < len(order_cols):
            window = cut_lineage(window)
    return window.limit(1).withColumn(idx, F.lit(i).cast("long"))


def kth_smallest(df: DataFrame, col: str, r: int, buckets: int = BUCKETS) -> float | None:
    """Exact value of 0-based rank ``r`` among the non-null values
    (see :func:`select_rank`)."""
    return select_rank(df, col, lambda n: r, buckets)[0]


def lower_median_value(df: DataFrame, col: str, buckets: int = BUCKETS) -> tuple[float | None, int]:
    """``(lower median, n)`` by selection; the rank is (n - 1) // 2."""
    return select_rank(df, col, lambda n: (n - 1) // 2 if n else None, buckets)


def lower_median(df: DataFrame, col: str = "v", method: str = "select",
                 out: str = "median") -> DataFrame:
    """The lower median -- the ((n-1)//2)-th smallest value (0-based):
    the middle for odd n, the n/2-th smallest for even n.

    The reference meant this but returns the maximum for odd n (operator
    precedence in its index formula); that bug is not reproduced.

    ``select`` (default) finds it by counting (:func:`kth_smallest`);
    ``sort`` takes the row at the median's position of the sorted values
    (:func:`pick_rank`, which sorts nothing).
    The result is one row.
    """
    data = df.select(F.col(col).cast("double").alias(out)).where(F.col(out).isNotNull())
    if method == "sort":
        n = data.count()
        if n == 0:
            return data.limit(0)
        return pick_rank(data, [out], (n - 1) // 2).select(out)
    if method != "select":
        raise ValueError(f"unknown method {method!r}")
    q, n = lower_median_value(data, out)
    if n == 0:
        return data.limit(0)
    return df.sparkSession.createDataFrame([(q,)], f"`{out}` double")
