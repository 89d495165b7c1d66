"""Partitioning and reuse.

The reference gives meaning to physical partitions (K document parts, L
point parts). Here a part is an explicit column, so results never hang on
layout, retries or AQE coalescing; the physical layout follows it only
where that saves a shuffle.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def part_of(key, k: int, method: str = "hash") -> Column:
    """Part number in [0, k) for a key column.

    ``hash``: ``pmod(xxhash64(key), k)`` -- spreads any key set evenly.
    ``mod``: ``pmod(key, k)`` -- for integer ids, reproducible in SQL.
    """
    c = F.col(key) if isinstance(key, str) else key
    if k < 1:
        raise ValueError("k must be >= 1")
    if method == "hash":
        return F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    if method == "mod":
        return F.pmod(c.cast("long"), F.lit(k)).cast("int")
    raise ValueError(f"unknown part method {method!r}")


def with_parts(df: DataFrame, k: int, key: str = "id", method: str = "hash",
               out: str = "part", relayout: bool = False) -> DataFrame:
    """Add a part column; with ``relayout`` also lay the rows out by part
    and key (one shuffle), each part over many tasks: a part may be far larger
    than a task, and hashing ``k`` part numbers would leave tasks empty."""
    out_df = df.withColumn(out, part_of(key, k, method))
    return by_part_and_key(out_df, k, out, key) if relayout else out_df


def by_part_and_key(df: DataFrame, k: int, part: str, key: str) -> DataFrame:
    """Hash-partition on part and key, over at least ``k`` partitions and as
    many as the session shuffles into or can run at once."""
    spark = df.sparkSession
    n = max(k, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, part, key)


def keep(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep for reuse (a lost executor's blocks are recomputed from
    lineage; use :func:`cut_lineage` inside long loops)."""
    return df.persist(level)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's reliable checkpoint folder and return a
    frame that reads it back (survives executor loss, truncates lineage)."""
    from roundstats.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def plan_nodes(df: DataFrame) -> list[str]:
    """Class names of the physical plan's nodes, whatever its columns are called."""
    todo, names = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        names.append(node.getClass().getSimpleName())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return names


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when its scan yields fewer partitions
    than the session can run at once (a few large files or row groups);
    otherwise return it unchanged.

    On a cluster reading many files this is a no-op; on a single large file
    it turns one task into ``defaultParallelism`` tasks at the cost of one
    shuffle. A frame that has been shuffled or kept already has a layout and
    stays as it is: counting its partitions would run its shuffles. Hash
    partitioning on a key (not round robin) needs no extra sort to stay
    deterministic under retries.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if any(x.endswith("ExchangeExec") or x in ("AdaptiveSparkPlanExec", "InMemoryTableScanExec")
           for x in plan_nodes(df)):
        return df
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
