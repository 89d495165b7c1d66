"""Sharding by a consistent-hash ring with bounded loads (operator 8).

Each shard owns ``vnodes`` points of a ring. A document's key (its id) hashes
to a place on the ring and goes clockwise to the next point. No shard takes
more rows than its bound; the rows of a stretch that its full shard cannot
take continue clockwise to the next points until a shard has room. With
``slack`` 0 the bounds add up to the number of rows, so the shards' counts
differ by one at most; more slack moves fewer rows when shards change.

The ring has ``shards x vnodes`` stretches whatever the input. Spark counts
rows by stretch; the driver fills the shards from those counts alone and gets
pieces (stretch, first row, last row, shard). A row finds its stretch by an
equi-join on ring cells and its piece by its number inside the stretch, which
is a prefix sum over sub-buckets plus one inside a sub-bucket, so no task
orders a whole stretch. Rows equal in id and text cannot be told apart by
their hash: those of a run of ``2 ** RUN_BITS`` row numbers are counted before
they are shuffled, so a third of all rows may be identical. All tables that are broadcast have sizes fixed by
``shards``, ``vnodes`` and ``SUBS``. Only DataFrame functions are used.

Edge cases: a null text counts no bytes (size 1, checksum 0); a null id is the
key ''; repeated ids share a place on the ring and are told apart by their
texts' checksums (identical rows are interchangeable); an empty table gives no
rows; other columns are neither read nor needed.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundstats.llm.common import Stage, unused

VNODES = 32
SUBS = 64            # sub-buckets of a stretch
RING_BITS = 60
CELL_BITS = 10
RUN_BITS = 12        # rows are numbered in runs of 2 ** RUN_BITS


def ring_points(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(place, shard)`` of every point, in ring order."""
    mask = (1 << RING_BITS) - 1
    return sorted((xxhash.xxh64_intdigest(f"shard {s} point {v}", 42) & mask, s)
                  for s in range(shards) for v in range(vnodes))


def ring_cells(points: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """``(cell, lo, hi, arc)``: the parts of each stretch by ring cell."""
    top, out, lo = (1 << RING_BITS) - 1, [], 0
    spans = []
    for arc, (place, _) in enumerate(points):
        spans.append((lo, place, arc))
        lo = place + 1
    spans.append((lo, top, 0))              # past the last point: round to the first
    shift = RING_BITS - CELL_BITS
    for lo, hi, arc in spans:
        if lo <= hi:
            out += [(c, lo, hi, arc) for c in range(lo >> shift, (hi >> shift) + 1)]
    return out


def bounds(n: int, points: list[tuple[int, int]], slack: float) -> dict[int, int]:
    """Rows each shard may take. Without slack they add up to ``n``; the
    shards met first on the ring take the remainder."""
    order = list(dict.fromkeys(s for _, s in points))
    if slack > 0:
        return {s: -int(-(1 + slack) * n // len(order)) for s in order}
    return {s: n // len(order) + (i < n % len(order)) for i, s in enumerate(order)}


def fill(points: list[tuple[int, int]], counts: list[int], room: dict[int, int]
         ) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(arc, first, end, shard, slot of the first)``. Shards first take
    the rows of their own stretches in ring order, then those that overflow
    walk on clockwise."""
    room, taken, pieces, over = dict(room), dict.fromkeys(room, 0), [], []

    def take(arc, lo, hi, shard):
        n = min(hi - lo, room[shard])
        if n > 0:
            pieces.append((arc, lo, lo + n, shard, taken[shard]))
            room[shard] -= n
            taken[shard] += n
        return lo + max(n, 0)

    for arc, (_, shard) in enumerate(points):
        lo = take(arc, 0, counts[arc], shard)
        if lo < counts[arc]:
            over.append((arc, lo))
    for arc, lo in over:
        step = 1
        while lo < counts[arc]:
            lo = take(arc, lo, counts[arc], points[(arc + step) % len(points)][1])
            step += 1
    return pieces


def assign_shards(docs: DataFrame, shards: int = 16, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    return _assigned(docs, F.monotonically_increasing_id(), shards, vnodes, slack).drop("row")


def shard_documents(docs: DataFrame, shards: int = 16, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """The rows of ``docs`` with ``size, text_crc32, shard, slot`` added (names
    that ``docs`` has already get underscores). Rows are written with a number
    each, by which they meet their shard: ids may be null or repeated. Whole
    rows move once."""
    row = unused("__row", docs)
    rows = Stage(docs.sparkSession, "shard_documents").write(docs.withColumn(row, F.monotonically_increasing_id()))
    new = {c: unused(c, docs) for c in ("size", "text_crc32", "shard", "slot")}
    placed = _assigned(rows, F.col(row), shards, vnodes, slack) \
        .select(F.col("row").alias(row), *[F.col(c).alias(n) for c, n in new.items()])
    return rows.join(placed.hint("shuffle_hash"), row).select(*[f"`{c}`" for c in docs.columns], *new.values())


def _assigned(docs: DataFrame, number: Column, shards: int, vnodes: int, slack: float) -> DataFrame:
    """``row`` (the value of ``number``, distinct by row) and the columns of :func:`assign_shards`."""
    spark = docs.sparkSession
    stage = Stage(spark, "shards")
    points = ring_points(shards, vnodes)
    cells = spark.createDataFrame(ring_cells(points), "cell long, lo long, hi long, arc int")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(number.alias("row"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(key).bitwiseAND(F.lit((1 << RING_BITS) - 1)).alias("place"))
    placed = rows.withColumn("cell", F.shiftright("place", RING_BITS - CELL_BITS)) \
        .join(F.broadcast(cells), "cell").where(F.col("place").between(F.col("lo"), F.col("hi")))
    order = F.xxhash64("place", "text_crc32", "size")
    placed = stage.write(placed.select("row", "doc_id", "size", "text_crc32", "arc", order.alias("order"))
                         .withColumn("sub", F.pmod("order", F.lit(SUBS)).cast("int")))
    counts = stage.write(placed.groupBy("arc", "sub").agg(F.count(F.lit(1)).alias("n")))
    by_arc = [0] * len(points)
    for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect():
        by_arc[r["arc"]] = r["n"]
    pieces = spark.createDataFrame(fill(points, by_arc, bounds(sum(by_arc), points, slack)),
                                   "arc int, first long, end long, shard int, at long")
    before = Window.partitionBy("arc").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("arc", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # Identical rows, however many, reach the window as one row for each run of
    # row numbers; a row's number is its run's start plus its place in the run.
    same = ["order", "doc_id", "size", "text_crc32", "run"]
    runs = placed.withColumn("run", F.shiftright("row", RUN_BITS)).groupBy("arc", "sub", *same) \
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
    earlier = Window.partitionBy("arc", "sub").orderBy(*same).rowsBetween(Window.unboundedPreceding, -1)
    numbered = runs.withColumn("nth", F.coalesce(F.sum(F.size("rows")).over(earlier), F.lit(0))) \
        .join(F.broadcast(starts), ["arc", "sub"]) \
        .select("arc", "doc_id", "size", "text_crc32", (F.col("start") + F.col("nth")).alias("nth"),
                F.posexplode("rows").alias("k", "row")).withColumn("nth", F.col("nth") + F.col("k"))
    return numbered.join(F.broadcast(pieces), "arc") \
        .where((F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("end"))) \
        .select("row", "doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("nth") - F.col("first")).alias("slot"))
