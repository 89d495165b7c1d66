"""Secret scan with multipart credential linking (operator 4).

Strong patterns are reported wherever they occur: assignments of a value of
six or more characters to a secret's name, access key ids, and long hex runs.
Weak candidates say little alone: account or client ids, short or loosely
named secrets, and endpoints. They are reported only when a complementary part
lies in their scope: at most ``SCOPE`` code points between the two intervals
in one text. Ids and endpoints need a secret (weak or strong); weak secrets
need an id or an endpoint.

The interval join is a semi-join on nearest neighbours: ordered by start, the
largest end of a class so far and, in reverse order, the smallest start still
to come tell whether any part of that class is in scope. A text's parts are
sorted once each way and no pairs are made, however many parts a text holds.
Matches and their positions come from splitting a text by the pattern: a match
starts after the lengths of all pieces and matches before it. Only DataFrame
functions are used; one shuffle moves lengths, no text.

Edge cases: a null text is empty: no spans. Every row of the input gives a row;
repeated rows and ids stay apart. Overlapping parts are zero apart. Equal
starts order by kind as listed. Other columns are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 200
VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)" + VALUE
ACCESS = r"AKIA[A-Z0-9]{16,}"      # as AKIA[A-Z0-9]+ of 20 or more: a shorter run holds no longer match
HEX = r"[0-9a-f]{24,}"             # likewise a whole run
ID = r"(?i)(access_?key_?id|client_?id|user_?name|user|login|account)" + VALUE
KEY = r"(?i)(pwd|pass|auth|credential|private_?key|signature)" + VALUE
# From the first letter of a run of scheme characters (group 1); one try a run.
ENDPOINT = r"""(?i)(?<![a-z0-9+.-])[0-9+.-]*+([a-z][a-z0-9+.-]*+://[^\s"'<>]+)"""

KINDS = ("assign", "access", "hex", "id", "key", "endpoint")     # in listed order
LEAST_VALUE = 6


def _matches(text: Column, kind: str, pattern: str, may: Column | None = None, group: int = 0) -> Column:
    """Matches as ``(kind, i, before, size, value)``: code points since the last
    match, of the match and of its group."""
    re = F.lit(pattern)
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, re, F.lit(0))
    value = F.regexp_extract_all(text, re, F.lit(group))
    rows = F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("a"), whole.alias("b"), value.alias("c")),
                       lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["a"]).alias("before"),
                                             F.length(x["b"]).alias("size"), F.length(x["c"]).alias("value")))
    some = F.size(pieces) > 1
    return F.when(may & some if may is not None else some, rows) \
        .otherwise(F.array().cast("array<struct<kind:string,i:int,before:int,size:int,value:int>>"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id``, counts by kind, and the spans ``base`` and ``all``: arrays of
    ``(start, rank, kind, end)`` by start and listed kind (code points)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = F.concat(_matches(text, "assign", ASSIGN, group=2), _matches(text, "access", ACCESS, F.contains(text, F.lit("AKIA"))),
                     _matches(text, "hex", HEX), _matches(text, "id", ID), _matches(text, "key", KEY),
                     _matches(text, "endpoint", ENDPOINT, F.contains(text, F.lit("://")), group=1))
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"),
                       parts.alias("parts")) \
        .select("doc_id", "h", "row", F.explode_outer("parts").alias("p")).select("doc_id", "h", "row", "p.*") \
        .repartition("doc_id", "h")
    own = ["doc_id", "h", "row"]
    run = Window.partitionBy(*own, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.col("size")).over(run)
    size = F.when(F.col("kind") == "endpoint", F.col("value")).otherwise(F.col("size"))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - size)
    # An assignment of a short value is a weak secret.
    rows = rows.withColumn("kind", F.when((F.col("kind") == "assign") & (F.col("value") < LEAST_VALUE), "key")
                           .otherwise(F.col("kind")))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    rows = rows.withColumn("rank", rank)
    kind = F.col("kind")
    classes = {"ids": kind.isin("access", "id"), "secrets": kind.isin("assign", "hex", "key"), "ends": kind == "endpoint"}
    order = [F.col(c) for c in ("start", "rank", "end")]
    back = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*own).orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    near = {}
    for name, member in classes.items():
        rows = rows.withColumn(f"{name}_before", F.max(F.when(member, F.col("end"))).over(back))
    for name, member in classes.items():
        rows = rows.withColumn(f"{name}_after", F.min(F.when(member, F.col("start"))).over(ahead))
        near[name] = F.coalesce(F.col(f"{name}_before") >= F.col("start") - scope, F.lit(False)) \
            | F.coalesce(F.col(f"{name}_after") <= F.col("end") + scope, F.lit(False))
    strong = kind.isin("assign", "access", "hex")
    linked = (kind.isin("id", "endpoint") & near["secrets"]) | ((kind == "key") & (near["ids"] | near["ends"]))
    span = F.struct("start", "rank", "kind", "end")
    return rows.groupBy(*own).agg(
        *[F.count_if(kind == k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.count_if(linked).alias("n_linked"),
        F.sort_array(F.collect_list(F.when(strong, span))).alias("base"),
        F.sort_array(F.collect_list(F.when(strong | linked, span))).alias("all")).drop("h", "row")


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
