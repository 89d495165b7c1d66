"""Column-level building blocks.

Everything here returns a :class:`pyspark.sql.Column` built from Spark's
own functions, so it stays inside whole-stage codegen (or, for the
higher-order array functions, at least inside the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for equal results)
# ---------------------------------------------------------------------------
# Special spellings Java's Double.parseDouble accepts (optional sign in
# front of Infinity and NaN). Spark's string->double cast additionally
# accepts case-insensitive "inf"/"infinity"/"nan" forms, which Java refuses.
JAVA_NUMBER_SPELLINGS = ("NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity")
SPARK_ONLY_SPECIALS_RE = r"(?i)^[+-]?(inf|infinity|nan)$"
# Java Scanner's default delimiter: one or more Java whitespace characters.
JAVA_WHITESPACE_RE = r"\p{javaWhitespace}+"
# 2^52 + 1: the divisor that maps 13 hex digits of md5 into (0, 1].
UNIFORM_DIVISOR = 4503599627370497.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_split(text) -> Column:
    """``text.split(" ")`` with Java's rules, as an array column.

    Java drops trailing empty strings but keeps inner and leading ones;
    a string without any space (including ``''``) gives itself:
    ``''`` -> ``['']``, ``'  '`` -> ``[]``, ``'a  b  '`` -> ``['a','','b']``,
    ``' a'`` -> ``['','a']``. ``rtrim`` removes exactly the trailing blanks,
    after which Spark's split (limit -1) has no trailing empties to keep.
    """
    t = _c(text)
    r = F.rtrim(t)
    return (F.when(t == F.lit(""), F.array(F.lit("")))
            .when(r == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(r, " ", -1)))


def java_length(word, utf16: bool = False) -> Column:
    """Length of a string: code points (default, as SQL engines count) or
    UTF-16 units (what Java's ``String.length`` returns)."""
    w = _c(word)
    if utf16:
        return (F.octet_length(F.encode(w, "UTF-16BE")) / 2).cast("long")
    return F.length(w).cast("long")


def whitespace_tokens(text) -> Column:
    """Tokens of a line split on Java whitespace, empty tokens removed."""
    parts = F.split(_c(text), JAVA_WHITESPACE_RE, -1)
    return F.filter(parts, lambda s: s != F.lit(""))


def number_token_ok(tok) -> Column:
    """True when Java's parser would also accept the token.

    ``try_cast`` already refuses anything Java refuses except the lower-case
    or abbreviated infinity/NaN spellings; those are excluded here.
    """
    t = _c(tok)
    return ~(t.rlike(SPARK_ONLY_SPECIALS_RE) & ~t.isin(*JAVA_NUMBER_SPELLINGS))


def distance(a, b) -> Column:
    """Euclidean distance of two equal-length double arrays (column form).

    Interpreted higher-order functions; the Arrow kernels in
    :mod:`roundstats.operators.vectors` are the fast path for many points.
    """
    sq = F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def nearest_center(v, centers: list[list[float]]) -> Column:
    """``struct(d, i)``: distance to and position of the nearest of a few
    literal centers; ``array_min`` compares (d, i) left to right, so the
    first position wins ties. JVM-only (no Python worker); the Arrow kernel
    in :mod:`roundstats.operators.vectors` is the fast path."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    return F.array_min(F.transform(
        table, lambda c, i: F.struct(distance(_c(v), c).alias("d"), i.alias("i"))))


def uniform(seed: int, step: int, id_col) -> Column:
    """Seeded uniform draw in (0, 1] for each row, from md5(seed:step:id).

    Depends only on (seed, step, id), so retries, partition layout and AQE
    never change it; DuckDB and NumPy reproduce it bit for bit.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(step)), _c(id_col).cast("string")))
    v = F.conv(F.substring(h, 1, 13), 16, 10).cast("double")
    return (v + F.lit(1.0)) / F.lit(UNIFORM_DIVISOR)


def salt(k: int, seed: int, *cols) -> Column:
    """Seeded group key in [0, k) from md5(seed:col1:col2...) (first 60 bits).

    Same value in DuckDB (``('0x'||substr(md5(..),1,15))::bigint % k``), so
    the salted groups themselves can be checked against SQL.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(c).cast("string") for c in cols]))
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("long"), F.lit(k)).cast("int")
