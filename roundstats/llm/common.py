"""Shared helpers of the text operators: written tables in the session's
shared folder, and NumPy kernels over Arrow batches of texts.

Texts reach the kernels as bytes (UTF-8), so any stored string is accepted.
A kernel works on blocks of about ``BLOCK_BYTES`` of text: its memory follows
the block (or one longer text), not the Arrow batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundstats.session import checkpoint_dir

BLOCK_BYTES = 1 << 17
BLOCK_ROWS = 128


# ----------------------------------------------------------- staged tables --

class Stage:
    """Tables written under the shared checkpoint folder, one folder per
    instance: lineage ends there and a lost executor loses nothing."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return a frame that reads it back."""
        self._n += 1
        path = f"{self.root}/t{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table of this stage that nothing will read again."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# ----------------------------------------------------------- column helpers --

def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 2 modulo 4 (a missing id: as '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: inside a lambda of ``body``
    a plain expression is evaluated again for every element."""
    return F.transform(F.array(value), body)[0]


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    while name in df.columns:
        name += "_"
    return name


def hash_cut(n: int, want: int) -> Column:
    """Signed 64-bit value below which about ``want`` (and half as many more)
    of ``n`` evenly spread hashes lie; all of them if there are no more."""
    share = min(1.0, (1.5 * want + 50) / max(n, 1))
    return F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))).cast("long")


# ------------------------------------------------------------ batch helpers --

def binary_parts(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a binary or string array, no copies."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    wide = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32) if offs else np.zeros(1, np.int32)
    o = o[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    if not len(o):
        o = np.zeros(1, np.int64)
    d = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]: o[-1]], o - o[0]


def blocks(arr, max_bytes: int = BLOCK_BYTES, max_rows: int = BLOCK_ROWS
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text array into blocks ``(first row, end row, bytes, offsets)``
    of at most ``max_rows`` rows and about ``max_bytes`` (one row at least)."""
    data, offs = binary_parts(arr)
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), i + max_rows, n)
        yield i, j, data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


# ------------------------------------------------------------- word kernels --

MASK = (1 << 64) - 1
BYTE_MULT = 0x9E3779B97F4A7C15      # odd: has an inverse modulo 2^64
WORD_MULT = 0xD6E8FEB86659FD93

_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
SPACE = _space                       # what separates words
_mark = np.ones(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _mark[_lo:_hi] = False
MARKS = _mark                        # all but ASCII letters, digits and other scripts
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64 (kept per process)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 12) * 5 // 4, base & MASK, dtype=np.uint64)
        out[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(out)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def find_words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a block, and the word offsets of
    its texts (n + 1). Words never cross a text boundary."""
    ns = ~sep[data]
    first = ns.copy()
    first[1:] &= ~ns[:-1]
    last = ns.copy()
    last[:-1] &= ~ns[1:]
    edge = offs[:-1][offs[:-1] < offs[1:]]
    first[edge] = ns[edge]
    edge = offs[1:][offs[:-1] < offs[1:]] - 1
    last[edge] = ns[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _ranges_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, mult: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each range, from prefix sums."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(mult, n), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(pow(mult, -1, 1 << 64), n + 1)[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word (A-Z folded when ``lower``)."""
    v = (LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    return mix(_ranges_hash(v, starts, ends, BYTE_MULT))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (len - k + 1)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = np.arange(n)
    return mix(_ranges_hash(words, s, s + k, WORD_MULT))


def code_point_offsets(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte position (positions at character starts)."""
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return lead[at]
