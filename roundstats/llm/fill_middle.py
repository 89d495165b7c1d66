"""Fill-in-the-middle transformation (operator 12).

A text is cut into units: a word with the white space before it, or the white
space that ends the text. One ``fullmatch`` of ``(unit)*`` by the ``regex``
library keeps every repetition of its group, so ``match.ends(1)`` gives the
number of units and both cut offsets at once, without a loop over the text.
The repetitions are possessive: every text matches, so nothing is ever taken
back and no states are kept for it.

Where a text is cut and which form it takes comes from the SHA-256 of
``seed:doc_id`` alone, so neither layout nor retries change it. ``plain`` texts
stay as they are (empty, holding a sentinel, or drawn so); ``psm`` is prefix,
suffix, middle and ``spm`` suffix, prefix, middle, each after its sentinel.
``restore`` rebuilds the text from output and form.

One Arrow pass, no shuffle: a task holds one block of texts (or one longer
text) at a time.

Edge cases: a null text is empty: plain, no units. A null id is hashed as the
empty string. Repeated rows give equal rows. Bytes that are not UTF-8 are read
as U+FFFD. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import blocks, text_bytes

UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50     # of the texts are cut
SPM_PERCENT = 80     # of the cut texts are spm


def draws(seed: int, doc_id: str) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    hexes = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(hexes[i: i + 8], 16) for i in (0, 8, 16, 24)]


def _transform(units, text: str, h: list[int], fim_percent: int, spm_percent: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    if not n or h[2] % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``doc_id, text`` (as given), ``n`` (units), ``form``, ``prefix_chars``,
    ``middle_chars`` (code points; null if plain) and ``output`` for every row."""
    schema = T.StructType([docs.schema["doc_id"]]).add("text", "string").add("n", "long").add("form", "string") \
        .add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def kernel(batches):
        units = regex.compile(f"({UNIT})*+")
        for b in batches:
            ids = b.column(1).to_pylist()
            for i, j, data, offs in blocks(b.column(2)):
                raw, offs = np.ascontiguousarray(data).tobytes(), offs.tolist()
                texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(offs, offs[1:])]
                rows = [_transform(units, t, draws(seed, d), fim_percent, spm_percent) for t, d in zip(texts, ids[i:j])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(texts, pa.string()),
                     *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=schema.names)

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select("doc_id", name.alias("name"), text_bytes().alias("text")).mapInArrow(kernel, schema)


def restore(form: Column, output: Column) -> Column:
    """The text that ``output`` of the given form was made of: a cut text holds
    no sentinel, so the three in the output are the ones put there."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    cut = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])) \
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(cut)
