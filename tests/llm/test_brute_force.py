"""Scores, rates, surrogates and shards against plain Python versions."""

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundstats.llm import langid, quality, queries, sharding, suffix_dedup, surrogates
from roundstats.llm.common import BYTE_MULT, held_out

from . import brute

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def spread(h):
    for _ in range(2):
        h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & MASK
    return h ^ (h >> 32)


# ------------------------------------------------------------- op9: cosines --

def grams(text):
    out = Counter()
    word = []
    for c in [*(ord(c) for c in text.lower()), 0]:
        if c and chr(c).isalpha():
            word.append(c)
            continue
        for i, b in enumerate(word):
            a = word[i - 1] if i else 0
            n = word[i + 1] if i + 1 < len(word) else 0
            for g in (b, b << 21 | n | 1 << 62, a << 42 | b << 21 | n | 1 << 63):
                out[spread(g) >> 52] += 1
        word = []
    return out


def test_language_scores_against_plain_cosines(spark, docs):
    model = langid.fit(docs.where(~held_out()))
    rows = docs.select("doc_id", "text").limit(40).collect()
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for r in rows:
        counts = grams(r.text or "")
        if not counts:
            assert got[r.doc_id].lang_pred == "und"
            continue
        x = {g: math.log1p(n) * model.idf[g] for g, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        cos = [sum(v * float(c[g]) for g, v in x.items()) / norm for c in model.centers]
        best = max(cos)
        near = {model.langs[o] for o, c in zip(model.owner, cos) if c > best - 1e-5}
        assert got[r.doc_id].lang_pred in near and abs(got[r.doc_id].score - min(max(best, 0), 1)) < 1e-4


# --------------------------------------------------------- op7: every pair ---

def word_bucket(word):
    h = 0
    for i, b in enumerate(word):
        b += 32 if 65 <= b <= 90 else 0
        h += (b + 1) * pow(BYTE_MULT, i, 1 << 64)
    return spread(h & MASK) >> 52


def structure(raw, words):
    n, k = max(len(raw), 1), max(len(words), 1)
    sets = (range(65, 91), range(48, 58), b"!%$#&*|", b".,;:?'\"()-", b"\n", range(128, 256))
    low = [w.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))) for w in words]
    return [sum(b in s for b in raw) / n for s in sets] + [
        sum(map(len, words)) / k, sum(a == b for a, b in zip(low, low[1:])) / k, math.log1p(len(words))]


def test_quality_scores_against_all_pairs(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    m = quality.fit(docs, labels.where(~held_out()), "quality", metadata=("n_chars",))
    got = {r.doc_id: r.score for r in quality.score(docs, m, metadata=("n_chars",)).collect()}
    rows = docs.select("doc_id", "text", "n_chars").where(F.length("text") < 1500).limit(12).collect()
    assert rows
    for r in rows:
        raw = (r.text or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        x = {b: math.log1p(n) for b, n in Counter(map(word_bucket, words)).items()}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
        x = {b: v / norm for b, v in x.items()}
        dense = [*structure(raw, words), math.log1p(abs(r.n_chars or 0))]
        for i, (d, mean, std) in enumerate(zip(dense, m.mean, m.std)):
            x[quality.DIMS + i] = min(max((d - mean) / std, -4), 4)
        keys = sorted(x)
        margin = float(m.bias[0]) + sum(x[i] * float(m.linear[i]) for i in keys)
        for a, i in enumerate(keys):
            for j in keys[a + 1:]:
                margin += x[i] * x[j] * float(m.factors[i].astype(float) @ m.factors[j].astype(float))
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-margin))) < 1e-3


# -------------------------------------------------------------- op10: rates --

def test_rates_against_plain_projected_gradient(spark):
    out = queries.op10_soft_membership_mixing(spark, SF).collect()
    domains = sorted(out[0].posterior)
    p = np.array([[r.posterior[d] for d in domains] for r in out])
    n = np.array([r.tokens for r in out], float)
    assert np.allclose(p.sum(axis=1), 1)
    share = np.array([queries.SHARES[d] for d in domains])
    at = domains.index(queries.LEAD)
    goal = share / share.sum()
    goal = goal * queries.LIFT * (n @ p)[at] / goal[at]
    inverse = np.linalg.pinv((p * n[:, None]).T @ p, hermitian=True)
    r = np.ones(len(n))
    for _ in range(200):
        gap = (n * r) @ p - goal
        if np.abs(gap).max() <= 1e-4 * goal.sum():
            break
        r = np.maximum(0, r - p @ (inverse @ gap))
    assert np.abs(np.array([x.rate for x in out]) - r).max() < 1e-6
    assert np.abs((n * r) @ p - goal).max() <= 1e-4 * goal.sum()


# --------------------------------------------------------- op3: surrogates ---

NAMES = {"LATIN": ["Smith", "O'Brien", "Garcia", "Weber"], "CYRILLIC": ["Смирнов", "Кузнецов"], "GREEK": ["Παπαδόπουλος", "Γεωργίου"]}
SINGLE = {"phone", "ssn", "card", "ip"}


def entities(rng, n):
    """``(kind, text)`` of random entities, with pieces that come back."""
    pick = lambda s: s[rng.integers(len(s))]
    digits = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    for _ in range(n):
        kind = pick(["email", "phone", "ssn", "card", "ip", "name", "name"])
        if kind == "email":
            yield kind, f"{pick(['ann', 'bob', 'c.lee', 'd_w'])}@{pick(['mail', 'corp.site', 'x-y'])}.{pick(['com', 'org'])}"
        elif kind == "phone":
            yield kind, f"+{pick(['1', '44'])} ({digits(3)}) {digits(3)}-{digits(4)}"
        elif kind == "ssn":
            yield kind, f"{digits(3)}-{digits(2)}-{digits(4)}"
        elif kind == "card":
            yield kind, f"4{digits(3)} {digits(4)} {digits(4)} {digits(4)}"
        elif kind == "ip":
            yield kind, ".".join(str(v) for v in rng.integers(1, 255, 4))
        else:
            yield kind, f"{pick(['Mr.', 'Mrs.', 'Dr.'])} {pick(pick(list(NAMES.values())))}"


def scripts(word):
    return {unicodedata.name(c).split()[0] for c in word if c.isalpha()}


def test_surrogates_of_random_pieces_against_plain_laws(spark):
    rng = np.random.default_rng(8)
    items = [list(entities(rng, 12)) for _ in range(60)]
    df = spark.createDataFrame([(i, "plain start | " + " | ".join(e for _, e in row) + " | plain end")
                                for i, row in enumerate(items)], "doc_id long, text string")
    table = {}
    for r in surrogates.replace_personal_data(df, "k").collect():
        parts = r.text.split(" | ")
        assert (parts[0], parts[-1], len(parts)) == ("plain start", "plain end", 14)
        for (kind, old), new in zip(items[r.doc_id], parts[1:-1]):
            if kind == "email":
                (a, host), (b, other) = old.split("@"), new.split("@")
                stem, top = host.rsplit(".", 1)
                assert other.rsplit(".", 1)[1] == top and re.sub("[a-z]", "a", a) == re.sub("[a-z]", "a", b)
                table.setdefault("domain", []).append((stem, other.rsplit(".", 1)[0]))
                table.setdefault("local@" + host, []).append((a, b))
            elif kind == "name":
                assert old.split(" ")[0] == new.split(" ")[0]
                a, b = old.split(" ", 1)[1], new.split(" ", 1)[1]
                assert scripts(a) == scripts(b) and b[0].isupper()
                table.setdefault("last " + min(scripts(a)), []).append((a.lower(), b.lower()))
            else:
                if kind != "ip":
                    assert re.sub(r"\d", "0", old) == re.sub(r"\d", "0", new)
                # Country codes and a card's first digit stay.
                at = {"phone": old.index(" ") if kind == "phone" else 0, "card": 1}.get(kind, 0)
                assert old[:at] == new[:at]
                strip = (lambda s: s) if kind == "ip" else (lambda s: re.sub(r"\D", "", s))
                table.setdefault(kind, []).append((strip(old[at:]), strip(new[at:])))
    assert {"domain", "phone", "ssn", "card", "ip", "last LATIN", "last CYRILLIC", "last GREEK"} <= set(table)
    for pairs in table.values():
        pairs = set(pairs)
        old, new = {a for a, _ in pairs}, {b for _, b in pairs}
        assert len(pairs) == len(old) == len(new)      # one surrogate a piece, one piece a surrogate
        assert not old & new


def test_name_words_of_two_scripts_keep_their_own(spark):
    df = spark.createDataFrame([(1, "Dr. Anna Παπαδόπουλος and Dr. Иван Smith")], "doc_id long, text string")
    (r,) = surrogates.replace_personal_data(df, "k").collect()
    got = re.fullmatch(r"Dr\. (\w+) (\w+) and Dr\. (\w+) (\w+)", r.text)
    assert [scripts(w) for w in got.groups()] == [{"LATIN"}, {"GREEK"}, {"CYRILLIC"}, {"LATIN"}]


# --------------------------------------------------- hot groups: op8 and op2 --

@pytest.mark.parametrize("bits", [0, 3, 12])
def test_shards_with_a_third_of_all_rows_identical(spark, monkeypatch, bits):
    monkeypatch.setattr(sharding, "RUN_BITS", bits)
    rows = [(i if i % 3 else None, f"t {i}" if i % 3 else "the same") for i in range(3000)]
    rows += [(7, "t 7"), (7, None), (7, ""), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.assign_shards(df, 7).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((d, size(t)) for d, t in rows)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(len, slots.values())) == [len(rows) // 7] * (7 - len(rows) % 7) + [len(rows) // 7 + 1] * (len(rows) % 7)
    whole = sharding.shard_documents(df, 7).collect()
    assert Counter((r.doc_id, r.text) for r in whole) == Counter(rows)
    # How many of each kind of row a shard gets does not follow the layout.
    kinds = Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in out)
    again = sharding.assign_shards(df.repartition(2), 7).collect()
    assert kinds == Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in again)


def test_repeated_passages_with_one_run_in_a_third_of_the_texts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    common = " ".join(f"c{v}" for v in rng.integers(0, 400, 60))
    word = lambda k: " ".join(f"w{v}" for v in rng.integers(0, 10 ** 6, k))
    rows = [(i, f"{word(20)} {common} {word(15)}" if i % 3 == 0 else word(90)) for i in range(150)]
    every, later = brute.repeated_words(rows)
    got, got_later = {}, {}
    for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id] = {i for s in r.spans for i in range(s.start, s.end)}
        if r.later_spans:
            got_later[r.doc_id] = {i for s in r.later_spans for i in range(s.start, s.end)}
    assert len(got) == 50 and got == every and got_later == later
