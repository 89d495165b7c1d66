"""SetSketch near-duplicates, fill-in-the-middle and bisector centroids
against brute force, and their edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roundstats.llm import centroids, fill_middle, queries, setsketch

SF = "/root/testdata/sf0.001"
EDGE = "doc_id long, text string, n long, form string, node long, key long"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empties, repeated rows, a long text and columns with clashing names."""
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "a b c d e"), (4, " \t\n"), (5, "word other " * 30000),
            (6, "ONE"), (7, "a b c d e"), (None, "lonely text"), (8, "ends in blanks  "), (9, "has <P> in it"), (10, "ñandú x 語 \U0001f600 b")]
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], EDGE)


# ------------------------------------------------------------ near-duplicates --

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(" ".join(w[i: i + size]) for i in range(max(len(w) - size + 1, 1))) if w else frozenset()


def brute_components(rows):
    """[(doc_id, text)] -> [(doc_id, n, component_id, kept)], all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    nodes = sorted(set(s for s in sets if s), key=sorted)
    up = {s: s for s in nodes}

    def top(s):
        while up[s] is not s:
            s = up[s]
        return s

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    up[top(a)] = top(b)
    least = {}
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            least[top(s)] = min(least.get(top(s), d), d)
    out = []
    for (d, _), s in zip(rows, sets):
        c = least.get(top(s)) if s else d
        out.append((d, len(s), c, d == c))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def found(df, **kw):
    return sorted((tuple(r) for r in setsketch.near_duplicates(df, **kw).collect()), key=key)


def test_near_duplicates_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op11_setsketch_near_duplicates(spark, SF).collect()), key=key)
    assert got == sorted(brute_components(rows), key=key)


@pytest.mark.parametrize("bucket", [64, 1])
def test_large_groups_and_chains_of_near_copies(spark, bucket):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(150):                       # near copies of one text, some of them 0.8 apart
        t = list(base)
        for _ in range(rng.randrange(5)):
            t[rng.randrange(len(t))] = f"x{i}"
        rows.append((i, " ".join(t)))
    for i in range(150, 190):                  # a chain: neighbours link, ends do not
        rows.append((i, " ".join(f"c{j}" for j in range(i * 8, i * 8 + 120))))
    for i in range(190, 260):                  # a shared passage that is not enough
        rows.append((i, " ".join(base[:70] + [f"y{i}_{j}" for j in range(80)])))
    rows += [(300 + i, rows[0][1]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, max_bucket=bucket) == sorted(brute_components(rows), key=key)


def test_near_duplicate_edge_cases(spark, edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = [(d, n, c, d == c) for d, n, c, _ in brute_components(rows)]
    assert found(edge) == sorted(want, key=key)
    empty = setsketch.near_duplicates(edge.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_registers_merge_and_estimate_likeness():
    rng = np.random.default_rng(2)
    for shared, own in ((800, 100), (100, 450), (950, 10)):
        h = rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64) * np.uint64(2)
        a, b = h[: shared + own], np.concatenate([h[:shared], h[shared + own:]])
        sketch = lambda x: setsketch.register_values(setsketch.minima(x, np.array([0, len(x)]), 4096))[0]
        x, y = sketch(a), sketch(b)
        assert (setsketch.merge(x, y) == sketch(h)).all()
        n = np.array([float(len(a))])
        est, short = setsketch.likeness(*(np.array([c.sum()]) for c in (x > y, x < y, x == y)), n, n, 0.8)
        true = shared / (shared + 2 * own)
        assert abs(est[0] - true) < 0.05
        assert (est[0] >= 0.8 or short[0] <= setsketch.SLACK) == (true > 0.7)


def test_unlike_sets_hardly_ever_share_registers():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 400 * 50, dtype=np.uint64) * np.uint64(2)
    r = setsketch.register_values(setsketch.minima(h, np.arange(0, 20001, 50)))
    i, j = np.triu_indices(400, 1)
    assert (r[i] == r[j]).mean() < 1e-3          # keys shared by chance: the square of the rows


def test_near_duplicates_take_few_written_tables(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    rows = [(i, " ".join(base[:40] + [f"x{i}"] * (i % 4) + base[40:])) for i in range(40)]
    rows += [(100 + i, " ".join(f"c{j}" for j in range(i * 6, i * 6 + 80))) for i in range(20)]
    written, write = [], setsketch.Stage.write
    monkeypatch.setattr(setsketch.Stage, "write", lambda self, df: written.append(df) or write(self, df))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(brute_components(rows), key=key)
    assert len(written) <= 30


# -------------------------------------------------------------- fill in middle --

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_cut(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hexes = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[i * 8: i * 8 + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, lo), (lo, hi), (hi, n)))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return doc_id, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


def test_cuts_of_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(tuple(r) for r in queries.op12_fill_in_middle(spark, SF).collect())
    assert got == sorted(brute_cut(r.doc_id, r.text) for r in rows)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_cut_edge_cases(spark, edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()] + [(i, f"  a\tb\x0b{i} \n\nc ") for i in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fill_middle.fill_in_middle(df, seed=42)
    out = out.withColumn("back", fill_middle.restore(F.col("form"), F.col("output"))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, sha(r.output), sha(r.back)) for r in out]
    assert sorted(got, key=key) == sorted((brute_cut(*r) for r in rows), key=key)
    assert all(r.back == (r.text or "") for r in out)
    assert fill_middle.fill_in_middle(edge.limit(0)).count() == 0
    assert fill_middle.fill_in_middle(edge).count() == edge.count()


def test_every_text_is_cut_at_full_rate(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b"), "id", F.lit("c")).alias("text"))
    forms = fill_middle.fill_in_middle(df, fim_percent=100, spm_percent=0).groupBy("form").count().collect()
    assert [(r["form"], r["count"]) for r in forms] == [("psm", 200)]


# ------------------------------------------------------------------- centroids --

def brute_clusters(rows, k=8, rounds=10, dim=64):
    """[(vec_id, list)] -> rows of the query, all distances in Python integers."""
    import math
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cs = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(cs)):
            own = [v for (_, v), (_, g) in zip(kept, got) if g == j]
            if own:
                cs[j] = [sum(x) // len(own) for x in zip(*own)]
    got = assign()
    by = {}
    for d, j in got:
        by[j] = by.get(j, 0) + d
    return [(i, j, d, by[j], sum(by.values()), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest())
            for (i, _), (d, j) in zip(kept, got)]


def clusters(df, **kw):
    out = centroids.cluster(df, **kw)
    digest = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
    return sorted((tuple(r) for r in out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest).collect()), key=key)


def test_clusters_of_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op13_bisector_centroids(spark, SF).collect()), key=key)
    assert got == sorted(brute_clusters(rows), key=key)


def test_cluster_edge_cases(spark):
    rng = random.Random(1)
    vec = lambda: [rng.uniform(-2, 2) for _ in range(64)]
    same = vec()
    rows = [(i, vec()) for i in range(30)] + [(99, same)] * 40 + [(None, vec()), (None, None), (1, vec()[:63]), (2, []),
            (3, [float("nan")] * 64), (4, [float("inf")] * 64), (5, [None] * 64), (6, [0.0] * 64), (6, [-0.0] * 64)]
    schema = "vec_id long, embedding array<double>, x int, cluster int, distance int, h string"
    df = spark.createDataFrame([(i, v, 1, 1, 1, "x") for i, v in rows], schema)
    assert clusters(df) == sorted(brute_clusters(rows), key=key)
    few = df.where("vec_id = 99")
    assert clusters(few) == sorted(brute_clusters([r for r in rows if r[0] == 99]), key=key)
    assert clusters(df.limit(0)) == [] and clusters(df.where("vec_id = 3 and isnan(embedding[0])")) == []


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x)] + [0.0] * 63) for i, x in enumerate([-1, 1, 0, 0, 3, -3, 2, -2, 0, 1, -1] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clusters(df) == sorted(brute_clusters(rows), key=key)


def test_tournament_is_the_nearest_centroid():
    rng = np.random.default_rng(4)
    c = rng.integers(-3, 4, (8, 5))
    c[5] = c[2]
    x = rng.integers(-4, 5, (500, 5))
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (centroids.tournament(x, *centroids.bisectors(c)) == d.argmin(axis=1)).all()


def test_components_out_of_range_are_an_error(spark):
    df = spark.createDataFrame([(1, [2e5] + [0.0] * 63)], "vec_id long, embedding array<double>")
    with pytest.raises(PySparkException, match="component beyond"):
        centroids.cluster(df).collect()
