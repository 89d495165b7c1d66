"""The text operators against brute force, and their edge cases."""

import hashlib
import zlib

from . import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from roundstats.llm import decontam, langid, merkle, mixing, quality, queries, secret_scan, sharding, simhash, suffix_dedup, surrogates

SF = "/root/testdata/sf0.001"
EDGE = "doc_id long, text string, lang string, fp string, d string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empties, repeated rows, a long text and columns with clashing names."""
    rows = [(1, None, "en", "x", "x"), (2, "", None, None, None), (3, "one", "en", "x", "x"), (3, "one", "en", "x", "x"),
            (None, "a b c d", "en", "x", "x"), (4, " \t\n", "en", "x", "x"), (5, "word other " * 30000, "en", "x", "x")]
    return spark.createDataFrame(rows, EDGE)


def test_fingerprints_and_components(spark, texts):
    out = queries.op6_simhash_golay(spark, SF).toPandas()
    want = brute.components(texts)
    assert dict(zip(out.doc_id, out.fingerprint)) == {k: f"{v[0]:016x}" for k, v in want.items()}
    assert dict(zip(out.doc_id, out.component_id)) == {k: v[1] for k, v in want.items()}


@pytest.mark.parametrize("bucket", [1, 64])
def test_golay_links_lose_nothing(spark, bucket):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(40):
            bits = rng.choice(64, rng.integers(1, 5), replace=False)
            fps.add(int(b) ^ sum(1 << int(x) for x in bits))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    from roundstats.llm.common import Stage
    from roundstats.llm.components import connected_components

    edges = simhash.links(df, Stage(spark, "t"), 2, bucket)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    want = brute.linked(fps, 2)
    got = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        got.setdefault(roots.get(s, s), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))


def test_repeated_passages(spark, docs, texts, monkeypatch):
    every, later = brute.repeated_words(list(texts.items()))
    for most in (64, 1):
        monkeypatch.setattr(suffix_dedup, "MAX_RUN", most)
        got, got_later = {}, {}
        for r in suffix_dedup.repeated_passages(docs).collect():
            got[r.doc_id] = {i for s in r.spans for i in range(s.start, s.end)}
            if r.later_spans:
                got_later[r.doc_id] = {i for s in r.later_spans for i in range(s.start, s.end)}
        assert got == every and got_later == later


def test_contamination_finds_items(spark, texts):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in queries.op1_bm25_decontamination(spark, SF).collect()}
    want = {(k, r.item_id) for r in items for k, t in texts.items() if r.text in t}
    assert want <= got and len(got) <= len(want) + 1


def test_block_max_wand_equals_full_scores():
    rng = np.random.default_rng(5)
    n_terms, n_items = 60, 200
    ptr, items, weights = [0], [], []
    for _ in range(n_terms):
        own = np.sort(rng.choice(n_items, rng.integers(1, 80), replace=False))
        items.append(own), weights.append(rng.random(len(own)))
        ptr.append(ptr[-1] + len(own))
    band = decontam.Band(32, np.array(ptr), np.concatenate(items), np.concatenate(weights))
    for _ in range(50):
        terms = rng.choice(n_terms, 12, replace=False).tolist()
        full = np.zeros(n_items)
        for t in terms:
            full[items[t]] += weights[t]
        goal = float(np.quantile(full, 0.97))
        assert {i for i, _ in band.search(terms, goal)} == set(np.flatnonzero(full >= goal - 1e-9).tolist())


def test_secrets(spark, texts):
    for r in queries.op4_linked_secrets(spark, SF).collect():
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute.base_row(texts[r.doc_id])
    x = spark.createDataFrame([(1, "user=bob\ntoken: abc"), (2, "user=bob " + "q" * 300 + " token: abc"),
                               (3, "https://h.x/a password=hunter22"), (4, "token=tok : abcdefgh")], "doc_id long, text string")
    got = {r.doc_id: r.s for r in secret_scan.scan(x).select("doc_id", secret_scan.joined(F.col("all")).alias("s")).collect()}
    assert got == {1: "id:0:8,key:9:19", 2: "", 3: "endpoint:0:13,assign:14:31", 4: ""}


def test_merkle(spark, texts):
    out = queries.op5_merkle_fingerprints(spark, SF).collect()
    edited = brute.edited_texts(list(texts.items()))
    seen = {}
    for r in out:
        assert r.n_chars == len(texts[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(edited[r.doc_id].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert seen.setdefault(r.fingerprint, texts[r.doc_id]) == texts[r.doc_id]
    assert len(seen) == len(set(texts.values()))


def test_shards(spark, texts):
    out = queries.op8_bounded_ring_shards(spark, SF).toPandas()
    n = out.groupby("shard").size()
    assert len(n) == 16 and n.max() - n.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    for r in out.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    points = sharding.ring_points(4, 8)
    pieces = sharding.fill(points, [10] * len(points), {s: 80 for s in range(4)})
    assert sum(b - a for _, a, b, _, _ in pieces) == 10 * len(points)


def test_language(spark, docs):
    out = queries.op9_centroid_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").collect()
    assert held and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.9


def test_quality_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(np.zeros(2), np.ones(2), np.float32(0.5), rng.random(6).astype("f4"), rng.random((6, 3)).astype("f4"))
    x = rng.random((4, 6)).astype("f4")
    pairs = sum((m.factors[i] @ m.factors[j]) * x[:, i] * x[:, j] for i in range(6) for j in range(i + 1, 6))
    assert np.allclose(m.margin(x)[0], 0.5 + x @ m.linear + pairs, atol=1e-4)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op7_factorisation_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    held = out.where("held_out").collect()
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9


def test_mixing_meets_targets(spark):
    rows = queries.op10_soft_membership_mixing(spark, "/root/testdata/sf0.01").collect()
    total = {}
    for r in rows:
        assert r.rate >= 0
        for d, p in r.posterior.items():
            total[d] = total.get(d, 0.0) + r.rate * r.tokens * p
    for d, share in queries.SHARES.items():
        assert abs(total[d] / sum(total.values()) - share) < 1e-3


def test_surrogates(spark):
    x = spark.createDataFrame([
        (1, "Mr. John Smith wrote to a.b@mail.example.com. Mr. Smith called +1 (736) 555-2678."),
        (2, "+1 736-555-2678, c@mail.example.com, 42.1.2.3 and 4111111111111111"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in surrogates.replace_personal_data(x, "k").collect()}
    assert got[3].text is None and got[4].text == ""
    a, b = got[1].text, got[2].text
    for old in ("John", "Smith", "a.b@", "555", "42.1.2.3", "41111"):
        assert old not in a and old not in b
    last = a.split()[2]
    assert f"Mr. {last} called" in a and a.split("@")[1].split(". ")[0] in b
    digits = lambda s: "".join(c for c in s if c.isdigit())
    assert digits(a)[-11:] == digits(b.split(",")[0])


def test_edge_rows(spark, edge):
    n = edge.count()
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "word other word other")], "item_id long, text string")
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = langid.fit(edge)
    assert {r.lang_pred for r in langid.identify(edge, model).where("doc_id in (1, 2, 4)").collect()} == {"und"}
    assert simhash.near_duplicates(edge).count() == n
    assert [r.doc_id for r in decontam.contamination(edge, bench).collect()] == [5]
    assert decontam.drop_contaminated(edge, bench).schema == edge.schema
    assert {r.doc_id for r in suffix_dedup.repeated_passages(edge).collect()} == {5}
    assert secret_scan.scan(edge).count() == n == merkle.neighbours(edge).count()
    assert sharding.assign_shards(edge).count() == n == surrogates.replace_personal_data(edge, "k").count()
    assert quality.score(edge, quality.fit(edge, labels)).count() == n
    assert mixing.mix(edge, labels, queries.DOMAIN, queries.SHARES, queries.LEAD).count() == n


def test_empty_tables(spark, edge):
    none = edge.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (langid.identify(none, langid.fit(none)), simhash.near_duplicates(none), decontam.contamination(none, bench),
               suffix_dedup.repeated_passages(none), secret_scan.scan(none), merkle.neighbours(none),
               sharding.assign_shards(none), surrogates.replace_personal_data(none, "k"),
               quality.score(none, quality.fit(none, labels)),
               mixing.mix(none, labels, queries.DOMAIN, queries.SHARES, queries.LEAD)):
        assert df.collect() == []


def test_pipeline(spark, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, step in corpus_pipeline.STAGES[:3]:
        kept = step(spark, kept, SF)
        assert kept.columns == docs.columns
    groups = brute.components(texts)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = {r.doc_id for r in kept.collect()}
    assert all(groups[k][1] == k for k in ids) and not any(i in texts[k] for k in ids for i in items)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= ids and len({r.doc_id for r in out}) == len(out)


def test_rows_without_or_with_repeated_ids_are_decided_one_by_one(spark, texts, monkeypatch):
    import corpus_pipeline

    a, b, c, d = [t for t in dict.fromkeys(texts.values()) if len(t.split()) > 200][:4]
    rows = [(1, a), (None, a + "\n"), (None, b), (2, c), (2, " " + a), (3, d), (3, d), (None, None), (None, "")]
    x = spark.createDataFrame([(*r, "v", "w") for r in rows], "doc_id long, text string, tokens string, p string")
    got = simhash.keep_one(x)
    assert got.columns == x.columns
    want = [(1, a), (None, b), (2, c), (3, d)]
    rest = [tuple(r)[:2] for r in got.collect() if r.text]
    assert sorted(rest, key=str) == sorted(want, key=str) and got.count() == 5

    monkeypatch.setattr(mixing, "rate_of", lambda p, steps: F.when(F.col("text").startswith("keep"), 1.0).otherwise(0.0))
    x = spark.createDataFrame([(None, "keep a"), (None, "go b"), (7, "keep c"), (7, "go d"), (None, None)], "doc_id long, text string")
    monkeypatch.setattr(mixing, "fit_rates", lambda *args: [])
    got = corpus_pipeline.mix(spark, x, SF)
    assert got.columns == x.columns
    assert sorted([tuple(r) for r in got.collect()], key=str) == [(7, "keep c"), (None, "keep a")]


def test_other_scripts_are_rejected_at_every_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    greek = "Στην αρχή δημιούργησε ο Θεός τον ουρανό και τη γη και η γη ήταν άμορφη και έρημη "
    kanji = "".join(chr(0x4E00 + i * 37 % 4000) + " " * (i % 5 == 0) for i in range(500))
    junk = spark.createDataFrame([(-1, greek * 20, "en"), (-2, "ο", "de")], "doc_id long, text string, lang string")
    model = langid.fit(docs.union(junk))
    rows = [(n * 10 + i, (s * (n // len(s) + 1))[:n]) for n in (12, 25, 50, 100, 400, 3000, 12000, 50000)
            for i, s in enumerate((greek, kanji))]
    x = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in langid.identify(x, model).where("not rejected").collect()] == []
    assert langid.keep_identified(docs, model).count() > 0.95 * docs.count()
    own = docs.where("length(text) > 4000").select("doc_id", F.explode(F.array(*[F.substring("text", 1, n) for n in (40, 100, 400)])).alias("text"))
    assert langid.keep_identified(own, model).count() > 0.9 * own.count()


FORMS = [("phone", "736-555-2678"), ("phone", "736.555.2678"), ("phone", "736 555 2678"), ("phone", "1-736-555-2678"),
         ("phone", "(736)555-2678"), ("phone", "(736) 555.2678"), ("card", "3782 822463 10005"), ("card", "3782-822463-10005"),
         ("ip", "2001:db8:0:0:8:800:200c:417a"), ("ip", "2001:db8::8:800:200c:417a"), ("ip", "fe80::1"), ("ip", "::1"),
         ("ip", "::ffff:192.0.2.128"), ("ip", "2001:db8::"), ("name", "Dr. O'Brien"), ("name", "Mr. McDonald"),
         ("name", "Mr. John Paul Smith"), ("name", "Mrs. Smith-Jones"), ("name", "Mr. J. R. Smith"), ("name", "Anna Maria D’Angelo")]


def test_surrogates_of_every_form(spark):
    x = spark.createDataFrame([(i, f"so {s}, yes") for i, (_, s) in enumerate(FORMS)], "doc_id long, text string")
    got = {r.doc_id: r for r in surrogates.replace_personal_data(x, "k").collect()}
    for i, (kind, s) in enumerate(FORMS):
        r = got[i]
        assert [t for t in surrogates.TYPES if r[f"n_{t}"]] == [kind] and r[f"n_{kind}"] == 1, s
        assert r.text.startswith("so ") and r.text.endswith(", yes")
        old, new = (set(t.replace("-", " ").split()) for t in (s, r.text[3:-5]))
        assert s not in r.text and (kind != "name" or old & new <= {"Mr.", "Mrs.", "Dr."}), (s, r.text)
    same = lambda i: "".join(c for c in got[i].text if c.isdigit())[-10:]
    assert len({same(i) for i in range(6)}) == 1
    none = ["at 12:30:45", "std::vector", "1234-567-8901", "version 10.2.3", "a :: b"]
    x = spark.createDataFrame(list(enumerate(none)), "doc_id long, text string")
    assert [r.text for r in surrogates.replace_personal_data(x, "k").orderBy("doc_id").collect()] == none


def test_every_retrieved_passage_is_verified(spark):
    question = [f"q{i}" for i in range(33)]
    answer = [f"a{i}" for i in range(5)]
    filler = [f"w{i}" for i in range(400)]
    edited = question + answer
    for i in (5, 15, 25):
        edited[i] = "x" + edited[i]
    bench = spark.createDataFrame([(1, " ".join(question) + "? " + " ".join(answer))], "item_id long, text string")
    text = " ".join(question + filler + edited + filler)
    docs = spark.createDataFrame([(1, text), (2, " ".join(question + filler))], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.contamination(docs, bench).collect()] == [(1, 1)]
    assert [r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()] == [2]


def test_merkle_roots_cover_blank_lines(spark):
    rows = ["a\n\nb", "a\n \nb", "a\n\r\nb", "a\n\t\nb", "a\n\n\nb", "a\nb", "a\n \n\nb"]
    x = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = merkle.fingerprints(x)
    assert len({r.fingerprint for r in out.collect()}) == len(rows)
    a, b = (out.where(F.col("doc_id") == i).select(F.col("sections").alias(f"s{i}"), F.col("leaves").alias(f"l{i}"),
                                                   F.col("fingerprint").alias(f"f{i}")) for i in (0, 1))
    r = a.crossJoin(b).select(merkle.likeness(F.col("f0"), F.col("l0"), F.col("f1"), F.col("l1")).alias("near"),
                              merkle.edited_paragraphs(F.col("s0"), F.col("s1")).alias("edited")).first()
    assert r.near < 1 and len(r.edited) == 1


# ---------------------------------------------------------------- long texts --

def _seconds(df):
    import time

    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - t


def one(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id long, text string")


@pytest.mark.parametrize("text", [
    "Mr. " + "Aa-" * 3000 + "Aa went", "x@" + "a." * 20000 + "com", "see a@b.com. and c@d.com.9 and e@f.org-1",
    "x@1.2.3.4 or 10.0.0.1", "y@b..com"])
def test_long_chains_do_not_end_the_jvm(spark, text):
    out = surrogates.replace_personal_data(one(spark, text), "k").collect()
    assert len(out) == 1
    if text.startswith("see"):
        r = out[0]
        assert r.n_email == 3 and r.text.count("@") == 3 and ".com. and" in r.text and ".com.9 and" in r.text and r.text.endswith(".org-1")
        assert "a@b" not in r.text and "c@d" not in r.text


def test_long_texts_take_linear_time(spark):
    many = " ".join(f"user{i}@mail{i % 50}.example.com" for i in range(8000))       # 0.2 MB of addresses
    assert _seconds(surrogates.replace_personal_data(one(spark, many), "k")) < 60
    letters = "see http://a.b " + "abcdefgh1+" * 100000                              # 1 MB after ://
    assert _seconds(secret_scan.scan(one(spark, letters))) < 20
    sections = "\n\n".join(f"section {i}" for i in range(50000))
    assert _seconds(merkle.fingerprints(one(spark, sections))) < 20


def test_endpoints_start_at_the_first_letter_of_their_run(spark):
    text = "id: abcdefg key 9ab://x.y 12.ab1://z +http://q a1a1a1 ://no x://"
    import re as _re
    want = [(m.start(), m.end()) for m in _re.finditer(r"""(?i)[a-z][a-z0-9+.-]*://[^\s"'<>]+""", text)]
    pieces = secret_scan.scan(one(spark, text + " token=abcdefghi")).first()["all"]
    assert [(p.start, p.end) for p in pieces if p.kind == "endpoint"] == want


def test_located_edits_against_brute_force(spark):
    import random
    rng = random.Random(3)
    rows = []
    for i in range(30):
        old = "".join(rng.choice(["a", "b", "c\n", "\n\n", "\n \n", "d\n"]) for _ in range(rng.randrange(40)))
        new = "".join(rng.choice(["a", "b", "c\n", "\n\n", "\n \n", "e\n"]) for _ in range(rng.randrange(40)))
        rows.append((i, old, new))
    df = spark.createDataFrame(rows, "i int, old string, new string")
    o, n = (merkle.sections(merkle.tree(F.col(c))) for c in ("old", "new"))
    for r in df.select(o.alias("o"), n.alias("n"), merkle.edited_paragraphs(o, n).alias("e")).collect():
        have = {p for s in r.o for p in s}
        assert [tuple(x) for x in r.e] == [(i, j) for i, s in enumerate(r.n) for j, p in enumerate(s) if p not in have]


# -------------------------------------------------------------------- samples --

def test_labels_without_documents_take_no_place(spark):
    from roundstats.llm.features import labelled_sample

    docs = spark.range(200).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    docs = docs.union(docs.where("doc_id = 7").crossJoin(spark.range(3000)).select("doc_id", "text"))
    labels = spark.range(20000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    rows = labelled_sample(docs, labels, F.col("quality"), 300).collect()
    assert len(rows) == 200 and len({r.text for r in rows}) == 200
    assert len(labelled_sample(docs, labels, F.col("quality"), 50).collect()) == 50


def test_copies_do_not_fill_a_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    train, rest = docs.where("doc_id % 4 != 2"), docs.where("doc_id % 4 = 2 AND lang = 'en'")
    least = train.where("lang = 'en'").orderBy(F.xxhash64("text")).limit(1)
    many = train.union(least.crossJoin(spark.range(5000)).select("doc_id", "text", "lang"))
    out = langid.identify(rest, langid.fit(many))
    assert out.where("rejected").count() < 10


# ------------------------------------------------ trees, item blocks, stages --

def test_likeness_against_brute_force(spark):
    import random
    import re as _re
    from collections import Counter
    rng = random.Random(5)
    pieces = ["x.", "y. ", "x", "\n", "\n\n", "\n \n", "z!?", "long " * 40, "\u00e9. "]
    texts = ["", "x.\nx.\ny.\n", "y.\nx.\n", "a.b.", "b.a.", "a.\nb.", "b.\na."]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(40)]
    pairs = [(i, a, b) for i, (a, b) in enumerate((rng.choice(texts), rng.choice(texts)) for _ in range(150))]
    pairs += [(1000, texts[1], texts[2]), (1001, "a.\nb.", "b.\na."), (1002, "", ""), (1003, "x", "")]

    def own(text):
        out = Counter()
        for k, part in enumerate(_re.split(r"(\n[ \t\r]*\n)", text)):
            if k % 2:
                out.update([("b", part)] if part != "\n\n" else [])
            else:
                out.update(("l", s) for line in part.split("\n") for s in _re.findall(merkle.SENTENCE, line))
        return out

    df = spark.createDataFrame(pairs, "i int, a string, b string")
    trees = df.select("i", "a", "b", merkle.tree(F.col("a")).alias("ta"), merkle.tree(F.col("b")).alias("tb"))
    got = trees.select("a", "b", merkle.likeness(
        merkle.root(merkle.sections(F.col("ta"))), merkle.leaves(F.col("ta")),
        merkle.root(merkle.sections(F.col("tb"))), merkle.leaves(F.col("tb"))).alias("near")).collect()
    for r in got:
        a, b = own(r.a), own(r.b)
        want = 1.0 if r.a == r.b else 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()) + 2)
        assert abs(r.near - want) < 1e-12 and (r.near == 1) == (r.a == r.b)


def test_fingerprint_against_brute_force(spark):
    import re as _re

    def sha(level, of):
        return hashlib.sha256((level + of).encode()).hexdigest()

    def whole(text):
        out = []
        parts = _re.split(r"(\n[ \t\r]*\n)", text)
        for k in range(0, len(parts), 2):
            own = [[sha("l", x) for x in _re.findall(merkle.SENTENCE, p)] for p in parts[k].split("\n")]
            if k + 1 < len(parts) and parts[k + 1] != "\n\n":
                own.append([sha("b", parts[k + 1])])
            out.append(sha("s", ",".join(sha("p", ",".join(p)) for p in own)))
        return sha("r", ",".join(out))

    rows = ["", "a. b\nc\n\nd", "a\n \nb", "q" * 500 + ".", "\n\n\n", "e\u0301. \U0001f600!"]
    out = merkle.fingerprints(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint for r in out} == {i: whole(t) for i, t in enumerate(rows)}


def test_many_blocks_of_items_equal_one(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 5 > 0, F.col("doc_id")))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0]
    one = decontam.contamination(docs, bench).collect()
    many = decontam.contamination(docs, bench, block_text=size // 4)
    assert one and sorted(map(str, many.collect())) == sorted(map(str, one))
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    kept = decontam.drop_contaminated(docs, bench, block_text=size // 4)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, decontam.drop_contaminated(docs, bench).collect()))


def test_sharding_keeps_columns_and_rows(spark):
    rows = [(None, "a", 1, "s"), (None, "a", 1, "s"), (3, None, 2, "t"), (3, "b", 2, "t"), (3, "", 4, "u")] * 7
    docs = spark.createDataFrame(rows, "doc_id long, text string, size int, __row string")
    out = sharding.shard_documents(docs, 4)
    assert out.columns == [*docs.columns, "size_", "text_crc32", "shard", "slot"]
    got = out.collect()
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, rows))
    assert all(r.size_ == len(r.text or "") + 1 for r in got)
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    assert max(map(len, held.values())) - min(map(len, held.values())) <= 1
    assert sharding.shard_documents(docs.where("false")).count() == 0


def test_another_shard_moves_few_rows(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    a, b = (sharding.assign_shards(docs, n).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (16, 17))
    both = a.join(b, "doc_id")
    moved, into = both.where("s16 != s17").count(), both.where("s17 = 16").count()
    assert 4000 // 17 <= into <= moved <= 4 * into


def test_unmet_targets_are_logged(spark, caplog):
    df = spark.createDataFrame([(10, [1.0, 0.0]), (20, [1.0, 0.0])], "tokens long, p array<double>")
    with caplog.at_level("INFO"):
        mixing.fit_rates(df, 2, np.array([15.0, 5.0]))
        assert "not met" in caplog.text
        caplog.clear()
        mixing.fit_rates(df, 2, np.array([15.0, 0.0]))
        assert "targets met" in caplog.text
