"""Soft-membership mixing of domains to target weights (operator 10).

A classifier learned from a labelled table gives every document a posterior
over domains (here each pair of label values is one). Every document i gets a
rate r_i >= 0: how often it should be taken. The rates are fitted so that the
expected tokens of each domain, s_d = sum_i r_i n_i p_id with n_i tokens and
posterior p_id, meet the targets T_d, by projected-gradient least squares from
r = 1. The residual is measured by the inverse of G_de = sum_i n_i p_id p_ie
and rates are scaled by the square roots of n_i; with those scales the
gradient's Lipschitz constant is 1, so steps of length one converge:

    r_i <- max(0, r_i - p_i . z),    z = G^-1 (s - T).

A step needs s only: a sum over all documents of a few numbers per domain,
taken by Spark from the written table of posteriors. The driver holds z for
each step (domains x steps numbers); a rate is the fold of those steps.

Training reads at most ``max_train`` labelled documents, in one task:
multinomial logistic regression over the ``WORDS`` word buckets that differ
most between domains (chi-squared) and the texts' structure. Tokens are
words; posteriors, totals and rates cover all documents.

Edge cases: a null or empty text has no tokens and a rate like any other;
without labelled documents there are no domains, and every rate is 1; a target
for a domain that no label names is left out and the others share its weight;
repeated rows stay repeated and get equal rates. Other columns are not read.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import Stage, blocks, text_bytes, unused
from roundstats.llm.features import STATS, TextBlock, labelled_sample

BUCKETS = 1 << 16
WORDS = 1024
MAX_TRAIN = 8192
TRAIN_STEPS = 150
log = logging.getLogger(__name__)

MAX_STEPS = 60
TOLERANCE = 1e-4     # largest residual of a domain, as a share of all target tokens


# -------------------------------------------------------------- classifier --

class Posterior:
    """Multinomial logistic regression; its size does not follow the input."""

    def __init__(self, domains: list[str], buckets: np.ndarray, mean: np.ndarray, std: np.ndarray, weights: np.ndarray):
        self.domains, self.mean, self.std, self.weights = domains, mean, std, weights
        self.slot = np.full(BUCKETS, -1, np.int64)
        self.slot[buckets] = np.arange(len(buckets))
        self.width = len(buckets)

    def __call__(self, t: TextBlock) -> np.ndarray:
        slot = self.slot[(t.hashes >> np.uint64(48)).astype(np.int64)]
        has = slot >= 0
        rows = len(t.n_words)
        x = np.zeros((rows, self.width), np.float32)
        x[t.row[has], slot[has]] = 1
        return softmax(inputs(x, (t.stats() - self.mean) / self.std) @ self.weights)


def inputs(words: np.ndarray, z: np.ndarray) -> np.ndarray:
    return np.concatenate([words, np.clip(z, -4, 4), np.ones((len(words), 1))], axis=1).astype(np.float32)


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp((m - m.max(axis=1, keepdims=True)).astype(np.float64))
    return e / e.sum(axis=1, keepdims=True)


def telling_buckets(present: list[np.ndarray], y: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` word buckets with the largest chi-squared between classes."""
    n_class = np.bincount(y).astype(float)
    seen = np.zeros((len(n_class), BUCKETS))
    for p, c in zip(present, y):
        seen[c, p] += 1
    total = seen.sum(axis=0)
    chi = np.zeros(BUCKETS)
    for got, whole in ((seen, total), (n_class[:, None] - seen, len(y) - total)):
        want = n_class[:, None] * whole / len(y)
        chi += np.where(want > 0, (got - want) ** 2 / np.maximum(want, 1e-9), 0).sum(axis=0)
    chi[total < 3] = 0
    order = np.lexsort((np.arange(BUCKETS), -chi))[:k]
    return np.sort(order[chi[order] > 0])


def train(present: list[np.ndarray], stats: np.ndarray, y: np.ndarray) -> tuple:
    """Buckets, means, deviations and weights, by full-batch Adam."""
    buckets = telling_buckets(present, y, WORDS)
    slot = np.full(BUCKETS, -1)
    slot[buckets] = np.arange(len(buckets))
    words = np.zeros((len(y), len(buckets)), np.float32)
    for i, p in enumerate(present):
        s = slot[p]
        words[i, s[s >= 0]] = 1
    mean, std = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    x = inputs(words, (stats - mean) / std)
    n_class = int(y.max()) + 1
    hot = np.eye(n_class, dtype=np.float32)[y]
    w = np.zeros((x.shape[1], n_class), np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, TRAIN_STEPS + 1):
        g = x.T @ ((softmax(x @ w) - hot) / len(y)).astype(np.float32) + 1e-5 * w
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        w -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return buckets, mean, std, w


def fit_posterior(docs: DataFrame, labels: DataFrame, domain: str, max_train: int = MAX_TRAIN) -> Posterior | None:
    """Classifier of ``domain``, a SQL expression (string) over ``labels``."""
    sample = labelled_sample(docs, labels, F.expr(domain), max_train)

    def vectors(batches):
        for b in batches:
            for i, j, data, offs in blocks(b.column(2)):
                t = TextBlock(data, offs)
                h = (t.hashes >> np.uint64(48)).astype("<u2")
                out = [d.astype("<f8").tobytes() + np.unique(h[a:z]).tobytes()
                       for d, a, z in zip(t.stats(), t.woff[:-1], t.woff[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                                                  pa.array(out, pa.binary())], names=["h", "label", "vec"])

    bounded = sample.mapInArrow(vectors, "h long, label string, vec binary").orderBy("h", "vec").limit(max_train)

    def learn(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("vec", "ascending")])
        names = sorted(set(t.column("label").to_pylist()))
        y = np.array([names.index(v) for v in t.column("label").to_pylist()])
        vec = t.column("vec").to_pylist()
        stats = np.stack([np.frombuffer(v, "<f8", STATS) for v in vec])
        parts = train([np.frombuffer(v, "<u2", offset=8 * STATS) for v in vec], stats, y)
        return pa.table({"part": pa.array([np.asarray(p, "<f8").tobytes() for p in parts], pa.binary()),
                         "at": pa.array(range(len(parts)), pa.int32()),
                         "domains": pa.array([names] * len(parts), pa.list_(pa.string()))})

    got = sorted(bounded.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(learn, "part binary, at int, domains array<string>").collect(),
                 key=lambda r: r["at"])
    if not got:
        return None
    buckets, mean, std, w = (np.frombuffer(r["part"], "<f8") for r in got)
    domains = list(got[0]["domains"])
    return Posterior(domains, buckets.astype(np.int64), mean, std, w.reshape(-1, len(domains)).astype(np.float32))


def posteriors(docs: DataFrame, model: Posterior, tokens: str = "tokens", p: str = "p") -> DataFrame:
    """The rows of ``docs`` (whose text is the column ``text``) with their
    ``tokens`` and ``p`` (one posterior per domain)."""
    at = docs.columns.index("text")

    def kernel(batches):
        for b in batches:
            text = b.column(at)
            for i, j, data, offs in blocks(text.fill_null("") if text.null_count else text):
                t = TextBlock(data, offs)
                got = model(t)
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(i, j - i).columns, pa.array(t.n_words, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()),
                                              pa.array(got.ravel(), pa.float64()))], names=[*b.schema.names, tokens, p])

    schema = T.StructType(list(docs.schema.fields)).add(tokens, "long").add(p, T.ArrayType(T.DoubleType()))
    return docs.mapInArrow(kernel, schema)


# ------------------------------------------------------------------- rates --

def rate_of(p: list[Column], steps: list[np.ndarray]) -> Column:
    """The rate after the given steps, from 1."""
    r = F.lit(1.0)
    for z in steps:
        r = F.greatest(F.lit(0.0), r - sum((c * F.lit(float(v)) for c, v in zip(p, z)), F.lit(0.0)))
    return r


def fit_rates(table: DataFrame, n_domains: int, targets: np.ndarray, max_steps: int = MAX_STEPS,
              tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """Steps of the projected gradient over ``tokens, p``; ends when every
    domain's total is within ``tolerance`` of its target (as a share of all
    target tokens), or no longer moves, or after ``max_steps``; logs the totals
    reached against the targets (a warning where they are not met)."""
    p = [F.col("p")[i] for i in range(n_domains)]
    n = F.col("tokens")
    cells = [(i, j) for i in range(n_domains) for j in range(i, n_domains)]
    got = table.agg(*[F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)) for i, j in cells]).first()
    gram = np.zeros((n_domains, n_domains))
    for (i, j), v in zip(cells, got):
        gram[i, j] = gram[j, i] = v
    inverse = np.linalg.pinv(gram, hermitian=True)
    steps, scale, last = [], max(float(targets.sum()), 1.0), None
    while True:
        r = rate_of(p, steps)
        s = np.array(table.agg(*[F.coalesce(F.sum(n * r * c), F.lit(0.0)) for c in p]).first())
        gap = s - targets
        met = np.abs(gap).max() <= tolerance * scale
        if met or len(steps) >= max_steps or (last is not None and np.abs(s - last).max() <= 1e-9 * scale):
            break
        steps.append(inverse @ gap)
        last = s
    log.log(logging.INFO if met else logging.WARNING, "mixing: targets %s after %d steps; expected tokens by domain %s, targets %s",
            "met" if met else "not met", len(steps), s.round(1).tolist(), targets.round(1).tolist())
    return steps


def target_totals(now: np.ndarray, domains: list[str], shares: dict[str, float], lead: str,
                  lift: float = 1.0) -> np.ndarray:
    """Token targets in the given shares, with the domain ``lead`` (or else the
    largest) at ``lift`` times its present total."""
    want = np.array([max(shares.get(d, 0.0), 0.0) for d in domains])
    if want.sum() <= 0:
        return now
    want = want / want.sum()
    at = domains.index(lead) if lead in domains and want[domains.index(lead)] > 0 else int(np.argmax(want))
    return want * (lift * now[at] / want[at])


def _fitted(rows: DataFrame, labelled: DataFrame, labels: DataFrame, domain: str, shares: dict[str, float], lead: str,
            lift: float, max_train: int, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], str, str, Column]:
    """``rows`` written with tokens and posteriors (less the columns ``drop``),
    the domains, the names of the two new columns, and the rate of a row."""
    model = fit_posterior(labelled, labels, domain, max_train)
    if model is None:
        model = Posterior(["all"], np.zeros(0, np.int64), np.zeros(STATS), np.ones(STATS),
                          np.zeros((STATS + 1, 1), np.float32))
    tokens, post = unused("tokens", rows), unused("p", rows)
    table = Stage(rows.sparkSession, "mixing").write(posteriors(rows, model, tokens, post).drop(*drop))
    bare = table.select(F.col(tokens).alias("tokens"), F.col(post).alias("p"))
    p = [F.col("p")[i] for i in range(len(model.domains))]
    now = np.array(bare.agg(*[F.coalesce(F.sum(F.col("tokens") * c), F.lit(0.0)) for c in p]).first())
    steps = fit_rates(bare, len(p), target_totals(now, model.domains, shares, lead, lift))
    return table, model.domains, tokens, post, rate_of([F.col(post)[i] for i in range(len(p))], steps)


def mix(docs: DataFrame, labels: DataFrame, domain: str, shares: dict[str, float], lead: str,
        lift: float = 1.0, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, tokens, rate, posterior`` (domain -> probability) for every row
    of ``docs``. Targets: token shares by domain, at the total that gives the
    domain ``lead`` ``lift`` times its present tokens."""
    rows = docs.select("doc_id", text_bytes().alias("text"))
    table, domains, tokens, post, rate = _fitted(rows, docs, labels, domain, shares, lead, lift, max_train, ("text",))
    posterior = F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), F.col(post))
    return table.select("doc_id", F.col(tokens).alias("tokens"), rate.alias("rate"), posterior.alias("posterior"))


def thin(docs: DataFrame, labels: DataFrame, domain: str, shares: dict[str, float], lead: str,
         lift: float = 1.0, max_train: int = MAX_TRAIN, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, unchanged, that are taken at their rates. Each row
    is decided in place, so ids may be null or repeated. A row is taken once at
    most: rates above 1 keep it and no more, so domains whose rates exceed 1
    end below their targets."""
    table, _, _, _, rate = _fitted(docs, docs, labels, domain, shares, lead, lift, max_train)
    return table.where(take(rate, seed)).select(*[f"`{c}`" for c in docs.columns])


def take(rate: Column, seed: int = 7) -> Column:
    """Whether a row is taken at its rate: rates of 1 or more always, others
    with that probability, by a hash of the id and the text (equal rows
    share their draw)."""
    u = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")) / F.lit(2.0 ** 64) + 0.5
    return u < rate
