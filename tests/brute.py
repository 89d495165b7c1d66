"""Plain NumPy/Python versions of the seeded clustering, written from the
specification, used as brute-force checks on small fixtures."""

import hashlib
import math

import numpy as np


def u(seed, step, pid):
    h = hashlib.md5(f"{seed}:{step}:{pid}".encode()).hexdigest()
    return (int(h[:13], 16) + 1) / 4503599627370497.0


def dist(X, c):
    return np.sqrt(((X - c) ** 2).sum(axis=1))


def seeds(ids, X, w, k, seed):
    n = len(ids)
    first = min(range(n), key=lambda r: (u(seed, 0, ids[r]), ids[r]))
    chosen = [first]
    d = dist(X, X[first])
    for t in range(1, k):
        rest = [r for r in range(n) if r not in chosen]
        if not rest:
            break
        race = [r for r in rest if w[r] * d[r] > 0]
        if race:
            pick = min(race, key=lambda r: (-math.log(u(seed, t, ids[r])) / (w[r] * d[r]), ids[r]))
        else:
            pick = min(rest, key=lambda r: (u(seed, t, ids[r]), ids[r]))
        chosen.append(pick)
        d = np.minimum(d, dist(X, X[pick]))
    return chosen


def nearest(X, C):
    D = np.stack([dist(X, c) for c in C], axis=1)
    return D.min(axis=1), D.argmin(axis=1)


def lloyd(X, w, C, iters):
    C = np.array(C, dtype=float)
    for _ in range(iters):
        _, a = nearest(X, C)
        new = C.copy()
        for j in range(len(C)):
            m = a == j
            if m.any() and w[m].sum() > 0:
                new[j] = (w[m, None] * X[m]).sum(axis=0) / w[m].sum()
        C = new
    return C
