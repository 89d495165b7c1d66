"""Plain Python versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import re

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m.group()) >= 24]
    return sorted(out)


def base_row(text):
    spans = base_spans(text or "")
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    n = [sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")]
    return (*n, hashlib.sha256(joined.encode()).hexdigest())


def edited_texts(rows):
    """(doc_id, text) -> edited text, for distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (k, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1] or ""
        t = t or ""
        cut = len(t) // 3
        out[k] = t[: len(t) - cut] + nxt[:cut]
    return out


def repeated_words(rows, least=50):
    """{doc_id: set of word numbers} inside passages met at two places, and the
    same for places that have an earlier equal one (distinct ids)."""
    seen = {}
    for k, t in sorted(rows):
        w = (t or "").encode().lower().split()
        for i in range(len(w) - least + 1):
            seen.setdefault(tuple(w[i: i + least]), []).append((k, i))
    every, later = {}, {}
    for places in seen.values():
        if len(places) > 1:
            for n, (k, i) in enumerate(places):
                every.setdefault(k, set()).update(range(i, i + least))
                if n:
                    later.setdefault(k, set()).update(range(i, i + least))
    return every, later


def linked(fps, bits):
    """Sets of fingerprints connected by pairs at most ``bits`` apart."""
    left, out = set(fps), []
    while left:
        todo, own = [left.pop()], set()
        while todo:
            f = todo.pop()
            own.add(f)
            near = {g for g in left if (f ^ g).bit_count() <= bits}
            left -= near
            todo += near
        out.append(own)
    return out


def components(texts, size=3, bits=2):
    """{doc_id: (fingerprint, smallest linked doc_id)}."""
    import xxhash

    fps = {}
    for k, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        grams = [b" ".join(w[i: i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [b" ".join(w)][: len(w)]
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps[k] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
    least = {}
    for group in linked(set(fps.values()), bits):
        first = min(k for k, v in fps.items() if v in group)
        least.update(dict.fromkeys(group, first))
    return {k: (v, least[v]) for k, v in fps.items()}
