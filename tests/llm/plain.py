"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def contamination(docs, items, window=13):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda t: pattern.findall((t or "").translate(table))
    windows = []
    for item, text in items:
        w = split(text)
        windows += [("null" if item is None else str(item), tuple(w[k : k + window])) for k in range(max(1, len(w) - window + 1)) if w]
    out = []
    for doc, text in docs:
        w, hit, names = split(text), set(), set()
        for name, v in windows:
            for k in range(len(w) - len(v) + 1):
                if tuple(w[k : k + len(v)]) == v:
                    hit.update(range(k, k + len(v)))
                    names.add(name)
        out.append((doc, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def substring_dedup(docs, window=13):
    first, words = {}, []
    order = lambda i: float("inf") if i is None else i
    for doc, text in docs:
        w = (text or "").encode().split()
        words.append((doc, w))
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, float("inf")), order(doc))
    out = []
    for doc, w in words:
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < order(doc) for j in range(k, k + window)}
        out.append((doc, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


def shingles(text, n=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def near_duplicates(docs, percent=85, n=3):
    sets = [(doc, shingles(text, n)) for doc, text in docs]
    parent = {doc: doc for doc, _ in sets if doc is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return [(doc, len(s), None if doc is None else find(doc), doc is None or find(doc) == doc) for doc, s in sets]


def line_dedup(docs, run=2, words=13):
    place = lambda doc, k: (doc is None, doc or 0, k)
    first, kept = {}, []
    for doc, text in docs:
        parts = [] if text is None else text.split("\n")
        at = [k for k, x in enumerate(parts) if re.search(r"\S", x)]
        runs = [tuple(range(k, k + run)) for k in range(len(at) - run + 1)]
        runs += [(k,) for k, j in enumerate(at) if len(re.findall("[^\x20\x09-\x0d]+", parts[j])) >= words]
        kept.append((doc, text, parts, at, runs))
        for r in runs:
            key = tuple(parts[at[k]] for k in r)
            first[key] = min(first.get(key, place(doc, r[0])), place(doc, r[0]))
    out = []
    for doc, text, parts, at, runs in kept:
        gone = {at[k] for r in runs if first[tuple(parts[at[j]] for j in r)] < place(doc, r[0]) for k in r}
        out.append((doc, None if text is None else "\n".join(x for k, x in enumerate(parts) if k not in gone), len(at), len(gone)))
    return out


def top_k(vectors, k, every):
    usable = {(i, tuple(int(np.floor(64 * float(np.float32(c)))) for c in v)) for i, v in vectors if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    width = max(len(v) for _, v in usable)
    rows = sorted((i, v + (0,) * (width - len(v))) for i, v in usable)
    out = []
    for i, q in rows:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in rows if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return out


def record(page):
    i, url, html = page
    body = html or ""
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'none' if i is None else i}>\r\nWARC-Target-URI: {url or ''}\r\n" f"Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n")


def audit(pages, replica):
    """`(page_id, state, offset, length)` by comparing all records."""

    def leaves(rows):
        found = defaultdict(list)
        for p in rows:
            found[p[0]].append((p[1] is None, p[2] is None, record(p)))
        return {k: sorted(v) for k, v in found.items()}

    a, b = leaves(pages), leaves(replica)
    out, offset = [], 0
    for i in sorted(a.keys() | b.keys(), key=lambda i: (i is None, i or 0)):
        length = sum(len(r[2].encode()) for r in a.get(i, []))
        if a.get(i) != b.get(i):
            out.append((i, "missing" if i not in b else "extra" if i not in a else "changed", offset, length))
        offset += length
    return out
