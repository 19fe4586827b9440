"""Plain single-machine versions of the operators, for small inputs."""

import collections
import math

import numpy as np

EDGES = ".,;:!?\"'()[]{}<>|%&#*$-_/\\~`^+=…«»“”‘’¿¡"


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def shingle_counts(text, size=5):
    words = [w for w in (x.strip(EDGES).lower() for x in (text or "").split()) if w]
    n = min(size, len(words))
    return collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else collections.Counter()


def probability_jaccard(a, b):
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in a.keys() & b.keys())


def near_document_classes(docs, least=0.8):
    sets, links = {d: shingle_counts(t) for d, t in docs}, Sets([d for d, _ in docs])
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(sets[a].keys() & sets[b].keys()) > 0.2 * len(sets[a].keys() | sets[b].keys()) and probability_jaccard(sets[a], sets[b]) >= least:
                links.join(a, b)
    return {d: links.find(d) for d in ids}


def cleaned_lines(docs, threshold, min_chars):
    """doc_id -> (removed line numbers, how many of them are near only)."""
    first = {}
    for d, t in sorted(docs):
        for i, line in enumerate((t or "").split("\n")):
            if len(line) >= min_chars:
                first.setdefault(line, (d, i))
    near = {x for x, p in first.items() for y, q in first.items()
            if q < p and abs(len(x) - len(y)) <= threshold and edits(x, y) <= threshold}
    out = {}
    for d, t in docs:
        gone = [i for i, x in enumerate((t or "").split("\n")) if len(x) >= min_chars and (first[x] != (d, i) or x in near)]
        out[d] = gone, sum(first[(t or "").split("\n")[i]] == (d, i) for i in gone)
    return out


def vector_links(rows, least):
    """vec_id -> (n_links, component) of (vec_id, vector, label)."""
    good = [(i, np.array(v, float), lab) for i, v, lab in rows
            if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, n = Sets([i for i, _, _ in rows]), collections.Counter()
    for k, (i, v, lab) in enumerate(good):
        for j, w, other in good[k + 1 :]:
            if lab == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links.join(i, j)
                n[i] += 1
                n[j] += 1
    return {i: (n[i], links.find(i)) for i, _, _ in rows}
