import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from walletyield.llm import ranked

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(item, rank, doc, score) with every document scored for every item."""
    held = [(d, Counter(terms(t))) for d, t in docs if d is not None and terms(t)]
    df = Counter(t for _, c in held for t in c)
    asked, out = {}, []
    for i, t in items:
        if i is not None:
            asked.setdefault(i, []).extend(terms(t))
    total = sum(c.total() for _, c in held)
    weight = {t: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * n + 1))) for t, n in df.items()}
    for i, ts in asked.items():
        found = []
        for d, c in held:
            m = 75 + (25 * c.total() * len(held)) // total
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def sample(n_docs, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    pick = lambda n: " ".join(rnd.choices(words, weights, k=n))
    docs = [(i, pick(rnd.randint(1, 60))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[3][1]) for i in range(40)]  # ties
    docs += [(5, "w7 W7 again"), (5, "w7 W7 again"), (None, "w7 w9"), (9001, None), (9002, ""), (9003, " ,;! "),
             (9004, "É é ÀB\u0001Cd 漢字-漢字 😀 x_y"), (9005, "w250 " + "w0," * 50000)]
    items = [(i, pick(rnd.randint(1, 25))) for i in range(25)]
    items += [(30, "w0 w0 w1"), (31, ""), (32, None), (None, "w1"), (33, "nowhere"), (34, "É é àb cd 漢字 😀 y"), (30, "w250"), (35, "w7 again AGAIN")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n long, terms string").repartition(3),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id long"))


@pytest.mark.parametrize("block_terms", [60, ranked.BLOCK_TERMS])
def test_as_scoring_every_document(spark, block_terms):
    docs, items = sample(400, 3)
    got = ranked.search(*frames(spark, docs, items), 7, block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs, items, 7)


def test_empty_tables(spark):
    docs, items = frames(spark, *sample(5, 1))
    assert ranked.search(docs.limit(0), items).collect() == []
    assert ranked.search(docs, items.limit(0)).collect() == []
    assert ranked.search(docs.where("text IS NULL"), items).collect() == []


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(ranked, "PART_BYTES", 7)
    text = "one Two,three one  two éÉ " * 20 + "tail"
    assert ranked.counted(text.encode()) == Counter(t.encode() for t in terms(text))


def test_fewer_accumulators_than_documents():
    rnd = np.random.default_rng(2)
    docs, weight = 5000, np.array([8000, 6000, 20, 10])
    per_term = [np.sort(rnd.choice(docs, n, replace=False)) for n in (40, 60, 4000, 4500)]
    own = np.concatenate(per_term)
    term = np.repeat(np.arange(4), [len(p) for p in per_term])
    order = np.lexsort((term, own))
    ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=docs))])
    items = [(np.arange(4), np.ones(4, np.int64))]
    ranking = ranked.Ranking(items, weight, docs, docs * 3, 20)
    ranking.add(np.arange(docs), np.full(docs, 3), ends, term[order], np.ones(len(own), np.int64))
    score = np.zeros(docs, np.int64)
    np.add.at(score, own, weight[term] * (10**9 // (1000 + 12 * 100)))
    best = np.lexsort((np.arange(docs), -score))[:20]
    assert ranking.made <= 100 and np.array_equal(ranking.doc[0], best) and np.array_equal(ranking.score[0], score[best])
