import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from walletyield.llm import quality, toxicity
from walletyield.llm.common import crc_of_id
from walletyield.llm.textfeat import Isotonic, TokenRows, labelled_sample, scored

WORDS = "the river ran over old stones and the light of morning fell upon garden walls while people spoke about trade".split()


def corpus(n=500):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        lines = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 15))) + "." for _ in range(rng.randint(1, 6))]
        toxic = i % 6 == 0
        bad = i % 7 == 0
        if toxic:
            lines[-1] += " you are " + rng.choice(["vermin", "vermins", "blockhead", "dimwit"])
        if bad:
            lines += [" ".join(["BUY!!! ###"] * 12)] * 4
        docs.append((i, "\n".join(lines), "x", 1.0))
        labels.append((i, int(not bad), int(toxic), "y"))
    return docs, labels


def frames(spark):
    docs, labels = corpus()
    extra = [(None, "no id", "x", 1.0), (900, None, "x", 1.0), (901, "", "x", 1.0), (902, "word " * 60000, "x", 1.0), (3, docs[3][1], "x", 1.0)]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string, y string, score double").repartition(3)
    lab = spark.createDataFrame([*labels, (None, 1, 1, "y"), (901, None, None, "y"), (5, labels[5][1], labels[5][2], "y")],
                                "doc_id long, quality int, toxic int, h string")
    return d, lab, labels


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, module, label):
    docs, labels, known = frames(spark)
    learnable = crc_of_id() % 5 != 0
    model = module.train(docs, labels, label, learnable)
    got = scored(docs, model, module.scorer).select("doc_id", (crc_of_id() % 5 == 0).alias("held"), "score").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    y = {i: (q if label == "quality" else t) for i, q, t, _ in known}
    held = [r for r in got if r.held and r.doc_id in y]
    assert len(held) > 50
    assert sum((r.score >= 0.3) == bool(y[r.doc_id]) for r in held) >= 0.97 * len(held)
    again = scored(docs, module.train(docs, labels, label, learnable), module.scorer).select("doc_id", "score").collect()
    assert sorted(map(tuple, again), key=str) == sorted(((r.doc_id, r.score) for r in got), key=str)
    # no labels, one kind of label, no documents
    none = module.train(docs, labels.limit(0), label, learnable)
    assert {r.score for r in scored(docs, none, module.scorer).select("score").collect()} == {0.0}
    one = module.train(docs, labels.where(F.col(label) == 1), label, learnable)
    assert {r.score for r in scored(docs, one, module.scorer).select("score").collect()} == {1.0}
    assert scored(docs.limit(0), model, module.scorer).collect() == []


def test_sample_is_bounded(spark):
    docs, labels, _ = frames(spark)
    got = labelled_sample(docs, labels, "toxic", F.lit(True), 40).collect()
    assert len(got) <= 40 and len({r.doc_id for r in got}) == len(got)


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    raw = np.round(rng.normal(size=400), 1)
    y = (rng.random(400) < 1 / (1 + np.exp(-raw))).astype(float)
    fit = Isotonic(raw, y)
    out = fit(np.sort(raw))
    assert (np.diff(out) >= 0).all() and abs(fit(raw).mean() - y.mean()) < 0.01


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    x, links, w = rng.normal(size=(9, 3)), rng.normal(size=(2, 2)), rng.normal(size=3)
    at = np.array([0, 4, 4, 5, 9])
    good, pairs = quality.Field(w, links).marginals(x, at)
    want, both = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(at[:-1], at[1:]):
        n, z, part, pair = b - a, 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(2**n) if n else ():
            y = [code >> k & 1 for k in range(n)]
            s = np.exp(sum(x[a + k] @ w * y[k] for k in range(n)) + sum(links[p, q] for p, q in zip(y, y[1:])))
            z += s
            part += s * np.array(y)
            for p, q in zip(y, y[1:]):
                pair[p, q] += s
        if n:
            want[a:b], both = part / z, both + pair / z
    assert np.allclose(good, want) and np.allclose(pairs, both)


def test_features_of_odd_texts():
    texts = pa.array(["", "   ", "\n\n", "you YOU idiot!!!", "i d i o t", "1d10t you", "a" * 5000])
    x = toxicity.document_features(texts, TokenRows(toxicity.token_row({"idiot": 3.0})))
    assert x.shape == (7, len(toxicity.FEATURES)) and np.isfinite(x).all()
    assert x[3, 5] == 1 and x[5, toxicity.FEATURES.index("disguised_lex")] == 1
    lines, weight, at = quality.line_features(texts, TokenRows(quality.token_row))
    assert np.isfinite(lines).all() and at.tolist() == [0, 1, 2, 5, 6, 7, 8, 9] and (weight >= 1).all()
