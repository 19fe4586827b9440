"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of a lexicon learnt from labelled rows (words and word
beginnings that toxic documents hold far more often), how near a second-person word its hits
stand, capitals, punctuation, and obfuscation (letters mixed with digits or signs, drawn-out
letters, lexicon hits once such signs are read as letters).

The model is learnt from a sample of at most ``SAMPLE_ROWS`` labelled documents, cut in two
halves: features of a half use the lexicon of the other, and the calibration uses the scores
of trees of the other. Every document is then scored in one pass without a shuffle. Null texts are empty, empty texts get the score that their features lead to.
Without labelled rows of both kinds the score is the share of label 1 among them (0 if
there are none). Repeated rows and rows without an id are scored like any other, and extra
columns pass through. A very long text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletyield.llm.common import giving_back
from walletyield.llm.textfeat import Isotonic, TokenRows, labelled_sample, token_sums

SAMPLE_ROWS = 12_000
LEXICON_SIZE = 600
NEAR_WORDS = 6
#: Second-person words of the languages at hand (fixed values).
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch euer ihr tu te ton ta tes toi vous votre vos "
                          "tú ti tuyo usted ustedes vosotros vuestro su".split())
#: Signs that stand for letters in disguised words (fixed values).
READ_AS = str.maketrans("013457@$!*", "oieastasi*")
PUNCTUATION = ".,;:!?\"'()[]{}<>|%&#*$-_/\\~`^+=…«»“”‘’¿¡"
DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
FEATURES = ["n_words", "lex_words", "lex_density", "lex_weight", "lex_strongest", "lex_near_you", "lex_near_density", "you_density",
            "caps_words", "caps_lex", "exclaim_density", "question_density", "sign_density", "digit_density",
            "mixed_density", "drawn_density", "disguised_lex", "long_words"]


def bare(token: str) -> str:
    return token.strip(PUNCTUATION).lower()


def terms(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself and its beginnings."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


def weight_of(word: str, lexicon: dict[str, float]) -> float:
    return max([lexicon.get(t, 0.0) for t in terms(word)]) if word else 0.0


def token_row(lexicon: dict[str, float]):
    """Per token: lexicon weight, hit, second person, capitals and hit, '!', '?', signs, digits,
    mixed, drawn out, disguised hit, long word."""
    def row(token: str) -> tuple[float, ...]:
        word = bare(token)
        weight = weight_of(word, lexicon)
        plain = word.isalpha()
        mixed = not plain and any(c.isalpha() for c in word) and any(not c.isalpha() and c not in "'’-" for c in word)
        drawn = DRAWN_OUT.search(word) is not None
        disguised = 0.0
        if mixed or drawn:
            clear = DRAWN_OUT.sub(r"\1", word.translate(READ_AS))
            disguised = float(weight == 0 and weight_of(clear, lexicon) > 0)
        caps = len(word) > 1 and token.upper() == token and token.lower() != token
        hit = float(weight > 0)
        letters = sum(c.isalpha() for c in token)
        digits = sum(c.isdigit() for c in token)
        return (weight, hit, float(word in SECOND_PERSON), float(caps), float(caps and hit > 0), float(token.count("!")),
                float(token.count("?")), float(len(token) - letters - digits), float(digits), float(mixed), float(drawn),
                disguised, float(len(word) > 14))
    return row


def document_features(texts: pa.Array, rows: TokenRows) -> np.ndarray:
    codes, matrix, at = rows(texts)
    total = token_sums(codes, matrix, at)
    weights, hit, second = (matrix[:, c][codes] for c in (0, 1, 2))
    n = np.maximum(at[1:] - at[:-1], 1.0)
    weight = np.concatenate([weights, [0.0]])
    strongest = np.maximum.reduceat(weight, np.minimum(at[:-1], len(weight) - 1)) if len(texts) else np.zeros(0)
    strongest = np.where(at[1:] > at[:-1], strongest, 0.0)
    # hits with a second-person word at most NEAR_WORDS away in the same document
    hits = np.flatnonzero(hit > 0)
    doc = np.searchsorted(at, hits, "right") - 1
    you = np.concatenate([[0.0], np.cumsum(second)])
    near = you[np.minimum(hits + NEAR_WORDS + 1, at[doc + 1])] > you[np.maximum(hits - NEAR_WORDS, at[doc])]
    near = np.bincount(doc[near], minlength=len(texts)).astype(float)
    return np.column_stack([
        np.log1p(at[1:] - at[:-1]), total[:, 1], total[:, 1] / n, total[:, 0], strongest, near, near / n, total[:, 2] / n,
        total[:, 3] / n, total[:, 4], total[:, 5] / n, total[:, 6] / n, total[:, 7] / n, total[:, 8] / n,
        total[:, 9] / n, total[:, 10] / n, total[:, 11], total[:, 12] / n])


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Terms by log-odds of standing in a toxic document; counted by task, then by term."""
    def count(batches):
        found: Counter = Counter()

        def rows():
            names, ys = zip(*found)
            n, y = np.fromiter(found.values(), np.int64), np.array(ys) > 0
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.where(y, n, 0)), pa.array(np.where(y, 0, n))],
                                              names=["term", "bad", "good"])

        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                for t in {t for w in {bare(x) for x in text.as_py().split()} if w for t in terms(w)}:
                    found[t, y] += 1
                if len(found) > 100_000:
                    yield rows()
        if found:
            yield rows()

    n = {r.y > 0: r["count"] for r in sample.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect()}
    bad, good = n.get(True, 0), n.get(False, 0)
    if not bad or not good:
        return {}
    odds = F.log((F.col("bad") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(good + 1.0))
    rows = (sample.select("text", "y").mapInArrow(giving_back(count), "term string, bad long, good long").groupBy("term")
            .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).withColumn("odds", odds)
            .where((F.col("bad") >= max(3, 0.004 * bad)) & (F.col("odds") > 2))
            .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "term").limit(size).collect())
    return {r.term: float(r.odds) for r in rows}


class Trees:
    """Gradient boosting of shallow trees on binned features, with logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15,
                 bins: int = 32, least: int = 8, ridge: float = 2.0):
        self.rate = rate
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = self.bin(x)
        width = bins + 1
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        self.base = math.log(share / (1 - share))
        raw = np.full(len(y), self.base)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # feature and bin by node, leaf values
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, width, np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.zeros(count)
                for f in range(x.shape[1]):
                    key = (node - first) * width + binned[:, f]
                    sg, sh, sn = (np.bincount(key, w, count * width).reshape(count, width) for w in (g, h, None))
                    lg, lh, ln = (s.cumsum(1) for s in (sg, sh, sn))
                    tg, th, tn = lg[:, -1:], lh[:, -1:], ln[:, -1:]
                    gain = lg**2 / (lh + ridge) + (tg - lg) ** 2 / (th - lh + ridge) - tg**2 / (th + ridge)
                    gain[(ln < least) | (tn - ln < least)] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    better = top > best + 1e-9
                    best[better] = top[better]
                    feature[first : first + count][better], cut[first : first + count][better] = f, at[better]
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**depth - 1)
            value = np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
            raw += rate * value[leaf]
            self.trees.append((feature, cut, value))

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)]).astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        binned, raw, rows = self.bin(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            raw += self.rate * value[node - len(feature)]
        return raw


class Model:
    def __init__(self, lexicon: dict[str, float], trees: Trees | None, calibrate: Isotonic | None, share: float):
        self.lexicon, self.trees, self.calibrate, self.share = lexicon, trees, calibrate, share


def sample_features(sample: DataFrame, lexicon: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the (bounded) sample, in the order of its hash."""
    def run(batches):
        rows = TokenRows(token_row(lexicon))
        for batch in batches:
            x = document_features(batch.column(0), rows)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["y", "h", "x"])

    got = sorted(sample.select("text", "y", "h").mapInArrow(giving_back(run), "y int, h long, x binary").collect(), key=lambda r: (r.h, bytes(r.x)))
    x = np.array([np.frombuffer(r.x) for r in got]).reshape(len(got), len(FEATURES))
    return x, np.array([r.y > 0 for r in got], np.float64)


def train(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, label, learnable, rows)
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))
    # each half gets its features by the lexicon, and its raw scores by the trees, of the other
    parts = [sample_features(sample.where(half == k), learn_lexicon(sample.where(half != k))) for k in (0, 1)]
    x, y = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    share = float(y.mean()) if len(y) else 0.0
    lexicon = learn_lexicon(sample)
    if not 0 < y.sum() < len(y):
        return Model(lexicon, None, None, share)
    trees = Trees(x, y)
    if all(0 < p[1].sum() < len(p[1]) for p in parts):
        raw = np.concatenate([Trees(*parts[1 - k])(parts[k][0]) for k in (0, 1)])
    else:
        raw = trees(x)
    return Model(lexicon, trees, Isotonic(raw, y), share)


def scorer(model: Model):
    rows = TokenRows(token_row(model.lexicon))

    def score(texts: pa.Array) -> np.ndarray:
        if model.trees is None:
            return np.full(len(texts), model.share)
        return model.calibrate(model.trees(document_features(texts, rows)))

    return score
