"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad. A line's features are its own (how its tokens look, how
often they repeat, its length) and the same of the lines before and after it; neighbouring
labels interact. The field is learnt by gradient ascent on the likelihood of the lines of a
bounded sample, where a line takes the label of its document. A document's raw score is the
mean of its lines' marginal probabilities of being good (forward-backward), weighted by
length, and isotonic regression over sample documents turns it into a probability.

Null texts are empty, and an empty text is one empty line of weight 1. Without labelled rows of both
kinds the score is the share of label 1 among them (0 if there are none). Repeated
rows and rows without an id are scored like any other, and extra columns pass through. A very
long text is scored whole, by lines; only the sample leaves out documents of more than
``SAMPLE_LINES`` lines.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame

from walletyield.llm.common import giving_back
from walletyield.llm.textfeat import Isotonic, TokenRows, labelled_sample, sums, token_sums

SAMPLE_ROWS = 8_000
SAMPLE_LINES = 5_000
SIGN_RUN = re.compile(r"([^\w\s])\1+")


def token_row(token: str) -> tuple[float, ...]:
    """Length, letters, digits, capitals, sign run, no letter at all, title case, drawn out, full stop, long."""
    letters = sum(c.isalpha() for c in token)
    digits = sum(c.isdigit() for c in token)
    upper = letters > 1 and token.upper() == token and token.lower() != token
    return (float(len(token)), float(letters), float(digits), float(upper), float(SIGN_RUN.search(token) is not None),
            float(letters == 0), float(token[:1].isupper() and not upper), float(any(a == b == c for a, b, c in zip(token, token[1:], token[2:]))),
            float(token[-1:] in ".!?"), float(len(token) > 15))


def own_features(lines: pa.Array, rows: TokenRows) -> np.ndarray:
    codes, matrix, at = rows(lines)
    count = (at[1:] - at[:-1]).astype(float)
    n = np.maximum(count, 1.0)
    total = token_sums(codes, matrix, at)
    line = np.repeat(np.arange(len(lines)), at[1:] - at[:-1])
    again = np.zeros(len(codes))
    if len(codes) > 1:
        again[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    distinct = np.bincount(np.unique(line * (len(matrix) + 1) + codes) // (len(matrix) + 1), minlength=len(lines)) if len(codes) else np.zeros(len(lines))
    chars = np.maximum(total[:, 0], 1.0)
    return np.column_stack([
        np.log1p(count) / 4, count == 0, count < 4, total[:, 0] / n / 8, total[:, 1] / chars, total[:, 2] / chars,
        total[:, 3] / n, total[:, 4] / n, total[:, 5] / n, total[:, 6] / n, total[:, 7] / n, total[:, 8] / n, total[:, 9] / n,
        sums(again, at) / n, distinct / n, (distinct / n < 0.5) & (count > 8), total[:, 3] / n > 0.5,
        total[:, 4] / n > 0.3, total[:, 5] / n > 0.25])


def line_features(texts: pa.Array, rows: TokenRows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and weight of every line, and where each document's lines begin."""
    cut = pc.split_pattern(texts, "\n")
    at = cut.offsets.to_numpy().astype(np.int64)
    lines = cut.values.slice(int(at[0]), int(at[-1] - at[0]))
    at = at - at[0]
    own = own_features(lines, rows)
    codes = lines.dictionary_encode().indices.to_numpy()
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    first[at[:-1]], last[at[1:] - 1] = True, True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    same = np.zeros(len(lines))
    if len(lines) > 1:
        same[1:] = (codes[1:] == codes[:-1]) & ~first[1:]
    x = np.column_stack([np.ones(len(lines)), own, before, after, first, last, same, np.roll(same, -1) * ~last])
    weight = np.maximum(pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(float), 1.0)
    return x, weight, at


@dataclass
class Field:
    """Weights of the features for the label good, and the scores of neighbouring labels."""

    weights: np.ndarray
    links: np.ndarray

    def marginals(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the mean-free counts of neighbouring labels per link.

        All chains advance together, one line at a time, sorted so that the longer ones are
        a prefix.
        """
        score = np.zeros((len(x), 2))
        score[:, 1] = x @ self.weights
        length = at[1:] - at[:-1]
        order = np.argsort(-length, kind="stable")
        start, length = at[:-1][order], length[order]
        longest = int(length[0]) if len(length) else 0
        alive = [int(np.searchsorted(-length, -t, "left")) for t in range(longest)]  # chains with more than t lines
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        for t in range(longest):
            i = start[: alive[t]] + t
            f = score[i]
            if t:
                prev = forward[i - 1]
                f = f + np.logaddexp(prev[:, :1] + self.links[0], prev[:, 1:] + self.links[1])
            forward[i] = f - np.logaddexp(f[:, :1], f[:, 1:])
        for t in range(longest - 2, -1, -1):
            i = start[: alive[t + 1]] + t
            nxt = score[i + 1] + backward[i + 1]
            b = np.logaddexp(nxt[:, :1] + self.links[:, 0], nxt[:, 1:] + self.links[:, 1])
            backward[i] = b - np.logaddexp(b[:, :1], b[:, 1:])
        both = forward + backward
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50)))
        inner = np.ones(len(x), bool)
        inner[at[:-1][at[1:] > at[:-1]]] = False
        i = np.flatnonzero(inner)
        pair = forward[i - 1][:, :, None] + self.links + (score[i] + backward[i])[:, None, :]
        pair = np.exp(pair - pair.max((1, 2), keepdims=True))
        return good, (pair / pair.sum((1, 2), keepdims=True)).sum(0)

    @staticmethod
    def learn(x: np.ndarray, at: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.05, ridge: float = 1e-3) -> Field:
        """Adam on the mean log-likelihood; y has the label of each line."""
        field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
        inner = np.ones(len(x), bool)
        inner[at[:-1][at[1:] > at[:-1]]] = False
        i = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[i - 1].astype(int), y[i].astype(int)), 1)
        moment, square = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
        for k in range(1, steps + 1):
            good, pairs = field.marginals(x, at)
            grad = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) / len(x)
            grad -= ridge * np.concatenate([field.weights, field.links.ravel()])
            moment = 0.9 * moment + 0.1 * grad
            square = 0.99 * square + 0.01 * grad**2
            step = rate * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
            field = Field(field.weights + step[:-4], field.links + step[-4:].reshape(2, 2))
        return field


def document_scores(good: np.ndarray, weight: np.ndarray, at: np.ndarray) -> np.ndarray:
    return sums(good * weight, at) / sums(weight, at)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


@dataclass
class Model:
    field: Field | None
    calibrate: Isotonic | None
    share: float

    def __call__(self, texts: pa.Array, rows: TokenRows) -> np.ndarray:
        if self.field is None:
            return np.full(len(texts), self.share)
        x, weight, at = line_features(texts, rows)
        good, _ = self.field.marginals(x, at)
        return self.calibrate(logit(document_scores(good, weight, at)))


def train(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, label, learnable, rows)

    def run(batches):
        of = TokenRows(token_row)
        for batch in batches:
            x, weight, at = line_features(batch.column(0), of)
            cut = list(zip(at[:-1].tolist(), at[1:].tolist()))
            keep = pa.array([b - a <= SAMPLE_LINES for a, b in cut])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([x[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary()),
                 pa.array([weight[a:b].tobytes() for a, b in cut], pa.binary())], names=["y", "h", "x", "weight"]).filter(keep)

    got = sample.select("text", "y", "h").mapInArrow(giving_back(run), "y int, h long, x binary, weight binary").collect()
    got.sort(key=lambda r: (r.h, bytes(r.x)))
    y = np.array([r.y > 0 for r in got], float)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < y.sum() < len(y):
        return Model(None, None, share)
    size = np.array([len(r.weight) // 8 for r in got])
    at = np.concatenate([[0], np.cumsum(size)])
    x = np.frombuffer(b"".join([r.x for r in got]), np.float32).reshape(at[-1], -1).astype(float)
    weight = np.frombuffer(b"".join([r.weight for r in got]))
    # the scores to calibrate by come from the field of the other half of the sample
    raw, half = np.zeros(len(y)), np.arange(len(y)) % 2
    for k in (0, 1):
        i, j = half != k, half == k
        if not 0 < y[i].sum() < i.sum():
            i = np.ones(len(y), bool)
        li, lj = np.repeat(i, size), np.repeat(j, size)
        field = Field.learn(x[li], np.concatenate([[0], np.cumsum(size[i])]), np.repeat(y[i], size[i]))
        ends = np.concatenate([[0], np.cumsum(size[j])])
        raw[j] = logit(document_scores(field.marginals(x[lj], ends)[0], weight[lj], ends))
    return Model(Field.learn(x, at, np.repeat(y, size)), Isotonic(raw, y), share)


def scorer(model: Model):
    rows = TokenRows(token_row)
    return lambda texts: model(texts, rows)
