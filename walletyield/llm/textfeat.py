"""Token-wise features of whole texts, computed by Arrow batch.

The tokens of a batch are dictionary-encoded, what depends on a token alone is computed once
for each distinct one, and sums over lines or documents are differences of running sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.bpe import release_tables, slices
from walletyield.llm.common import giving_back, stored

CACHE_TOKENS = 100_000


class TokenRows:
    """A row of numbers for each token, remembered for tokens met before."""

    def __init__(self, row: Callable[[str], tuple[float, ...]]):
        release_tables()
        self.row, self.known, self.empty = row, {}, np.array(row(""), np.float64).tobytes()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code of every token, the matrix of the distinct tokens, and where each text begins."""
        cut = pc.ascii_split_whitespace(texts)
        at = cut.offsets.to_numpy().astype(np.int64)
        flat = cut.values.slice(int(at[0]), int(at[-1] - at[0]))
        lasting = pc.not_equal(flat, "")  # splitting leaves empty strings at the ends of a text
        before = np.concatenate([[0], np.cumsum(lasting.to_numpy(zero_copy_only=False))])
        at = before[at - at[0]]
        flat = flat.filter(lasting).dictionary_encode()
        names = flat.dictionary.to_pylist()
        if len(self.known) > CACHE_TOKENS:
            met = set(names)
            self.known = {t: r for t, r in self.known.items() if t in met}
        known, row = self.known, self.row
        for t in names:
            if t not in known:
                known[t] = np.array(row(t), np.float64).tobytes()
        matrix = np.frombuffer(b"".join([known[t] for t in names]) or self.empty).reshape(-1, len(self.empty) // 8)
        return flat.indices.to_numpy().astype(np.int64), matrix, at


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of a column between neighbouring positions."""
    running = np.concatenate([[0.0], np.cumsum(values)])
    return running[at[1:]] - running[at[:-1]]


def token_sums(codes: np.ndarray, matrix: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the tokens' rows over each text, one column at a time to hold memory down."""
    return np.column_stack([sums(column[codes], at) for column in np.ascontiguousarray(matrix.T)])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learnable, rows: int) -> DataFrame:
    """At most ``rows`` documents to learn from: doc_id, text, y, h (a hash that orders them).

    ``learnable`` is a condition on doc_id. Labels that are null don't count, of several
    labels of a document the largest counts, and of several texts the greatest. The ids are
    picked first, so only this bounded list is broadcast and no text of another document moves.
    """
    picked = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learnable)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(rows))
    picked = stored(picked, "labelled")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    return stored(found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y"), F.max("h").alias("h")), "sample")


def scored(docs: DataFrame, model, score: Callable, name: str = "score", text_col: str = "text") -> DataFrame:
    """Rows with the score of their text (null: empty) as one more column, in one pass without
    a shuffle. ``score`` takes the model and gives a function of an Arrow array of texts.

    Only the texts go to Python, in batches cut by bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches):
        of = score(shared.value)
        for batch in batches:
            texts = pa.array(batch, pa.string())
            yield pd.Series(np.concatenate([of(texts.slice(a, b - a)) for a, b in slices(texts, 3_000_000)] or [np.zeros(0)]))

    of_task = giving_back(scores)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return of_task(batches)

    return docs.withColumn(name, run(F.coalesce(F.col(text_col), F.lit(""))))


class Isotonic:
    """Monotone calibration: probabilities of label 1 by score, pooled where they'd fall."""

    def __init__(self, raw: np.ndarray, y: np.ndarray):
        order = np.argsort(raw, kind="stable")
        blocks: list[list[float]] = []  # lowest score, sum of labels, count
        for x, t in zip(raw[order].tolist(), y[order].tolist()):
            if blocks and blocks[-1][0] == x:
                blocks[-1][1] += t
                blocks[-1][2] += 1
            else:
                blocks.append([x, t, 1.0])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                _, s, n = blocks.pop()
                blocks[-1][1] += s
                blocks[-1][2] += n
        self.low = np.array([b[0] for b in blocks] or [0.0])
        self.value = np.array([b[1] / b[2] for b in blocks] or [0.0])

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        """Between 0 and 1; within a pooled stretch a thousandth keeps the order of the scores."""
        step = self.value[np.clip(np.searchsorted(self.low, raw, "right") - 1, 0, None)]
        return 0.999 * step + 0.001 / (1 + np.exp(-np.clip(raw, -30, 30)))
