"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Terms are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. One
pass over the documents keeps the query terms of each document and its length, and gives the
number of documents, the number of terms, and the documents of every query term. The search
then takes the documents in blocks (one Arrow batch each): a block's postings are sorted by
term, and an item reads the lists of its terms from the rarest to the commonest. A document
gets an accumulator at the first list that holds it, until the highest scores that the lists
still to come can give add up to less than the k-th partial score: no document without an
accumulator can then be among the first k. From there on only accumulators that still can are
updated, exactly. The best documents of a task's earlier blocks set the bar for its later ones.
The blocks' best meet in one window of at most k rows for each task and item.

Each row of the documents with an id and a term is a document of its own; null and empty
texts, and rows without an id, don't count. Rows of items that share an item_id are one query
of all their terms; items without an id or without terms give no rows. Equal scores rank by
document id. Extra columns are dropped, empty tables give no rows, and long texts count whole.

The items are the stated query set: they are dealt into blocks of about ``BLOCK_TERMS`` terms,
and only a block's terms are broadcast; each block reads the documents once.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletyield.llm.bpe import slices
from walletyield.llm.common import stored

BLOCK_TERMS = 1 << 18
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a text as terms see them: what parts terms is a space.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).replace(UPPER.encode(), LOWER.encode())
#: Bytes of one text that are cut into terms at a time.
PART_BYTES = 4_000_000


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def counted(data: bytes) -> Counter:
    """How often each term occurs in a text, which is cut into terms part by part."""
    data = data.translate(FOLD)
    found: Counter = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART_BYTES)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


def postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), terms and tfs (the numbered ones) of documents with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        number = shared.value
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                at, n, size, terms, tfs = [], [], [0], [], []
                for i, text in enumerate(batch.column(1).slice(lo, hi - lo), lo):
                    if found := counted(text.as_buffer().to_pybytes()):
                        hits = [t for t in found if t in number]
                        at.append(i)
                        n.append(found.total())
                        terms += [number[t] for t in hits]
                        tfs += [found[t] for t in hits]
                        size.append(len(terms))
                ends = pa.array(size, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                    names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Ranking:
    """The best ``k`` documents of every item, block by block.

    ``items`` lists (terms, how often the item holds each) with the rarest term first.
    """

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, docs: int, terms: int, k: int):
        self.items, self.weight, self.docs, self.terms, self.k = items, weight, docs, terms, k
        self.score = [np.zeros(0, np.int64) for _ in items]
        self.doc = [np.zeros(0, np.int64) for _ in items]
        self.made = 0  # accumulators made, for tests

    def add(self, doc: np.ndarray, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """A block of documents; ``ends`` cuts terms and tfs by document."""
        if not len(term):
            return
        own = np.repeat(np.arange(len(doc)), np.diff(ends))
        order = np.argsort(term, kind="stable")
        own, term, tf = own[order], term[order], tf[order]
        middle = 75 + (25 * n * self.docs) // self.terms
        part = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * middle[own]))
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        start, end, top = (np.zeros(len(self.weight), np.int64) for _ in range(3))
        start[term[first]], end[term[first]] = first, np.append(first[1:], len(term))
        top[term[first]] = np.maximum.reduceat(part, first)
        for i, (wanted, times) in enumerate(self.items):
            here = top[wanted] > 0
            if here.any():
                self._rank(i, doc, wanted[here], times[here], own, part, start, end, top)

    def _rank(self, i, doc, wanted, times, own, part, start, end, top) -> None:
        k = self.k
        bar = int(self.score[i][-1]) if len(self.score[i]) == k else 1
        most = times * top[wanted]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0)  # what the lists from here on can add
        if rest[0] < bar:
            return
        partial = np.zeros(len(doc), np.int64)
        alive = None  # documents with an accumulator, once no more are made
        for j, (t, often) in enumerate(zip(wanted.tolist(), times.tolist())):
            if alive is None and rest[j] < bar:
                alive = np.flatnonzero(partial)
                self.made += len(alive)
                alive = alive[partial[alive] + rest[j] >= bar]
            docs, adds = own[start[t] : end[t]], part[start[t] : end[t]]
            if alive is None:
                partial[docs] += often * adds
                scores = partial[partial > 0]
            else:
                at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                hit = docs[at] == alive
                partial[alive[hit]] += often * adds[at[hit]]
                scores = partial[alive]
            if len(scores) >= k:
                bar = max(bar, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            if alive is not None:
                alive = alive[partial[alive] + rest[j + 1] >= bar]
        if alive is None:
            alive = np.flatnonzero(partial)
            self.made += len(alive)
        alive = alive[partial[alive] >= bar]
        score, ids = np.append(self.score[i], partial[alive]), np.append(self.doc[i], doc[alive])
        best = np.lexsort((ids, -score))[:k]
        self.score[i], self.doc[i] = score[best], ids[best]


def _ranked(found: DataFrame, chosen: list[tuple], weight: np.ndarray, docs: int, terms: int, k: int, kind: str) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast((chosen, weight))

    def run(batches):
        chosen, weight = shared.value
        ranking = Ranking([c[1:] for c in chosen], weight, docs, terms, k)
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            ranking.add(batch.column(0).to_numpy(), batch.column(1).to_numpy(), ends - ends[0],
                        lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy())
        for (item, *_), doc, score in zip(chosen, ranking.doc, ranking.score):
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(doc)), pa.array(doc), pa.array(score)],
                                                 names=["item_id", "doc_id", "score"])

    return found.where(F.size("terms") > 0).mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``k`` best documents of each item."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    asked = stored(items.where("item_id IS NOT NULL").select("item_id", F.explode(terms_of(F.col("text"))).alias("term"))
                   .groupBy("item_id", "term").agg(F.count("*").alias("times")), "items")
    blocks = -(-asked.count() // block_terms)
    best = []
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = part.orderBy("item_id", "term").collect()  # about block_terms rows
        number = {t: i for i, t in enumerate(dict.fromkeys(r.term for r in rows))}
        found = stored(postings(docs, {t.encode(): i for t, i in number.items()}), "postings")
        n_docs, n_terms = found.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        held = dict(map(tuple, found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(number))], np.int64)
        wanted: dict = {}
        for r in rows:
            if (t := number[r.term]) in held:
                wanted.setdefault(r.item_id, []).append((held[t], t, r.times))
        chosen = [(item, *np.array(sorted(ts), np.int64).T[1:]) for item, ts in wanted.items()]
        best.append(_ranked(found, chosen, weight, n_docs, n_terms, k, kind))
    if not best:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    every = best[0]
    for more in best[1:]:
        every = every.union(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
