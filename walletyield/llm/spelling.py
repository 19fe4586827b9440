"""Spelling variants: words grouped by one edit, found with a bidirectional FM index.

Two words one edit apart agree in all but one code point, so a cut of one of them leaves
either the part in front of it or the part behind it unchanged in the other. Words of length l
are found by queries of length l - 1, l and l + 1; for all of them the cut lies behind
``(l - 1) // 2`` code points, so the front search meets them by their length and that many first
code points, the back search by their length and the rest of ``(l - 1)`` last ones. These keys
deal words and queries into cells of about ``CELL_WORDS`` words; a key held by more words is
dealt in blocks of words against blocks of queries, so no cell grows with the vocabulary.

A cell's words, sorted and each between two delimiters, are indexed by the suffix ranks of
their text and of the reversed text. A search scheme matches one half of the query exactly
and extends across the other allowing its one error (a substitution, a code point more, or one
less, as the lengths say), all queries of a kind side by side. Stepping to the right moves the
interval in the reversed text and keeps the one in the text in step; at the closing delimiter
the suffix rank is the number of the word.

A pair that both searches reach counts for the front search alone, so every pair is found
once. Roots follow the forms by pointer jumping: a form occurs at least twice as often as its
word, so chains are short and never closed.

Null texts have no words; in rows without an id, no code point is deleted. Rows that repeat
count again. Extra columns are dropped, an empty table gives no rows, long texts and long
words count whole (the words of a cell are bounded in code points too, but for one alone).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.common import remove_folder, shared_folder, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETE_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Distinct words that a task counts before it hands them on, and code points it cuts at a time.
FLUSH_WORDS = 200_000
PART_CHARS = 2_000_000
CELL_WORDS = 16_384
#: A rank sample stands at every so many positions.
STEP = 32


def runs_of(text: bytes) -> Iterator[Counter]:
    """Counts of the runs of a text with A-Z in lower case, part by part."""
    whole, at = text.lower().decode(), 0  # bytes change A-Z alone
    while at < len(whole):
        end = at + PART_CHARS
        if more := RUN.match(whole, end):
            end = more.end()
        yield Counter(RUN.findall(whole, at, end))
        at = end


def spoilt(run: str, doc_id: int) -> str:
    """The run, without one code point where the checksum of id and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words of all texts that are long and frequent enough."""
    rows = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def batch_of(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for runs in runs_of(text.as_buffer().to_pybytes()):
                    for word, n in runs.items():
                        if len(word) >= least_length:
                            found[word if i is None else spoilt(word, i)] += n
                if len(found) > FLUSH_WORDS:
                    yield batch_of(found)
                    found.clear()
        yield batch_of(found)

    return (rows.mapInArrow(run, "word string, n long").where(F.length("word") >= least_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


class Ranks:
    """Suffix ranks of a text over the codes 0 (delimiter) to ``size`` - 1."""

    def __init__(self, text: np.ndarray, size: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while True:  # ranks of ever longer beginnings of the suffixes
            behind = np.full(n, -1, np.int64)
            behind[: n - width] = rank[width:]
            order = np.lexsort((behind, rank))
            new = np.empty(n, np.int64)
            step = (rank[order][1:] != rank[order][:-1]) | (behind[order][1:] != behind[order][:-1])
            new[order] = np.concatenate([[0], np.cumsum(step)])
            rank, width = new, width * 2
            if n == 0 or rank[order[-1]] == n - 1:
                break
        self.size = size
        before = text[order - 1]  # the code in front of each suffix, in rank order
        pad = -n % STEP + STEP
        self.window = np.pad(before, (0, pad), constant_values=255).astype(np.uint8).reshape(-1, STEP)
        here = np.zeros((len(self.window) + 1, size), np.int32)
        for c in range(size):
            here[1:, c] = np.cumsum((self.window == c).sum(1))
        self.sample = here
        self.below = np.concatenate([np.zeros((len(here), 1), np.int32), np.cumsum(here, 1, dtype=np.int32)[:, :-1]], 1)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self._inside = np.arange(STEP)

    def occurrences(self, code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the code, and how often a smaller one, stands in front of the first ``at`` suffixes."""
        block, inside = at // STEP, at % STEP
        window = np.where(self._inside < inside[:, None], self.window[block], 255)
        return (self.sample[block, code] + (window == code[:, None]).sum(1),
                self.below[block, code] + (window < code[:, None]).sum(1))


class Index:
    """A bidirectional index of distinct words (codes from 1), sorted by code."""

    def __init__(self, words: list[np.ndarray], size: int):
        gap = np.zeros(1, np.int64)
        text = np.concatenate([x for w in words for x in (gap, w)] + [gap])
        self.ahead, self.reversed = Ranks(text, size), Ranks(text[::-1], size)
        self.size, self.length = size, len(text)

    def all(self, n: int) -> np.ndarray:
        """Intervals of the empty string: first rank in the text, in the reversed text, and size."""
        return np.tile(np.array([[0, 0, self.length]], np.int64), (n, 1))

    def extend(self, at: np.ndarray, code: np.ndarray, right: bool) -> np.ndarray:
        """The intervals of the strings with one more code to the right or the left."""
        ranks, own, other = (self.reversed, 1, 0) if right else (self.ahead, 0, 1)
        low, less_low = ranks.occurrences(code, at[:, own])
        high, less_high = ranks.occurrences(code, at[:, own] + at[:, 2])
        out = np.empty_like(at)
        out[:, own] = ranks.start[code] + low
        out[:, other] = at[:, other] + less_high - less_low
        out[:, 2] = high - low
        return out

    def branches(self, at: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, code) of the letters that stand beside the strings on that side."""
        ranks, own = (self.reversed, 1) if right else (self.ahead, 0)
        few = at[:, 2] <= self.size
        narrow = np.flatnonzero(few)
        row = np.repeat(narrow, at[narrow, 2])
        where = np.repeat(at[narrow, own], at[narrow, 2]) + np.arange(len(row)) - np.repeat(np.cumsum(at[narrow, 2]) - at[narrow, 2], at[narrow, 2])
        pairs = np.unique(row * self.size + ranks.window.reshape(-1)[where])
        wide = np.repeat(np.flatnonzero(~few), self.size - 1)
        codes = np.tile(np.arange(1, self.size), int((~few).sum()))
        pairs = pairs[pairs % self.size > 0]
        return np.concatenate([pairs // self.size, wide]), np.concatenate([pairs % self.size, codes])

    def search(self, queries: np.ndarray, cut: int, more: int, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word number) of words one error away in one half, the other being equal.

        ``queries`` is a matrix of words of equal length, ``cut`` the length of the left half,
        ``more`` how much longer the words sought are (-1, 0 or 1), ``right`` whether the
        left half is matched and the right one holds the error, or the other way round.
        """
        n, length = queries.shape
        if right:
            exact = [np.zeros(n, np.int64), *queries[:, :cut].T]
            half = queries[:, cut:]
        else:
            exact = [np.zeros(n, np.int64), *queries[:, cut:][:, ::-1].T]
            half = queries[:, :cut][:, ::-1]
        query, at = np.arange(n), self.all(n)
        for column in exact:
            at = self.extend(at, column[query], right)
            query, at = query[at[:, 2] > 0], at[at[:, 2] > 0]
        done_query, done_at = query[:0], at[:0]
        width = half.shape[1]
        for pos in range(width + 1):
            # the error at this position, for strings that have none yet
            if len(query) and (pos < width or more == 1):
                if more == -1:
                    new_query, new_at = query, at
                else:
                    row, code = self.branches(at, right)
                    if more == 0:
                        other = code != half[query[row], pos]
                        row, code = row[other], code[other]
                    new_query, new_at = query[row], self.extend(at[row], code, right)
            else:
                new_query, new_at = query[:0], at[:0]
            # those with the error behind them step on; an added code point leaves the position as it is
            if more == 1:
                done_query, done_at = np.concatenate([done_query, new_query]), np.concatenate([done_at, new_at])
            if pos < width:
                done_at = self.extend(done_at, half[done_query, pos], right)
                at = self.extend(at, half[query, pos], right)
            if more != 1:
                done_query, done_at = np.concatenate([done_query, new_query]), np.concatenate([done_at, new_at])
            done_query, done_at = done_query[done_at[:, 2] > 0], done_at[done_at[:, 2] > 0]
            query, at = query[at[:, 2] > 0], at[at[:, 2] > 0]
        done_at = self.extend(done_at, np.zeros(len(done_at), np.int64), right)
        # a word occurs once, and its rank among the suffixes that begin with a delimiter is
        # its number but for the delimiter that ends the text, which comes first
        hit = done_at[:, 2] > 0
        found = np.unique(done_query[hit] * self.length + done_at[hit, 0] - 1)
        return found // self.length, found % self.length


def cell_pairs(rows: pa.Table) -> pa.Table:
    """word, n_near, form_n, form: what the words of one cell find in it."""
    word, n = np.array(rows["word"].to_pylist(), object), rows["n"].to_numpy()
    target, length, right = (rows[c].to_numpy() for c in ("target", "length", "front"))
    out: dict[str, list] = {c: [] for c in ("word", "n_near", "form_n", "form")}
    hold = np.flatnonzero(target)
    if len(hold) and len(hold) < len(word):
        _, first = np.unique(word[hold], return_index=True)
        hold = hold[first]  # sorted, as the codes are: both sides of a key may bring a word here
        letters = np.unique(np.frombuffer("".join(word).encode("latin-1"), np.uint8))
        code = np.zeros(256, np.int64)
        code[letters] = np.arange(1, len(letters) + 1)
        coded = lambda w: code[np.frombuffer(w.encode("latin-1"), np.uint8)]
        index = Index([coded(w) for w in word[hold]], len(letters) + 1)
        asked = np.flatnonzero(~target)
        own = np.array([len(w) for w in word[asked]])
        kinds = np.stack([own, length[asked], right[asked]], 1)
        for (size, goal, front) in np.unique(kinds, axis=0).tolist():
            chosen = asked[(kinds == (size, goal, front)).all(1)]
            for part in np.array_split(chosen, -(-len(chosen) // 4096)):
                cut = (goal - 1) // 2
                i, j = index.search(np.stack([coded(w) for w in word[part]]), cut, goal - size, bool(front))
                if not front:  # the front search has the pairs with an equal front
                    lone = np.array([not word[hold[b]].startswith(word[part[a]][:cut]) for a, b in zip(i, j)], bool)
                    i, j = i[lone], j[lone]
                found = hold[j]
                order = np.lexsort((j, -n[found], i))
                i, found = i[order], found[order]
                begin = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else i
                out["word"] += word[part[i[begin]]].tolist()
                out["n_near"] += np.diff(np.append(begin, len(i))).tolist()
                out["form_n"] += n[found[begin]].tolist()
                out["form"] += word[found[begin]].tolist()
    return pa.table([pa.array(out["word"], pa.string()), pa.array(out["n_near"], pa.int64()),
                     pa.array(out["form_n"], pa.int64()), pa.array(out["form"], pa.string())], names=list(out))


def near_words(counts: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n_near, form_n, form (the most frequent near word) of words with a near word."""
    front = F.explode(F.array(F.lit(True), F.lit(False))).alias("front")
    half = F.expr("IF(front, left(word, CAST((length - 1) DIV 2 AS INT)), right(word, CAST(length - 1 - (length - 1) DIV 2 AS INT)))")
    targets = counts.withColumn("length", F.length("word")).select("word", "n", "length", front).withColumn("half", half)
    size = F.length("word")
    queries = (counts.select("word", "n", F.explode(F.array(size - 1, size, size + 1)).alias("length"))
               .select("word", "n", "length", front).withColumn("half", half))
    key = ["front", "length", "half"]
    weight = F.greatest(F.lit(1.0), F.col("length") / 16.0)
    held = (targets.select(*key, weight.alias("words"), F.lit(0.0).alias("asked"))
            .union(queries.select(*key, F.lit(0.0), weight / 4)).groupBy(*key).agg(F.sum("words").alias("words"), F.sum("asked").alias("asked")))
    wide = (held.where((F.col("words") > cell_words) | (F.col("asked") > cell_words))
            .select(*key, *(F.greatest(F.lit(1), F.ceil(F.col(c) / cell_words)).alias(c) for c in ("words", "asked"))))
    total = targets.agg(F.sum(weight)).first()[0] or 0
    cells = max(1, int(-(-total // cell_words)))

    def dealt(rows: DataFrame, target: bool) -> DataFrame:
        """Blocks of words meet blocks of queries where a key is wide; other keys have one of each."""
        own, other = ("words", "asked") if target else ("asked", "words")
        rows = rows.join(wide, key, "left").withColumn("split", F.col("words").isNotNull())
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)).cast("int") - 1)).alias(other)
        rows = rows.select("word", "n", *key, "split", F.pmod(F.xxhash64("word"), F.coalesce(own, F.lit(1)).cast("long")).cast("int").alias(own), every)
        cell = F.when(F.col("split"), F.xxhash64(*key, "words", "asked")).otherwise(F.pmod(F.xxhash64(*key), F.lit(cells)))
        return rows.select("word", "n", "length", "front", F.lit(target).alias("target"), cell.alias("cell"), "split")

    rows = dealt(targets, True).union(dealt(queries, False))
    return (rows.groupBy("cell", "split").applyInArrow(cell_pairs, "word string, n_near long, form_n long, form string")
            .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")))


def group(docs: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words."""
    spark = docs.sparkSession
    counts = stored(word_counts(docs), "words")
    near = near_words(counts, cell_words)
    words = stored(counts.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form_n") >= 2 * F.col("n"), F.col("form")).alias("form"),
        F.when(F.col("form_n") >= 2 * F.col("n"), F.col("form_n")).alias("form_n")), "forms")
    path = shared_folder(spark, "roots")
    words.where("form IS NOT NULL").select("word", F.col("form").alias("root")).write.parquet(path)
    while True:  # each round doubles how far a word sees along its forms
        seen = spark.read.schema("word string, root string").parquet(path)
        next_ = seen.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        if seen.join(next_, F.col("root") == F.col("via"), "left_semi").isEmpty():
            break
        done, path = path, shared_folder(spark, "roots")
        seen.join(next_, F.col("root") == F.col("via"), "left").select("word", F.coalesce("beyond", "root").alias("root")).write.parquet(path)
        remove_folder(spark, done)
    return words.join(seen, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
