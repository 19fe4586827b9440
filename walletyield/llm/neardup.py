"""Near-duplicate documents by ProbMinHash over weighted word shingles.

The words of a text are its white-space tokens in lower case without punctuation around
them; its shingles are runs of five words (a shorter text is one shingle), weighted by how
often they occur. ProbMinHash: the shingles of a document send points to the registers of
its signature, each as a Poisson process with its weight as the rate; a register keeps the
shingle that reaches it first, and a shingle stops once its next point comes later than the
last register was reached. Two registers agree with the probability Jaccard similarity, so
bands of registers gather candidates, which are verified by the exact similarity.

Documents with equal weighted shingles are one node. Every bucket has a centre, the node with
the most company in its buckets, and all others of the bucket are compared with it first; so a
bucket of thousands of copies costs thousands of comparisons. Nodes of buckets that still hold
several components after that are joined exactly, by prefixes: of two sets with a similarity of
``least`` or more, the first common shingle in a global order, rare ones first, stands among
the first of each (those before it are missing from the other set, and their weight is
bounded). Only shingles in the prefixes of several components count, and on each of them the
members of its largest component aren't compared among themselves. A copy that differs too
much from the others has a prefix of its own and meets none of them.

Null and empty texts, and texts without words, have no shingles and link with nothing. Rows
without an id are left out of the result; rows that repeat a doc_id with another text belong
to the class of each of their texts, which is then one class. Extra columns are dropped, an
empty table gives no rows, and long texts count whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.bpe import slices
from walletyield.llm.common import giving_back, present, stored
from walletyield.llm.components import components
from walletyield.llm.textfeat import TokenRows

WORDS = 5
LEAST = 0.8
BANDS = 25
ROWS = 5
#: Bytes of text that a task turns into shingles at a time.
SLICE_BYTES = 3_000_000
#: Pairs that are compared in one group, and slots of the table of shingle frequencies.
GROUP_PAIRS = 500
SLOTS = 1 << 20
EDGES = ".,;:!?\"'()[]{}<>|%&#*$-_/\\~`^+=…«»“”‘’¿¡"


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of the result depend on all of x and the salt."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of the words of texts, in order."""

    def __init__(self):
        self.rows = TokenRows(self._halves)

    @staticmethod
    def _halves(token: str) -> tuple[float, float]:
        word = token.strip(EDGES).lower()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) if word else 0
        return float(h >> 32), float(h & 0xFFFFFFFF)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        codes, halves, at = self.rows(texts)
        whole = halves.astype(np.uint64)
        hashes = (whole[:, 0] << np.uint64(32) | whole[:, 1])[codes]
        return [h[h > 0] for h in np.split(hashes, at[1:-1])] if len(texts) else []


def shingles(words: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and how often each occurs."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            h = mix(h * np.uint64(0x100000001B3) + words[i : len(words) - n + 1 + i], n)
    return np.unique(h, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact probability Jaccard similarity: the sum, over common shingles i, of
    1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    both = np.union1d(a[0], b[0])
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])], y[np.searchsorted(both, b[0])] = a[1], b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y = x[order], y[order]
    below = np.concatenate([[0.0], np.cumsum(y)[:-1]])
    above = np.cumsum(x[::-1])[::-1]
    common = (x > 0) & (y > 0)
    return float((1 / (above[common] / x[common] + below[common] / y[common])).sum())


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash of many documents at once: for each register the shingle that came first.

    Round k gives the k-th point of every shingle that may still reach a register.
    """
    size = [len(s[0]) for s in sets]
    doc = np.repeat(np.arange(len(sets)), size)
    shingle = np.concatenate([s[0] for s in sets]) if sets else np.zeros(0, np.uint64)
    rate = np.concatenate([s[1] for s in sets]).astype(float) if sets else np.zeros(0)
    reached = np.full(len(sets) * registers, np.inf)
    first = np.zeros(len(sets) * registers, np.uint64)
    time = np.zeros(len(shingle))
    turn = 0
    while len(shingle):
        wait = (mix(shingle, 2 * turn) >> np.uint64(11)).astype(float) * 2.0**-53
        time = time - np.log1p(-wait) / rate
        alive = time < reached.reshape(-1, registers).max(1)[doc]
        doc, shingle, rate, time = doc[alive], shingle[alive], rate[alive], time[alive]
        register = doc * registers + (mix(shingle, 2 * turn + 1) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(reached, register, time)
        won = time == reached[register]
        first[register[won]] = shingle[won]
        turn += 1
    return first.reshape(-1, registers)


def band_values(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    h = np.zeros(parts.shape[:2], np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            h = mix(h * np.uint64(0x100000001B3) + parts[:, :, r], r)
    return h.view(np.int64)


def describe(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest of the weighted shingles and band values; null where there are no words."""
    def run(batches):
        words = Words()
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                sets = [shingles(w) for w in words(batch.column(1).slice(lo, hi - lo))]
                values = band_values(signatures(sets, bands * rows), bands, rows)
                digest = [hashlib.blake2b(s.tobytes() + n.tobytes(), digest_size=16).digest() if len(s) else None for s, n in sets]
                listed = [v if d else None for v, d in zip(values, digest)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(digest, pa.binary()),
                                                  pa.array(listed, pa.list_(pa.int64()))], names=["doc_id", "digest", "bands"])

    return docs.mapInArrow(giving_back(run), "doc_id long, digest binary, bands array<long>")


def set_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """``similarity``, by counting alone where no shingle occurs twice."""
    if a[1].max(initial=1) > 1 or b[1].max(initial=1) > 1:
        return similarity(a, b)
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    return both / max(1, len(a[0]) + len(b[0]) - both)


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles (sorted), times of the nodes (node, rep: a document that has it)."""
    rows = present(docs, nodes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")

    def run(batches):
        words = Words()
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                sets = [s for w in words(batch.column(1).slice(lo, hi - lo)) if len((s := shingles(w))[0])]
                digest = [hashlib.blake2b(s.tobytes() + n.tobytes(), digest_size=16).digest() for s, n in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest, pa.binary()), pa.array([s.view(np.int64) for s, _ in sets], pa.list_(pa.int64())),
                     pa.array([n for _, n in sets], pa.list_(pa.int64()))], names=["node", "shingles", "times"])

    found = rows.mapInArrow(giving_back(run), "node binary, shingles array<long>, times array<long>")
    return found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _sets(table: pa.Table | pa.RecordBatch, shingles_: str, times: str) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for s, n in zip(table[shingles_], table[times]):
        out.append((s.values.to_numpy(zero_copy_only=False).view(np.uint64), n.values.to_numpy(zero_copy_only=False)))
    return out


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose similarity is at least ``least``.

    Pairs are dealt into groups of about ``GROUP_PAIRS``; a node that is the ``a`` of very
    many is in several groups, and its set goes to each of them once.
    """
    own = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_PAIRS).alias("parts"))
    dealt = stored(pairs.join(own, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts"))).select("a", "b", "part"), "pairs")
    groups = max(1, -(-dealt.count() // GROUP_PAIRS))
    group = F.pmod(F.xxhash64("a", "part"), F.lit(groups)).alias("group")
    of_a, of_b = (present(sets.withColumnRenamed("node", c), dealt.select(c).distinct(), c) for c in ("a", "b"))
    left = dealt.select("a", "part").distinct().join(of_a, "a").select(group, "a", "shingles", "times")
    right = (dealt.join(of_b, "b")
             .select(group, *(F.col(c).alias(f"{c}_2") for c in ("a", "b", "shingles", "times"))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = dict(zip(left["a"].to_pylist(), _sets(left, "shingles", "times")))
        keep = [set_similarity(known[a], s) >= least for a, s in zip(right["a_2"].to_pylist(), _sets(right, "shingles_2", "times_2"))]
        return right.select(["a_2", "b_2"]).rename_columns(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return left.groupBy("group").cogroup(right.groupBy("group")).applyInArrow(run, "a binary, b binary")


def prefixes(sets: DataFrame, least: float) -> DataFrame:
    """node, shingle, place, size of the shingles that may be the first a near set has in common.

    The order puts shingles first whose hash slot is rare among these sets (a table of a
    fixed number of slots, whatever the data). ``size`` is the number of shingles of a set
    without repeated ones, else null: then places say nothing.
    """
    slot = F.pmod(F.col("shingle"), F.lit(SLOTS))
    taken = sets.select(F.explode("shingles").alias("shingle")).groupBy(slot.alias("slot")).count().toArrow()
    frequency = np.zeros(SLOTS, np.int64)
    frequency[taken["slot"].to_numpy()] = taken["count"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(frequency)

    def run(batches):
        frequency = shared.value
        for batch in batches:
            node, shingle, place, size = [], [], [], []
            for name, (s, n) in zip(batch["node"].to_pylist(), _sets(batch, "shingles", "times")):
                order = np.lexsort((s, frequency[s.view(np.int64) % SLOTS]))
                before = np.cumsum(n[order]) - n[order]
                first = int((before <= (1 - least) * n.sum() + 1e-9).sum())
                node += [name] * first
                shingle.append(s[order[:first]].view(np.int64))
                place.append(np.arange(first))
                size += [len(s) if n.max() == 1 else None] * first
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.binary()), pa.array(np.concatenate(shingle or [np.zeros(0, np.int64)])),
                 pa.array(np.concatenate(place or [np.zeros(0, np.int64)])), pa.array(size, pa.int64())], names=["node", "shingle", "place", "size"])

    return sets.mapInArrow(giving_back(run), "node binary, shingle long, place long, size long")


def prefix_pairs(entries: DataFrame, least: float) -> DataFrame:
    """Distinct (a, b), a < b, of nodes of different components whose prefixes meet.

    ``entries`` are prefixes with the nodes' ``component``.
    """
    held = entries.groupBy("shingle", "component").agg(F.count("*").alias("n")).groupBy("shingle").agg(
        F.max_by("component", F.struct("n", "component")).alias("major"), F.count("*").alias("components"))
    mixed = stored(entries.join(held.where("components > 1"), "shingle").drop("components"), "prefixes")
    minor = mixed.where("component <> major")
    other = mixed.select("shingle", *(F.col(c).alias(f"{c}_2") for c in ("node", "component", "place", "size")), (F.col("component") == F.col("major")).alias("is_major"))
    # sets without repeated shingles: how many they must have in common, and so how far a first common one can stand
    common = F.ceil(F.lit(least / (1 + least)) * (F.col("size") + F.col("size_2")) - 1e-9)
    near = F.coalesce((F.col("place") <= F.col("size") - common) & (F.col("place_2") <= F.col("size_2") - common), F.lit(True))
    pairs = minor.join(other, "shingle").where((F.col("component") != F.col("component_2")) & (F.col("is_major") | (F.col("node") < F.col("node_2"))) & near)
    return pairs.select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id (the smallest doc_id reachable by links), kept (doc_id = class_id)."""
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"),
                                                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    described = stored(describe(docs, bands, rows), "minhash")
    member = described.where("digest IS NOT NULL").select("doc_id", F.col("digest").alias("node")).distinct()
    listed = (described.where("digest IS NOT NULL").groupBy(F.col("digest").alias("node")).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
              .select("node", "rep", F.posexplode("bands").alias("band", "value")))
    held = listed.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(listed.join(held, ["band", "value"]), "buckets")
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    centers = stored(shared.select("node", "band", "value").join(company, "node").groupBy("band", "value")
                     .agg(F.max_by("node", F.struct("company", "node")).alias("center")), "centers")
    sets = stored(shingle_sets(docs, shared.select("node", "rep").distinct()), "sets")
    stars = stored(shared.join(centers, ["band", "value"]).where("node <> center")
                   .select(F.col("center").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    links = stored(verified(stars, sets, least), "links")
    # the texts of one document are of one class
    several = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
    links = links.union(several.join(member, "doc_id").where("node <> a").select("a", F.col("node").alias("b")))
    of = components(links, "a", "b")
    # nodes of buckets that still hold several components, but for the centres, which have met all others
    parted = (shared.join(of, "node", "left").join(centers, ["band", "value"]).where("node <> center")
              .select("node", "band", "value", F.coalesce("component", "node").alias("component")))
    mixed = (parted.groupBy("band", "value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("band", "value"))
    open_ = stored(parted.join(mixed, ["band", "value"]).select("node", "component").distinct(), "open")
    entries = prefixes(present(sets, open_.select("node"), "node"), least).join(open_, "node")
    met = F.array_sort(F.array("a", "b"))
    rest = prefix_pairs(entries, least).join(stars.select(met[0].alias("a"), met[1].alias("b")), ["a", "b"], "left_anti")
    rest = stored(rest, "rest")
    if not rest.isEmpty():
        of = components(links.union(stored(verified(rest, sets, least), "links")), "a", "b")
    placed = member.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    placed = placed.join(classes, "component").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return (docs.select("doc_id").distinct().join(placed, "doc_id", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
            .withColumn("kept", F.col("doc_id") == F.col("class_id")))
