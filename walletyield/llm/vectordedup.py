"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are picked from the data; a vector is described by its nearest
pivots in order of closeness. Inverted lists by label and pivot bring vectors together, the
pivots they share are counted, and pairs that share enough are verified by their cosine in
double precision. A pair is verified in one list only, that of the first pivot it shares.

Long lists are cut into blocks; a task gets a pair of blocks and gives counts of links and a
spanning set of edges, never the pairs. Vectors with equal labels and components are one
class: its members link with each other without being paired, and one row stands for them.

Null, empty, zero or non-finite vectors and those without a label link with nothing and
stay in the result. Vectors of unequal dimensions don't link. vec_id is taken as unique; rows
that repeat one are counted as members of their class, and rows without an id are dropped.
Extra columns are dropped; an empty table gives no rows. The pivots are at most
``MOST_PIVOTS``, about the square root of the number of classes, and every vector is indexed.
No two pivots are closer than a cosine of ``APART``: several in one tight group would be
ranked by noise, and its members would share few of their nearest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.common import stored, usable_vectors
from walletyield.llm.components import components

MOST_PIVOTS = 2048
APART = 0.85
NEAREST = 12
SHARED = 2
BLOCK_ROWS = 1500


def _unit(column, dim: int) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    return x / np.maximum(np.sqrt((x**2).sum(1)), 1e-300)[:, None]


def apart(units: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the unit vectors in their order, each less than ``APART`` close to those before it."""
    kept = np.empty((min(most, len(units)), units.shape[1]))
    n = 0
    for u in units:
        if n == len(kept):
            break
        if not n or (kept[:n] @ u).max() < APART:
            kept[n] = u
            n += 1
    return kept[:n]


def pivots(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Pivots by dimension: of the 2n representatives with the smallest hashes, up to n that stand apart."""
    got = classes.orderBy(F.xxhash64("rep", F.lit(3)), "rep").select("v").limit(2 * n).collect()
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(len(r.v), []).append(r.v)
    return {d: apart((m := np.array(v, np.float64)) / np.sqrt((m**2).sum(1))[:, None], n) for d, v in by.items()}


def describe(classes: DataFrame, of: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """Adds ``near``: the numbers of the nearest pivots, the closest first.

    Vectors of a dimension without a pivot get the list [0]: there the label alone gathers.
    """
    shared = classes.sparkSession.sparkContext.broadcast(of)

    def run(batches):
        for batch in batches:
            v = batch.column(batch.schema.get_field_index("v"))
            sizes = np.array([len(x) for x in v])
            near: list = [[0]] * len(v)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                p = shared.value.get(int(d))
                if p is None:
                    continue
                for lo in range(0, len(at), 2000):
                    some = at[lo : lo + 2000]
                    cos = _unit(v.take(pa.array(some)), int(d)) @ p.T
                    k = min(nearest, len(p))
                    top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
                    order = np.argsort(-np.take_along_axis(cos, top, 1), axis=1, kind="stable")
                    for i, row in zip(some.tolist(), np.take_along_axis(top, order, 1).tolist()):
                        near[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=[*batch.schema.names, "near"])

    return classes.mapInArrow(run, "rep long, label int, v array<double>, n long, near array<int>")


def link_block(rep: np.ndarray, n: np.ndarray, unit: np.ndarray, near: np.ndarray, side: np.ndarray, pivot: int,
               least: float, shared: int):
    """Verified links of a block pair: (row, row) where the first shared pivot is this list's."""
    shared = min(shared, near.shape[1])
    kinds, place = np.unique(near, return_inverse=True)
    held = np.zeros((len(rep), len(kinds)), np.float32)
    held[np.arange(len(rep))[:, None], place.reshape(near.shape)] = 1
    lower = held[:, kinds < pivot]
    a = np.flatnonzero(side == side.min())
    b = np.flatnonzero(side == side.max())
    same = side.min() == side.max()
    found = []
    for lo in range(0, len(a), 512):
        some = a[lo : lo + 512]
        candidate = (held[some] @ held[b].T >= shared) & (lower[some] @ lower[b].T == 0)
        if same:
            candidate &= some[:, None] < b[None, :]
        i, j = np.nonzero(candidate)
        i, j = some[i], b[j]
        for at in range(0, len(i), 100_000):
            x, y = i[at : at + 100_000], j[at : at + 100_000]
            keep = np.einsum("ij,ij->i", unit[x], unit[y]) >= least
            found.append((x[keep], y[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _spanning(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row of each row's component within a block pair."""
    root = np.arange(size)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def near_duplicates(vectors: DataFrame, least: float, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    nearest: int = NEAREST, shared: int = SHARED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector with an id."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("raw"), F.col(label_col).cast("int").alias("label"))
    taking = (usable_vectors(rows, "vec_id", "raw").where("label IS NOT NULL AND exists(raw, x -> x <> 0)")
              .select("vec_id", "label", F.transform("raw", lambda x: x.cast("double") + 0.0).alias("v")))
    # equal vectors by two independent 64-bit hashes: only these move, the components once
    key = [F.xxhash64("label", "v").alias("k1"), F.xxhash64(F.lit(11), "v", "label").alias("k2")]
    member = stored(taking.select("vec_id", *key), "vector-keys")
    grouped = member.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = stored(taking.join(grouped, F.col("vec_id") == F.col("rep")).where((key[0] == F.col("k1")) & (key[1] == F.col("k2")))
                     .groupBy("rep", "label").agg(F.max("v").alias("v"), F.max("n").alias("n")), "vector-classes")
    count = classes.count()
    of = pivots(classes, min(MOST_PIVOTS, max(8, 2 * math.isqrt(count))))
    described = stored(describe(classes, of, nearest), "described")

    entries = described.withColumn("pivot", F.explode("near"))
    lists = entries.groupBy("label", "pivot").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = (entries.join(lists, ["label", "pivot"])
             .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(5)), "blocks").cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))

    def run(rows: pa.Table) -> pa.Table:
        rep, n, side = (rows[c].to_numpy() for c in ("rep", "n", "block"))
        pivot = rows["pivot"][0].as_py()
        dims, width = (np.array([len(x) for x in rows[c]]) for c in ("v", "near"))
        out = []
        for d, w in {*zip(dims.tolist(), width.tolist())}:
            at = np.flatnonzero((dims == d) & (width == w))
            if rows["low"][0].as_py() != rows["high"][0].as_py() and len({*side[at].tolist()}) < 2:
                continue  # a pair of blocks of which one has no such row
            part = rows.take(pa.array(at))
            near = part["near"].combine_chunks().flatten().to_numpy().reshape(len(at), w)
            i, j = link_block(rep[at], n[at], _unit(part["v"], d), near, side[at], pivot, least, shared)
            if not len(i):
                continue
            size = len(at)
            links = np.bincount(i, n[at][j], size) + np.bincount(j, n[at][i], size)
            root = _spanning(size, i, j)
            linked = np.flatnonzero(links)
            out.append((rep[at][linked], links[linked].astype(np.int64), rep[at][root[linked]]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(["rep", "links", "hangs_on"], map(pa.array, cols))))

    found = stored(dealt.select("label", "pivot", "low", "high", "block", "rep", "n", "v", "near")
                   .groupBy("label", "pivot", "low", "high").applyInArrow(run, "rep long, links long, hangs_on long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found, "rep", "hangs_on").withColumnRenamed("node", "rep")
    by_class = (grouped.join(links, "rep", "left").join(roots, "rep", "left")
                .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    linked = member.join(by_class, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = (rows.select("vec_id").join(linked.select("vec_id"), "vec_id", "left_anti")
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
