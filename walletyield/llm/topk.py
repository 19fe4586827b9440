"""Exact top-k search by inner product, with vectors grouped by length.

Candidates fall into buckets of similar length, longest first, and buckets into blocks of a
bounded number of rows. The queries meet the first block to get a lower bound of their k-th
score each. For any other bucket the bound divided by the query's length and the bucket's
greatest length is a local cosine threshold: above 1 the query skips the bucket (before any
row moves); a high one prunes by coordinates, where a candidate's part along the query's
largest coordinates must lie in an interval that the threshold allows; a low one prunes by
length, where only the longer candidates remain. What remains is verified by its product.

Vectors are integer arrays. A null id or vector and null or non-finite components
take no part, nor do empty vectors; vectors of other dimensions than the query's are no
candidates. Equal scores go to the smaller vec_id. Repeated candidate rows are candidates
each; rows that repeat an id are one query, with the greatest of their vectors, and never
candidates of that query. Extra columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletyield.llm.common import stored, usable_vectors

BUCKETS = 16
BLOCK_ROWS = 4096
#: From this local cosine threshold on, coordinates prune better than length alone.
COORDINATES_FROM = 0.5
FOCUS = 4
SLACK = 1e-9


def scaled(df: DataFrame, scale: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and the vector floor(scale * x) of the rows that take part."""
    whole = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale))
    return usable_vectors(df, id_col, vec_col).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _coordinates(unit: np.ndarray, q: np.ndarray, t: float) -> np.ndarray:
    """Rows of unit vectors whose cosine with the unit vector q may reach t."""
    left = np.ones(len(unit), bool)
    for f in np.argsort(-np.abs(q))[:FOCUS]:
        spread = np.sqrt(max(0.0, (1 - t * t) * (1 - q[f] * q[f]))) + SLACK
        left &= (unit[:, f] >= q[f] * t - spread) if q[f] > 0 else (unit[:, f] <= q[f] * t + spread)
    return np.flatnonzero(left)


def search_block(ids: np.ndarray, p: np.ndarray, q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int):
    """Up to k best candidates of each query with a score of at least its bound."""
    exact = np.abs(p).max(initial=0).astype(float) * np.abs(q).max(initial=0) * max(1, p.shape[1]) < 2**53
    p, q = (p.astype(float), q.astype(float)) if exact else (p, q)  # sums below 2**53 are exact as doubles
    length = np.sqrt((p.astype(float) ** 2).sum(1))
    order = np.lexsort((ids, -length))
    ids, p, length = ids[order], p[order], length[order]
    q_length = np.sqrt((q.astype(float) ** 2).sum(1))
    unit = p / np.maximum(length, 1e-300)[:, None]
    out = []

    def best(i: int, at: np.ndarray, scores: np.ndarray) -> None:
        keep = (scores >= bound[i]) & (ids[at] != q_ids[i])
        at, scores = at[keep], scores[keep]
        if len(at) > k:
            keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            at, scores = at[keep], scores[keep]
        top = np.lexsort((ids[at], -scores))[:k]
        out.append((np.full(len(top), q_ids[i]), ids[at][top], scores[top].astype(np.int64)))

    reach = q_length * (length[0] if len(length) else 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(reach > 0, bound / reach, -np.inf)
        need = np.where(q_length > 0, bound / q_length, -np.inf)  # the length a candidate must have
    by_length = []
    for i in np.flatnonzero(local <= 1 + SLACK):
        if local[i] >= COORDINATES_FROM:
            at = _coordinates(unit, q[i] / q_length[i], min(local[i], 1.0) - SLACK)
            best(i, at, p[at] @ q[i])
        else:
            by_length.append(i)
    prefix = np.searchsorted(-length, -(need - SLACK * np.abs(need)), "right")
    by_length.sort(key=lambda i: prefix[i])
    for lo in range(0, len(by_length), 256):
        some = by_length[lo : lo + 256]
        m = int(prefix[some[-1]])
        at = np.arange(m)
        for i, scores in zip(some, q[some] @ p[:m].T):
            best(i, at[: prefix[i]], scores[: prefix[i]])
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def _meet(candidates: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            found = [np.zeros(0, np.int64)] * 3
        else:
            dim = left["dim"][0].as_py()
            bound = right["bound"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
            found = search_block(left["vec_id"].to_numpy(), _matrix(left["v"], dim), right["vec_id"].to_numpy(),
                                 _matrix(right["v"], dim), np.nan_to_num(bound, nan=-np.inf), k)
        return pa.table(dict(zip(["query_id", "vec_id", "score"], map(pa.array, found))))

    # both sides come from one table: new aliases tell their columns apart
    queries = queries.select([F.col(c).alias(c) for c in [*keys, "vec_id", "v", "bound"]])
    return (candidates.groupBy(*keys).cogroup(queries.groupBy(*keys))
            .applyInArrow(run, "query_id long, vec_id long, score long"))


def top_k(vectors: DataFrame, is_query: Column, k: int, buckets: int = BUCKETS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best products for each query.

    ``vectors`` has vec_id and an integer array v; ``is_query`` is a condition on vec_id.
    """
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = vectors.withColumns({"length": size, "dim": F.size("v")})
    edges = sorted(set(rows.approxQuantile("length", [i / buckets for i in range(1, buckets)], 0.005)), reverse=True)
    bucket = F.lit(0)
    for e in edges:  # at most ``buckets`` numbers: 0 holds the longest
        bucket = bucket + (F.col("length") < e).cast("int")
    rows = rows.withColumn("bucket", bucket)
    stats = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("length").alias("longest"),
                                              F.count(F.when(is_query, 1)).alias("queries"))
    # one row for each dimension and bucket, so this is as short as the list of dimensions
    stats = stats.withColumn("blocks", F.ceil(F.col("n") / block_rows))
    of_dim = stats.groupBy("dim").agg(F.greatest(F.ceil(F.sum("queries") / block_rows), F.lit(1)).cast("int").alias("parts"),
                                      F.min("bucket").alias("first"))
    blocked = (rows.join(F.broadcast(stats.select("dim", "bucket", "blocks")), ["dim", "bucket"])
               .join(F.broadcast(of_dim), "dim")
               .withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks")))
    candidates = blocked.select("dim", "bucket", "block", "first", "vec_id", "v",
                                F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    queries = (rows.where(is_query).groupBy("vec_id").agg(F.max("v").alias("v"))
               .withColumns({"dim": F.size("v"), "length": size}).join(F.broadcast(of_dim), "dim")
               .withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), "parts").cast("int")))
    seed = _meet(candidates.where("bucket = first AND block = 0"), queries.withColumn("bound", F.lit(None).cast("double")),
                 ["dim", "part"], k)
    seed = stored(seed, "topk-seed")
    bounds = seed.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound"))
    bounded = queries.join(bounds.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    rest = (bounded.join(F.broadcast(stats.select("dim", "bucket", "blocks", "longest")), "dim")
            .where(F.col("bound").isNull() | (F.col("longest") * F.col("length") * (1 + SLACK) >= F.col("bound")))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .where("bucket > first OR block > 0"))
    found = _meet(candidates.where("bucket > first OR block > 0"), rest, ["dim", "bucket", "block", "part"], k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (seed.unionByName(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
