import random

import numpy as np
from brute import vector_links

from pyspark.sql import functions as F
from walletyield.llm.components import components
from walletyield.llm.topk import scaled, search_block, top_k
from walletyield.llm.vectordedup import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rep long"
NAN, INF = float("nan"), float("inf")


def test_blocks_against_all_products():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, m, d, k = rng.integers(1, 200), rng.integers(1, 20), rng.integers(1, 9), rng.integers(1, 8)
        p = rng.integers(-9, 9, (n, d)) * rng.integers(1, 20, (n, 1))
        q, q_ids, ids = rng.integers(-9, 9, (m, d)), rng.integers(0, n, m), np.arange(n)
        s = q @ p.T
        bound = np.full(m, -np.inf)
        if n > k:
            for i in range(m):
                if rng.random() < 0.7:
                    bound[i] = np.sort(np.delete(s[i], q_ids[i]))[-k]
        got = sorted(zip(*(c.tolist() for c in search_block(ids, p, q_ids, q, bound, k))))
        want = []
        for i in range(m):
            best = sorted((-s[i][j], j) for j in range(n) if j != q_ids[i])[:k]
            want += [(int(q_ids[i]), j, int(-x)) for x, j in best if -x >= bound[i]]
        assert got == sorted(want)


def vectors(spark, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) * (1 + i % 3) for _ in range(6)], i % 3, "x", 1) for i in range(150)]
    rows += [(150 + i, list(rows[5][1]), rows[5][2], "x", 1) for i in range(40)]  # copies: ties
    rows += [(200 + i, [x + rng.uniform(-0.03, 0.03) for x in rows[9][1]], rows[9][2], "x", 1) for i in range(40)]
    rows += [(300, None, 0, "x", 1), (301, [0.0] * 6, 0, "x", 1), (302, [1.0, NAN, 0.0], 0, "x", 1), (303, [1.0, INF, 0.0], 0, "x", 1),
             (304, [1.0, None, 0.0], 0, "x", 1), (305, [], 0, "x", 1), (306, list(rows[9][1]), None, "x", 1), (307, [1.0, 2.0], 0, "x", 1),
             (308, [1.0, 2.0], 0, "x", 1)]
    return rows, spark.createDataFrame([*rows, (None, [1.0] * 6, 0, "x", 1)], SCHEMA).repartition(4)


def test_top_k(spark):
    rows, df = vectors(spark)
    got = sorted(map(tuple, top_k(scaled(df, 64), F.col("vec_id") % 5 == 0, 7, buckets=4, block_rows=16).collect()))
    good = {i: np.floor(64 * np.array([np.float32(x) for x in v], float)) for i, v, *_ in rows
            if v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for i, q in good.items():
        if i % 5 == 0:
            best = sorted((-int(q @ p), j) for j, p in good.items() if j != i and len(p) == len(q))[:7]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert got == sorted(want)
    assert top_k(scaled(df.limit(0), 64), F.col("vec_id") % 5 == 0, 7).collect() == []


def test_vector_dedup(spark):
    rows, df = vectors(spark)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, 0.93, block_rows=16).collect()}
    want = vector_links([(i, v and [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab, *_ in rows], 0.93)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)
    assert near_duplicates(df.limit(0), 0.93).collect() == []


def test_vector_dedup_of_one_large_group(spark):
    rng = np.random.default_rng(2)
    n, size, dim = 9000, 3000, 64
    v = rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[:size] = 0.98**0.5 * v[-1] + 0.02**0.5 * v[:size]  # a third of all within a cosine of about 0.98
    v = v.astype(np.float32)
    df = spark.createDataFrame([(i, x, 0, "x", 1) for i, x in enumerate(v.tolist())], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, 0.93).collect()}
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    assert want.sum() > size * (size - 1) * 0.99 and len(got) == n
    assert all(got[i][0] <= want[i] for i in range(n))
    assert sum(x for x, _ in got.values()) >= 0.999 * want.sum()
    assert all(got[i][1] == 0 for i in range(size))


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (101, 102), (7, 7)] + [(500, 500 + i) for i in range(1, 50)]
    random.Random(3).shuffle(chain)
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 104)} | {500 + i: 500 for i in range(50)}
    assert got == want
