import random

import numpy as np
from brute import cleaned_lines, edits, near_document_classes, probability_jaccard, shingle_counts

from pyspark.sql import functions as F
from walletyield.llm import linededup, neardup

WORDS = [f"{a}{b}" for a in "the of and river stone light garden".split() for b in ("", "s", "ed", "er", "ly", "ing")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near_documents():
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randint(1, 80))) for i in range(60)]
    base = prose(rng, 120).split()
    for i in range(60, 120):  # near copies of one text, and copies of those
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        docs.append((i, " ".join(words)))
    docs += [(200 + i, docs[i][1]) for i in range(0, 120, 7)] + [(300 + i, docs[61][1].upper() + "!") for i in range(5)]
    docs += [(400, None), (401, ""), (402, " \n "), (403, "... ,,"), (404, "one two"), (405, "One, two."), (406, prose(rng, 1500))]
    docs += [(407, docs[-1][1] + " more"), (408, "\n".join([docs[3][1]] * 30)), (409, "\n".join([docs[3][1]] * 31))]
    return docs


def test_near_documents(spark):
    docs = near_documents()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs] + [(None, docs[0][1], 1, "x"), (5, docs[5][1], 1, "x")],
                               "doc_id long, text string, rep long, digest string").repartition(5)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert got == near_document_classes(docs)
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_documents_with_several_texts(spark):
    rng = random.Random(9)
    a, b, c = (prose(rng, 70) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " more"), (15, a + " and"), (15, c), (13, c + " more"), (12, b + " more"), (20, prose(rng, 50)), (20, None), (21, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert got == {1: (1, True), 2: (1, False), 12: (1, False), 13: (1, False), 15: (1, False), 20: (20, True), 21: (21, True)}


def test_copies_around_the_threshold(spark):
    """A group whose members are partly linked, as by comparing all pairs that share a bucket."""
    import pyarrow as pa
    rng = random.Random(3)
    base, docs = [f"w{i}" for i in range(150)], []
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}" if i % 3 else f"x{rng.randrange(4)}"
        docs.append((i, " ".join(words + words[: 20 * (i % 5 == 0)])))
    words = neardup.Words()
    sets = [neardup.shingles(w) for w in words(pa.array([t for _, t in docs]))]
    bands = neardup.band_values(neardup.signatures(sets, neardup.BANDS * neardup.ROWS))
    from brute import Sets
    links = Sets(range(160))
    for i in range(160):
        for j in range(i):
            if (bands[i] == bands[j]).any() and neardup.similarity(sets[i], sets[j]) >= 0.8:
                links.join(i, j)
    want = [links.find(i) for i in range(160)]
    assert 5 < len(set(want)) < 130
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()}
    assert [got[i] for i in range(160)] == want


def test_similarity_and_signatures():
    rng = random.Random(6)
    words = neardup.Words()
    import pyarrow as pa
    for _ in range(20):
        base = prose(rng, 60).split()
        other = [rng.choice(WORDS) if rng.random() < 0.05 else w for w in base] + base[:rng.randint(0, 30)]
        texts = [" ".join(base), " ".join(other)]
        a, b = (neardup.shingles(w) for w in words(pa.array(texts)))
        want = probability_jaccard(shingle_counts(texts[0]), shingle_counts(texts[1]))
        assert abs(neardup.similarity(a, b) - want) < 1e-9
        assert abs(neardup.set_similarity(a, b) - want) < 1e-9
        s = neardup.signatures([a, b], 4000)
        assert abs((s[0] == s[1]).mean() - want) < 0.06
    assert neardup.similarity(a, (np.zeros(0, np.uint64), np.zeros(0, int))) == 0


def line_documents(rng):
    lines = [prose(rng, rng.randint(1, 14)) for _ in range(40)] + ["é" * 30, "é" * 29 + "e", "😀" * 28 + "ab", "😀" * 27 + "ab", "x" * 400]
    docs = []
    for i in range(70):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(lines)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                p = rng.randrange(len(line) + 1)
                line = rng.choice([line[:p] + "q" + line[p:], line[:p] + line[p + 1 :], line[:p] + "z" + line[p + 1 :]])
            own.append(line)
        docs.append((i, "\n".join(own)))
    return docs + [(100, None), (101, ""), (102, "\n\n"), (103, "y" * 3000), (104, "y" * 2999 + "z\n" + "short"), (105, docs[3][1])]


def test_lines(spark):
    for seed in (1, 2):
        docs = line_documents(random.Random(seed))
        df = spark.createDataFrame([(d, t, 1, "x", "k") for d, t in docs] + [(None, docs[4][1], 1, "x", "k")],
                                   "doc_id long, text string, doc long, place string, removed string").repartition(4)
        rows = linededup.dedup_lines(df).collect()
        got = {r.doc_id: (r.removed, r.n_near) for r in rows if r.doc_id is not None}
        assert got == cleaned_lines(docs, linededup.THRESHOLD, linededup.MIN_CHARS)
        texts = dict(docs)
        for r in rows:
            if r.doc_id is None:
                assert r.text == docs[4][1] and r.removed == []
            else:
                want = None if texts[r.doc_id] is None else "\n".join(x for i, x in enumerate(texts[r.doc_id].split("\n")) if i not in got[r.doc_id][0])
                assert r.text == want and r.doc == 1 and r.place == "x"
    assert linededup.dedup_lines(df.limit(0)).collect() == []


def test_short_equal_lines(spark):
    long = "a line of more than twenty-four characters"
    docs = [(1, f"Menu\n\n{long}\n}}"), (2, "Menu\n \nmenu\n}\nMenu"), (3, f"\n \nMenuu\n{long}x\n{long}"), (None, "Menu")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r.removed, r.n_near) for r in linededup.dedup_lines(df, equal_chars=1).collect()}
    assert got == {1: (docs[0][1], [], 0), 2: (" \nmenu", [0, 3, 4], 0), 3: ("\n \nMenuu", [3, 4], 1), None: ("Menu", [], 0)}
    rng = random.Random(5)
    docs = line_documents(rng)
    rows = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), equal_chars=1).collect()
    first, floor = {}, cleaned_lines(docs, linededup.THRESHOLD, linededup.MIN_CHARS)
    for d, t in sorted(docs):
        for i, line in enumerate((t or "").split("\n")):
            first.setdefault(line, (d, i))
    for r in rows:
        short = [i for i, x in enumerate((dict(docs)[r.doc_id] or "").split("\n"))
                 if x.strip() and len(x) < linededup.MIN_CHARS and first[x] != (r.doc_id, i)]
        assert (r.removed, r.n_near) == (sorted(floor[r.doc_id][0] + short), floor[r.doc_id][1])


def test_bit_parallel_distance(spark):
    rng = random.Random(8)
    for t in (1, 2, 3):
        pairs = []
        for _ in range(400):
            a = "".join(rng.choice("abcé") for _ in range(rng.randint(6, 20)))
            b = a
            for _ in range(rng.randint(0, t + 2)):
                p = rng.randrange(len(b) + 1)
                b = rng.choice([b[:p] + "x" + b[p:], b[:p] + b[p + 1 :], b[:p] + rng.choice("ab") + b[p + 1 :]])
            pairs.append((a, b))
        df = spark.createDataFrame(pairs, "a string, b string").select(
            "a", "b", F.split("a", "(?!^)").alias("x"), F.split("b", "(?!^)").alias("y"))
        for r in df.where(F.size("y") > 0).select("a", "b", linededup.within(t).alias("near")).collect():
            assert r.near == (edits(r.a, r.b) <= t), (r.a, r.b, t)
