import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from brute import edits
from walletyield.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute(docs):
    """word -> (form, root, n, n_near, form_n), by comparing all words."""
    n = Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if x != w and abs(len(x) - len(w)) <= 1 and edits(w, x) == 1] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: x for w, x in best.items() if n[x] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def sample(seed, docs=150):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice("abé") for _ in range(rnd.randint(4, 9))) for _ in range(60)] + ["Straße", "ÀBÇDE", "naïve", "÷×÷×÷×"]
    weights = [1 / (i + 1) for i in range(len(stems))]

    def word():
        w = rnd.choices(stems, weights)[0]
        if rnd.random() < 0.3:
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice([w[:i] + "b" + w[i:], w[:i] + w[i + 1 :], w[:i] + "a" + w[i + 1 :]])
        return w.upper() if rnd.random() < 0.1 else w

    rows = [(i, " ".join(word() for _ in range(40))) for i in range(docs)]
    chain = [(900, "chainword " * 40), (901, "chainwords " * 12 + "chainwordsx " * 5)]
    return rows + chain + [(7, rows[7][1])] * 2 + [(None, "nobody knows " * 50), (902, None), (903, ""), (904, "漢字 12 !"),
                                                   (905, ("a" * 3000 + " ") * 3 + ("a" * 2999 + "b ") * 7)]


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], "doc_id long, text string, word string, n long, form int").repartition(3)


@pytest.mark.parametrize("cell_words", [20, spelling.CELL_WORDS])
def test_as_comparing_all_words(spark, cell_words):
    docs = sample(4)
    got = spelling.group(frame(spark, docs), cell_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(docs)
    by_word = {r.word: r for r in got.collect()}
    assert by_word["chainwordsx"].root == "chainword" and by_word["chainwordsx"].form == "chainwords"


def test_no_words(spark):
    docs = frame(spark, sample(1, 8))
    assert spelling.group(docs.limit(0)).collect() == []
    assert spelling.group(docs.where("doc_id IN (902, 903, 904)")).collect() == []


def test_parts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(spelling, "PART_CHARS", 5)
    text = "One two,threefour é É five " * 7 + "tail"
    assert sum(spelling.runs_of(text.encode()), Counter()) == Counter(RUN.findall(text.replace("O", "o")))


def test_index_steps_both_ways():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(5, 8))) for _ in range(300)})
    code = lambda w: np.array([ord(c) - 96 for c in w])
    index = spelling.Index([code(w) for w in words], 4)
    text = "#" + "#".join(words) + "#"
    for _ in range(200):
        at, part = index.all(1), ""
        for _ in range(5):
            c, right = rnd.choice("abc"), rnd.random() < 0.5
            at, part = index.extend(at, code(c), right), part + c if right else c + part
            here = sum(text.startswith(part, i) for i in range(len(text)))
            assert at[0, 2] == here
            if not here:
                break
            row, codes = index.branches(at, True)
            follow = {text[i + len(part)] for i in range(len(text)) if text.startswith(part, i)} - {"#"}
            if at[0, 2] <= 4:
                assert {chr(96 + c) for c in codes.tolist()} == follow
