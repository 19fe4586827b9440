import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from walletyield.llm import tokencount
from walletyield.llm.tokencount import Pieces, Transducer, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def odd_texts(pieces, n):
    rnd = random.Random(5)
    singles, every = sorted(pieces.single), sorted(pieces.rank)

    def part():
        k = rnd.randrange(7)
        if k < 2:
            return "".join(rnd.choice("etaoins hr\n=-") for _ in range(rnd.randint(1, 30)))
        if k == 2:
            return "".join(rnd.choice(every) for _ in range(rnd.randint(1, 6)))
        if k == 3:
            return rnd.choice(" ab\n=-0") * rnd.randint(1, 60)
        if k == 4:
            return "".join(rnd.choice(singles) for _ in range(rnd.randint(1, 10)))
        if k == 5:
            return "".join(chr(rnd.randint(0, 0x2FFF)) for _ in range(rnd.randint(1, 10)))
        return rnd.choice(["\U0001F600", "\x00", "\t", "▁", "▁▁", "<s>", "</s>", "<0x41>", "<unk>", " ", "é", "中", "ﬁ"])

    texts = ["".join(part() for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return texts + ["", " ", "a" * 5000, " " * 5000, "ab" * 5000, "=*" * 4000, "=-" * 300 + "-" * 20000,
                    "".join(rnd.choice("etaoinshr") for _ in range(20000))]


@pytest.mark.parametrize("block", [997, 3000, 2_000_000])
def test_counts_as_the_library(library, pieces, monkeypatch, block):
    monkeypatch.setattr(tokencount, "BLOCK_CHARS", block)
    texts = odd_texts(pieces, 1200)
    want = [len(ids) for ids in library.encode(texts)]
    assert Transducer(pieces).counts(pa.array(texts)).tolist() == want


def test_starting_anew_changes_nothing(library, pieces, monkeypatch):
    monkeypatch.setattr(tokencount, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(tokencount, "MOST_STATES", 500)
    texts = odd_texts(pieces, 300)
    assert np.array_equal(Transducer(pieces).counts(pa.array(texts)), [len(ids) for ids in library.encode(texts)])


def test_documents_as_the_library(spark, library, pieces):
    texts = odd_texts(pieces, 60)
    rows = [(i if i % 20 else None, t, 1, "x") for i, t in enumerate(texts)] + [(7, texts[7], 2, "y")] * 2 + [(9, None, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, id string").repartition(3)
    got = sorted(map(tuple, count_tokens(docs, PATH, 50).collect()), key=str)
    counted = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in rows]
    assert got == sorted(((i, b, n, n > 50) for i, b, n in counted), key=str)
    assert count_tokens(docs.limit(0), PATH, 50).collect() == []
