import hashlib
import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from walletyield.llm.bpe import WordBpe, encode_documents
from walletyield.llm.packing import fill_windows, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcxyz'sdtré É12 ΣİẞÅǻ̈\n\t\x1c\x85\xa0<|endoftext|>!?.😀漢字ｱ՘"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts(n):
    random.seed(5)
    out = [None, "", " ", "the " * 30000, "a" * 4000, "<|endoftext|>", "<|startoftext|>the<|endoftext|>'ll", "The the THE, the!"]
    for _ in range(n):
        s = "".join(random.choice(ALPHABET) for _ in range(random.randint(0, 40)))
        out.append(s + "<|endoftext|>" + s if random.random() < 0.2 else s)
    return out


def test_words_as_the_library(library):
    own = WordBpe(PATH)
    long = ["ab" * 3000, "é" * 500, "漢" * 300, "thetion" * 90, "".join(random.choice("abcdeéñ") for _ in range(700))]
    for t in odd_texts(1500)[1:] + long:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids, repr(t)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_documents_as_the_library(spark, library):
    texts = odd_texts(300)
    rows = [(i if i % 50 else None, t, 1, "x") for i, t in enumerate(texts)] + [(7, texts[7], 2, "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, ids_sha256 string").repartition(3)
    got = sorted(map(tuple, encode_documents(docs, PATH).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    full = {r.doc_id: r for r in encode_documents(docs, PATH, with_text=True).collect()}
    ids = library.encode(texts[7], add_special_tokens=False).ids
    assert full[7].ids == " ".join(map(str, ids)) and full[7].decoded == library.decode(ids, skip_special_tokens=False)
    assert encode_documents(docs.limit(0), PATH).collect() == []


def test_packing_keeps_every_id_once(spark, library):
    texts = odd_texts(120)
    rows = [(i if i % 40 else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(2)
    pieces = pack_documents(docs, PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for i, t, _ in rows:
        if i is None:
            continue
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            part = ids[p.start : p.start + p.length]
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert pack_documents(docs.limit(0), PATH).collect() == []


def test_windows_come_close_to_capacity():
    random.seed(2)
    lengths = [random.randint(1, 4095) for _ in range(3000)]
    windows = fill_windows(lengths, 4096)
    assert sorted(n for w in windows for n in w) == sorted(lengths)
    assert all(sum(w) <= 4096 for w in windows)
    assert sum(4096 - sum(w) for w in windows) < 0.02 * 4096 * len(windows)
    assert fill_windows([], 4096) == [] and fill_windows([5], 8) == [[5]]
    # the best multiset, not the first that fits: 6 alone leaves 4, which 2 + 2 fills
    assert fill_windows([6, 3, 2, 2], 10)[0] == [6, 2, 2]


def test_chunks_cut_at_once_as_one_by_one(library):
    import pyarrow as pa

    from walletyield.llm.bpe import ChunkTable, as_words
    own = WordBpe(PATH)
    every = [chr(c) for c in range(0x21, 0x340) if c not in (0x85, 0xA0)]
    chunks = ["", *every, *[f"ab{c}" for c in every], *[f"{c}b" for c in every], *[f"A{c}b" for c in every], *[c for t in odd_texts(800)[1:] for c in t.split(" ")[:9]]]
    chunks = list(dict.fromkeys(c for c in chunks if not set(c) & set(" \t\n\r\x0b\x0c")))
    got = ChunkTable(own, as_words(own)).split(pa.array(chunks)).to_pylist()
    assert got == [own.chunk_words(c) if c else [] for c in chunks]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    import pyarrow as pa

    from walletyield.llm import bpe
    own = WordBpe(PATH)
    texts = [t or "" for t in odd_texts(300)]
    want = [b"".join(i.to_bytes(4, "little") for i in library.encode(t, add_special_tokens=False).ids) for t in texts]
    for most in (0, 3000, 64_000_000):
        monkeypatch.setattr(bpe, "CACHE_BYTES", most)
        table = bpe.ChunkTable(own, bpe.as_words(own))
        got = [bytes(x) for i in range(0, len(texts), 40) for x in table(pa.array(texts[i : i + 40], pa.string()))[0]]
        assert got == want


def test_first_window_is_the_best_by_enumeration():
    """The longest length is fixed; of all subsets of the others none comes closer to the capacity."""
    rnd = random.Random(8)
    for _ in range(60):
        window = rnd.randint(20, 60)
        lengths = [rnd.randint(1, window - 1) for _ in range(rnd.randint(1, 11))]
        first = max(lengths)
        rest = list(lengths)
        rest.remove(first)
        best = max(s for s in (first + sum(n for k, n in enumerate(rest) if pick >> k & 1) for pick in range(1 << len(rest))) if s <= window)
        assert sum(fill_windows(lengths, window)[0]) == best


def test_words_learnt_in_blocks(library, monkeypatch):
    """Memory follows the block, not the words that are new in a slice, and results stay."""
    import tracemalloc

    import pyarrow as pa

    from walletyield.llm import bpe
    own = WordBpe(PATH)
    rnd = random.Random(6)
    words = list({"".join(rnd.choices("abcdeinorstué", k=9)) for _ in range(24000)})

    def peak(n):
        table = bpe.ChunkTable(own, bpe.as_words(own))
        own.pairs.clear()
        tracemalloc.start()
        (got,) = table(pa.array([" ".join(words[:n])]))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most, bytes(got[0])

    monkeypatch.setattr(bpe, "CACHE_PAIRS", 1000)
    monkeypatch.setattr(bpe, "LEARN_WORDS", 3000, raising=False)
    few, _ = peak(3000)
    many, got = peak(len(words))
    assert got == b"".join(i.to_bytes(4, "little") for i in library.encode(" ".join(words), add_special_tokens=False).ids)
    assert many < 3 * few


def test_tokens_are_held_once():
    own = WordBpe(PATH)
    one = {t: t for t in own.id_of}
    assert all(t is one[t] for names in (own.inner.values(), own.final.values(), own.made, own.halves) for t in names if t in one)
    assert all(x is one[x] for pair in own.rank for x in pair if x in one)
    assert own.whole.cache_info().currsize == 0
