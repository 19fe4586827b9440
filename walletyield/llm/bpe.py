"""BPE encoding and decoding by a prefix-sharing trie.

A text is cut at ASCII white space into chunks, and a chunk is normalised and split into words
the way the vocabulary file says. The distinct words that a task has not met yet form a
trie (kept as their sorted list, where the part shared with the word before is the path
from the root); the depth-first walk carries along the path the last token of each prefix,
so the encoding of a shared prefix is computed once. Of the tokens that could end a prefix
only the one that survives the merges next to the last token before it is right, so the
state of a node follows from the states above it.

Null texts count as empty; an empty text has no tokens, and the hashes are those of the
empty string. Rows that repeat, and rows without an id, are encoded like any other; extra
columns are dropped. A very long text is a slice of its own. The memory of a task is
bounded: new words are learnt ``LEARN_WORDS`` at a time, and when what it knows of words
exceeds ``CACHE_BYTES``, the words that the texts at hand do not use go, which never changes
a result.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from walletyield.llm.common import give_back, giving_back

CACHE_BYTES = 40_000_000
CACHE_PAIRS = 150_000
LEARN_WORDS = 20_000
SLICE_BYTES = 4_000_000
SPACE = regex.compile(r"\p{White_Space}+")
#: From here on scripts differ between Unicode versions: the library's own normaliser and
#: splitter cut a chunk that holds such a character.
RARE = "\u0530"
#: Characters that are a word of their own where they follow letters and end a chunk.
SIGNS = pa.array(list("0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
#: Chunks that need a look of their own: characters from U+0300 on (they may combine, or lie
#: beyond ``RARE``), one whose lower case is two, spaces and controls, and special tokens.
ODD = r"^$|[^\x21-\x7E\x{A1}-\x{12F}\x{131}-\x{2FF}]|<\|"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class WordBpe:
    """Encoder and decoder of one vocabulary file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        same = {t: t for t in vocab}  # one string for each token, whatever names it
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {tuple(same.get(t, t) for t in p): i for i, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        #: The same pattern, as a group of its own, for many chunks at once.
        self.split_all = "(" + split["pattern"]["Regex"] + ")"
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.letter_of = dict(enumerate(letters))
        self.path = path
        self.id_of = vocab | self.special
        self.token_of = {i: t for t, i in self.id_of.items()}
        #: How a token is first made: the rank of the merge, and what it joins.
        self.made: dict[str, int] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        for pair, i in self.rank.items():
            if (t := pair[0] + pair[1]) not in self.made:
                t = same.get(t, t)
                self.made[t], self.halves[t] = i, pair
        self.whole = lru_cache(maxsize=None)(self._whole)
        kept = [t for t in vocab if self.whole(t)]
        self.whole.cache_clear()
        n = len(self.end)
        #: Tokens inside a word, and those that end one, by their text without the suffix.
        self.inner = {t: t for t in kept if not t.endswith(self.end)}
        self.final = {same.get(t[:-n], t[:-n]): t for t in kept if t.endswith(self.end)}
        self.heads = {same.get(h, h) for t in [*self.inner, *self.final] for i in range(1, len(t) + 1) for h in [t[:i]]}
        self.pairs: dict[tuple[str, str], bool] = {}

    @cached_property
    def library(self) -> Tokenizer:
        """Loaded for the first chunk or word that needs it."""
        return Tokenizer.from_file(self.path)

    def _apart(self, left: str, right: str, limit: int) -> bool:
        """Whether two tokens side by side stay two until the merge of rank ``limit``.

        The merges that made them are undone at their border, the latest first. They join
        if the symbols at the border would merge before the merge just undone; on equal
        ranks the border goes first where it is further left.
        """
        rank, made, halves = self.rank, self.made, self.halves
        while True:
            if rank.get((left, right), limit) < limit:
                return False
            of_left, of_right = made.get(left, -1), made.get(right, -1)
            if of_left < 0 and of_right < 0:
                return True
            if of_left > of_right:
                limit, left = of_left, halves[left][1]
            else:
                limit, right = of_right + 1, halves[right][0]

    def _whole(self, token: str) -> bool:
        """Whether a token is its own encoding."""
        if token not in self.made:
            return len(token.removesuffix(self.end)) == 1 or token == self.end
        a, b = self.halves[token]
        return self.whole(a) and self.whole(b) and self._apart(a, b, self.made[token])

    def follows(self, a: str, b: str) -> bool:
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._apart(a, b, len(self.rank))
        return known

    def chunk_words(self, chunk: str) -> list[str]:
        """Words of a chunk; special tokens stand for themselves, white space beyond ASCII
        may stand inside and falls away as the pattern never matches it."""
        if "<|" not in chunk:
            return self._plain_words(chunk)
        parts = self.specials.split(chunk)
        return [w for p in parts if p for w in ((p,) if p in self.special else self._plain_words(p))]

    def _plain_words(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            if max(chunk) >= RARE:
                return self._library_words(chunk)
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return self.words.findall(chunk.lower())

    def _library_words(self, chunk: str) -> list[str]:
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(self.byte_of[c] for c in w).decode("utf-8") for w, _ in cut]

    def encode_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word, by one depth-first walk over the trie of the words."""
        letter_of, inner, final, heads, follows, pairs = self.letter_of, self.inner, self.final, self.heads, self.follows, self.pairs
        out: dict[str, list[str]] = {}
        path = ""
        last: list[str] = []  # by depth: the last token of the prefix that ends there,
        size: list[int] = []  # its number of symbols,
        head: list[int] = []  # and of the longest end of the prefix that begins a token
        names = {w if w.isascii() else w.encode("utf-8").decode("latin-1").translate(letter_of): w for w in words}
        for name in sorted(names):
            n, depth = len(name) - 1, 0
            for a, b in zip(name[:n], path):
                if a != b:
                    break
                depth += 1
            del last[depth:], size[depth:], head[depth:]
            for d in range(depth, n):
                k = min((head[d - 1] if d else 0) + 1, d + 1)
                reach = 0
                stop = d + 1
                while True:
                    tail = name[stop - k : stop]
                    if not reach and tail in heads:
                        reach = k
                    token = inner.get(tail)
                    if token is not None:
                        if k > d:
                            break
                        before = last[d - k]
                        known = pairs.get((before, token))
                        if known or known is None and follows(before, token):
                            break
                    k -= 1
                    if k < 1:
                        break
                last.append(token or tail)
                size.append(max(k, 0))
                head.append(reach)
            path = name[:n]
            k = min((head[n - 1] if n else 0) + 1, n + 1)
            while True:
                tail = final.get(name[n + 1 - k :])
                if tail is not None and (k > n or follows(last[n - k], tail)):
                    break
                k -= 1
                if k < 1:
                    break
            if k < 1 or 0 in size:  # no token fits: the library's merges decide
                out[names[name]] = self.library.encode(names[name], add_special_tokens=False).tokens
                path = ""
                continue
            tokens, d = [tail], n - k
            while d >= 0:
                tokens.append(last[d])
                d -= size[d]
            tokens.reverse()
            out[names[name]] = tokens
        return out

    def encode(self, text: str) -> list[int]:
        chunks = [c for c in SPACE.split(text) if c]
        words = {c: self.chunk_words(c) for c in set(chunks)}
        tokens = self.encode_words({w for ws in words.values() for w in ws if w not in self.special})
        return [self.id_of[t] for c in chunks for w in words[c] for t in tokens.get(w, (w,))]

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by a space: the vocabulary names no decoder, special tokens stay."""
        return " ".join([self.token_of[i] for i in ids if i in self.token_of])


class ChunkTable:
    """Chunks of texts replaced by what ``render`` makes of their tokens.

    ``render`` turns the tokens of a word into a tuple of bytes; the bytes of a text are
    those of its words in order. What is known of words is held as Arrow arrays, a few
    bytes for each, and looked up for all words of a slice of texts at once.
    """

    def __init__(self, bpe: WordBpe, render: Callable[[list[str]], tuple[bytes, ...]]):
        self.bpe, self.render = bpe, render
        known = ["", *bpe.special]
        self.words = pa.array(known, pa.string())
        rows = [render([]), *(render([t]) for t in bpe.special)]
        self.first = self.words, [pa.array(part, pa.binary()) for part in zip(*rows)]
        self.words, self.parts = self.first

    def learn(self, words: pa.Array) -> list[pa.Array]:
        """The parts of each word; a block of neighbours in sorted order at a time, as the
        tokens of a word take many times the bytes that are kept of it."""
        order = pc.sort_indices(words)
        made = [[p.slice(0, 0)] for p in self.parts]
        gc.disable()  # it would walk the tables again and again; nothing here makes cycles
        try:
            for lo in range(0, len(words), LEARN_WORDS):
                block = words.take(order.slice(lo, LEARN_WORDS)).to_pylist()
                tokens = self.bpe.encode_words(block)
                for part, column in zip(made, zip(*(self.render(tokens[w]) for w in block))):
                    part.append(pa.array(column, pa.binary()))
        finally:
            gc.enable()
        place = np.empty(len(words), np.int64)
        place[order.to_numpy()] = np.arange(len(words))
        place = pa.array(place)
        return [pa.concat_arrays(part).take(place) for part in made]

    def split(self, chunks: pa.Array) -> pa.ListArray:
        """The words of each chunk: all letters, letters and one sign, what a regular
        expression cuts for all at once, and odd chunks one by one."""
        odd = pc.match_substring_regex(chunks, ODD)
        kinds, lists = [np.flatnonzero(odd)], [pa.array([self.bpe.chunk_words(c) for c in chunks.filter(odd).to_pylist()], pa.list_(pa.string()))]

        def take(kind: pa.Array | np.ndarray, words: pa.ListArray) -> None:
            kinds.append(left[np.asarray(kind)])
            lists.append(words)

        left = np.flatnonzero(~np.asarray(odd))
        low = pc.utf8_lower(chunks.take(pa.array(left)))
        whole = np.asarray(pc.utf8_is_alpha(low))
        plain = low.filter(pa.array(whole))
        take(whole, pa.ListArray.from_arrays(pa.array(np.arange(len(plain) + 1), pa.int32()), plain))
        left, low = left[~whole], low.filter(pa.array(~whole))
        front, sign = pc.utf8_slice_codeunits(low, 0, -1), pc.utf8_slice_codeunits(low, -1)
        ended = np.asarray(pc.and_(pc.utf8_is_alpha(front), pc.is_in(sign, SIGNS)))
        pairs = pa.concat_arrays([front.filter(pa.array(ended)), sign.filter(pa.array(ended))])
        n = int(ended.sum())
        pairs = pairs.take(pa.array(np.arange(2 * n).reshape(2, n).T.reshape(-1)))
        take(ended, pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * n + 1, 2), pa.int32()), pairs))
        spaced = pc.replace_substring_regex(low.filter(pa.array(~ended)), self.bpe.split_all, r"\1 ")
        take(~ended, pc.split_pattern(pc.ascii_rtrim_whitespace(spaced), " "))
        place = np.empty(len(chunks), np.int64)
        place[np.concatenate(kinds)] = np.arange(len(chunks))
        return pa.concat_arrays(lists).take(pa.array(place))

    def __call__(self, texts: pa.Array) -> list[list[memoryview]]:
        """For each part that ``render`` gives: the bytes of every text."""
        cut = pc.ascii_split_whitespace(texts)
        ends = cut.offsets.to_numpy()
        chunks = cut.values.slice(int(ends[0]), int(ends[-1] - ends[0])).dictionary_encode()
        ends = ends - ends[0]
        lists = self.split(chunks.dictionary)
        met = lists.flatten().dictionary_encode()
        at = pc.index_in(met.dictionary, self.words)
        fresh = met.dictionary.filter(at.is_null())
        made = self.learn(fresh)
        words = pa.concat_arrays([self.words, fresh])
        parts = [pa.concat_arrays([old, new]) for old, new in zip(self.parts, made)]
        where = at.to_numpy(zero_copy_only=False).astype(np.float64)
        where[np.isnan(where)] = len(self.words) + np.arange(len(fresh))
        where = pa.array(where.astype(np.int64))
        out = []
        for part in parts:
            of_word = part.take(where).take(met.indices)
            of_chunk = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, of_word), b"")
            made = of_chunk.take(chunks.indices)
            if not len(made):
                out.append([memoryview(b"")] * len(texts))
                continue
            at_ = np.frombuffer(made.buffers()[1], np.int32, len(made) + 1, made.offset * 4)[ends]
            data = memoryview(made.buffers()[2] or b"")
            out.append([data[a:b] for a, b in zip(at_[:-1].tolist(), at_[1:].tolist())])
        pa.default_memory_pool().release_unused()
        if words.nbytes + sum(p.nbytes for p in parts) <= CACHE_BYTES:
            self.words, self.parts = words, parts
        else:  # those that the texts at hand do not use go
            words, parts = words.take(where), [p.take(where) for p in parts]
            self.words = pa.concat_arrays([self.first[0], words])
            self.parts = [pa.concat_arrays([a, b]) for a, b in zip(self.first[1], parts)]
        return out


def as_text(bpe: WordBpe) -> Callable[[list[str]], tuple[bytes, ...]]:
    """Decimal ids, and the decoded tokens, each with a space behind it."""
    ids = {t: b"%d " % i for t, i in bpe.id_of.items()}
    names = {t: t.encode() + b" " for t in bpe.id_of}
    return lambda toks: (b"".join([ids[t] for t in toks]), b"".join([names[t] for t in toks]))


def as_words(bpe: WordBpe) -> Callable[[list[str]], tuple[bytes, ...]]:
    """Ids as little-endian 32-bit words."""
    ids = {t: i.to_bytes(4, "little") for t, i in bpe.id_of.items()}
    return lambda toks: (b"".join([ids[t] for t in toks]),)


@lru_cache(maxsize=2)
def chunk_table(path: str, render: Callable) -> ChunkTable:
    """One table for each Python worker: later tasks find what earlier ones have learnt."""
    bpe = WordBpe(path)
    return ChunkTable(bpe, render(bpe))


def release_tables() -> None:
    """Give back what an earlier stage left in this Python worker: workers outlive stages."""
    if chunk_table.cache_info().currsize:
        chunk_table.cache_clear()
        gc.collect()
        give_back()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded sum of bytes (a single longer text stands alone)."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_text: bool = False) -> DataFrame:
    """id, n_tokens, ids (decimal, joined by one space), decoded; one row per document.

    ``with_text`` False replaces the two long columns by their SHA-256.
    """
    names = ("ids", "decoded") if with_text else ("ids_sha256", "decoded_sha256")
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        table = chunk_table(vocab_path, as_text)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                own, decoded = table(batch.column(1).slice(lo, hi - lo))
                counts = [bytes(x).count(b" ") for x in own]
                if with_text:
                    parts = [[str(x[:-1], "utf-8") for x in col] for col in (own, decoded)]
                else:
                    parts = [[hashlib.sha256(x[:-1]).hexdigest() for x in col] for col in (own, decoded)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts, pa.int64()), *(pa.array(p, pa.string()) for p in parts)],
                    names=["id", "n_tokens", *names])
            batch = own = decoded = None  # else they would stay while the next batch comes in

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(giving_back(run), f"id {kind}, n_tokens long, {names[0]} string, {names[1]} string").withColumnRenamed("id", id_col)
