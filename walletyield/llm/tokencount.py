"""Token counts of whole texts by a compiled finite-state transducer.

A piece vocabulary with merge scores is compiled into a deterministic transducer over
characters. A state remembers, for every end of the text read so far that could still grow
into a longer piece, the last token before that end and how many tokens fewer there are up
to it; a transition carries the number of tokens that its character adds (negative where
merges make tokens fewer). Of the pieces that may end at a character just one survives the
merges beside the token before it, so the transducer is deterministic and the sum of its
transitions is the number of tokens. States and transitions are compiled when a text first
needs them.

Two neighbouring characters that stand side by side in no piece are a border that no merge
crosses: the state behind it doesn't depend on the state before. A block of texts is cut into
chunks of equal length, which all run at once from an unknown state up to their first border
and from a known one behind it. The state map of a chunk with a border is a constant, so a
scan over the chunks gives each its entering state, and the heads before the first borders
run at once as well. Chunks without a border run from the state their neighbour leaves when
entered afresh, and again only where that guess was wrong.

Null texts count as empty; an empty text has no tokens. Rows that repeat, and rows without an
id, are counted like any other; extra columns are dropped; an empty table gives no rows. A
long text passes in blocks of ``BLOCK_CHARS`` characters that hand on their last state. The
memory of a task is bounded: beyond ``MOST_STATES`` or ``SLOTS`` / 2 transitions the compiled
part starts anew, which changes no result.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.bpe import slices, text_rows

BLOCK_CHARS = 2_000_000
MOST_STATES = 120_000
SLOTS = 1 << 21
#: The sign that stands for a space, and before every text.
GAP = "▁"
#: For each end of the text that may grow into a piece, the longest first: the end, the last
#: token before it, and the tokens up to there less those up to now.
State = tuple[tuple[str, str, int], ...]


class Pieces:
    """Merge ranks of a piece vocabulary (lower: earlier; equal scores share a rank)."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        score = {model.id_to_piece(i): model.get_score(i) for i in range(model.vocab_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        order = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.single = {p for p in score if len(p) == 1}
        self.rank = {p: order[s] for p, s in score.items()}
        #: What the last merge joins, of each piece that is its own encoding.
        self.halves = {p: h for p in self.rank if len(p) > 1 and (h := self._last_merge(p))}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        parts, joined = list(piece), None
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.rank.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return None
            i = min(found)[1]
            joined = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return joined

    def apart(self, left: str, right: str) -> bool:
        """Whether two tokens side by side stay two.

        The merges that made them are undone at their border, the latest first (of equal
        ranks those on the right); the tokens join if the symbols at the border would merge
        before the merge just undone.
        """
        rank, halves = self.rank, self.halves
        limit = len(rank)
        while True:
            if rank.get(left + right, limit) < limit:
                return False
            of_left = rank[left] if left in halves else -1
            of_right = rank[right] if right in halves else -1
            if of_left < 0 and of_right < 0:
                return True
            if of_left > of_right:
                limit, left = of_left, halves[left][1]
            else:
                limit, right = of_right + 1, halves[right][0]


class Transducer:
    """States, numbered from 0, and counted transitions, both compiled on demand."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        usable = [*pieces.halves]
        chars = sorted(pieces.single | {c for p in usable for c in p})
        self.chars = ["", *chars]  # symbol 0: a character of no piece
        number = {c: i for i, c in enumerate(chars, 1)}
        self.size = len(self.chars)
        self.symbol = np.zeros(0x110000, np.int32)
        self.symbol[[ord(c) for c in chars]] = np.arange(1, self.size)
        self.symbol[ord(" ")] = self.symbol[ord(GAP)]
        self.beside = np.zeros((self.size, self.size), bool)
        for p in usable:
            for a, b in zip(p, p[1:]):
                self.beside[number[a], number[b]] = True
        self.heads = {p[:i] for p in usable for i in range(1, len(p))}
        self.cost = np.array([0, *[1 if c in pieces.single else len(c.encode()) for c in chars]], np.int32)
        self.side: dict[tuple[str, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: list[State] = [()]
        self.number: dict[State, int] = {(): 0}
        self.fresh = np.full(self.size, -1, np.int32)
        self.fresh[0] = 0
        self.key = np.full(SLOTS, -1, np.int64)
        self.next = np.zeros(SLOTS, np.int32)
        self.count = np.zeros(SLOTS, np.int16)
        self.known: dict[int, tuple[int, int]] = {}

    def full(self) -> bool:
        return len(self.states) > MOST_STATES or len(self.known) > SLOTS // 2

    def intern(self, state: State) -> int:
        n = self.number.setdefault(state, len(self.states))
        if n == len(self.states):
            self.states.append(state)
        return n

    def enter(self, symbols: np.ndarray) -> np.ndarray:
        """The states behind a border, by the symbol that follows it."""
        for s in np.unique(symbols[self.fresh[symbols] < 0]).tolist():
            c = self.chars[s]
            begun = ((c, "", -1),) if c in self.heads else ()
            self.fresh[s] = self.intern((*begun, ("", c, 0)))
        return self.fresh[symbols]

    def _apart(self, left: str, right: str) -> bool:
        if not left:
            return True
        if (known := self.side.get((left, right))) is None:
            if len(self.side) > 300_000:
                self.side.clear()
            known = self.side[left, right] = self.pieces.apart(left, right)
        return known

    def move(self, key: int) -> tuple[int, int]:
        """State and tokens added, of one state and symbol that no border parts."""
        if (found := self.known.get(key)) is not None:
            return found
        state, c = self.states[key // self.size], self.chars[key % self.size]
        halves = self.pieces.halves
        for head, before, fewer in state:
            token = head + c
            if (not head or token in halves) and self._apart(before, token):
                added = fewer + 1
                if not head and c not in self.pieces.single:
                    added += len(c.encode()) - 1
                break
        grown = [(t, before, fewer - added) for head, before, fewer in state if (t := head + c) in self.heads]
        self.known[key] = found = self.intern((*grown, ("", token, 0))), added
        return found

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)

    def _learn(self, keys: np.ndarray) -> None:
        made = np.array([self.move(k) for k in keys.tolist()], np.int64)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            taken, first = np.unique(at[left], return_index=True)
            free = self.key[taken] < 0
            put = left[first[free]]
            self.key[at[put]], self.next[at[put]], self.count[at[put]] = keys[put], made[put, 0], made[put, 1]
            left = left[self.key[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (SLOTS - 1)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and tokens added, for many states and symbols at once."""
        keys = state.astype(np.int64) * self.size + symbol
        at = self._slots(keys)
        while True:
            other = np.flatnonzero(self.key[at] != keys)
            if not len(other):
                return self.next[at], self.count[at]
            new = other[self.key[at[other]] < 0]
            if len(new):
                self._learn(np.unique(keys[new]))
                at[new] = self._slots(keys[new])  # those of other lanes may have moved in
            else:
                at[other] = (at[other] + 1) & (SLOTS - 1)

    def walk(self, state: int, symbols: list[int]) -> tuple[int, int]:
        """State and tokens added behind several symbols without a border."""
        total = 0
        for s in symbols:
            state, n = self.move(state * self.size + s)
            total += n
        return state, total

    def run(self, codes: np.ndarray, border: np.ndarray, entry: State | None = None) -> tuple[np.ndarray, State]:
        """Tokens added at each character of a block, and the state behind the block.

        ``border`` marks characters that begin a text; ``entry`` is the state in front of a
        block that begins inside a text. The tokens of a chunk's head stand at its first
        character.
        """
        if self.full():
            self.forget()
        symbol = self.symbol[codes]
        border = border.copy()
        border[1:] |= ~self.beside[symbol[:-1], symbol[1:]]
        if entry is None or not self._joins(entry, symbol[0]):
            border[0] = True
        many = len(symbol)
        length = min(max(isqrt(many) // 4, 16), 512)
        lanes = -(-many // length)
        pad = lanes * length - many
        sym = np.ascontiguousarray(np.pad(symbol, (0, pad)).reshape(lanes, length).T)
        rst = np.ascontiguousarray(np.pad(border, (0, pad), constant_values=True).reshape(lanes, length).T)
        added = np.where(rst, self.cost[sym], 0)
        rare = rst & (sym == 0)
        code = np.pad(codes, (0, pad)).reshape(lanes, length).T
        added[rare] = 1 + (code[rare] >= 0x80) + (code[rare] >= 0x800) + (code[rare] >= 0x10000)
        ends = rst.any(0)
        head = np.where(ends, rst.argmax(0), length)
        if head[-1] >= length - pad:  # the padding is no border
            ends[-1], head[-1] = False, length - pad
        # from the first border on, and chunks without one as if entered behind a border
        state = np.full(lanes, -1, np.int32)
        plain = np.flatnonzero(~ends)
        state[plain] = self.enter(sym[0, plain])
        for t in range(length):
            if t == length - pad:
                last = int(state[-1])
            in_ = np.flatnonzero(rst[t])
            go = np.flatnonzero(~rst[t] & (state >= 0)) if t else np.flatnonzero(~rst[t] & (state >= 0) & ends)
            if len(go):
                state[go], n = self.step(state[go], sym[t, go])
                added[t, go] = n
            state[in_] = self.enter(sym[t, in_])
        added[:, plain] = 0
        if pad:
            state[-1] = last
        # the heads, from the state that the chunk before leaves
        begin = self.intern(entry) if entry else 0
        came = np.concatenate([[begin], state[:-1]])
        todo = np.flatnonzero(head > 0)
        now, total = came[todo].copy(), np.zeros(len(todo), np.int64)
        for t in range(int(head[todo].max(initial=0))):
            on = np.flatnonzero(head[todo] > t)
            now[on], n = self.step(now[on], sym[t, todo[on]])
            total[on] += n
        # chunks without a border hand on what they were entered with: mend wrong guesses
        if len(plain):
            for j, i in enumerate(todo.tolist()):
                enter = begin if i == 0 else int(state[i - 1])
                if enter != came[i]:
                    now[j], total[j] = self.walk(enter, sym[: head[i], i].tolist())
                if not ends[i]:
                    state[i] = now[j]
        added[0, todo] += total
        return added.T.reshape(-1)[:many], self.states[int(state[-1])]

    def _joins(self, state: State, symbol: int) -> bool:
        """Whether the last character read may stand beside the symbol in a piece."""
        return bool(state) and bool(symbol) and bool(self.beside[self.symbol[ord(state[-1][1][-1])], symbol])

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for lo, hi in slices(texts, BLOCK_CHARS):
            own = [GAP + t if t else "" for t in texts.slice(lo, hi - lo).to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(t) for t in own])])
            codes = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
            starts = np.zeros(len(codes) + 1, bool)
            starts[at[:-1]] = True
            state = None
            for a in range(0, len(codes), BLOCK_CHARS):
                b = min(a + BLOCK_CHARS, len(codes))
                added, state = self.run(codes[a:b], starts[a:b], state)
                running = np.concatenate([[0], np.cumsum(added)])
                out[lo:hi] += np.diff(running[np.clip(at, a, b) - a])
        return out



def count_tokens(docs: DataFrame, model_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of each row.

    The vocabulary is read once and broadcast (its size doesn't depend on the table).
    """
    rows = text_rows(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model_path))

    def run(batches):
        transducer = Transducer(shared.value)
        for batch in batches:
            n = transducer.counts(batch.column(1))
            size = pc.cast(pc.binary_length(batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n), pa.array(n > limit)],
                                             names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
