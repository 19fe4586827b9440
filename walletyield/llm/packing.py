"""Packing of documents into fixed windows by minimum bin slack.

Every document becomes its token ids and a closing id, cut into full windows and one rest.
A full window is a sequence of its own. Rests are filled into windows one window at a time:
the longest rest left goes first, then a subset-sum over the lengths that are left (one bit
per reachable fill, lengths from long to short, their counts split into powers of two)
finds the multiset that comes closest to the capacity; going back through the stored bit
sets gives how many of each length it takes.

Null texts are empty, and an empty text is the closing id alone. Rows without an id and
repeated rows are documents of their own. Extra columns are dropped. A very long text gives
many full windows. An empty table gives no rows. Rests are dealt at random into groups of
about ``GROUP_PIECES``, each packed by one task, so no task grows with the table.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.bpe import as_words, chunk_table, slices, text_rows
from walletyield.llm.common import giving_back, stored

WINDOW = 4096
CLOSING_ID = 2
GROUP_PIECES = 8192


def cut_pieces(docs: DataFrame, vocab_path: str, window: int = WINDOW, closing_id: int = CLOSING_ID,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every full window and rest."""
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        table = chunk_table(vocab_path, as_words)
        closing, step = closing_id.to_bytes(4, "little"), 4 * window
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                (own,) = table(batch.column(1).slice(lo, hi - lo))
                at, start, length, crc, total = [], [], [], [], []
                for i, data in enumerate(own, lo):
                    data = bytes(data) + closing
                    for a in range(0, len(data), step):
                        piece = data[a : a + step]
                        at.append(i)
                        start.append(a // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(data) // 4)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens"])
            batch = own = data = piece = None  # else they would stay while the next batch comes in

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(giving_back(run), f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long").withColumnRenamed("id", "doc_id")


def fill_windows(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of lengths: minimum bin slack with the longest one fixed."""
    left: dict[int, int] = defaultdict(int)
    for n in lengths:
        left[n] += 1
    out = []
    order = sorted(left, reverse=True)
    while order:
        first = order[0]
        left[first] -= 1
        room, chosen = window - first, [first]
        reach, mask = 1, (1 << (room + 1)) - 1
        steps: list[tuple[int, int, int]] = []  # a length, how many at once, and the fills before them
        for n in order:
            if reach >> room & 1:
                break
            if n > room:
                continue
            count, bundle = min(left[n], room // n), 1
            while count > 0:
                k = min(bundle, count)
                steps.append((n, k, reach))
                reach |= reach << (n * k) & mask
                count -= k
                bundle *= 2
        fill = reach.bit_length() - 1
        for n, k, before in reversed(steps):
            if not before >> fill & 1:
                chosen += [n] * k
                left[n] -= k
                fill -= n * k
        order = [n for n in order if left[n]]
        out.append(chosen)
    return out


def pack(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``window``.

    The pieces are stored once, with a number each that deals them into groups.
    """
    kept = stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-kept.count() // group_pieces))
    kept = kept.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece")
        length = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        full = np.flatnonzero(length == window)
        sequence[full] = np.arange(len(full))
        waiting: dict[int, list[int]] = defaultdict(list)
        rest = np.flatnonzero(length < window)
        for i in rest[::-1].tolist():
            waiting[int(length[i])].append(i)
        for number, chosen in enumerate(fill_windows(length[rest].tolist(), window), len(full)):
            at = 0
            for n in chosen:
                i = waiting[n].pop()
                sequence[i], offset[i] = number, at
                at += n
        sequence += rows["group"][0].as_py() << 32
        rows = rows.drop_columns(["group", "piece"])
        return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    return kept.groupBy("group").applyInArrow(run, ", ".join([*names, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, vocab_path: str, window: int = WINDOW) -> DataFrame:
    return pack(cut_pieces(docs, vocab_path, window), window)
