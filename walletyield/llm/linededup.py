"""Line dedup by a segment-partition edit join (native DataFrame and SQL functions only).

A line of at least ``min_chars`` characters goes if the same line, or one within
``threshold`` edits, stands earlier: in a document with a smaller doc_id, or further up. A
shorter line goes if it has at least ``equal_chars`` characters, is not blank and the same line
stands earlier; the edit join leaves it out. Other lines always stay. The steps:

* Distinct lines, each with its first place.
* A line's length falls into a class of ``CLASS_WIDTH`` lengths; the class has a fixed partition
  into threshold + 1 segments, those of the first half counted from the left end of a line
  and the others from the right end. Of two lines within the threshold one segment of the
  one stands whole in the other, shifted by less than its rank from its side: so a line is
  indexed by its segments and probes with the substrings at the shifts that are possible,
  also in the neighbouring class if its length is within the threshold of the border.
* Only keys that several distinct lines share matter. Their lines get two 64-bit sketches, the
  parities of their characters and of their neighbouring characters by hash. An edit changes
  two bits of the first and four of the second at most, so the join of index and probes
  drops most pairs that merely share a segment.
* What is left is verified by the banded bit-parallel edit distance: a band of
  2 * threshold + 1 cells of the table lives in the bits of one number, moved on by a few
  bit operations for each character.

Null and empty texts have no such lines. Rows without a doc_id keep all lines, and rows that
repeat a doc_id count as one document with the lines of all of them (so a repeated row is
not a copy of itself). Columns other than text pass through; the columns that this operator adds
replace those of the same name. Characters are Unicode code points, lines end at a line feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletyield.llm.common import present, stored

THRESHOLD = 2
MIN_CHARS = 24
CLASS_WIDTH = 16
#: Line numbers take the low digits of a place, so that places sort by document, then line.
LINES = 1 << 32


def counts(line: Column, min_chars: int, equal_chars: int) -> Column:
    """Whether a line can go or make others go."""
    length = F.length(line)
    return (length >= min_chars) | ((length >= equal_chars) & line.rlike("\\S"))


def places(docs: DataFrame, min_chars: int, equal_chars: int, id_col: str, text_col: str) -> DataFrame:
    """place, line of every line that can go or make others go."""
    text = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("decimal(20,0)").alias("doc"), F.posexplode(text).alias("pos", "line"))
    place = (F.col("doc") * F.lit(LINES).cast("decimal(10,0)") + F.col("pos")).cast("decimal(32,0)")
    return lines.where(counts(F.col("line"), min_chars, equal_chars)).select(place.alias("place"), "line")


def segment_keys(threshold: int) -> Column:
    """The keys of column ``line`` of length ``len``: structs of key and whether it is an index key."""
    n = threshold + 1
    classes = f"array_distinct(transform(array(len, len - {threshold}, len + {threshold}), x -> x div {CLASS_WIDTH}))"
    parts = []
    for i in range(n):
        start, stop = f"(c * {CLASS_WIDTH} * {i} div {n})", f"(c * {CLASS_WIDTH} * {i + 1} div {n})"
        left = i <= threshold - i
        shifts = i if left else threshold - i
        at = start if left else f"(len - c * {CLASS_WIDTH} + {start})"
        for s in range(-shifts, shifts + 1):
            parts.append(f"IF({at} + {s} >= 0 AND {at} + {s} + ({stop} - {start}) <= len, struct(xxhash64(c, {i}, "
                         f"substring(line, cast({at} + {s} + 1 AS int), cast({stop} - {start} AS int))) AS key, "
                         f"{'c = len div ' + str(CLASS_WIDTH) if s == 0 else 'false'} AS indexed), NULL)")
    return F.expr(f"filter(flatten(transform(filter({classes}, c -> c > 0), c -> array({', '.join(parts)}))), k -> k IS NOT NULL)")


def within(threshold: int) -> Column:
    """Whether the character arrays ``x`` and ``y`` are within ``threshold`` edits.

    vp and vn hold the band's cells that are one more and one less than the cell above them;
    ``s`` is the distance at the band's lower edge, then along the last row.
    """
    t, width = threshold, 2 * threshold + 1
    mask = (1 << width) - 1
    first = sum(1 << k for k in range(width) if k >= t)
    same = " | ".join(f"IF(get(x, j - {t} + {k} - 1) <=> get(y, j - 1), {1 << k}L, 0L)" for k in range(width))
    let = "element_at(transform(array({0}), {1} -> {2}), 1)"
    step = ("named_struct('vp', (hn | ~(shiftright(d, 1) | hp)) & {m}L, 'vn', shiftright(d, 1) & hp, "
            "'s', a.s + IF(j + {t} <= size(x), 1L - (shiftright(d, {e}) & 1L), "
            "(shiftright(hp, size(x) - j + {t}) & 1L) - (shiftright(hn, size(x) - j + {t}) & 1L)))").format(m=mask, t=t, e=2 * t)
    step = let.format("d & a.vp", "hn", step)
    step = let.format(f"(a.vn | ~(d | a.vp)) & {mask}L", "hp", step)
    step = let.format(f"((((pm & a.vp) + a.vp) ^ a.vp) | pm | a.vn) & {mask}L", "d", step)
    step = let.format(same, "pm", step)
    return F.expr(f"abs(size(x) - size(y)) <= {t} AND aggregate(sequence(1, size(y)), "
                  f"named_struct('vp', {first}L, 'vn', 0L, 's', {t}L), (a, j) -> {step}, a -> a.s <= {t})")


def near_lines(lines: DataFrame, docs_lines: DataFrame, threshold: int) -> DataFrame:
    """place of the distinct lines that have an earlier line within the threshold.

    ``lines`` has place, h, keys of each distinct line; ``docs_lines`` place and line of all.
    """
    keyed = lines.select("h", F.inline("keys"))
    shared = keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("key")
    entries = stored(keyed.join(shared, "key"), "line-keys")
    # rows read again only for lines that share a key
    texts = (present(docs_lines.withColumn("h", F.xxhash64("line")), entries.select("h").distinct(), "h", 1 << 20)
             .groupBy("line").agg(F.min("place").alias("place")))
    letters = "aggregate(chars, 0L, (s, c) -> s ^ shiftleft(1L, pmod(hash(c), 64)))"
    twos = "aggregate(sequence(0, size(chars) - 2), 0L, (s, i) -> s ^ shiftleft(1L, pmod(hash(get(chars, i), get(chars, i + 1)), 64)))"
    texts = stored(texts.withColumn("chars", F.expr("regexp_extract_all(line, '(?s).', 0)"))
                   .select(F.xxhash64("line").alias("h"), "place", "line", F.length("line").alias("len"),
                           F.expr(letters).alias("letters"), F.expr(twos).alias("twos")), "line-texts")
    full = entries.join(texts.select("h", "place", "len", "letters", "twos"), "h")
    probes = full.select("key", *(F.col(c).alias(f"other_{c}") for c in ("place", "len", "letters", "twos")))
    pairs = (full.where("indexed").join(probes, "key")
             .where((F.col("place") != F.col("other_place")) & (F.abs(F.col("len") - F.col("other_len")) <= threshold)
                    & (F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2 * threshold)
                    & (F.bit_count(F.col("twos").bitwiseXOR(F.col("other_twos"))) <= 4 * threshold))
             .select(F.least("place", "other_place").alias("early"), F.greatest("place", "other_place").alias("late")).distinct())
    chars = texts.select("place", F.expr("regexp_extract_all(line, '(?s).', 0)").alias("chars"))
    both = (pairs.join(chars.select(F.col("place").alias("early"), F.col("chars").alias("x")), "early")
            .join(chars.select(F.col("place").alias("late"), F.col("chars").alias("y")), "late"))
    return both.where(within(threshold)).select(F.col("late").alias("place")).distinct()


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text", equal_chars: int | None = None) -> DataFrame:
    """The documents without their repeated lines, and n_lines, removed (line numbers), n_near
    (how many of these have no equal line before them, only a near one).

    ``equal_chars`` is the floor for equal lines, ``min_chars`` if not given; 1 takes every
    line that is not blank.
    """
    if min_chars < CLASS_WIDTH + threshold:
        raise ValueError(f"min_chars must be at least {CLASS_WIDTH + threshold}")
    equal_chars = min_chars if equal_chars is None else equal_chars
    every = places(docs, min_chars, equal_chars, id_col, text_col)
    first = (every.groupBy("line").agg(F.min("place").alias("place")).withColumn("len", F.length("line"))
             .select("place", F.xxhash64("line").alias("h"), F.when(F.col("len") >= min_chars, segment_keys(threshold)).alias("keys")))
    lines = stored(first, "lines")
    near = near_lines(lines, every.where(F.length("line") >= min_chars), threshold).withColumn("near", F.lit(1))
    doc = F.floor(F.col("place") / F.lit(LINES)).cast("decimal(20,0)")
    pos = (F.col("place") - F.col("doc") * F.lit(LINES).cast("decimal(10,0)")).cast("int")
    firsts = (lines.select("place").join(near, "place", "left").withColumn("doc", doc).withColumn("pos", pos)
              .groupBy(F.col("doc").alias("_place_doc")).agg(F.collect_list(F.when(F.col("near").isNull(), F.col("pos"))).alias("_kept"),
                                  F.count("near").cast("int").alias("n_near")))
    cut = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    rows = docs.drop("n_lines", "removed", "n_near").withColumns({
        "n_lines": F.size(cut), "_doc": F.col(id_col).cast("decimal(20,0)"),
        "_long": F.when(F.col(id_col).isNotNull(), F.filter(F.transform(cut, lambda x, i: F.when(counts(x, min_chars, equal_chars), i)), lambda i: i.isNotNull()))})
    none = F.array().cast("array<int>")
    joined = (rows.join(firsts, F.col("_doc") == F.col("_place_doc"), "left")
              .withColumn("removed", F.sort_array(F.array_except(F.coalesce("_long", none), F.coalesce("_kept", none)))))
    left = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "removed")
    text = F.when(F.size("removed") == 0, F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(cut, i)), "\n"))
    return (joined.withColumn(text_col, text).withColumn("n_near", F.coalesce("n_near", F.lit(0)))
            .drop("_doc", "_long", "_kept", "_place_doc"))
