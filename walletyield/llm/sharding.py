"""Sharding by a lookup table that the shards fill in turns (native DataFrame code).

Every shard has a preference order over the slots of a table of prime size, a walk with an
offset and a step from the shard's name. The shards take turns, each claiming the next free
slot of its order, until the table is full: all own equally many slots up to one, and when a
shard joins or leaves few slots change hands. A row hashes to a slot; the table has a fixed
number of rows, so broadcasting it is safe at any size of the data.

The key is the id as text. Rows without an id are placed by the hash of their text (null:
empty), so they spread as well; repeated rows land in the same shard. Empty tables and extra
columns need no care: rows keep all columns, a column ``slot`` or ``shard`` is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 4099
SHARDS = 32


def shard_names(n: int) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The owner of each slot, as a position in ``names``; ``slots`` is a prime number."""
    if slots < len(names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table needs a prime number of slots, as many as shards at least")
    walks = []
    for name in names:
        h = hashlib.md5(name.encode()).hexdigest()
        walks.append([int(h[:8], 16) % slots, int(h[8:16], 16) % (slots - 1) + 1])
    owner, turn, left = [-1] * slots, 0, slots
    while left:
        walk = walks[turn % len(names)]
        while owner[walk[0]] >= 0:
            walk[0] = (walk[0] + walk[1]) % slots
        owner[walk[0]] = turn % len(names)
        turn, left = turn + 1, left - 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def lookup_frame(spark: SparkSession, owner: list[int]) -> DataFrame:
    listed = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(listed).alias("slot", "owner")).select("slot", F.col("owner").cast("int").alias("shard"))


def place(rows: DataFrame, names: list[str], slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with their ``slot`` and ``shard``; no row moves."""
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    kept = rows.drop("slot", "shard").withColumn("slot", slot_of(key, slots))
    return kept.join(F.broadcast(lookup_frame(rows.sparkSession, lookup_table(names, slots))), "slot")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder for each shard; ``files_per_shard`` tasks write it."""
    salt = F.pmod(F.xxhash64("slot", *[c for c in placed.columns if c not in ("slot", "shard")]), F.lit(files_per_shard))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)


#: The same in DuckDB: one step of the recursion is one claim.
ORACLE = f"""
WITH RECURSIVE walks AS (
  SELECT i::INT AS i, ('0x' || substr(md5('shard-' || i), 1, 8))::BIGINT % {SLOTS} AS first,
         ('0x' || substr(md5('shard-' || i), 9, 8))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM range({SHARDS}) t(i)),
turns(turn, owner) AS (
  SELECT 0, list_transform(range({SLOTS}), lambda x: -1)
  UNION ALL
  SELECT turn + 1, owner[1:slot] || [i] || owner[slot + 2:]
  FROM (SELECT turn, owner, i,
               list_filter(list_transform(range({SLOTS}), lambda j: (first + j * step) % {SLOTS}), lambda s: owner[s + 1] = -1)[1] AS slot
        FROM turns JOIN walks ON i = turn % {SHARDS} WHERE turn < {SLOTS})),
filled AS (SELECT owner FROM turns WHERE turn = {SLOTS}),
d AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 8))::BIGINT % {SLOTS})::INT AS slot
      FROM documents)
SELECT doc_id, slot, owner[slot + 1] AS shard FROM d, filled
"""
