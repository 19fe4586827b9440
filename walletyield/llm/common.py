"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared checkpoint folder, one for each run."""
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex}")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives
    lost executors, and is never computed twice."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_folder`` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return freed memory to the system: Arrow and the C library keep it for later use."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task; once all it held is gone, its memory is given back.
    Python workers outlive their tasks and idle beside the JVM's part of the work."""
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return whole


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id written as text, as a long."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows with an id and a non-empty vector without null or non-finite components."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)


def present(rows: DataFrame, ids: DataFrame, col: str, slots: int = 1 << 18) -> DataFrame:
    """The rows whose id is among ``ids`` (distinct, one column of the same name).

    A broadcast table of at most ``slots`` hash slots drops most other rows before the exact
    join moves any; where ids are many it drops few, and the join alone does the work.
    """
    slot = F.pmod(F.xxhash64(col), F.lit(slots))
    taken = ids.select(slot.alias("_slot")).distinct()
    return rows.join(F.broadcast(taken), slot == F.col("_slot"), "left_semi").join(ids, col, "left_semi")
