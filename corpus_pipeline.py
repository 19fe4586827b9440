"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: documents with the same
columns, and at the end the packed pieces. Between stages the documents are written to the
shared folder and read again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.llm import linededup, neardup, packing, quality, toxicity
from walletyield.llm.common import crc_of_id, remove_folder, shared_folder, table
from walletyield.llm.queries import WORD_VOCABULARY
from walletyield.llm.textfeat import scored

#: Documents at or above the first are toxic, documents below the second are of low quality.
TOXIC_FROM = 0.3
GOOD_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below ``TOXIC_FROM`` stay, as they are. Null texts are scored as empty ones; rows
    without an id and repeated rows are scored like any other."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", crc_of_id() % 4 != 2)
    return scored(docs, model, toxicity.scorer, "_toxic").where(F.col("_toxic") < TOXIC_FROM).select(docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents from ``GOOD_FROM`` stay, as they are; odd rows as in ``drop_toxic``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", crc_of_id() % 5 != 0)
    return scored(docs, model, quality.scorer, "_good").where(F.col("_good") >= GOOD_FROM).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier in the corpus. A document that loses all its text
    is gone; n_chars follows the text. Null and empty texts, and rows without an id, stay as they
    are; further columns keep their values, whatever their names."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("_rest"))
    cleaned = linededup.dedup_lines(packed, equal_chars=1).where((F.size("removed") == 0) | (F.trim(F.translate("text", "\n\t\r", "   ")) != ""))
    columns = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.{c}") for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = (F.when(F.size("removed") == 0, columns["n_chars"])
                              .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return cleaned.select(*(x.alias(c) for c, x in columns.items()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group stays, with all its rows; rows without
    an id stay, and so do null and empty texts."""
    gone = neardup.near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows; null texts are empty, every row is a document."""
    return packing.pack_documents(docs, WORD_VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: Models, shingles and packing are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
