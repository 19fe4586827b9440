"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.llm import sharding
from walletyield.llm.common import crc_of_id, remove_folder, shared_folder, table

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def register(fn: Builder) -> Builder:
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import topk
    return topk.top_k(topk.scaled(table(spark, sf_dir, "embeddings"), 64), F.col("vec_id") % 20 == 0, 20)


ORACLE["op1_topk"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@register
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm.bpe import encode_documents
    return encode_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


@register
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


@register
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import quality
    from walletyield.llm.textfeat import scored
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", crc_of_id() % 5 != 0)
    return scored(docs, model, quality.scorer).select(
        "doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.place(docs, sharding.shard_names(sharding.SHARDS)).select("doc_id", "slot", "shard")


ORACLE["op4_sharding"] = sharding.ORACLE


@register
def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import vectordedup
    return vectordedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


ORACLE["op5_vector_dedup"] = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
"""


@register
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import neardup
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import linededup
    cleaned = linededup.dedup_lines(table(spark, sf_dir, "documents"), equal_chars=1)
    return cleaned.select("doc_id", "n_lines", "removed", "n_near")


@register
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import warc
    arc, out = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, out)
    remove_folder(spark, arc)
    return warc.read_warc(spark, out).drop("url")


ORACLE["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
"""


@register
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import toxicity
    from walletyield.llm.textfeat import scored
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", crc_of_id() % 4 != 2)
    return scored(docs, model, toxicity.scorer).select(
        "doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import spelling
    return spelling.group(table(spark, sf_dir, "documents"))


@register
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm.tokencount import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), PIECE_VOCABULARY, 4096)


@register
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from walletyield.llm import ranked
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


ORACLE["op13_ranked_search"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
           FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
d AS (SELECT row_number() OVER () AS row, doc_id, terms, len(terms) AS n FROM t WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
p AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, total GROUP BY term),
i AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL),
s AS (SELECT item_id, row, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total.terms))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN w USING (term), total GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def queries() -> dict[str, Builder]:
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
