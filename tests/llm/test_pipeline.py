"""The stages of the corpus pipeline over odd rows, each against a plain version."""

import random

import pytest
from brute import cleaned_lines, near_document_classes
from test_text_dedup import line_documents, near_documents

from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from walletyield.llm import linededup, quality, toxicity  # noqa: E402
from walletyield.llm.common import crc_of_id  # noqa: E402
from walletyield.llm.textfeat import scored  # noqa: E402

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, lang string, source string, n_chars int, score double, kept string, class_id int, removed int"


def documents(spark, pairs):
    """Documents with further columns that the operators use inside as well."""
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), 0.5, "k", 1, 2) for d, t in pairs], EXTRA).repartition(3)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def odd_documents(spark):
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    pairs = [(r.doc_id, r.text) for r in own.collect()] + [
        (9001, None), (9002, ""), (9003, " \n\t "), (None, "the of and river"), (None, None), (9004, "word " * 30000), (9004, "word " * 30000)]
    return pairs, documents(spark, pairs)


@pytest.mark.parametrize("stage, train, scorer, learn, floor", [
    ("toxicity", toxicity, toxicity.scorer, ("toxic", 4, 2), False), ("quality", quality, quality.scorer, ("quality", 5, 0), True)])
def test_classifier_stages_drop_what_they_reject(spark, stage, train, scorer, learn, floor):
    _, docs = odd_documents(spark)
    label, mod, out = learn
    model = train.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), label, crc_of_id() % mod != out)
    kept = F.col("p") >= 0.3 if floor else F.col("p") < 0.3
    want = scored(docs, model, scorer, "p").where(kept).drop("p")
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF)
    assert got.columns == docs.columns and rows_of(got) == rows_of(want)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(0), SF).collect() == []


def test_line_stage(spark):
    pairs = line_documents(random.Random(1)) + [(None, "y" * 3000)]
    docs = documents(spark, pairs)
    got = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    assert got.columns == docs.columns
    gone = cleaned_lines([p for p in pairs if p[0] is not None], linededup.THRESHOLD, linededup.MIN_CHARS)
    text = {r.doc_id: r.text for r in got.collect()}
    for d, t in pairs:
        left = None if t is None else [x for i, x in enumerate(t.split("\n")) if d is None or i not in gone[d][0]]
        if left is None or not gone.get(d, [()])[0]:  # short equal lines may go besides
            assert d in text
        elif "".join(left).strip() == "":
            assert d not in text
        elif d in text:
            assert set(text[d].split("\n")) <= set(left)
    assert {tuple(r)[5:] for r in got.collect()} == {(0.5, "k", 1, 2)}
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None)
    assert corpus_pipeline.drop_repeated_lines(spark, docs.limit(0), SF).collect() == []


def test_near_stage_keeps_one_of_each_class(spark):
    pairs = near_documents()
    docs = documents(spark, [*pairs, (None, pairs[0][1]), (5, pairs[5][1])])
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    classes = near_document_classes(pairs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.where("doc_id IS NOT NULL").collect()) == sorted(
        d for d in [*(d for d, _ in pairs), 5] if classes[d] == d)
    assert got.where("doc_id IS NULL").count() == 1
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF).collect() == []


def test_whole_run(spark, tmp_path):
    pairs, docs = odd_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = spark.createDataFrame(stage(spark, before, str(tmp_path)).collect(), docs.schema)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in before.collect()} and 0 < before.count() < len(pairs)
    tokens = {}
    for p in pieces:
        tokens.setdefault((p.doc_id, p.doc_tokens), []).append(p.length)
    assert all(sum(n) % total == 0 for (_, total), n in tokens.items())


def test_tasks_give_back_what_they_held(monkeypatch):
    """Idle Python workers kept the memory of their last task beside the JVM's part of the work."""
    import weakref

    from walletyield.llm import common

    class Held(dict):
        pass

    refs, alive = [], []

    def run(batches):
        held = Held()
        refs.append(weakref.ref(held))
        for b in batches:
            held[b] = b
            yield b

    monkeypatch.setattr(common, "give_back", lambda: alive.append(refs[0]() is not None))
    assert list(common.giving_back(run)(iter("abc"))) == ["a", "b", "c"]
    assert alive == [False]
