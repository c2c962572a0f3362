"""The pipeline against plain code, stage by stage."""

import pytest

import corpus_pipeline as P
from tableferry.llm.queries import read

from . import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture
def odd_documents(spark):
    """Rows of the corpus with nulls in every column, repeats and extra columns."""
    docs = read(spark, SF, "documents")
    extra = spark.createDataFrame(
        [(None,) * 5, (1, None, None, None, None), (2, "", "en", "src1", 0), (None, "a b c d e f g h i j k", "en", None, 5)],
        docs.schema,
    )
    return docs.union(docs.where("doc_id < 30")).union(extra).selectExpr("*", "1 as n", "'x' as doc", "'y' as host")


def test_stages_keep_the_columns_of_documents(spark, odd_documents):
    assert len(P.STAGES) == 5
    for name, stage in P.STAGES[:-1]:
        done = stage(spark, odd_documents, SF)
        assert done.columns == odd_documents.columns, name
        assert [f.dataType for f in done.schema] == [f.dataType for f in odd_documents.schema], name
        assert done.count() > 0


def test_stages_take_empty_tables(spark, odd_documents):
    for _, stage in P.STAGES:
        assert stage(spark, odd_documents.where("false"), SF).collect() == []


def test_whole_run(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in read(spark, SF, "documents").collect()]
    docs = [d for d in docs if plain.quality(d[1])[6]]
    texts = plain.without_boilerplate([(s, t) for _, t, s in docs])
    docs = [(i, t) for (i, _, _), (t, _, _) in zip(docs, texts)]
    named = plain.near_duplicates(docs)
    docs = [d for d, (i, _, c) in zip(docs, named) if i == c]
    items = [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()]
    bad = plain.contamination(docs, items)
    docs = [d for d, b in zip(docs, bad) if not b[5]]
    found = P.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in found) == sorted((i, len(plain.spaced(t))) for i, t in docs)
    ends = {}
    for r in sorted((r for r in found if r["sequence"] is not None), key=lambda r: (r["sequence"], r["start"])):
        assert r["start"] == ends.get(r["sequence"], 0)
        ends[r["sequence"]] = r["start"] + r["n_tokens"]
        assert ends[r["sequence"]] <= r["capacity"]


def test_clean_documents_stay(spark):
    """Nearly all documents that are labelled good pass the quality rules."""
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    good = docs.join(labels.where("quality = 1").select("doc_id"), "doc_id")
    long = good.where("size(split(text, ' ')) >= 12")
    assert P.quality(spark, long, SF).count() > 0.97 * long.count()
