"""Searches by blocks give what a join of all pairs gives."""

import pytest
from pyspark.sql import functions as F

from siltstone.operators import dedup, products, retrieval
from siltstone.plans import search

D = "/root/testdata/sf0.001"


@pytest.fixture
def small(monkeypatch):
    for name, n in (("FEW", 1), ("QUERY_GROUP", 7), ("DOCUMENT_GROUP", 300), ("QUERIES", 3), ("DOCUMENTS", 120), ("NUMBERS", 1)):
        monkeypatch.setattr(products, name, n)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_documents_are_searched_by_blocks(spark, small):
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("text is not null").select("doc_id", "text")
    asked = docs.filter("doc_id % 50 = 0").toDF("query_id", "query")
    want = rows(retrieval.top(retrieval.bm25(docs, "doc_id", "text", asked), "doc_id", 10))
    assert rows(retrieval.top(retrieval.bm25_best(docs, "doc_id", "text", asked, 10), "doc_id", 10)) == want
    got = search.document_search(spark, D)
    assert rows(got) == want and want
    # no pair of a document and a query is made by a join of their terms
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().toString()


def test_few_queries_ties_and_empty_texts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["alpha beta", "alpha beta", "", "--", "beta beta gamma", "alpha beta"])] + [(None, "alpha")], "k int, t string")
    asked = spark.createDataFrame([(1, "alpha beta"), (2, ""), (3, "delta"), (None, "beta")], "query_id int, query string")
    got = rows(retrieval.top(retrieval.bm25_best(docs, "k", "t", asked, 2), "k", 2))
    assert [(r[0], r[1], r[3]) for r in got] == [(1, 0, 1), (1, 1, 2)]
    assert rows(retrieval.bm25_best(docs, "k", "t", asked.limit(0), 2)) == []


def test_chunks_are_searched_by_blocks(spark, small):
    chunks, asked = spark.read.parquet(f"{D}/chunks.parquet"), search.questions(spark, D)
    docs = search.chunk_texts(spark, D)
    want = rows(retrieval.top(retrieval.bm25(docs, "id", "body", asked, True), "id", 50))
    got = search.bm25_topk(spark, D)
    assert rows(got) == want and want
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().toString()


def test_documents_are_fused_by_blocks(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("text is not null").select("doc_id", "text")
    asked = docs.filter("doc_id % 50 = 0").toDF("query_id", "query")
    lexical = retrieval.top(retrieval.bm25(docs, "doc_id", "text", asked), "doc_id", 50)
    want = rows(retrieval.fuse([lexical, search._nearest_documents(docs, 50)], "doc_id", 10))
    monkeypatch.delattr(retrieval, "bm25")
    assert rows(search.hybrid_document_search(spark, D)) == want and want


def test_chunks_are_fused_by_blocks(spark, small, monkeypatch):
    chunks, asked = spark.read.parquet(f"{D}/chunks.parquet"), search.questions(spark, D)
    want = rows(retrieval.search_tables(retrieval.corpus_tables(chunks), asked, 10).drop("reference"))
    monkeypatch.delattr(retrieval, "bm25_of")
    assert rows(search.hybrid_topk(spark, D)) == want and want


def test_paths_are_counted_by_kind_before_queries_join(spark):
    paths, asked = spark.read.parquet(f"{D}/chunks.parquet").select("path").distinct(), search.questions(spark, D)
    weight = F.round(retrieval.source_weight(F.col("path"), F.col("query")), 2)
    want = rows(paths.crossJoin(asked).groupBy("query_id", weight.alias("weight")).agg(F.count("*").alias("n")))
    got = search.source_weights(spark, D)
    assert rows(got) == want and want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "AS kind" in plan[plan.index("Join") :]


def test_every_document_is_a_case_of_recall(spark, small):
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("text is not null").select("doc_id", "text")
    best = retrieval.top(retrieval.bm25(docs, "doc_id", "text", docs.toDF("query_id", "query")), "doc_id", 5)
    found, cases = best.filter("query_id = doc_id").count(), docs.count()
    assert rows(search.recall_at_5(spark, D)) == [(cases, round(found / cases, 6))]


def test_bounds_of_close_vectors_are_products_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PAIR_BLOCK", 3)
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("text is not null").select("doc_id", "text")
    vectors = {}
    for r in retrieval.tf_idf(docs, "doc_id", "text").collect():
        vectors.setdefault(r["doc_id"], {})[r["term"]] = r["value"]
    norm = {k: sum(x * x for x in v.values()) ** 0.5 for k, v in vectors.items()}
    dot = lambda a, b: sum(x * vectors[b].get(t, 0.0) for t, x in vectors[a].items())
    alike = [(a, b, round(dot(a, b) / norm[a] / norm[b], 4)) for a in vectors for b in vectors if a < b]
    want = sorted(x for x in alike if x[2] >= 0.92)
    assert rows(dedup.close_vectors(retrieval.tf_idf(docs, "doc_id", "text"), "doc_id", 0.92)) == want and want
