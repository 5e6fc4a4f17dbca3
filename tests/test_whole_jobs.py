"""Queries do the whole of what they name: no row, text or group is left out."""


from siltstone.operators import dedup, golang, retrieval, splits
from siltstone.plans import datasets, search, structure
from siltstone.streaming import index


def test_equal_texts_without_terms_are_duplicates(spark, tmp_path):
    rows = [(1, ""), (2, "-"), (3, ""), (4, "日本語の文"), (5, "日本語の文"), (6, "-"), (7, ""), (8, None), (9, "alpha beta"), (10, "gamma delta"), (11, "alpha beta")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["duplicate_of"] for r in datasets.semantic_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: None, 2: None, 3: 1, 4: None, 5: 4, 6: 2, 7: 1, 9: None, 10: None, 11: 9}


def test_a_cosine_that_rounds_up_to_the_least_is_close(spark):
    x = 0.91997
    rows = [(1, "rare", (1 - x * x) ** 0.5), (1, "shared", x), (2, "shared", 1.0)]
    got = dedup.close_vectors(spark.createDataFrame(rows, "k int, term string, value double"), "k", 0.92).collect()
    assert [tuple(r) for r in got] == [(1, 2, 0.92)]


def test_go_files_with_a_byte_order_mark_are_read_and_refused_ones_reported(spark, tmp_path):
    good, bad = "﻿package a\n\nfunc F() { g() }\n", "package a\n\nfunc f( {\n"
    assert [(d["start_line"], d["symbol"]) for d in golang.declarations(good)] == [(1, "a"), (3, "F")]
    rows = [("r", "a.go", "c", good, "go"), ("r", "b.go", "c", bad, "go"), ("r", "d.go", "c", "", "go")]
    files = spark.createDataFrame(rows, "repo string, path string, commit_hash string, content string, code_lang string")
    files.write.parquet(str(tmp_path / "source_files.parquet"))
    got = sorted((r["path"], r["start_line"], r["symbol"], r["symbol_type"]) for r in structure.go_declarations(spark, str(tmp_path)).collect())
    assert got == [("a.go", 1, "a", "package"), ("a.go", 3, "F", "function"), ("b.go", 3, None, "syntax_error")]
    assert index.parse(files.filter("path = 'a.go'")).count() == 2


def test_every_repository_is_split_with_its_team(spark, tmp_path):
    repos = ["payments-api"] * 4 + ["Payments-Api", "https://host.example/x/PAYMENTS_CORE.git", "claims-web", "Claims-Web", "mono", "Mono", "ledger-core", None]
    spark.createDataFrame([(r,) for r in repos], "repo string").write.parquet(str(tmp_path / "source_files.parquet"))
    got = {r["team"]: r["split"] for r in datasets.greedy_group_split(spark, str(tmp_path)).collect()}
    assert set(got) == {"payments", "claims", "mono", "ledger", ""} and set(got.values()) == {"train", "validation", "test"}


def test_all_groups_are_split_by_the_same_rule(spark):
    sizes = {f"g{i:04}": 1 + i % 7 for i in range(2500)}
    goal = {"test": 0.1, "train": 0.8, "validation": 0.1}
    filled, want = dict.fromkeys(goal, 0), {}
    for g, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        gain = {s: (filled[s] + n - goal[s] * sum(sizes.values())) ** 2 - (filled[s] - goal[s] * sum(sizes.values())) ** 2 for s in goal}
        want[g] = min(goal, key=lambda s: (gain[s], -goal[s], s))
        filled[want[g]] += n
    got = splits.greedy_split(spark.createDataFrame(list(sizes.items()), "g string, n int"), "g", "n").collect()
    assert {r["g"]: r["split"] for r in got} == want


def test_every_fiftieth_document_is_asked(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "DOCUMENT_BLOCK", 40)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 1)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text is not null").select("doc_id", "text")
    vectors = retrieval.hashed_vectors(docs, "doc_id", "text")
    asked = vectors.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")
    for name, k in (("hashed_document_search", 10), ("hybrid_document_search", 10)):
        got = search.QUERIES[name](spark, "/root/testdata/sf0.001")
        if name.startswith("hashed"):
            want = retrieval.top(retrieval.sparse_cosine(vectors, "doc_id", asked), "doc_id", k)
        else:
            queries = docs.filter("doc_id % 50 = 0").toDF("query_id", "query")
            parts = retrieval.bm25(docs, "doc_id", "text", queries), retrieval.sparse_cosine(vectors, "doc_id", asked)
            want = retrieval.fuse([retrieval.top(x, "doc_id", 50) for x in parts], "doc_id", k)
        rows = sorted(map(tuple, got.collect()))
        assert rows == sorted(map(tuple, want.collect()))
        assert {r[0] for r in rows} == {r["query_id"] for r in asked.select("query_id").distinct().collect()} and rows
