"""Merkle comparison, its store, and the index."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import incremental as inc
from siltstone.streaming.index import IncompatibleIndex, Index, Update
from siltstone.streaming import index as ix


def states(spark, d):
    return spark.createDataFrame([(k, h, c) for k, (h, c) in d.items()], "k string, hash string, commit_hash string")


def test_changed_records_hold_all_differences(spark):
    draw = random.Random(1)
    a = {f"f{i}": (f"h{i}", "c1") for i in range(800)}
    b = dict(a)
    for k in draw.sample(sorted(a), 12):
        b[k] = ("other", "c1")
    for k in draw.sample(sorted(a), 5):
        b.pop(k, None)
    b["new"] = ("h", None)
    rows = inc.changed_records(states(spark, a).withColumn("node", F.lit(1)), states(spark, b), "k", ["hash", "commit_hash"]).collect()
    got = {r["k"] for r in rows if r["now"] != r["was"]}
    assert got == {k for k in a | b if a.get(k) != b.get(k)}
    assert len(rows) < 500
    assert inc.changed_records(states(spark, a), states(spark, a), "k", ["hash", "commit_hash"]).count() == 0


def files(spark, rows):
    return spark.createDataFrame(rows, "repo string, path string, commit_hash string, content_hash string, content string, scanned_at timestamp")


def test_file_changes(spark):
    from datetime import datetime as at

    sha = "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    src = files(spark, [("r", "same", "c" * 40, sha, None, at(2025, 1, 2)), ("r", "same", "d" * 40, "old", None, at(2025, 1, 1)), ("r", "same", "c" * 40, sha, None, at(2025, 1, 2)), ("r", "null", "c" * 40, None, "hello", at(2025, 1, 1)), ("r", "new", "c" * 40, "x", None, None), ("r", "chg", "c" * 40, "x", None, at(2025, 1, 1)), ("r", "com", "c" * 40, "x", None, at(2025, 1, 1)), ("r", "fail", "c" * 40, "x", None, at(2025, 1, 1)), (None, "p", "c", "x", None, at(2025, 1, 1))])
    old = spark.createDataFrame(
        [("r/same", "SHA256:" + sha.upper(), "c" * 12, 1, at(2025, 1, 1)), ("r/null", sha, "C" * 40, 1, at(2025, 1, 1)), ("r/chg", "y", "c" * 40, 1, at(2025, 1, 9)), ("r/chg", "x", "c" * 40, 3, at(2025, 1, 9)), ("r/com", "z", "c" * 40, 1, at(2025, 1, 9)), ("r/com", "x", "e" * 12, 2, at(2025, 1, 1)), ("r/com", None, "c" * 40, 2, at(2025, 2, 1)), ("r/fail", "x", "c" * 40, 3, at(2025, 1, 1)), ("r/gone", "x", "c", 1, at(2025, 1, 1)), (None, "x", "c", 1, None)],
        "file_key string, hash string, commit_hash string, run_id int, written_at timestamp",
    )
    runs = spark.createDataFrame([(1, at(2025, 1, 1), "success"), (2, at(2025, 1, 5), "success"), (3, at(2025, 1, 9), "failed"), (4, None, None)], "run_id int, started_at timestamp, status string")
    got = {r["file_key"]: r["change_kind"] for r in inc.file_changes(src, old, runs).collect()}
    assert got == {"r/new": "added", "r/chg": "changed", "r/com": "recommitted", "r/fail": "added"}
    assert inc.file_changes(src.limit(0), old.limit(0), runs.limit(0)).count() == 0


def test_store_survives_failures_without_skipping_or_repeating(spark, tmp_path):
    store = inc.Store(spark, str(tmp_path / "s"))
    seen = []

    def keep(changes):
        seen.append({r["k"]: r["change_kind"] for r in changes.collect()})
        return changes

    a = states(spark, {"x": ("1", "c"), "y": ("1", "c")})
    store.run(a, "k", ["hash"], keep)

    def fail(changes):
        raise RuntimeError("lost")

    b = states(spark, {"x": ("2", "c"), "z": ("1", "c")})
    with pytest.raises(RuntimeError):
        store.run(b, "k", ["hash"], fail)
    store.run(b, "k", ["hash"], keep)
    store.run(b, "k", ["hash"], keep)
    assert seen == [{"x": "added", "y": "added"}, {"x": "changed", "y": "removed", "z": "added"}, {}]
    assert {r["k"] for r in store.read("state").collect()} == {"x", "z"}


def test_index_takes_in_only_what_changed(spark, tmp_path):
    schema = "repo string, path string, code_lang string, content_hash string, commit_hash string, content string"
    go = "package pay\n\n// Refund gives it back.\nfunc Refund() error {\n\treturn nil\n}\n"
    first = spark.createDataFrame([("r", "pay.go", "go", "h1", "c1", go), ("r", "a.md", "markdown", "h2", "c1", "# One\nBody\n# Two\nOther\n")], schema)
    index = Index(spark, str(tmp_path / "i"), str(tmp_path))
    with pytest.raises(RuntimeError):
        Index(spark, str(tmp_path / "i"), str(tmp_path))
    assert index.update(first) == Update(2, 0, 0, 4)
    assert index.update(first) == Update(0, 2, 0, 0)
    assert index.update(first.withColumn("commit_hash", F.lit("c2"))) == Update(0, 2, 0, 0)
    assert {r["commit_hash"] for r in index.read("chunks").collect()} == {"c2"}
    changed = first.filter("path = 'pay.go'").withColumn("content_hash", F.lit("h3")).withColumn("commit_hash", F.lit("c2"))
    assert index.update(changed, prune=False) == Update(1, 0, 0, 2)
    assert index.read("files").count() == 2
    with pytest.raises(ValueError):
        index.update(changed.withColumn("content_hash", F.lit("h4")).withColumn("content", F.lit('password = "abcdef"')))
    assert index.update(changed) == Update(0, 1, 1, 0)
    queries = spark.createDataFrame([(1, "refund error"), (2, " ")], "query_id int, query string")
    for mode in ("lexical", "vector", "hybrid"):
        found = index.search(queries, 3, mode).collect()
        assert found and found[0]["query_id"] == 1 and found[0]["reference"] == "r/pay.go:3-6"
    assert index.find_symbol("Refund").count() == 1
    index.close()
    old, ix.VERSION = ix.VERSION, "other"
    try:
        with pytest.raises(IncompatibleIndex):
            Index(spark, str(tmp_path / "i"), str(tmp_path))
    finally:
        ix.VERSION = old
