"""Contraction, matches and splits against union-find."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.llm import keep_together, matches
from siltstone.llm.contraction import components


def union_find(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("method", ["hash_order", "random_mate"])
def test_components_of_chains_stars_and_random_graphs(spark, method):
    draw = random.Random(7)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    pairs += [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(40)]
    rows = pairs + pairs[:10] + [(b, a) for a, b in pairs[:10]] + [(5, 5), (None, 3), (4, None)]
    df = spark.createDataFrame(rows, "a long, b long").withColumn("v", F.lit("x")).withColumn("w", F.lit("y"))
    got = {r["v"]: r["root"] for r in components(df, "a", "b", method).collect()}
    want = {k: v for k, v in union_find([p for p in pairs if p[0] != p[1]]).items()}
    assert set(got) == set(want)
    classes = {}
    for k, v in want.items():
        classes.setdefault(v, set()).add(got[k])
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_consolidate_gives_the_least_id_and_keeps_lone_ones(spark):
    df = spark.createDataFrame([("b", "c"), ("c", "a"), ("c", "a"), ("z", "z"), (None, "q")], "a string, b string")
    got = {(r["id"], r["group_id"]) for r in matches.consolidate(df).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a"), ("z", "z")}


A, B, C, D = ("a" * 32, "b" * 32, "c" * 32, "d" * 32)


def test_matches_are_resolved_however_they_are_written(spark):
    chunks = spark.createDataFrame([(A, "r", "p.go", 1, 5), (B, "r", "q.go", 2, None), (B, "r", "q.go", 2, None)], "id string, repo string, path string, start_line int, end_line int")
    rows = [
        (f"chunk:{A}", None, None, "r/none.go:1-2"),  # no such reference
        (f" {A.upper()}\t", None, C, None),  # an id that is gone from chunks counts
        (None, "r/p.go:1-5", D, "ignored"),
        (None, None, D, None),
        (B, None, B, None),
    ]
    m = spark.createDataFrame(rows, "left_id string, left_reference string, right_id string, right_reference string").withColumn("score", F.lit(None).cast("double")).withColumn("id", F.lit(1))
    got = {(r["id"], r["group_id"]) for r in matches.match_groups(m, chunks).collect()}
    assert got == {(A, A), (C, A), (D, A), (B, B)}
    assert matches.match_groups(m.limit(0), chunks.limit(0)).count() == 0


def test_modules_by_any_spelling_of_repository_and_path(spark):
    repos = spark.createDataFrame([("old-pay", "mid-pay"), ("mid-pay", "pay-core"), ("pay-core", None)], "repo string, moved_to string")
    spelled = [
        ("pay-core", "a/b/x.go"), ("Pay_Core", "a//b/y.go"), ("git@h.example:team/old-pay.git", "./a/./b/z.go"), (" mid-pay/ ", "a\\b\\w.go"),
        ("pay-core", "a/c/../b/u.go"), ("pay-core", "a/B/x.go"), ("pay-core", "a/x.go"), ("other", "a/b/x.go"), ("pay-core", "top.go"), ("pay-core", "/top2.go"), (None, None),
    ]
    rows = [(f"{r}/{p}", r, p) for r, p in spelled]
    chunks = spark.createDataFrame(rows + rows[:2], "file_key string, repo string, path string").withColumn("record", F.lit(0)).withColumn("keys", F.lit("k"))
    got = {r["file_key"]: r["group_key"] for r in keep_together.modules(chunks, repos).collect()}
    first = min(k for k, _, _ in rows[:5])
    assert [got[k] for k, _, _ in rows[:5]] == [first] * 5
    assert [got[k] == k for k, _, _ in rows[5:8]] == [True] * 3
    assert got["pay-core/top.go"] == got["pay-core//top2.go"] == min("pay-core/top.go", "pay-core//top2.go")
    assert len(got) == len(rows)
    assert keep_together.modules(chunks.limit(0), repos.limit(0)).count() == 0


def test_groups_over_several_keys_and_rows(spark):
    rows = [("r1", "ann", None), ("r2", "ann", "s1"), ("r3", None, "s1"), ("r4", "bob", "s2"), ("r4", "cid", None), ("r5", "cid", None), ("r6", None, None), ("r7", "s2", None), (None, "ann", "s9")]
    df = spark.createDataFrame(rows, "id string, author string, source string")
    got = {r["id"]: r["group_key"] for r in keep_together.groups(df, "id", ["author", "source"]).collect()}
    assert got == {"r1": "r1", "r2": "r1", "r3": "r1", "r4": "r4", "r5": "r4", "r6": "r6", "r7": "r7"}


def test_splits_keep_groups_whole_and_come_near_the_proportions(spark):
    draw = random.Random(3)
    rows = [(f"g{i}", draw.randrange(1, 20)) for i in range(3000)] + [("hot", 3000), (None, 5)]
    df = spark.createDataFrame(rows, "g string, n int").withColumn("w", F.lit(1)).withColumn("part", F.lit(1))
    got = keep_together.assign(df, "g", F.col("n"), {"train": 0.8, "validation": 0.1, "test": 0.1})
    split = {r["g"]: r["split"] for r in got.collect()}
    sizes = dict.fromkeys(("train", "validation", "test"), 0)
    for g, n in rows[:-1]:
        sizes[split[g]] += n
    whole = sum(sizes.values())
    assert len(split) == 3001
    assert all(abs(sizes[s] / whole - p) < 0.06 for s, p in (("train", 0.8), ("validation", 0.1), ("test", 0.1)))
    assert keep_together.assign(df.limit(0), "g", F.col("n"), {"a": 1.0}).count() == 0


def test_module_splits_do_not_part_a_module(spark):
    rows = [(f"{i:032x}", f"r/d{i % 40}/f{i}.go", "r", f"d{i % 40}/f{i}.go") for i in range(400)]
    chunks = spark.createDataFrame(rows, "id string, file_key string, repo string, path string")
    got = keep_together.module_splits(chunks, spark.createDataFrame([], "repo string, moved_to string")).collect()
    assert len(got) == 400
    assert len({(r["group_key"], r["split"]) for r in got}) == 40
