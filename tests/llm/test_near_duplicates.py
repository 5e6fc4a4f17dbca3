"""Near-duplicates against comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import near_duplicates as nd


def shingles(text, k):
    tokens = nd.TOKEN.findall(text.lower())
    return {tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1)}


def brute(rows, k, least):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None and t is not None]
    out = set()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1 :]:
            if i != j and a and b and len(a & b) / len(a | b) >= least:
                out.add((min(i, j), max(i, j)))
    return out


def family(draw, n, size, edits):
    base = [f"w{draw.randrange(5000)}" for _ in range(size)]
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[draw.randrange(size)] = f"w{draw.randrange(5000)}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    texts = []
    for _ in range(12):
        texts += list(family(draw, draw.randrange(2, 9), draw.randrange(20, 120), draw.randrange(0, 6)))
    texts += [" ".join(f"w{draw.randrange(5000)}" for _ in range(60)) for _ in range(80)]
    texts += ["common start of it all " * 3 + t for t in texts[:20]]
    texts += [texts[0]] * 5 + [texts[1].upper()] + ["", "two words", "日本語", "a b c"]
    rows = [(f"k{i:04d}", t) for i, t in enumerate(texts)]
    return rows + rows[:9] + [("none", None), (None, texts[3])]


@pytest.mark.parametrize("shard", [nd.SHARD, 6])
def test_pairs_equal_brute_force(spark, rows, shard):
    df = spark.createDataFrame(rows, "id string, content string").withColumn("rep", F.lit(1)).withColumn("shard", F.lit(2)).withColumn("text", F.lit("clash")).withColumn("key", F.lit("k"))
    found = nd.NearDuplicates(df, "id", "content", 0.7, 3, shard)
    got = [(r["id_a"], r["id_b"]) for r in found.pairs().collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, 3, 0.7)


def test_groups_are_those_of_the_pairs(spark, rows):
    found = nd.NearDuplicates(spark.createDataFrame(rows, "id string, content string"), "id", "content", 0.8, 5)
    pairs = brute(rows, 5, 0.8)
    parent = {i: i for i, t in rows if i and t and shingles(t, 5)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["id"]: r["group_id"] for r in found.groups().collect()}
    assert got == {i: root(i) for i in parent}


def test_no_rows(spark):
    found = nd.NearDuplicates(spark.createDataFrame([], "id string, content string"), "id", "content")
    assert found.pairs().count() == 0 and found.groups().count() == 0


def sets_of_many_sizes(draw):
    """Sets as rows of a matrix: bases of many sizes, each with near copies, and their fingerprints."""
    made = []
    for size in draw.integers(5, 900, 60):
        base = draw.integers(0, 1 << 50, size).astype(np.uint64)
        for n in draw.integers(0, max(2, size // 4), 5):
            made.append(np.unique(np.concatenate([base[n:], draw.integers(0, 1 << 50, n // 2).astype(np.uint64)])))
    return made, nd._prints(np.concatenate(made), np.concatenate([[0], np.cumsum([len(x) for x in made])]))


@pytest.mark.parametrize("similarity", [0.7, 0.9])
def test_tree_finds_all_similar_sets_and_enters_few_branches(similarity):
    made, words = sets_of_many_sizes(np.random.default_rng(3))
    sizes, counted = np.array([len(x) for x in made]), []
    a, b = nd.close_pairs(words, sizes, similarity, counted)
    got = set(zip(a.tolist(), b.tolist()))
    assert len(got) == len(a) and all(x < y for x, y in got)
    n = len(made)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if (s := len(np.intersect1d(made[i], made[j]))) / (sizes[i] + sizes[j] - s) >= similarity}
    assert want <= got
    assert counted[0] < 0.4 * n * n


def test_no_distance_exceeds_what_is_apart():
    made, words = sets_of_many_sizes(np.random.default_rng(4))
    for i in range(0, len(made), 7):
        for j in range(0, len(made), 5):
            assert nd._distance(words[i], words[j]) <= len(np.setxor1d(made[i], made[j]))


def test_candidates_against_all_pairs_of_a_table(spark):
    """The recall of the whole operator, shards included, on a table: no pair of texts is missed."""
    chunks = spark.read.parquet("/root/testdata/sf0.001/chunks.parquet")
    rows = [tuple(r) for r in chunks.filter("length(content) >= 100 and coalesce(symbol_type not in ('package', 'import'), true)").select("id", "content").distinct().collect()]
    got = {(r["id_a"], r["id_b"]) for r in nd.chunk_near_duplicates(chunks).pairs().collect()}
    assert got == brute(rows, 3, 0.7)


def test_which_chunks_take_part(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [("a", text, "function"), ("b", text, None), ("c", text, "import"), ("d", text, "package"), ("e", None, "function"), ("f", "short text", "function"), ("g", "short text", "function")]
    got = nd.chunk_near_duplicates(spark.createDataFrame(rows, "id string, content string, symbol_type string")).pairs().collect()
    assert [(r["id_a"], r["id_b"]) for r in got] == [("a", "b")]
