"""Chunking, Go, splits, dedup, components, examples, sources."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import chunking, components, dedup, examples, golang, retrieval, splits
from siltstone.plans import building
from siltstone.sources import files as sources
from siltstone.sources import sinks
from siltstone.sources.html import page_blocks

GO = """package pay

import (
	"fmt"
	alias "x/y"
)

// Service serves.
// Second line.
type Service struct {
	n string // }
}

// apart

func (s *Service) Pay(n int) (err error) {
	if n > 3 { return fmt.Errorf("no } %d", n) }
	select { case v := <-s.in: s.out <- v }
	defer close(s.out)
	return nil
}

type (
	A = int
	B interface{ Get() error }
)
var x, y = 1, `raw
{ text`
"""


def test_go_declarations():
    got = [(d["start_line"], d["end_line"], d["symbol_type"], d["symbol"]) for d in golang.declarations(GO)]
    assert got == [(1, 1, "package", "pay"), (3, 6, "import", "import"), (8, 12, "struct", "Service"), (16, 21, "method", "(s *Service).Pay"), (23, 26, "type", "A, B"), (27, 28, "var", "x, y")]
    pay = golang.declarations(GO)[3]
    assert pay["calls"] == ["close", "fmt.Errorf"] and pay["imports"] == ["fmt", "x/y"]
    assert pay["constructs"] == ["defer_statement", "if_statement", "receive_statement", "return_statement", "select_statement", "send_statement"]
    for bad in ("package x\nfunc f( {\n", "package x\nhello\n", 'package x\nvar s = "a\n', "func\n"):
        with pytest.raises(golang.GoSyntaxError):
            golang.declarations(bad)


def test_sections(spark):
    long = "\n".join(f"k{i} = {i}" for i in range(400))
    rows = [("m", "markdown", "# One\nBody\n# Two\nOther\n"), ("y", "yaml", "a: 1\n b: 2\nc: 3"), ("e", "yaml", ""), ("b", "yaml", "\n \n"), ("t", "text", long), ("n", "text", None)]
    got = sorted((r["k"], r["start_line"], r["end_line"], r["symbol"][:9]) for r in chunking.sections(spark.createDataFrame(rows, "k string, lang string, c string"), ["k"], "c", "lang").collect())
    assert got == [("m", 1, 2, "# One"), ("m", 3, 4, "# Two"), ("t", 1, 160, "k0 = 0"), ("t", 161, 320, "k0 = 0"), ("t", 321, 400, "k0 = 0"), ("y", 1, 2, "a: 1"), ("y", 3, 3, "c: 3")]


def test_token_batches_stay_within_budget(spark):
    text = " ".join(["A sentence of several words stands here again."] * 200)
    got = chunking.token_batches(spark.createDataFrame([(1, text), (2, "short"), (3, ""), (4, None)], "k int, c string"), ["k"], "c").collect()
    assert len([r for r in got if r["k"] == 1]) > 2
    assert all(r["estimated_tokens"] <= 1000 and r["content"].endswith(".") for r in got if r["k"] == 1)
    assert {r["k"] for r in got} == {1, 2}


def test_components_against_union_find(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(80), draw.randrange(80)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300), (None, 1)]
    parent = {}

    def root(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs[:-1]:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["vertex"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a int, b int"), "a", "b").collect()}
    assert got == {v: root(v) for v in parent}


def test_greedy_equals_a_loop(spark):
    draw = random.Random(5)
    for n in (1, 12, 40):
        links = [(draw.randrange(n), draw.randrange(n)) for _ in range(n)]
        kept, cause = [], {}
        near = {frozenset(x) for x in links if x[0] != x[1]}
        for i in range(n):
            hit = next((k for k in kept if frozenset((k, i)) in near), None)
            if hit is None:
                kept.append(i)
            cause[i] = hit
        df = spark.createDataFrame([(i,) for i in range(n)], "i int")
        got = {r["i"]: r["duplicate_of"] for r in dedup.greedy(df, "i", ["i"], spark.createDataFrame(links, "a int, b int")).collect()}
        assert got == cause


def test_ten_equal_groups_split_eight_one_one(spark):
    df = spark.createDataFrame([(f"g{i}", 1) for i in range(10)], "g string, n int")
    got = splits.greedy_split(df, "g", "n").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 8, "validation": 1, "test": 1}
    with pytest.raises(ValueError):
        splits.greedy_split(df.limit(2), "g", "n")
    many = spark.range(3000).select(F.col("id").cast("string").alias("g"), F.lit(1).alias("n"))
    sizes = {r["split"]: r["count"] for r in splits.greedy_split(many, "g", "n").groupBy("split").count().collect()}
    assert sum(sizes.values()) == 3000 and abs(sizes["train"] - 2400) < 90


def test_same_text_in_two_repositories_is_split_together(spark):
    text = "func Long() error {\n" + "\tcall()\n" * 20 + "}"
    rows = [(r, f"{m}/a.go", text if m < 3 else text + str(m), "function") for r in ("one", "two") for m in range(20)]
    chunks = spark.createDataFrame(rows, "repo string, path string, content string, symbol_type string")
    got = {r["file_key"]: r["split"] for r in splits.module_split(chunks, chunks, 0.5).collect()}
    assert len(got) == 40 and len({got[f"{r}/{m}/a.go"] for r in ("one", "two") for m in range(3)}) == 1
    assert set(got.values()) == {"train", "validation"}


def test_argument_guards(spark):
    for k, mode in ((0, "hybrid"), (101, "hybrid"), (5, "other")):
        with pytest.raises(ValueError):
            retrieval.check_search(k, mode)
    with pytest.raises(ValueError):
        splits.module_split(spark.range(1), spark.range(1), 1.0)
    with pytest.raises(ValueError):
        sources.first_files(spark.range(1), 0)


def test_stale_review_raises(spark):
    rows = spark.createDataFrame([("1", "r", "h", True, "ann", [("user", "a b"), ("assistant", "c d")])], building.REVIEW)
    live = spark.createDataFrame([("r", "other")], "reference string, content_hash string")
    with pytest.raises(ValueError):
        examples.import_reviewed(rows, rows.limit(0), live)


def test_scan_of_a_folder(spark, tmp_path):
    root = tmp_path / "repo"
    (root / "vendor").mkdir(parents=True)
    (root / "a.go").write_text("package a\n")
    (root / "vendor" / "b.go").write_text("package b\n")
    (root / "bin.go").write_bytes(b"package c\0\xff")
    (root / "s.yaml").write_text("x: 1\npassword: abcdefg\n")
    accepted, report = sources.scan(sources.read_folder(spark, str(root), "repo"))
    assert [(r["path"], r["code_lang"]) for r in accepted.collect()] == [("a.go", "go")]
    assert sorted((r["path"], r["rule"], r["line"]) for r in report.collect()) == [("s.yaml", "credential_yaml", 2), ("vendor/b.go", "excluded_path", None)]


def test_json_lines_round_trip_replaces_the_old(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "ä"), (2, None)], "a int, b string")
    for _ in range(2):
        sinks.write_json_lines(df, path)
    back = sources.read_json_lines(spark, sinks.json_lines_folder(spark, path), "a int, b string")
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("v-")]) == 1
    assert sorted(map(tuple, back.collect())) == [(1, "ä"), (2, None)]
    same = sinks.content_hash(df.orderBy(F.desc("a"))).first()
    assert same == sinks.content_hash(back).first() and same["rows"] == 2
    (tmp_path / "bad.json").write_text("{oops\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        sources.read_json_lines(spark, str(tmp_path / "bad.json"), "a int").collect()


def test_html_headings_mute_what_lies_below():
    html = "<h2>History of it</h2><p>old text of the page</p><h3>Deeper</h3><p>older text of it</p><h2>Now</h2><p>new text</p>"
    assert page_blocks(html) == [("Now", "new text")]


def test_close_vectors_equal_all_pairs(spark):
    draw = random.Random(9)
    docs = {}
    for i in range(60):
        base = docs.get(draw.randrange(60)) if i % 3 == 0 else None
        docs[i] = dict(base) if base else {f"t{draw.randrange(40)}": float(draw.randrange(1, 5)) for _ in range(12)}
        docs[i][f"t{draw.randrange(40)}"] = 1.0
    rows = [(i, t, v) for i, d in docs.items() for t, v in d.items()]
    want = set()
    for i, a in docs.items():
        for j, b in docs.items():
            dot = sum(v * b.get(t, 0) for t, v in a.items()) / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
            if i < j and round(dot, 4) >= 0.8:
                want.add((i, j))
    got = {(r["a"], r["b"]) for r in dedup.close_vectors(spark.createDataFrame(rows, "k int, term string, value double"), "k", 0.8).collect()}
    assert got == want
