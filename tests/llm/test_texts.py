"""Encoding, packing and splitting of texts."""

import base64
import random
import re

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from siltstone.llm import bpe, packing, pieces

ODD = ["", " ", "a", "  \n\t x", "don't", "ÜBER straße", "日本語のテキスト", "👍🏽‍👩", "á​ b", "<|endoftext|>", "x" * 3000, " " * 2000, "ab" * 1500, "=-" * 900, "\x1c\x1d\x85 ", "\r\n\r", "12345 678", "\x00"]


@pytest.fixture(scope="module")
def reference():
    with open(bpe.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_a_merging_one(reference):
    one = bpe.Encoder(bpe.vocabulary_path())
    draw = random.Random(1)
    marks = [chr(i) for i in range(128)] + list("éüñ中日🎉") + ["the ", "ing", "'s", "  "]
    for text in ODD + ["".join(draw.choices(marks, k=draw.choice([2, 9, 60]))) for _ in range(800)]:
        ids = one.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert one.decode(ids) == text


def test_token_ids_of_all_rows(spark, reference):
    rows = list(enumerate(ODD)) + [(97, None), (None, "null key"), (1, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("tokens", F.lit(1))
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, list(r["ids"])) for r in bpe.token_ids(df, "doc_id").collect()))
    want = sorted((k if k is not None else -1, reference.encode_ordinary(t) if t else []) for k, t in rows)
    assert got == want
    sizes = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["tokens"]) for r in bpe.token_counts(df, "doc_id").collect())
    assert sizes == sorted((k, len(v)) for k, v in want)
    assert bpe.token_ids(df.limit(0), "doc_id").count() == 0


def test_differencing_keeps_every_item_and_balances():
    draw = np.random.default_rng(2)
    for n, windows in ((1, 1), (5, 3), (40, 7), (400, 30), (3, 8)):
        sizes = draw.integers(0, 500, n)
        owner, sums = packing._difference(sizes, windows)
        assert len(owner) == n and (owner >= 0).all() and (owner < windows).all()
        found = np.bincount(owner, sizes, windows).astype(int)
        assert sorted(found[found > 0]) == sorted(s for s in sums if s > 0)


def test_packing_is_whole_within_capacity_and_tight(spark):
    draw = random.Random(4)
    rows = [(i, min(int(draw.expovariate(1 / 250)) + 1, 9000)) for i in range(6000)] + [(1, 100), (None, 7), (7000, 0), (7001, None), (7002, 2048), (7003, 4096), (7004, 5000)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long").withColumn("cell", F.lit(1)).withColumn("row", F.lit(2)).withColumn("part", F.lit(3))
    got = packing.pack(df, "doc_id", "tokens", 2048, cell=64).collect()
    fill, parts = {}, {}
    for r in got:
        fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
        parts.setdefault(r["doc_id"], []).append((r["part"], r["first"], r["tokens"]))
    assert max(fill.values()) <= 2048
    assert sum(fill.values()) == sum(n or 0 for _, n in rows)
    assert len(fill) <= 1.03 * -(-sum(fill.values()) // 2048)
    assert sorted(parts[7004]) == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 904)]
    assert sorted(parts[7003]) == [(0, 0, 2048), (1, 2048, 2048)]
    assert len(parts[1]) == 2 and parts[7000] == [(0, 0, 0)] and parts[7001] == [(0, 0, 0)]
    assert all(len(v) == 1 for k, v in parts.items() if k not in (1, 7003, 7004) and dict(rows).get(k, 0) and dict(rows)[k] <= 2048)
    assert packing.pack(df.limit(0), "doc_id", "tokens").count() == 0
    with pytest.raises(Exception, match="negative"):
        packing.pack(spark.createDataFrame([(1, -1)], "doc_id long, tokens long"), "doc_id").collect()


def lines(text):
    return len(re.findall(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+\Z", text))


def test_pieces_spell_the_text_and_keep_the_limits():
    draw = random.Random(5)
    texts = ["x\n" * 500, "y" * 30000, "a, b; c. " * 3000, "\r\n".join("z" * draw.randrange(200) for _ in range(400)), "\r" * 900, "word " * 1000 + "\n" + "k = 1\n" * 300]
    for _ in range(20):
        texts.append("".join("w" * draw.choice([0, 5, 60, 1500, 9000]) + draw.choice(["\n", "\r\n", "\r"]) for _ in range(draw.randrange(1, 250))))
    for text in texts:
        for overlap in (0, 4, 80):
            found = pieces.cut_points(text, overlap=overlap)
            assert all(len(c) <= 8000 and lines(c) <= 160 for _, _, c in found)
            assert found[0][0] == 0 and found[-1][1] == lines(text) - 1
            assert all(a <= b for a, b, _ in found)
            assert all(n[0] <= p[1] + 1 and n[1] >= p[1] for p, n in zip(found, found[1:]))
            if not overlap:
                assert "".join(c for _, _, c in found) == text
    joined = pieces.cut_points("".join(f"l{i}\n" for i in range(400)), overlap=10)
    assert all(n[0] == p[1] - 9 for p, n in zip(joined, joined[1:]))


def test_cuts_prefer_blank_lines_before_declarations():
    body = "".join(f"func f{i}() {{\n" + "\tx := 1\n" * 30 + "}\n\n" for i in range(12))
    for _, _, c in pieces.cut_points(body)[1:]:
        assert c.startswith("func ")


def test_split_oversized_rows(spark):
    long = "".join(f"line {i}\n" for i in range(161))
    rows = [("a", 11, long), ("a", 11, long), ("b", None, "x" * 8001), ("c", 1, "x" * 8000), ("d", 1, "l\n" * 160), ("e", 1, None), ("f", 1, ""), (None, 5, "\r" * 161), ("g", 1, "ß" * 8001)]
    df = spark.createDataFrame(rows, "id string, start_line int, content string").withColumn("piece", F.lit(0)).withColumn("at", F.lit(0)).withColumn("end_line", F.lit(None).cast("int"))
    got = pieces.split_oversized(df, "id", "content", "start_line").collect()
    assert {r["id"] for r in got} == {"a", "b", None, "g"}
    first = sorted((r for r in got if r["id"] == "a"), key=lambda r: r["piece"])
    assert first[0]["start_line"] == 11 and first[-1]["end_line"] == 171
    assert "".join(r["content"] for r in first) == long
    assert all(r["start_line"] == r["end_line"] == 1 for r in got if r["id"] == "b")
    assert pieces.split_oversized(df.limit(0), "id", "content", "start_line").count() == 0
    with pytest.raises(ValueError):
        pieces.split_oversized(df, "id", "content", "start_line", overlap=81)


def test_line_counts_equal_python(spark):
    texts = ["", "a", "a\n", "a\r\n", "a\r", "\n\r", "\r\n\n", "a\rb\r\nc\nd"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pieces.line_count(F.col("t")).alias("n")).collect()
    assert {r["t"]: r["n"] for r in got} == {t: lines(t) for t in texts}


def test_the_overlap_asked_for_is_delivered():
    for width, want in ((700, 8), (20, 8), (1100, 7)):
        text = "\n".join("x" * width for _ in range(400 if width == 20 else 40))
        found = pieces.cut_points(text, overlap=8)
        assert {a[1] - b[0] + 1 for a, b in zip(found, found[1:])} == {want}
        assert all(len(c) <= 8000 and b - a < 160 for a, b, c in found)
    assert all(len(c) <= 8000 for _, _, c in pieces.cut_points("z" * 30000, overlap=8))


def test_many_empty_items_are_spread_over_cells(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ITEMS", 50)
    got = packing.pack(spark.range(400).selectExpr("id", "0L as tokens"), "id").collect()
    assert len(got) == 400 and len({r["container"] for r in got}) > 4
