"""Exact, keyed and semantic deduplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import digest, fingerprint
from siltstone.operators.components import components
from siltstone.runtime import cut, drop, ship

#: Links of a component that one task goes through in order; larger components are decided in rounds.
FOLD_LINKS = 200_000
COSINE_DIGITS = 4
#: Parts that a vector's terms are hashed into for a bound of its products.
PARTS = 64
#: Vectors of a term whose bounds are one product of matrices, and how far single precision may be off.
PAIR_BLOCK, SLACK = 2_000, 1e-5


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`; all columns stay."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def exact(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """The first row of each text, whatever its white space; rows with a null text all stay.

    Every task keeps the first row of each text it has before anything is shuffled, so a text of a third of all rows
    moves one row a task.
    """
    some = df.filter(F.col(text).isNotNull()).withColumn("_fp", fingerprint(F.col(text)))
    return first_by(some, ["_fp"], order).drop("_fp").unionByName(df.filter(F.col(text).isNull()))


def greedy(rows: DataFrame, key: str, order: list[str], links: DataFrame) -> DataFrame:
    """(key, kept, duplicate_of): rows in `order`, each kept unless a kept one before it is linked to it.

    `links` has (a, b, similarity) in either direction. `duplicate_of` is the first such row. The result is that of a
    loop over the rows. Rows of different components of the links do not touch each other: a component of up to
    FOLD_LINKS links is gone through in order by one task, long chains too. A larger one is decided in rounds: a row is
    kept once all its earlier neighbours have fallen, and falls once one of them is kept; the rounds are as many as the
    longest chain of decisions that hang on each other, which is short where so many links are dense, and they go on
    until all is decided.
    """
    place = rows.select(F.col(key).alias("k"), F.struct(*[c for c in order if c != key], key).alias("o"))
    both = links.select(F.col("a").alias("k"), F.col("b").alias("j")).unionByName(links.select(F.col("b").alias("k"), F.col("a").alias("j"))).filter("k <> j").distinct()
    earlier = both.join(place, "k").join(place.select(F.col("k").alias("j"), F.col("o").alias("p")), "j").filter("p < o").select("k", "j", "o", "p")
    earlier = cut(earlier, "earlier")
    roots = components(earlier, "k", "j").withColumnRenamed("vertex", "k")
    marked = cut(earlier.join(roots, "k"), "earlier")
    large = cut(marked.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > FOLD_LINKS).select("root"), "large")
    fallen = _fold(marked.join(large, "root", "left_anti"))
    if not large.isEmpty():
        fallen = fallen.unionByName(_rounds(marked.join(large, "root", "left_semi")))
    return place.select("k").join(fallen, "k", "left").select(F.col("k").alias(key), F.col("duplicate_of").isNull().alias("kept"), "duplicate_of")


def _fold(earlier: DataFrame) -> DataFrame:
    """(k, duplicate_of) of the rows that fall, by going through each component (root) in order."""
    kind = earlier.schema["k"].dataType.simpleString()
    # a row's place among those of its component: numbers, since the order's structs have any columns
    ends = earlier.select("root", "k", "o").unionByName(earlier.select("root", F.col("j").alias("k"), F.col("p").alias("o"))).distinct()
    number = ends.select("root", "k", (F.row_number().over(Window.partitionBy("root").orderBy("o")) - 1).alias("x"))
    rows = earlier.join(number, ["root", "k"]).join(number.select("root", F.col("k").alias("j"), F.col("x").alias("y")), ["root", "j"])

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["x", "y"])
        fell, out = set(), []
        for k, j, x, y in zip(group["k"], group["j"], group["x"], group["y"]):
            # all earlier rows are decided, and the first kept neighbour counts
            if x not in fell and y not in fell:
                fell.add(x)
                out.append((k, j))
        return pd.DataFrame(out, columns=["k", "duplicate_of"])

    return rows.select("root", "k", "j", "x", "y").groupBy("root").applyInPandas(walk, f"k {kind}, duplicate_of {kind}")


def _rounds(earlier: DataFrame) -> DataFrame:
    """(k, duplicate_of) of the rows that fall, by deciding in each round whatever can be decided."""
    ends = earlier.select("k").unionByName(earlier.select(F.col("j").alias("k"))).distinct()
    # rows without earlier neighbours are kept at once
    kept = cut(ends.join(earlier.select("k").distinct(), "k", "left_anti"), "kept")
    pending = cut(earlier.select("k", "j"), "pending")
    while not pending.isEmpty():
        fell = cut(pending.join(kept.select(F.col("k").alias("j")), "j").select("k").distinct(), "fell")
        left = cut(pending.join(fell, "k", "left_anti").join(fell.select(F.col("k").alias("j")), "j", "left_anti"), "pending")
        fresh = pending.select("k").distinct().join(fell, "k", "left_anti").join(left.select("k").distinct(), "k", "left_anti")
        kept_now = cut(kept.unionByName(fresh), "kept")
        drop(pending, kept, fell)
        kept, pending = kept_now, left
    return earlier.join(kept.select(F.col("k").alias("j")), "j").groupBy("k").agg(F.min_by("j", "p").alias("duplicate_of"))


def equal_texts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b, similarity): each row with the text of an earlier one, linked to the least row of that text, a < b."""
    marked = rows.select(F.col(key).alias("b"), digest(F.col(text)).alias("_text")).filter("_text is not null")
    least = marked.groupBy("_text").agg(F.min("b").alias("a"), F.count("*").alias("_n")).filter("_n > 1")
    return marked.join(least, "_text").filter("a < b").select("a", "b", F.lit(1.0).alias("similarity"))


def _alike(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows (k, term, l) sorted by term, the pairs (k, j) of rows of one term whose product is at least `least`."""
    def of_terms(rows: pa.Table, ends: list[int]) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        lengths, left, right = rows["l"].combine_chunks().flatten().to_numpy().reshape(-1, PARTS), [], []
        for start, end in zip([0, *ends], ends):
            for i0 in range(start, end, PAIR_BLOCK):
                for j0 in range(i0, end, PAIR_BLOCK):
                    i, j = np.nonzero(lengths[i0 : min(end, i0 + PAIR_BLOCK)] @ lengths[j0 : min(end, j0 + PAIR_BLOCK)].T >= least)
                    both = i + i0 < j + j0
                    left.append(i[both] + i0)
                    right.append(j[both] + j0)
        if left:
            # a pair may share many terms
            i, j = np.divmod(np.unique(np.concatenate(left) * len(rows) + np.concatenate(right)), len(rows))
            yield pa.RecordBatch.from_arrays([rows["k"].combine_chunks().take(pa.array(i)), rows["k"].combine_chunks().take(pa.array(j))], ["k", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            # rows of the last term wait for those of the next batch
            if held and held[-1]["term"][-1] == batch["term"][0] and batch["term"][0] == batch["term"][-1]:
                held.append(batch)
                continue
            rows = pa.Table.from_batches([*held, batch])
            code = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
            ends = (np.flatnonzero(code[1:] != code[:-1]) + 1).tolist()
            if ends:
                yield from of_terms(rows.slice(0, ends[-1]), ends)
            held = rows.slice(ends[-1] if ends else 0).to_batches()
        if held:
            yield from of_terms(rows := pa.Table.from_batches(held), [len(rows)])

    return run


def close_vectors(vectors: DataFrame, key: str, least: float) -> DataFrame:
    """(a, b, similarity): pairs of sparse vectors (key, term, value) whose cosine, rounded, is at least `least`, a < b.

    Exact, without comparing all pairs: terms are put in the order of how many vectors have them, rarest first, and of
    each unit vector only the terms are indexed before the rest of it is shorter than the least cosine that rounds to
    `least`. Two vectors that share no indexed term share terms only in the rest of one of them, and their product is
    then below that. Two that share one are a candidate only if the product of their lengths in each of PARTS parts
    of the terms, summed, comes to as much: no product exceeds that. The bounds of all vectors of an indexed term are
    products of matrices, made where the index is sorted, so that what fails them is never a row.
    """
    norm = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(key)))
    unit = cut(vectors.select(F.col(key).alias("k"), "term", (F.col("value") / norm).cast("double").alias("x")).filter("x <> 0"), "vectors")
    df = unit.groupBy("term").agg(F.count("*").alias("df"))
    rare_first = Window.partitionBy("k").orderBy("df", "term")
    rest = F.sum(F.col("x") * F.col("x")).over(rare_first.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    lowest = max(0.0, least - 0.5 * 10**-COSINE_DIGITS)
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS))
    lengths = unit.groupBy("k").agg(*[F.sqrt(F.sum(F.when(part == i, F.col("x") * F.col("x")).otherwise(0.0))).alias(f"l{i}") for i in range(PARTS)])
    # terms that only one vector has join with nothing
    indexed = unit.join(df, "term").withColumn("rest", rest).filter((F.col("rest") >= lowest * lowest - 1e-9) & (F.col("df") > 1)).select("k", "term")
    indexed = indexed.join(lengths.select("k", F.array(*[F.col(f"l{i}").cast("float") for i in range(PARTS)]).alias("l")), "k")
    ship(vectors.sparkSession)
    kind = unit.schema["k"].dataType.simpleString()
    found = indexed.repartition("term").sortWithinPartitions("term").mapInArrow(_alike(lowest - SLACK), f"k {kind}, j {kind}")
    pairs = cut(found.filter("k <> j").select(F.least("k", "j").alias("k"), F.greatest("k", "j").alias("j")).distinct(), "pairs")
    both = pairs.join(unit, "k").join(unit.select(F.col("k").alias("j"), "term", F.col("x").alias("y")), ["j", "term"])
    dot = F.round(F.sum(F.col("x") * F.col("y")), COSINE_DIGITS)
    return both.groupBy(F.col("k").alias("a"), F.col("j").alias("b")).agg(dot.alias("similarity")).filter(F.col("similarity") >= least)
