"""Consolidating pairwise matches into groups (problem 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.contraction import components
from siltstone.runtime import cut

#: What may stand around an id, and before it.
ID_PATTERN = r"^\s*(?:[A-Za-z]+:)?\s*([0-9A-Fa-f]{32})\s*$"


def plain_id(column: str | Column) -> Column:
    """An id as 32 lower-case hex digits, whatever case, label (`chunk:`), dashes or blanks it was written with.

    Null where the text holds no such id (then the end has no id, and its reference counts).
    """
    text = F.regexp_replace(F.col(column) if isinstance(column, str) else column, "-", "")
    return F.lower(F.nullif(F.regexp_extract(text, ID_PATTERN, 1), F.lit("")))


def references(chunks: DataFrame) -> DataFrame:
    """(reference, id): `repo/path:start_line-end_line` of every chunk that has all four; the least id if several."""
    ref = F.concat("repo", F.lit("/"), "path", F.lit(":"), F.col("start_line").cast("string"), F.lit("-"), F.col("end_line").cast("string"))
    return chunks.select(ref.alias("reference"), plain_id("id").alias("id")).filter("reference is not null and id is not null").groupBy("reference").agg(F.min("id").alias("id"))


def resolve(matches: DataFrame, chunks: DataFrame) -> DataFrame:
    """(a, b): the ids of both ends of each usable row of `matches`, each pair once.

    An end is named by its id, or without one by a reference that a chunk has; a row with an end that neither names is
    left out. Only the rows that need a reference are joined with the references, so that a null id is no hot key.
    """
    ends = matches.select(
        plain_id("left_id").alias("a"), plain_id("right_id").alias("b"), F.col("left_reference").alias("ra"), F.col("right_reference").alias("rb")
    ).filter("(a is not null or ra is not null) and (b is not null or rb is not null)")
    ends = cut(ends.select("a", "b", F.when(F.col("a").isNull(), F.col("ra")).alias("ra"), F.when(F.col("b").isNull(), F.col("rb")).alias("rb")).distinct(), "ends")
    wanted = ends.select(F.explode(F.array("ra", "rb")).alias("reference")).filter("reference is not null").distinct()
    known = cut(references(chunks).join(wanted, "reference", "left_semi"), "references")
    named = ends.filter("ra is null and rb is null").select("a", "b")
    asked = (
        ends.filter("ra is not null or rb is not null")
        .join(known.select(F.col("reference").alias("ra"), F.col("id").alias("ia")), "ra", "left")
        .join(known.select(F.col("reference").alias("rb"), F.col("id").alias("ib")), "rb", "left")
        .select(F.coalesce("a", "ia").alias("a"), F.coalesce("b", "ib").alias("b"))
        .filter("a is not null and b is not null")
    )
    return named.unionByName(asked).distinct()


def consolidate(pairs: DataFrame, left: str = "a", right: str = "b", seed: int = 1) -> DataFrame:
    """(id, group_id): one row for every id of `pairs`, group_id the least id linked to it, directly or not.

    An id that is paired only with itself is its own group. Rows with a null end are ignored; repeated rows, either
    direction and further columns change nothing; an empty table gives an empty result. Contraction by fresh hash
    order: see `siltstone.llm.contraction`.
    """
    pairs = cut(pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null").distinct(), "pairs")
    roots = cut(components(pairs, "a", "b", "hash_order", seed), "roots")
    least = roots.groupBy("root").agg(F.min("v").alias("group_id"))
    linked = roots.join(least, "root").select(F.col("v").alias("id"), "group_id")
    # ids without an edge to another id
    alone = pairs.filter("a = b").select(F.col("a").alias("id")).distinct().join(roots.select(F.col("v").alias("id")), "id", "left_anti")
    return linked.unionByName(alone.select("id", F.col("id").alias("group_id")))


def match_groups(matches: DataFrame, chunks: DataFrame, seed: int = 1) -> DataFrame:
    """(id, group_id) of the ids that usable rows of `matches` name; ids are 16 bytes while they are linked."""
    pairs = resolve(matches, chunks).select(F.unhex("a").alias("a"), F.unhex("b").alias("b"))
    out = consolidate(pairs, seed=seed)
    return out.select(*(F.lower(F.hex(c)).alias(c) for c in ("id", "group_id")))
