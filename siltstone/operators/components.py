"""Connected components by alternating stars (Kiveris et al., "Connected components in MapReduce and beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import digest
from siltstone.runtime import cut, drop

MAX_ROUNDS = 100


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the neighbours of every vertex to the least of them and itself: the larger ones, or the smaller."""
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        ends = ends.filter("b < a")
    least = ends.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = ends.join(least, "a")
    rows = linked.filter("b > a").select("b", "m") if large else linked.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
    return rows.filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(vertex, root): the least vertex of the component of every end of an edge; loops name a vertex of its own.

    Null ends make no edge. A round is two joins by vertex; each is written to the shared folder.
    """
    rows = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null")
    every = rows.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    now = cut(rows.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    mark = lambda df: df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    before = mark(now)
    for _ in range(MAX_ROUNDS):
        after = cut(_stars(cut(_stars(now, True), "stars"), False), "stars")
        drop(now)
        now, told = after, mark(after)
        if told == before:
            break
        before = told
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    return every.join(now.withColumnsRenamed({"a": "vertex", "b": "root"}), "vertex", "left").select("vertex", F.coalesce("root", "vertex").alias("root"))


def shared_key_groups(rows: DataFrame, row_id: str, keys: DataFrame) -> DataFrame:
    """(row_id, root): rows of `keys` (row_id, key) that share a key are in one group, over others too."""
    first = keys.groupBy("key").agg(F.min(row_id).alias("hub"))
    edges = keys.join(first, "key").select(row_id, "hub")
    found = components(edges, row_id, "hub").withColumnRenamed("vertex", row_id)
    return rows.select(row_id).distinct().join(found, row_id, "left").select(row_id, F.coalesce("root", row_id).alias("root"))


def group_digest(grouped: DataFrame, row_id: str, root: str = "root") -> DataFrame:
    """(root, group_id, size): a name for each group that depends on all its members and on nothing else.

    It is a digest of the sums of the members' digests, in eight parts, so that no list of members is made: a group with
    a third of all rows is added up where its rows lie, before the shuffle.
    """
    each = grouped.select(root, digest(F.col(row_id).cast("string")).alias("_d")).distinct()
    parts = [F.sum(F.conv(F.substring("_d", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("string") for i in range(8)]
    return each.groupBy(root).agg(digest(F.concat_ws("|", *parts)).alias("group_id"), F.count("*").alias("size"))
