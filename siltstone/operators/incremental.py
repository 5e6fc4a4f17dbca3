"""Processing only new or changed records, by Merkle trees over ranges of key hashes (problem 6).

A state is one row a key with what describes the record (a content hash, a commit). Its tree has a leaf for each range
of the keys' hashes and sixteen children for each inner node; a node's digest covers all keys and descriptions below
it. Two states are compared from the root down, only below nodes whose digests differ; the records of the leaves that
differ are taken from both sides and compared exactly. A run publishes what it made, the new state and its tree in one
step, so that a failed run leaves nothing that the next one would count as done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import Versions, cut, drop

#: Children of an inner node as bits, and records that a leaf is expected to hold.
FAN_BITS, LEAF_RECORDS = 4, 16
MAX_LEVELS = 7


def levels_for(records: int) -> int:
    """Levels below the root for so many records."""
    levels = 1
    while levels < MAX_LEVELS and records > LEAF_RECORDS << (FAN_BITS * levels):
        levels += 1
    return levels


def leaf_of(key: Column, levels: int) -> Column:
    """The leaf of a key: the first bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FAN_BITS * levels)


def tree(state: DataFrame, key: str, described: list[str], levels: int) -> DataFrame:
    """(level, node, records, d1, d2) of every node that has records; level 0 is the root.

    A digest is two independent 64-bit sums (exclusive or) of row hashes with the count, so that it does not depend on
    the order of rows and aggregates before the shuffle. Keys must be unique in `state`.
    """
    each = lambda seed: F.xxhash64(F.lit(seed), F.col(key), *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in described])
    sums = lambda: (F.sum("records").alias("records"), F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"))
    level = state.select(leaf_of(F.col(key), levels).alias("node"), F.lit(1).alias("records"), each(1).alias("d1"), each(2).alias("d2")).groupBy("node").agg(*sums())
    level = cut(level, "leaves")
    out = level.select(F.lit(levels).alias("level"), "*")
    for n in range(levels - 1, -1, -1):
        level = level.withColumn("node", F.shiftrightunsigned("node", FAN_BITS)).groupBy("node").agg(*sums())
        out = out.unionByName(level.select(F.lit(n).alias("level"), "*"))
    return out


def differing_leaves(now: DataFrame, saved: DataFrame, levels: int) -> DataFrame:
    """(node): leaves whose digests differ, found by descending only below nodes that do."""
    open_nodes: DataFrame | None = None
    for n in range(levels + 1):
        a, b = (t.filter(F.col("level") == n).select("node", F.struct("records", "d1", "d2").alias(name)) for t, name in ((now, "a"), (saved, "b")))
        if open_nodes is not None:
            below = open_nodes.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit((1 << FAN_BITS) - 1)), lambda i: F.shiftleft("node", FAN_BITS) + i)).alias("node"))
            a, b = a.join(below, "node", "left_semi"), b.join(below, "node", "left_semi")
        open_nodes = cut(a.join(b, "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node"), "open")
    return open_nodes


def changed_records(current: DataFrame, saved: DataFrame, key: str, described: list[str], levels: int | None = None, saved_tree: DataFrame | None = None, current_tree: DataFrame | None = None) -> DataFrame:
    """Rows (key, now, was) of the leaves that differ: structs of `described`, null where the side has no such key.

    Not every row has changed: it only shares a leaf with one that has. Rows with a null key are left out. A side whose
    tree is given is read in the leaves that differ only; of another, the tree is made from all its rows first.
    """
    current = current.select(key, *described).filter(F.col(key).isNotNull())
    saved = saved.select(key, *described).filter(F.col(key).isNotNull())
    if levels is None:
        levels = levels_for(current.count())
    made = [tree(side, key, described, levels) if given is None else given for side, given in ((current, current_tree), (saved, saved_tree))]
    leaves = differing_leaves(*made, levels)
    take = lambda side, name: side.withColumn("node", leaf_of(F.col(key), levels)).join(leaves, "node", "left_semi").select(key, F.struct(*described).alias(name))
    return take(current, "now").join(take(saved, "was"), key, "full_outer")


# --- files of source_files against the runs' records ---------------------------------------------------------------


def plain_hash(digest: Column) -> Column:
    """A hash in lower case without an algorithm label or blanks."""
    return F.lower(F.regexp_replace(F.trim(digest), r"^[A-Za-z0-9_-]+:\s*", ""))


def newest_files(source_files: DataFrame) -> DataFrame:
    """(file_key, hash, commit_hash) of the newest version of each file; a null hash is made from the content.

    Newest is the latest scanned_at (null ones are oldest), among equal ones the greatest commit and hash. Rows without
    a repo or path are no file. The content is hashed where it is read and does not reach the shuffle.
    """
    digest = F.coalesce(plain_hash(F.col("content_hash")), F.sha2(F.col("content"), 256))
    rows = source_files.select(F.concat("repo", F.lit("/"), "path").alias("file_key"), "scanned_at", F.lower("commit_hash").alias("commit_hash"), digest.alias("hash")).filter("file_key is not null")
    newest = rows.groupBy("file_key").agg(F.max_by(F.struct("hash", "commit_hash"), F.struct("scanned_at", "commit_hash", "hash")).alias("n"))
    return newest.select("file_key", "n.hash", "n.commit_hash")


def recorded_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(file_key, hash, commit_hash) that the latest-started successful run with a hash recorded for each file.

    When the rows were written does not matter; it only decides between rows of one run.
    """
    good = runs.filter("status = 'success'").select("run_id", "started_at").distinct()
    # runs are few beside files, but nothing bounds them: the planner decides by size
    rows = files.filter("file_key is not null and hash is not null").join(good, "run_id")
    newest = rows.groupBy("file_key").agg(F.max_by(F.struct("hash", "commit_hash"), F.struct("started_at", "run_id", "written_at", "hash", "commit_hash")).alias("n"))
    return newest.select("file_key", plain_hash(F.col("n.hash")).alias("hash"), F.lower(F.trim("n.commit_hash")).alias("commit_hash"))


def same_commit(a: Column, b: Column) -> Column:
    """Whether two commits are one: equal, or one of them (not empty) the beginning of the other."""
    a, b = F.nullif(a, F.lit("")), F.nullif(b, F.lit(""))
    return a.eqNullSafe(b) | F.coalesce(F.startswith(a, b) | F.startswith(b, a), F.lit(False))


def file_changes(source_files: DataFrame, files: DataFrame, runs: DataFrame) -> DataFrame:
    """(file_key, change_kind) of every file that is `added`, `changed` or `recommitted`; see TESTDATA, p6_found."""
    rows = changed_records(cut(newest_files(source_files), "now"), cut(recorded_files(files, runs), "was"), "file_key", ["hash", "commit_hash"])
    kind = (
        F.when(F.col("now").isNull(), F.lit(None).cast("string"))
        .when(F.col("was").isNull(), "added")
        .when(~F.col("now.hash").eqNullSafe(F.col("was.hash")), "changed")
        .when(~same_commit(F.col("now.commit_hash"), F.col("was.commit_hash")), "recommitted")
    )
    return rows.select("file_key", kind.alias("change_kind")).filter("change_kind is not null")


# --- a store whose versions appear whole or not at all ---------------------------------------------------------------


class Store(Versions):
    """Output, state and tree under `folder`, in versions that appear whole or not at all.

    A run that dies before it publishes leaves a folder nobody reads, and the next run sees the same changes again: none
    is skipped and none counts twice. Of two runs that began from one version, the second to publish fails.
    """

    def run(self, current: DataFrame, key: str, described: list[str], process: Callable[[DataFrame], DataFrame]) -> str:
        """Process what differs from the saved state and publish it; gives the new version's name.

        `process` gets (key, change_kind) with `added`, `changed` or `removed` and gives the output to keep. The tree
        has levels for the records there are now: when they have become so many that another level is due, the saved
        side's tree is made once more from its state, and saved with that level from then on.
        """
        began = self.current()
        now = cut(current.select(key, *described).filter(F.col(key).isNotNull()), "now")
        levels = levels_for(now.count())
        made = cut(tree(now, key, described, levels), "tree")
        saved = self.read("state") if began else now.limit(0)
        kept = made.limit(0) if not began else self.read("tree") if began["levels"] == levels else None
        rows = changed_records(now, saved, key, described, levels, kept, made)
        kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(~F.col("now").eqNullSafe(F.col("was")), "changed")
        changes = cut(rows.select(key, kind.alias("change_kind")).filter("change_kind is not null"), "changes")
        told = self.publish(began, {"output": process(changes), "state": now, "tree": made}, {"levels": levels})
        drop(now, made, changes)
        return told["version"]
