"""Splits that keep related records together (problem 3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.paths import directory, plain_path, plain_repo
from siltstone.llm.contraction import components
from siltstone.runtime import cut

#: Parts of the hash range in which components are laid out; the layout's starts are one row a part.
PARTS = 1024


def groups(records: DataFrame, record: str, keys: list[str], seed: int = 1) -> DataFrame:
    """(record, group_key): records that share a value of any of `keys` are in one group, directly or over others.

    group_key is the least `record` of the group. Keys of different columns never meet, null keys link nothing, a
    record without any key is its own group, and a record may have several rows. Records with a null `record` are left
    out. The graph has the keys as vertices and an edge where a record bears two of them, so that a key with a third of
    all records is one vertex, not a third of all edges; it is contracted by random mates.
    """
    named = [F.when(F.col(k).isNotNull(), F.concat(F.lit(f"{i}:"), F.col(k).cast("string"))) for i, k in enumerate(keys)]
    own = F.concat(F.lit("r:"), F.col(record).cast("string"))
    borne = records.select(F.col(record).alias("record"), F.array_compact(F.array(*named)).alias("keys")).filter("record is not null").distinct()
    several = borne.groupBy("record").agg(F.count("*").alias("n")).filter("n > 1").select("record")
    # a record with several rows links their keys through a vertex of its own
    borne = cut(borne.join(several.withColumn("more", F.lit(True)), "record", "left").select(F.col("record"), F.when(F.col("more") | (F.size("keys") == 0), F.concat(F.array(F.concat(F.lit("r:"), F.col("record").cast("string"))), F.col("keys"))).otherwise(F.col("keys")).alias("keys")), "borne")
    links = borne.filter("size(keys) > 1").select(F.col("keys")[0].alias("a"), F.explode(F.slice("keys", 2, len(keys))).alias("b")).distinct()
    roots = components(links, "a", "b", "random_mate", seed)
    told = borne.select("record", F.col("keys")[0].alias("v")).distinct().join(roots, "v", "left").select("record", F.coalesce("root", "v").alias("root"))
    told = cut(told.distinct(), "told")
    least = told.groupBy("root").agg(F.min("record").alias("group_key"))
    return told.join(least, "root").select(F.col("record").alias(record), "group_key")


def assign(grouped: DataFrame, group: str, weight: Column, proportions: Mapping[str, float], seed: int = 1) -> DataFrame:
    """(group, split): each group whole in one of the splits, whose weights come near the `proportions`.

    The groups are laid end to end in a random order, each as long as its weight; a group belongs to the split in whose
    share of the whole length its middle lies. A split misses its share by at most half the weight of the groups on its
    borders. The order is by hash parts: starts of the parts are summed over one row a part, and the order within a
    part by its own window, so that no window covers all groups.
    """
    sums = grouped.select(F.col(group).alias("g"), weight.cast("double").alias("w")).filter("g is not null").groupBy("g").agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("w"))
    sums = cut(sums.select("g", "w", F.xxhash64(F.lit(str(seed)), "g").alias("h")).withColumn("part", F.pmod(F.col("h"), F.lit(PARTS))), "weights")
    parts = sums.groupBy("part").agg(F.sum("w").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # at most PARTS rows
    starts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0.0)).alias("start"), F.sum("size").over(whole).alias("all"))
    upto = Window.partitionBy("part").orderBy("h", "g").rowsBetween(Window.unboundedPreceding, 0)
    placed = sums.join(F.broadcast(starts), "part").select("g", F.coalesce((F.col("start") + F.sum("w").over(upto) - F.col("w") / 2) / F.nullif(F.col("all"), F.lit(0.0)), F.lit(0.0)).alias("at"))
    total, edge = float(sum(proportions.values())), 0.0
    names = list(proportions)
    split = None
    for name in names[:-1]:
        edge += proportions[name] / total
        split = F.when(F.col("at") < edge, name) if split is None else split.when(F.col("at") < edge, name)
    return placed.select(F.col("g").alias(group), (F.lit(names[-1]) if split is None else split.otherwise(names[-1])).alias("split"))


def repository_names(repos: DataFrame, seed: int = 1) -> DataFrame:
    """(name, repository): every plain name ever used, and one name for all that were ever names of the same."""
    moved = repos.select(plain_repo(F.col("repo")).alias("name"), plain_repo(F.col("moved_to")).alias("to"))
    links = moved.filter("name is not null")
    return groups(links.select("name", F.col("name").alias("k0"), F.col("to").alias("k1")).select("name", F.explode(F.array_compact(F.array("k0", "k1"))).alias("key")), "name", ["key"], seed).select("name", F.col("group_key").alias("repository"))


def modules(chunks: DataFrame, repos: DataFrame, seed: int = 1) -> DataFrame:
    """(file_key, group_key) of every file of `chunks`: see TESTDATA, p3_found.

    Files are linked by the module as it is spelled and by the module in plain spelling. A file with a null repo and
    path is a group of its own; one with only one of them null counts that as empty.
    """
    files = chunks.select("file_key", "repo", "path").filter("file_key is not null").distinct()
    folder = F.regexp_extract("path", r"^(.*?)[^/\\]*$", 1)
    files = files.select("file_key", plain_repo(F.col("repo")).alias("name"), F.when(F.col("repo").isNotNull() | F.col("path").isNotNull(), F.concat_ws("\u0001", F.coalesce("repo", F.lit("")), F.coalesce(folder, F.lit("")))).alias("spelled"), directory(plain_path(F.coalesce("path", F.lit("")))).alias("dir"))
    named = files.join(repository_names(repos, seed), "name", "left")
    plain = F.when(F.col("spelled").isNotNull(), F.concat_ws("\u0001", F.coalesce("repository", "name", F.lit("")), "dir"))
    return groups(named.select("file_key", "spelled", plain.alias("plain")), "file_key", ["spelled", "plain"], seed)


def module_splits(chunks: DataFrame, repos: DataFrame, proportions: Mapping[str, float] | None = None, seed: int = 1) -> DataFrame:
    """(id, file_key, group_key, split) for every row of `chunks` with an id, each once; weights are distinct ids."""
    shares = proportions or {"train": 0.8, "validation": 0.1, "test": 0.1}
    ids = chunks.select("id", "file_key").filter("id is not null and file_key is not null").distinct()
    told = cut(modules(chunks, repos, seed), "modules")
    # weights by file first: a module with a third of all chunks is then a third of the files, not of the chunks
    sizes = ids.groupBy("file_key").agg(F.count("*").alias("n")).join(told, "file_key")
    splits = assign(sizes, "group_key", F.col("n"), shares, seed)
    return ids.join(told.join(splits, "group_key"), "file_key").select("id", "file_key", "group_key", "split")
