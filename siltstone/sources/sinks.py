"""Writing tables: whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import digest
from siltstone.runtime import cut, drop, read_file, replace_file


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON lines, nulls kept, as a version under `path`; the file `path`/_CURRENT names the version that counts.

    The version is written whole before _CURRENT is replaced by a rename, so at every moment, and after a crash at any
    moment, `json_lines_folder` gives either the old version or the new one. Older versions are removed afterwards.
    """
    spark = df.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    version = f"v-{uuid.uuid4().hex}"
    df.write.option("ignoreNullFields", "false").json(f"{path}/{version}")
    replace_file(spark, f"{path}/_CURRENT", version)
    fs = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(jpath(path)):
        name = status.getPath().getName()
        if name.startswith("v-") and name != version:
            fs.delete(status.getPath(), True)


def json_lines_folder(spark: SparkSession, path: str) -> str:
    """The folder of the version that counts, to be read as JSON lines."""
    version = read_file(spark, f"{path}/_CURRENT")
    if version is None:
        raise FileNotFoundError(f"{path} has no version")
    return f"{path}/{version}"


def messages_only(examples: DataFrame) -> DataFrame:
    """Only the messages of examples: what training reads."""
    return examples.select("messages")


def export_dataset(examples: DataFrame, splits: DataFrame, folder: str) -> None:
    """Messages of each split there is, provenance with the split of each row, the split of each file, counts by task.

    A file without a split is an error, and nothing is written then.
    """
    lost = examples.join(splits, "file_key", "left_anti").select("file_key").limit(1).collect()
    if lost:
        raise ValueError(f"{lost[0]['file_key']} has no split")
    rows = cut(examples.join(splits, "file_key"), "examples")
    # one row for each split
    for row in splits.select("split").distinct().orderBy("split").collect():
        write_json_lines(messages_only(rows.filter(F.col("split") == row["split"])), f"{folder}/{row['split']}")
    write_json_lines(rows.drop("messages"), f"{folder}/provenance")
    write_json_lines(splits, f"{folder}/split_manifest")
    write_json_lines(rows.groupBy("task", "split").agg(F.count("*").alias("n")), f"{folder}/report")
    drop(rows)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, the columns): rows that one table has more often than the other; none if both hold the same."""
    right = right.select(left.columns)
    only = lambda a, b, name: a.exceptAll(b).select(F.lit(name).alias("side"), "*")
    return only(left, right, "left").unionByName(only(right, left, "right"))


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, content_hash): a digest of a table that does not hang on the order of its rows.

    Row digests are summed in four parts of 64 bits each, before and after one shuffle; no list of rows is made.
    """
    row = digest(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    sums = df.select(row.alias("_r"))
    parts = [F.sum(F.conv(F.substring("_r", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")) for i in range(8)]
    return sums.agg(F.count("*").alias("rows"), digest(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("0")) for p in parts])).alias("content_hash"))
