"""What every plan needs from the session: tables, durable intermediate tables, and this package on the executors."""

from __future__ import annotations

import atexit
import json
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Settings a session of this engine starts with; a session that exists keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with this engine's defaults."""
    spark = SparkSession.builder.master(master).config(map=DEFAULTS | conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table `name` of `directory`, lazily."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan over as many tasks as there are cores, if it would have fewer; for costly work on few files.

    A table of many files is left as it is: nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; only where that is unset, a folder of this machine.

    The fallback serves local sessions only: on a cluster it raises instead of using a machine-local folder.
    """
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"siltstone-{os.getuid()}-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    atexit.register(shutil.rmtree, folder, True)
    return f"file://{folder}"


#: Folders that `cut` has written and that are still there.
_written: set[str] = set()


def _sweep() -> None:
    """Delete what is left of this process's intermediate tables."""
    jvm = SparkContext._jvm
    for path in list(_written):
        try:
            if path.startswith("file:") or "://" not in path:
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), True)
            elif jvm is not None:
                jpath = jvm.org.apache.hadoop.fs.Path(path)
                jpath.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(jpath, True)
        except Exception:  # noqa: BLE001, S110 - the machine that holds them may be gone already
            pass
    _written.clear()


def cut(df: DataFrame, label: str = "t") -> DataFrame:
    """`df` written once to the shared folder and read back: no lineage to recompute, and true sizes for the planner.

    Survives the loss of executors, unlike cached or locally checkpointed data. It lasts until it is dropped, or until
    the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/siltstone/{label}-{uuid.uuid4().hex}"
    # by now the gateway is there, whose own end is then after this
    atexit.unregister(_sweep)
    atexit.register(_sweep)
    _written.add(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables made by `cut` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if "/siltstone/" in str(path):
                _written.difference_update([w for w in _written if w.rsplit("/", 1)[-1] == path.getName()])
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, group: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """`df` with the number of each row in its `group`, from 1, by `order`; without groups, in all of `df`.

    A window would put each group into one task, however large it is. Here rows are sorted over all tasks and numbered
    in each; what the tasks before hold of a group is added from a table of one row for each task and group in it.
    """
    rows = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = cut(rows.withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    held = rows.groupBy(*group, "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(*group, "_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    named = held.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_task").alias("_t"), "_first", "_before")
    same = F.col("_task") == F.col("_t")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(named, same).select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_siltstone_shipped", False):
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="siltstone-"), "siltstone.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("siltstone", p.relative_to(root)))
    sc.addPyFile(str(out))
    sc._siltstone_shipped = True
    atexit.register(shutil.rmtree, out.parent, True)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: written beside it under another name, then renamed over it."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    target, staged = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, read by the driver; None if there is no such file."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file only if there is none of its name; whether it was written. Of several writers, one succeeds.

    The file appears whole: it is written beside under another name first, then linked or renamed to its own.
    """
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if fs.getUri().getScheme() == "file":
        # a rename would replace the other's file here
        name = target.toUri().getPath()
        staged = f"{name}.{uuid.uuid4().hex}"
        Path(staged).write_text(text)
        try:
            os.link(staged, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(staged)
        return True
    staged = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    context = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)
    except Exception:  # noqa: BLE001
        fs.delete(staged, False)
        if fs.exists(target):
            return False
        raise
    return True


class Versions:
    """Versions of tables under `folder`. The one that counts is the last of the numbered files in `folder`/commits.

    A version is written to a folder of its own name first and counts from the moment when the next number's file is
    there. That file is created only if nobody else has created it, so of two writers that began from the same version
    one fails, and nothing it wrote counts. The version before stays for those who read it; older ones are removed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> dict | None:
        """What was published last, or None before the first."""
        commits = self._jpath(f"{self.folder}/commits")
        if not self._fs.exists(commits):
            return None
        names = [f.getPath().getName() for f in self._fs.listStatus(commits)]
        numbers = [n for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return None
        return json.loads(read_file(self.spark, f"{self.folder}/commits/{max(numbers)}"))

    def read(self, part: str) -> DataFrame:
        """A table of the version that counts."""
        return self.spark.read.parquet(f"{self.folder}/{self.current()['version']}/{part}")

    def publish(self, began: dict | None, parts: dict[str, DataFrame], told: dict) -> dict:
        """Write `parts` as the version after `began` and make it count; raises if another has come before."""
        number, version = (began["number"] if began else 0) + 1, f"v-{uuid.uuid4().hex}"
        for name, df in parts.items():
            df.write.parquet(f"{self.folder}/{version}/{name}")
        now = told | {"number": number, "version": version, "before": began["version"] if began else None}
        if not create_file(self.spark, f"{self.folder}/commits/{number:010}.json", json.dumps(now)):
            self._fs.delete(self._jpath(f"{self.folder}/{version}"), True)
            raise RuntimeError("another run has published since this one began")
        if began and began["before"]:
            self._fs.delete(self._jpath(f"{self.folder}/{began['before']}"), True)
        return now
