"""Reading corpora: folders of files, Git repositories, JSON lines, catalogs, settings."""

from __future__ import annotations

import os
import subprocess
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from siltstone.functions import screening
from siltstone.functions import text as tx
from siltstone.runtime import ship

MOST_BYTES, GIT_SECONDS, SUBJECTS = 1_000_000, 30, 5
#: How often a page is asked for, and its bytes at most.
ATTEMPTS, MOST_PAGE_BYTES = 3, 8_000_000


@dataclass(frozen=True)
class Settings:
    """What a run needs to know; `from_env` reads SILTSTONE_* variables."""

    workspace: str = "."
    store: str = "store"
    most_bytes: int = MOST_BYTES
    blame: bool = False

    @classmethod
    def from_env(cls) -> Settings:
        env = os.environ.get
        return cls(env("SILTSTONE_WORKSPACE", "."), env("SILTSTONE_STORE", "store"), int(env("SILTSTONE_MOST_BYTES", str(MOST_BYTES))), flag("SILTSTONE_BLAME"))


def flag(name: str, default: str = "false") -> bool:
    """A variable that is true, false, 1 or 0; anything else is refused."""
    value = os.environ.get(name, default).lower()
    if value not in ("true", "false", "1", "0"):
        raise ValueError(f"{name} must be true, false, 1 or 0")
    return value in ("true", "1")


def discover(workspace: str) -> list[str]:
    """The repositories that are folders of `workspace`: no links, with a `.git`; sorted."""
    with os.scandir(workspace) as entries:
        return sorted(e.path for e in entries if e.is_dir(follow_symlinks=False) and os.path.exists(os.path.join(e.path, ".git")))


def git(repository: str, *args: str) -> str:
    """What a Git command says; it may take GIT_SECONDS."""
    done = subprocess.run(["git", "-C", repository, *args], capture_output=True, timeout=GIT_SECONDS, check=True)
    return done.stdout.decode("utf-8", "replace")


def repository_state(spark: SparkSession, repository: str) -> DataFrame:
    """(repo, commit_hash, commit_messages) of a repository's head: its last subjects without unsafe ones."""
    head = git(repository, "rev-parse", "HEAD").strip()
    subjects = git(repository, "log", f"-{SUBJECTS}", "--format=%s").splitlines()
    rows = spark.createDataFrame([(os.path.basename(repository), head, subjects)], "repo string, commit_hash string, commit_messages array<string>")
    return rows.withColumn("commit_messages", F.filter("commit_messages", screening.safe))


def listed_files(repository: str) -> list[str]:
    """The paths that Git tracks or would, sorted, each once."""
    return sorted({p for p in git(repository, "ls-files", "-z", "--cached", "--others", "--exclude-standard").split("\0") if p})


def is_link(root: str, path: str) -> bool:
    """Whether a path below `root` is a symbolic link or goes through one."""
    at = root
    for part in path.split("/"):
        at = os.path.join(at, part)
        if os.path.islink(at):
            return True
    return False


def blame(repository: str, path: str) -> list[tuple[str, int]]:
    """(commit, line) of every line of a file; who wrote it is not kept."""
    out = []
    for line in git(repository, "blame", "--line-porcelain", "HEAD", "--", path).splitlines():
        parts = line.split(" ")
        if len(parts) >= 3 and len(parts[0]) == 40 and all(c in "0123456789abcdef" for c in parts[0]) and parts[2].isdigit():
            out.append((parts[0], int(parts[2])))
    return out


def with_blame(accepted: DataFrame, repository: str) -> DataFrame:
    """Accepted files of one repository with `blame`: (commit_hash, line_no) of every line, null where Git knows none.

    Git runs where the rows are, so the repository must lie in a folder that all executors see.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("blame", T.ArrayType(T.StructType([T.StructField("commit_hash", T.StringType()), T.StructField("line_no", T.IntegerType())])))])
    ship(accepted.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = []
            for path in batch["path"]:
                try:
                    told.append([{"commit_hash": c, "line_no": n} for c, n in blame(repository, path)])
                except subprocess.CalledProcessError:
                    told.append(None)
            yield pd.DataFrame({"path": batch["path"], "blame": told})

    return accepted.join(accepted.select("path").distinct().mapInPandas(run, schema), "path")


def read_folder(spark: SparkSession, folder: str, repo: str, pattern: str = "*") -> DataFrame:
    """(repo, path, length, bytes) of all files below a folder of any file system, in parallel."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    # the same file system may be spelled with or without empty slashes
    tail = lambda s: s.split(":", 1)[-1].lstrip("/")
    bare = F.regexp_replace("path", "^[a-z0-9]+:/*", "")
    path = F.expr(f"substring(bare, {len(tail(root)) + 2})")
    return files.withColumn("bare", bare).select(F.lit(repo).alias("repo"), path.alias("path"), "length", F.col("content").alias("bytes"))


def scan(files: DataFrame, most_bytes: int = MOST_BYTES, links: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, report) of files (repo, path, length, bytes).

    Accepted rows have (repo, path, code_lang, content_hash, content). The report has (repo, path, rule, line) of what
    was refused and why: `excluded_path`, `symlink` (those of `links`: repo, path), `oversized`, or each finding of the
    screening. Files of other languages, generated ones and what is no text are left out without a report. The cheap
    checks come first, and the length is read before the bytes.
    """
    content = F.col("bytes").cast("string")
    excluded = screening.path_excluded(F.col("path"))
    if links is None:
        files = files.withColumn("linked", F.lit(False))
    else:
        files = files.join(links.select("repo", "path", F.lit(True).alias("linked")).distinct(), ["repo", "path"], "left").withColumn("linked", F.coalesce("linked", F.lit(False)))
    lang = screening.language_of(F.col("path"))
    large = F.col("length") > most_bytes
    early = files.select("repo", "path", F.when(excluded, "excluded_path").when(lang.isNull(), None).when(F.col("linked"), "symlink").when(large, "oversized").alias("rule"), F.lit(None).cast("int").alias("line")).filter("rule is not null")
    good = files.filter(~excluded & lang.isNotNull() & ~F.col("linked") & ~large & F.is_valid_utf8(content) & ~F.contains(content, F.lit("\0")) & ~screening.generated(F.col("path"), content))
    good = good.select("repo", "path", lang.alias("code_lang"), tx.digest(content).alias("content_hash"), content.alias("content"))
    unsafe = screening.findings(good, ["repo", "path"], "content")
    accepted = good.filter(screening.safe(F.col("content")))
    return accepted, early.unionByName(unsafe.withColumn("line", F.col("line").cast("int")))


def links_of(spark: SparkSession, repository: str) -> DataFrame:
    """(repo, path) of the listed files that are symbolic links or lie behind one."""
    name = os.path.basename(repository.rstrip("/"))
    return spark.createDataFrame([(name, p) for p in listed_files(repository) if is_link(repository, p)], "repo string, path string")


def scan_repository(spark: SparkSession, repository: str, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(accepted, report) of the files that Git lists in a repository; accepted ones with the head's commit."""
    name = os.path.basename(repository.rstrip("/"))
    listed = spark.createDataFrame([(p,) for p in listed_files(repository)], "path string")
    files = read_folder(spark, repository, name).join(listed, "path", "left_semi")
    accepted, report = scan(files, most_bytes, links_of(spark, repository))
    head = git(repository, "rev-parse", "HEAD").strip()
    return accepted.withColumn("commit_hash", F.lit(head)), report


def first_files(accepted: DataFrame, limit: int) -> DataFrame:
    """The first `limit` files by repository and path."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return accepted.orderBy("repo", "path").limit(limit)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON-lines table; blank lines are skipped, anything malformed raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


CATALOG = "title string, url string, category string, priority string, family string, tags array<string>, license struct<name:string,url:string>, description string"


def catalog_errors(catalog: DataFrame, host: str, categories: list[str], priorities: list[str]) -> DataFrame:
    """(title, errors) of catalog rows: what is missing, malformed, unknown or repeated; none an empty list."""
    blank = lambda c: tx.collapse(F.coalesce(c, F.lit(""))) == ""
    when = lambda condition, name: F.when(F.coalesce(condition, F.lit(True)), name)
    need = F.lit(False)
    for c in ("title", "url", "category", "priority", "family", "description"):
        need = need | blank(F.col(c))
    part = lambda name: F.try_parse_url("url", F.lit(name))
    good_url = (part("PROTOCOL") == "https") & (part("HOST") == host) & F.startswith(part("PATH"), F.lit("/wiki/")) & part("QUERY").isNull() & part("REF").isNull()
    slugs = catalog.groupBy(tx.slug(F.col("title")).alias("slug")).agg(F.count("*").alias("same"))
    rows = catalog.withColumn("slug", tx.slug(F.col("title"))).join(slugs, "slug", "left")
    errors = F.array_compact(
        F.array(
            when(need, "missing_field"),
            when(~good_url, "bad_url"),
            when(tx.page_title(F.col("url")) != F.col("title"), "title_mismatch"),
            when(~F.col("category").isin(categories), "unknown_category"),
            when(~F.col("priority").isin(priorities), "unknown_priority"),
            when(~F.startswith("license.url", F.lit("https://")) | F.col("tags").isNull(), "bad_license_or_tags"),
            when(F.col("same") > 1, "repeated_slug"),
        )
    )
    return rows.select("title", "priority", errors.alias("errors"))


def select_sources(catalog: DataFrame, titles: list[str] | None = None, priority: str | None = None) -> DataFrame:
    """The catalog rows asked for: by exact titles, unknown ones raise; by priority; else all. By priority and title."""
    out = catalog
    if titles:
        out = out.filter(F.col("title").isin(titles))
        unknown = set(titles) - {r["title"] for r in out.select("title").distinct().collect()}
        if unknown:
            raise ValueError(f"unknown titles: {', '.join(sorted(unknown))}")
    elif priority:
        out = out.filter(F.col("priority") == priority)
    return out.orderBy("priority", "title")


def fetch_status(catalog: DataFrame, pages: DataFrame) -> DataFrame:
    """(title, status) of each source: `cached` if a page for just this address is there whole, by its hash; `damaged`
    if only pages that differ from their hash are; else `failed`."""
    whole = F.coalesce(tx.digest(F.col("html")) == F.col("html_hash"), F.lit(False))
    have = pages.groupBy(F.col("title").alias("_title"), F.col("requested_url").alias("_url")).agg(F.max(whole).alias("_whole"))
    status = F.when(F.col("_whole"), "cached").when(F.col("_whole").isNotNull(), "damaged").otherwise("failed")
    return catalog.join(have, (F.col("title") == F.col("_title")) & (F.col("url") == F.col("_url")), "left").select("title", status.alias("status"))


def status_counts(statuses: DataFrame) -> DataFrame:
    """(sources, cached, damaged, failed): how many sources there are, and of which status."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("cached", "damaged", "failed")]
    return statuses.agg(F.count("*").alias("sources"), *counts)


def fetch(url: str, opener: Callable[[str], tuple[int, dict[str, str], bytes]], most_bytes: int = MOST_PAGE_BYTES, wait: Callable[[float], None] = time.sleep) -> str:
    """The text at an address, by an `opener` that gives (status, headers, body): ATTEMPTS times at most.

    Statuses 429 and from 500 on are tried again, after what Retry-After says, up to 30 seconds, or twice as long each
    time. Another status, a body over `most_bytes` and one that is not UTF-8 are errors.
    """
    for attempt in range(ATTEMPTS):
        status, headers, body = opener(url)
        if status == 200:
            if len(body) > most_bytes:
                raise ValueError(f"{url} has more than {most_bytes} bytes")
            return body.decode("utf-8")
        if status != 429 and status < 500 or attempt == ATTEMPTS - 1:
            break
        after = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
        wait(min(30.0, float(after)) if after.isdigit() else float(2**attempt))
    raise OSError(f"{url} gave status {status}")
