"""Queries of the training-data operators, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, credentials, keep_together, matches, near_duplicates, packing, pieces, subjects
from siltstone.runtime import cut, spread, table


def files(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table whose texts are costly to read: see `spread`."""
    return spread(table(spark, d, name))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.chunk_near_duplicates(files(spark, d, "chunks")).pairs()


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.chunk_near_duplicates(files(spark, d, "chunks")).groups()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_pieces(spark, d).select("id").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_oversized(table(spark, d, "chunks"), "id", "content", "start_line", overlap=8)


def p2_limits(spark: SparkSession, d: str) -> DataFrame:
    """Of each oversized chunk, whether its pieces keep the limits, and the lines that they cover."""
    found = p2_pieces(spark, d)
    within = (pieces.line_count(F.col("content")) <= pieces.MAX_LINES) & (F.length("content") <= pieces.MAX_CHARS)
    return found.groupBy("id").agg(F.min(within).alias("within"), F.min("start_line").alias("first_line"), F.max("end_line").alias("last_line"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return keep_together.modules(table(spark, d, "chunks"), table(spark, d, "repos"))


def p3_split(spark: SparkSession, d: str) -> DataFrame:
    return keep_together.module_splits(table(spark, d, "chunks"), table(spark, d, "repos"))


def p3_whole(spark: SparkSession, d: str) -> DataFrame:
    """Of each module, how many splits its chunks are in."""
    return p3_split(spark, d).groupBy("group_key").agg(F.count_distinct("split").alias("splits"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return matches.match_groups(table(spark, d, "chunk_matches"), table(spark, d, "chunks"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return credentials.find_secrets(files(spark, d, "source_files"))


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return credentials.redact_secrets(files(spark, d, "source_files"))


def p5_lines(spark: SparkSession, d: str) -> DataFrame:
    """How many lines and messages each redacted version has."""
    return p5_redacted(spark, d).select("repo", "path", "commit_hash", pieces.line_count(F.col("content")).alias("lines"), F.size("commit_messages").alias("messages"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.token_ids(files(spark, d, "documents"), "doc_id")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    counts = bpe.token_counts(files(spark, d, "documents"), "doc_id")
    return packing.pack(counts, "doc_id", "tokens", 2048)


def p8_whole(spark: SparkSession, d: str) -> DataFrame:
    """Of each document, whether its containers hold no more than they may, and its parts all of its tokens."""
    counts = cut(bpe.token_counts(files(spark, d, "documents"), "doc_id"), "counts")
    packed = cut(packing.pack(counts, "doc_id", "tokens", 2048), "packed")
    fill = packed.groupBy("container").agg((F.sum("tokens") <= 2048).alias("fits"))
    told = packed.join(fill, "container").groupBy("doc_id").agg(F.min("fits").alias("fits"), F.sum("tokens").alias("n"))
    return counts.join(told, "doc_id", "left").select("doc_id", "fits", F.col("n").eqNullSafe(F.col("tokens")).alias("whole"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_subjects(spark, d).select("doc_id", "subject").distinct()


def p9_subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(files(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_pieces, p2_limits, p3_found, p3_split, p3_whole, p4_found, p5_found, p5_redacted, p5_lines, p7_ids, p8_containers, p8_whole, p9_found, p9_subjects)}

_LINES = r"len(regexp_extract_all(content, '\r\n|\r|\n')) + CASE WHEN content = '' OR content[-1] IN (chr(10), chr(13)) THEN 0 ELSE 1 END"

SQL: dict[str, str] = {
    "p2_limits": f"SELECT id, true AS within, min(coalesce(start_line, 1)) AS first_line, max(coalesce(start_line, 1) + n - 1)::INT AS last_line FROM (SELECT *, {_LINES} AS n FROM chunks) WHERE n > 160 OR length(content) > 8000 GROUP BY id",
    "p5_lines": f"SELECT repo, path, commit_hash, {_LINES} AS lines, len(commit_messages) AS messages FROM source_files",
    "p8_whole": "SELECT doc_id, true AS fits, true AS whole FROM documents",
    "p2_found": r"""
SELECT DISTINCT id FROM (
  SELECT id, content, len(regexp_extract_all(content, '\r\n|\r|\n')) + CASE WHEN content = '' OR content[-1] IN (chr(10), chr(13)) THEN 0 ELSE 1 END AS lines FROM chunks)
WHERE lines > 160 OR length(content) > 8000""",
    "p3_found": r"""
WITH RECURSIVE names(name, now) AS (
  SELECT repo, repo FROM repos UNION SELECT n.name, r.moved_to FROM names n JOIN repos r ON r.repo = n.now WHERE r.moved_to IS NOT NULL),
last AS (SELECT n.name, n.now FROM names n JOIN repos r ON r.repo = n.now WHERE r.moved_to IS NULL),
files AS (SELECT DISTINCT file_key, replace(regexp_extract(regexp_replace(regexp_replace(lower(repo), '^[\s/]+|[\s/]+$', '', 'g'), '\.git$', ''), '([^/:]*)$', 1), '_', '-') AS name,
  list_filter(string_split(replace(trim(path), '\', '/'), '/'), lambda x: x <> '' AND x <> '.') AS parts FROM chunks),
up(file_key, name, parts) AS (
  SELECT * FROM files UNION ALL
  SELECT file_key, name, list_concat(parts[1 : list_position(parts, '..') - 2], parts[list_position(parts, '..') + 1 :]) FROM up WHERE list_contains(parts, '..')),
modules AS (SELECT u.file_key, coalesce(l.now, u.name) AS repo, array_to_string(u.parts[1 : len(u.parts) - 1], '/') AS dir FROM up u LEFT JOIN last l ON l.name = u.name WHERE NOT list_contains(u.parts, '..'))
SELECT file_key, min(file_key) OVER (PARTITION BY repo, dir) AS group_key FROM modules""",
    "p4_found": r"""
WITH RECURSIVE known AS (
  SELECT repo || '/' || path || ':' || start_line || '-' || end_line AS ref, min(id) AS id FROM chunks GROUP BY 1),
ends AS (SELECT regexp_extract(lower(trim(left_id, E' \t\n\r')), '^(?:[a-z]+:)?([0-9a-f]{32})$', 1) AS a, regexp_extract(lower(trim(right_id, E' \t\n\r')), '^(?:[a-z]+:)?([0-9a-f]{32})$', 1) AS b, left_reference AS ra, right_reference AS rb FROM chunk_matches),
pairs AS MATERIALIZED (
  SELECT DISTINCT * FROM (SELECT coalesce(nullif(a, ''), x.id) AS a, coalesce(nullif(b, ''), y.id) AS b FROM ends LEFT JOIN known x ON x.ref = ra LEFT JOIN known y ON y.ref = rb)
  WHERE a IS NOT NULL AND b IS NOT NULL),
edges AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
cc(id, group_id) USING KEY (id) AS (
  SELECT a, min(b) FROM (SELECT a, b FROM edges UNION SELECT a, a FROM edges) GROUP BY a
  UNION
  SELECT n.id, min(l.group_id) FROM cc l JOIN edges e ON l.id = e.a JOIN recurring.cc n ON n.id = e.b WHERE l.group_id < n.group_id GROUP BY n.id)
SELECT id, group_id FROM cc""",
}
SQL["p3_whole"] = SQL["p3_found"].replace("SELECT file_key, min(file_key) OVER (PARTITION BY repo, dir) AS group_key FROM modules", "SELECT min(file_key) AS group_key, 1::BIGINT AS splits FROM modules GROUP BY repo, dir")
