"""The core's queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators import incremental
from siltstone.plans import building, corpus, datasets, search, structure
from siltstone.runtime import table


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return incremental.file_changes(table(spark, d, "source_files"), table(spark, d, "files"), table(spark, d, "runs"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p6_found": p6_found}
for _plan in (corpus, structure, search, datasets, building):
    QUERIES |= _plan.QUERIES

SQL: dict[str, str] = {
    "p6_found": r"""
WITH now AS (
  SELECT repo || '/' || path AS file_key, arg_max({'h': coalesce(lower(content_hash), sha256(content)), 'c': lower(commit_hash)}, {'a': scanned_at, 'b': commit_hash}) AS n
  FROM source_files GROUP BY 1),
was AS (
  SELECT f.file_key, arg_max({'h': regexp_replace(lower(f.hash), '^sha256:', ''), 'c': lower(f.commit_hash)}, {'a': r.started_at, 'b': f.written_at, 'c': f.hash, 'd': f.commit_hash}) AS w
  FROM files f JOIN runs r ON r.run_id = f.run_id WHERE r.status = 'success' AND f.hash IS NOT NULL GROUP BY 1),
kinds AS (
  SELECT now.file_key, CASE WHEN was.file_key IS NULL THEN 'added' WHEN n.h <> w.h THEN 'changed'
    WHEN NOT (starts_with(n.c, w.c) OR starts_with(w.c, n.c)) THEN 'recommitted' END AS change_kind
  FROM now LEFT JOIN was ON was.file_key = now.file_key)
SELECT file_key, change_kind FROM kinds WHERE change_kind IS NOT NULL""",
}
for _plan in (corpus, structure, search, datasets, building):
    SQL |= _plan.SQL
