"""Queries of chunking and of Go declarations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import screening
from siltstone.functions import text as tx
from siltstone.operators import chunking, golang
from siltstone.plans.corpus import _WS, _re2
from siltstone.runtime import table

KEY = ["repo", "path", "commit_hash"]


def sections(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "source_files").filter("content is not null and code_lang <> 'go'").dropDuplicates(KEY)
    return chunking.sections(files, KEY, "content", "code_lang").select(*KEY, "start_line", "end_line", "symbol", tx.digest(F.col("content")).alias("digest"))


def section_runs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").filter("id is not null").select("file_key", "start_line", "id", F.coalesce("symbol_type", F.lit("none")).alias("kind")).distinct()
    ordered = rows.withColumn("position", F.struct("start_line", "id"))
    return chunking.section_runs(ordered, "file_key", "position", "kind", "id").select("file_key", "run", "kind", "blocks")


def token_batches(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null")
    return chunking.token_batches(docs, ["doc_id"], "text", 200, 60).select("doc_id", "part", "estimated_tokens", "size_note", tx.digest(F.col("content")).alias("digest"))


def line_windows(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content")
    return table(spark, d, "chunks").filter("content is not null").select("id", F.size(tx.lines(c)).alias("lines"), tx.digest(tx.line_slice(c, F.lit(2), F.size(tx.lines(c)) - 1)).alias("digest")).distinct()


def go_declarations(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "source_files").filter("content is not null and code_lang = 'go'").dropDuplicates(KEY)
    return golang.go_chunks(files, KEY, "content", "report").select(*KEY, "start_line", "end_line", "symbol", "symbol_type", F.array_join("facts.calls", ",").alias("calls"), F.array_join("facts.constructs", ",").alias("constructs"))


def language_counts(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "source_files")
    return files.groupBy(screening.language_of(F.col("path")).alias("found_lang"), "code_lang").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (sections, section_runs, token_batches, line_windows, go_declarations, language_counts)}

_ENDS = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_SPLIT = f"regexp_split_to_array({{c}}, '{_ENDS}')"


def _lines(c: str) -> str:
    split = f"regexp_split_to_array({c}, '{_ENDS}')"
    return f"CASE WHEN {c} = '' THEN [] WHEN {split}[-1] = '' THEN {split}[1 : len({split}) - 1] ELSE {split} END"


_BOUNDARY = "CASE code_lang " + " ".join(f"WHEN '{k}' THEN regexp_matches(line, '{_re2(p)}')" for k, p in chunking.BOUNDARIES.items()) + " ELSE line = '' END"
_PIECES = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]"


def _n(c: str) -> str:
    return f"len(regexp_extract_all({c}, '{_PIECES}'))"


SQL = {
    "sections": f"""
WITH files AS (SELECT repo, path, commit_hash, any_value(code_lang) AS code_lang, any_value(content) AS content FROM source_files WHERE content IS NOT NULL AND code_lang <> 'go' GROUP BY ALL),
ls AS (SELECT repo, path, commit_hash, code_lang, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT *, {_lines('content')} AS l FROM files)),
sec AS (SELECT *, max(CASE WHEN i = 1 OR {_BOUNDARY} THEN i END) OVER (PARTITION BY repo, path, commit_hash ORDER BY i) AS begin FROM ls),
named AS (SELECT *, first_value(line) OVER (PARTITION BY repo, path, commit_hash, begin ORDER BY i) AS head, (i - begin) // 160 AS win FROM sec),
out AS (SELECT repo, path, commit_hash, min(i) AS start_line, max(i) AS end_line,
  any_value(CASE WHEN regexp_replace(head, '^{_WS}+|{_WS}+$', '', 'g') = '' THEN 'section-' || begin ELSE substring(regexp_replace(head, '^{_WS}+|{_WS}+$', '', 'g'), 1, 100) END) AS symbol,
  string_agg(line, chr(10) ORDER BY i) AS body FROM named GROUP BY repo, path, commit_hash, begin, win)
SELECT repo, path, commit_hash, start_line, end_line, symbol, sha256(body) AS digest FROM out WHERE regexp_replace(body, '{_WS}+', '', 'g') <> ''""",
    "section_runs": """
WITH rows AS (SELECT DISTINCT file_key, start_line, id, coalesce(symbol_type, 'none') AS kind FROM chunks WHERE id IS NOT NULL),
marked AS (SELECT *, CASE WHEN kind IS NOT DISTINCT FROM lag(kind) OVER w THEN 0 ELSE 1 END AS c FROM rows WINDOW w AS (PARTITION BY file_key ORDER BY start_line, id)),
runs AS (SELECT *, sum(c) OVER (PARTITION BY file_key ORDER BY start_line, id)::BIGINT AS run FROM marked)
SELECT file_key, run, kind, count(*) AS blocks FROM runs GROUP BY ALL""",
    "token_batches": f"""
WITH RECURSIVE paras AS (SELECT doc_id, p, i FROM (SELECT doc_id, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '\\n\\n+') AS l FROM documents WHERE text IS NOT NULL)) WHERE regexp_replace(p, '{_WS}+', '', 'g') <> ''),
units AS (SELECT doc_id, s, {_n('s')} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS k FROM (
  SELECT doc_id, i, unnest(l) AS s, generate_subscripts(l, 1) AS j FROM (
    SELECT doc_id, i, CASE WHEN greatest(1, {_n('p')} * 4 // 3) > 200 THEN string_split(regexp_replace(p, '([.!?]){_WS}+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) ELSE [p] END AS l FROM paras))),
fold(doc_id, k, n, part) AS (
  SELECT doc_id, 1::BIGINT, n, 1 FROM units WHERE k = 1
  UNION ALL
  SELECT u.doc_id, u.k, CASE WHEN f.n = 0 OR greatest(1, (f.n + u.n) * 4 // 3) <= 200 THEN f.n + u.n ELSE u.n END, CASE WHEN f.n = 0 OR greatest(1, (f.n + u.n) * 4 // 3) <= 200 THEN f.part ELSE f.part + 1 END
  FROM fold f JOIN units u ON u.doc_id = f.doc_id AND u.k = f.k + 1),
batches AS (SELECT f.doc_id, f.part, sum(u.n)::BIGINT AS n, string_agg(s, chr(10) || chr(10) ORDER BY f.k) AS body FROM fold f JOIN units u ON u.doc_id = f.doc_id AND u.k = f.k GROUP BY ALL)
SELECT doc_id, part, greatest(1, n * 4 // 3) AS estimated_tokens, CASE WHEN greatest(1, n * 4 // 3) > 200 THEN 'oversized' WHEN greatest(1, n * 4 // 3) < 60 THEN 'short' ELSE 'target' END AS size_note, sha256(body) AS digest FROM batches""",
    "line_windows": f"SELECT DISTINCT id, len(l) AS lines, sha256(array_to_string(l[2 : len(l) - 1], chr(10))) AS digest FROM (SELECT id, {_lines('content')} AS l FROM chunks WHERE content IS NOT NULL)",
    "language_counts": "SELECT CASE regexp_extract(path, '[^/](\\.[^./]+)$', 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in screening.LANGUAGES.items()) + " END AS found_lang, code_lang, count(*) AS n FROM source_files GROUP BY ALL",
}
