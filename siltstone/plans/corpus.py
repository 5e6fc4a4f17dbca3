"""Queries over source files: scalar functions, screening, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import screening, text
from siltstone.functions import text as tx
from siltstone.runtime import spread, table

KEY = ["repo", "path", "commit_hash"]


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "chunks").select("id", F.explode(text.tokens(F.col("content"))).alias("token"))
    return found.groupBy("token").agg(F.count("*").alias("n"), F.count_distinct("id").alias("chunks"))


def content_digest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_files").select(*KEY, text.digest(F.col("content")).alias("digest"), text.fingerprint(F.col("content")).alias("fingerprint"), text.caseless_fingerprint(F.col("content")).alias("caseless"))


def text_measures(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.size(text.words(t)).alias("words"), text.estimated_tokens(t).alias("estimated"), F.size(text.sentences(t)).alias("sentences"), F.size(text.tokens(t)).alias("tokens"), F.length(text.without_citations(t)).alias("bare"), text.digest(text.slug(t)).alias("slug")).filter("words is not null")


def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.col("file_key"), F.lit(":dependencies"))
    return table(spark, d, "files").select("file_key").distinct().filter(text.in_sample(name, 30)).select("file_key", F.round(text.hash_share(F.col("file_key")), 9).alias("share"))


def rule_findings(spark: SparkSession, d: str) -> DataFrame:
    counts = spread(table(spark, d, "source_files").select(*KEY, "content")).select(F.explode(screening.rule_counts(F.col("content"))).alias("rule", "n"))
    return counts.filter("n > 0").groupBy("rule").agg(F.sum("n").alias("matches"), F.count("*").alias("files"))


def findings_lines(spark: SparkSession, d: str) -> DataFrame:
    found = screening.findings(spread(table(spark, d, "source_files").select(*KEY, "content")).filter("content is not null"), KEY, "content")
    return found.groupBy(*KEY, "rule").agg(F.count("*").alias("n"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


def screen_files(spark: SparkSession, d: str) -> DataFrame:
    c, p = F.col("content"), F.col("path")
    verdict = (
        F.when(screening.path_excluded(p), "excluded_path")
        .when(screening.language_of(p).isNull(), "other_language")
        .when(F.octet_length(c) > 1_000_000, "oversized")
        .when(F.contains(c, F.lit("\0")), "not_text")
        .when(screening.generated(p, c), "generated")
        .when(~screening.safe(c), "secret")
        .otherwise("accepted")
    )
    return spread(table(spark, d, "source_files").select(*KEY, "content")).filter("content is not null").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def safe_documents(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return spread(table(spark, d, "documents").select("doc_id", "text")).filter("text is not null").select("doc_id", screening.safe(t).alias("safe"), screening.safe_prose(t).alias("safe_prose"))


def path_checks(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return table(spark, d, "chunks").select("path").distinct().select("path", screening.path_excluded(p).alias("excluded"), screening.language_of(p).alias("found_lang"), text.parent(p).alias("folder"))


QUERIES = {f.__name__: f for f in (token_counts, content_digest, text_measures, hash_sample, rule_findings, findings_lines, screen_files, safe_documents, path_checks)}


#: Runs of word characters with one beyond ASCII among them: RE2's borders know ASCII only, so such a run is made one
#: letter that is no word to it. A border within the run, which only RE2 sees, is gone with it.
_WIDE = r"[^\x{00}-\x{7f}\P{L}]|[^\x{00}-\x{7f}\P{N}]"
_KEYS = r"password|passwd|pwd|api[_-]?key|access[_-]?key|secret|token|authorization|client[_-]?secret"


def _re2(pattern: str) -> str:
    """A rule for RE2 in an SQL literal."""
    return tx.respell(pattern, hexadecimal="\\x{{{:02x}}}").replace("'", "''")


def _for_re2(c: str, name: str) -> str:
    """The text in which RE2's ASCII borders are where the rule's are."""
    if name == "credential_literal":
        # the lengths of values count, so only what stands before a key is changed
        return rf"regexp_replace({c}, '({_WIDE})((?i:{_KEYS}))', '\1_\2', 'g')"
    return rf"regexp_replace({c}, '[A-Za-z0-9_]*(?:{_WIDE})(?:[A-Za-z0-9_]|{_WIDE})*', 'é', 'g')" if r"\b" in screening.RULES.get(name, r"\b") else c


_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
_COUNTS = " UNION ALL ".join(f"SELECT repo, path, commit_hash, '{n}' AS rule, len(regexp_extract_all({_for_re2('content', n)}, '{_re2(p)}')) AS n FROM source_files WHERE content IS NOT NULL" for n, p in screening.RULES.items())


def findings_sql(files: str, key: str, text: str = "content") -> str:
    """Rows (key, rule, n, first_line, last_line) of the rules that match: what stands before the first match and behind
    the last begins tells the lines."""
    ends = lambda x: f"(length({x}) - length(replace({x}, chr(10), '')))"
    each = " UNION ALL ".join(f"SELECT {key}, '{n}' AS rule, {_for_re2(text, n)} AS t, regexp_split_to_array({_for_re2(text, n)}, '{_re2(p)}') AS parts, regexp_extract_all({_for_re2(text, n)}, '{_re2(p)}') AS hits FROM {files} WHERE regexp_matches({_for_re2(text, n)}, '{_re2(p)}')" for n, p in screening.RULES.items())
    return f"SELECT {key}, rule, len(hits) AS n, 1 + {ends('parts[1]')} AS first_line, 1 + {ends('t')} - {ends('parts[-1]')} - {ends('hits[-1]')} AS last_line FROM ({each})"


def _any(c: str) -> str:
    return " OR ".join(f"regexp_matches({_for_re2(c, n)}, '{_re2(p)}')" for n, p in screening.RULES.items())


_BLOCKED = ", ".join(f"'{x}'" for x in screening.BLOCKED_DIRECTORIES)
_LANG = "CASE regexp_extract(path, '[^/](\\.[^./]+)$', 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in screening.LANGUAGES.items()) + " END"
_EXCLUDED = f"len(list_filter(string_split(path, '/'), lambda p: p IN ({_BLOCKED}) OR regexp_matches(p, '{screening.BLOCKED_PART}'))) > 0"


def _tokens(c: str) -> str:
    return rf"regexp_extract_all(lower(regexp_replace({c}, '([a-z])([A-Z])', '\1 \2', 'g')), '[a-z][a-z0-9]*')"




def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"



SQL = {
    "token_counts": f"SELECT token, count(*) AS n, count(DISTINCT id) AS chunks FROM (SELECT id, unnest({_tokens('content')}) AS token FROM chunks) GROUP BY token",
    "content_digest": f"SELECT repo, path, commit_hash, sha256(content) AS digest, sha256({_collapse('content')}) AS fingerprint, sha256(replace(lower(content), 'ß', 'ss')) AS caseless FROM source_files",
    "text_measures": f"""
SELECT doc_id, len(list_filter(regexp_split_to_array(text, '{_WS}+'), lambda x: x <> '')) AS words,
  greatest(1, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]')) * 4 // 3) AS estimated,
  len(string_split(regexp_replace(text, '([.!?]){_WS}+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS sentences,
  len({_tokens('text')}) AS tokens,
  length({_collapse(f"regexp_replace(text, '(?i)\\[{_WS}*(?:[0-9]+(?:{_WS}*[,–-]{_WS}*[0-9]+)*|citation needed|edit){_WS}*\\]', '', 'g')")}) AS bare,
  sha256(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug
FROM documents WHERE text IS NOT NULL""",
    "hash_sample": """
SELECT file_key, round(('0x' || sha256(file_key)[1:8])::BIGINT / 4294967296.0, 9) AS share FROM (SELECT DISTINCT file_key FROM files)
WHERE ('0x' || sha256(file_key || ':dependencies')[1:8])::BIGINT % 100 < 30""",
    "rule_findings": f"SELECT rule, sum(n)::BIGINT AS matches, count(*) AS files FROM ({_COUNTS}) WHERE n > 0 GROUP BY rule",
    "findings_lines": f"""
SELECT repo, path, commit_hash, rule, sum(n)::BIGINT AS n, min(first_line) AS first_line, max(last_line) AS last_line
FROM ({findings_sql('source_files', 'repo, path, commit_hash')}) GROUP BY ALL""",
    "screen_files": f"""
SELECT CASE WHEN {_EXCLUDED} THEN 'excluded_path' WHEN {_LANG} IS NULL THEN 'other_language' WHEN strlen(content) > 1000000 THEN 'oversized'
  WHEN contains(content, chr(0)) THEN 'not_text'
  WHEN contains(substring(content, 1, 4096), 'DO NOT EDIT') OR contains(path, '.pb.go') OR contains(path, '.gen.') THEN 'generated'
  WHEN {_any('content')} THEN 'secret' ELSE 'accepted' END AS verdict, count(*) AS n
FROM source_files WHERE content IS NOT NULL GROUP BY 1""",
    "safe_documents": f"""
SELECT doc_id, NOT ({_any('text')}) AS safe, NOT ({_any('text')} OR regexp_matches({_for_re2('text', 'private')}, '{_re2(screening.PRIVATE)}')) AS safe_prose
FROM documents WHERE text IS NOT NULL""",
    "path_checks": f"""
SELECT path, {_EXCLUDED} AS excluded, {_LANG} AS found_lang, coalesce(nullif(regexp_extract(path, '^(.*)/[^/]*$', 1), ''), '.') AS folder
FROM (SELECT DISTINCT path FROM chunks)""",
}
