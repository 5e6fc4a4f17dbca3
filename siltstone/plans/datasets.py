"""Queries of deduplication, splits, examples, review, evaluation, knowledge and state, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions import screening
from siltstone.functions import text as tx
from siltstone.functions.paths import plain_repo
from siltstone.operators import components, dedup, evaluation, examples, incremental, knowledge, retrieval, splits
from siltstone.plans.corpus import _WS, _any, _for_re2, _re2, _tokens
from siltstone.runtime import table
from siltstone.sources import sinks
from siltstone.streaming import events as windows
from siltstone.streaming import index

# --- deduplication and splits ----------------------------------------------------------------------------------------


def exact_dedup_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null")
    return dedup.exact(docs, "text", ["doc_id"]).select("doc_id")


def semantic_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    vectors = retrieval.tf_idf(docs, "doc_id", "text")
    links = dedup.close_vectors(vectors, "doc_id", 0.92).unionByName(dedup.equal_texts(docs, "doc_id", "text"))
    return dedup.greedy(docs, "doc_id", ["doc_id"], links)


def close_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    vectors = retrieval.tf_idf(docs, "doc_id", "text")
    return dedup.close_vectors(vectors, "doc_id", 0.92)


def module_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.module_split(table(spark, d, "source_files"), table(spark, d, "chunks"))


def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("text is not null").select(tx.fingerprint(F.col("text")).alias("fp"), F.when(tx.hash_share(F.col("doc_id").cast("string")) < 0.15, "validation").otherwise("train").alias("split"))
    return splits.leakage(rows, "fp", "split")


def shared_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").select("id", "file_key", F.when(F.length("content") >= 100, tx.fingerprint(F.col("content"))).alias("fp")).filter("id is not null")
    keys = rows.select("id", F.explode(F.array_compact(F.array(F.concat(F.lit("file:"), "file_key"), F.concat(F.lit("text:"), "fp")))).alias("key")).distinct()
    grouped = components.shared_key_groups(rows, "id", keys)
    return components.group_digest(grouped, "id").select("root", "group_id", "size")


def greedy_group_split(spark: SparkSession, d: str) -> DataFrame:
    name = F.coalesce(plain_repo(F.col("repo")), F.lit(""))
    team = F.coalesce(F.nullif(F.regexp_extract(name, "([a-z]+)-[a-z]+", 1), F.lit("")), name)
    sizes = table(spark, d, "source_files").groupBy(team.alias("team")).agg(F.count("*").alias("n"))
    return splits.greedy_split(sizes, "team", "n")


def ratio_cap(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.when(tx.hash_share(F.col("doc_id").cast("string")) < 0.2, "validation").otherwise("train").alias("split"), F.col("repo").isNotNull().alias("linked"))
    return splits.ratio_cap(rows, "doc_id", "split", "linked", 0.6)


def split_ratios(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.coalesce("lang", F.lit("none")).alias("split"), F.col("repo").isNotNull().alias("linked"))
    return evaluation.split_ratios(rows, "split", "linked")


# --- examples and review ---------------------------------------------------------------------------------------------


def _unique_chunks(spark: SparkSession, d: str) -> DataFrame:
    """One row a chunk id: of its rows the one with the greatest commit, with a content where any has."""
    rows = table(spark, d, "chunks").filter("id is not null")
    return dedup.first_by(rows.withColumn("_c", F.col("content").isNull()), ["id"], ["_c", "commit_hash", "end_line", "symbol"]).drop("_c")


def example_rows(spark: SparkSession, d: str) -> DataFrame:
    found = examples.examples(_unique_chunks(spark, d))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return found.select("id", "task", "reference", tx.digest(said).alias("digest"))


def task_counts(spark: SparkSession, d: str) -> DataFrame:
    return examples.examples(_unique_chunks(spark, d)).groupBy("task").agg(F.count("*").alias("n"))


def context_packing(spark: SparkSession, d: str) -> DataFrame:
    packed = examples.pack_context(table(spark, d, "chunks"), 4000)
    return packed.select("id", F.array_join("context_ids", ",").alias("context"), "used")


def task_cycle(spark: SparkSession, d: str) -> DataFrame:
    return examples.task_cycle(table(spark, d, "chunks"), "id", ["explain", "test", "review", "document"], 250)


def per_file_questions(spark: SparkSession, d: str) -> DataFrame:
    return examples.per_file_questions(table(spark, d, "chunks"), 30)


def claim_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunk_matches")
    share = F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0)
    n = F.pmod("match_id", F.lit(4)).cast("int")
    answers = rows.select(F.col("matcher").alias("variant"), F.when(n > 0, "desk").alias("reviewer"), n.alias("supported"), F.when(n > 1, 1).otherwise(0).alias("unsupported"), F.when(n == 2, 1).otherwise(0).alias("contradicted"), share.alias("location_accuracy"), F.round("score", 3).alias("latency_seconds"), F.when(F.col("matcher") < "m", share).alias("source_accuracy"))
    return evaluation.variant_summary(answers)


# --- knowledge -------------------------------------------------------------------------------------------------------

_FACT_WORDS = r"(?i:transaction|message|token|index|queue|payment)"


def useful_facts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null")
    return knowledge.useful_facts(docs, ["doc_id"], "text", _FACT_WORDS).select("doc_id", F.array_join("facts", "\u0001").alias("facts"))


# --- sources, sinks, state -------------------------------------------------------------------------------------------


def index_diff(spark: SparkSession, d: str) -> DataFrame:
    now = incremental.newest_files(table(spark, d, "source_files"))
    return index.snapshot_diff(now, incremental.recorded_files(table(spark, d, "files"), table(spark, d, "runs")))


def table_digest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "files").select("file_key", "hash", "run_id")
    return sinks.content_hash(rows)


def smoke_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_files").select("repo", "path").filter("repo is not null and path is not null").distinct()
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("repo").orderBy("path")))
    return ranked.filter("n <= 4").select("repo", "path")


def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return windows.tumbling(table(spark, d, "events"))


def events_sliding(spark: SparkSession, d: str) -> DataFrame:
    return windows.sliding(table(spark, d, "events"))


def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    return windows.sessions(table(spark, d, "events")).groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup_first, semantic_dedup, close_documents, module_split, split_leakage, shared_groups, greedy_group_split, ratio_cap, split_ratios,
        example_rows, task_counts, context_packing, task_cycle, per_file_questions, claim_metrics,
        useful_facts, index_diff, table_digest, smoke_sample, events_tumbling, events_sliding, events_sessions,
    )
}

_SHARE = "('0x' || sha256({c})[1:8])::BIGINT / 4294967296.0"
_PARENT = "coalesce(nullif(regexp_extract({c}, '^(.*)/[^/]*$', 1), ''), '.')"
_FP = "sha256(trim(regexp_replace({c}, '" + _WS.replace("{", "{{").replace("}", "}}") + "+', ' ', 'g')))"
_VEC = f"""
raw AS MATERIALIZED (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({_tokens('text')}) AS term FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
tf AS MATERIALIZED (SELECT doc_id, raw.term, n * ln((SELECT count(*) FROM documents WHERE text IS NOT NULL) / df) AS n FROM raw JOIN (SELECT term, count(*) AS df FROM raw GROUP BY term) d USING (term)),
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM tf GROUP BY 1 HAVING sum(n * n) > 0),
close AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, round(sum(x.n * y.n) / any_value(nx.norm) / any_value(ny.norm), 4) AS similarity
  FROM tf x JOIN tf y ON x.term = y.term AND x.doc_id < y.doc_id JOIN norms nx ON nx.doc_id = x.doc_id JOIN norms ny ON ny.doc_id = y.doc_id
  GROUP BY ALL HAVING round(sum(x.n * y.n) / any_value(nx.norm) / any_value(ny.norm), 4) >= 0.92)"""
_CC = """
cc(v, r) USING KEY (v) AS (
  SELECT a, min(b) FROM (SELECT a, b FROM edges UNION SELECT b, a FROM edges UNION SELECT a, a FROM edges UNION SELECT b, b FROM edges) GROUP BY a
  UNION
  SELECT n.v, min(l.r) FROM cc l JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON l.v = e.a JOIN recurring.cc n ON n.v = e.b WHERE l.r < n.r GROUP BY n.v)"""
_UNIQUE = "one AS MATERIALIZED (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY content IS NULL, commit_hash NULLS FIRST, end_line NULLS FIRST, symbol NULLS FIRST) AS rn FROM chunks WHERE id IS NOT NULL) WHERE rn = 1)"
_REF = "repo || '/' || path || ':' || start_line || '-' || end_line"
_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
_QUOTED = "array_to_string(list_transform({l}, lambda n: '`' || n || '`'), ', ')"
_NL = "chr(10)"
_SYNTAX = "'. That is syntax; what runs depends on what is called.'"
_EXAMPLES = f"""{_UNIQUE},
fit AS (SELECT id, content, {_REF} AS reference, coalesce(facts.calls, []) AS calls, coalesce(facts.constructs, []) AS constructs, coalesce(facts.doc, '') AS doc FROM one
  WHERE code_lang = 'go' AND symbol_type IN {_IN(examples.KINDS)} AND length(content) <= 9000 AND len(regexp_extract_all(content, '\\r\\n|[\\n\\r\\x{{0b}}\\x{{0c}}\\x{{1c}}-\\x{{1e}}\\x{{85}}\\x{{2028}}\\x{{2029}}]')) + CASE WHEN regexp_matches(content, '[\\n\\r\\x{{0b}}\\x{{0c}}\\x{{1c}}-\\x{{1e}}\\x{{85}}\\x{{2028}}\\x{{2029}}]$') THEN 0 ELSE 1 END >= 3 AND {_REF} IS NOT NULL),
lists AS (SELECT *, list_filter(calls, lambda c: c NOT IN {_IN(examples.TRIVIAL)}) AS telling, list_filter(constructs, lambda c: c IN {_IN(examples.CONCURRENT)}) AS conc,
  list_filter(calls, lambda c: regexp_extract(c, '([^.]*)$', 1) IN {_IN(examples.TRANSACTIONAL)}) AS trans, list_filter(calls, lambda c: c IN {_IN(examples.FAILING)}) AS fail FROM fit),
made AS (
  SELECT id, reference, content, 'dependencies' AS task, 'What does it call directly?' AS ask, 'It calls ' || {_QUOTED.format(l='telling')} || '. What those call in turn is not visible here.' AS answer FROM lists WHERE len(telling) >= 3 AND ('0x' || sha256(reference || ':dependencies')[1:8])::BIGINT % 100 < 30
  UNION ALL SELECT id, reference, content, 'function', 'What does its author say that it does?', 'The author says:' || {_NL} || doc || {_NL} || 'That is a claim, not a proof.' FROM lists WHERE doc <> ''
  UNION ALL SELECT id, reference, content, 'concurrency', 'Which concurrency constructs or calls are explicit here, and what do they show?', 'Visible here: ' || {_QUOTED.format(l='conc')} || {_SYNTAX} FROM lists WHERE len(conc) > 0
  UNION ALL SELECT id, reference, content, 'transactions', 'Which transactions constructs or calls are explicit here, and what do they show?', 'Visible here: ' || {_QUOTED.format(l='trans')} || {_SYNTAX} FROM lists WHERE len(trans) > 0
  UNION ALL SELECT id, reference, content, 'errors', 'Which errors constructs or calls are explicit here, and what do they show?', 'Visible here: ' || {_QUOTED.format(l='fail')} || {_SYNTAX} FROM lists WHERE len(fail) > 0),
asked AS (SELECT *, 'Source of ' || reference || ':' || {_NL} || '```go' || {_NL} || content || {_NL} || '```' || {_NL} || ask AS prompt FROM made),
told AS (SELECT * FROM asked WHERE NOT ({_any('prompt')}) AND NOT ({_any('answer')}))"""

SQL = {
    "exact_dedup_first": f"SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY {_FP.format(c='text')}",
    "close_documents": f"WITH {_VEC} SELECT * FROM close",
    "semantic_dedup": f"""
WITH RECURSIVE {_VEC},
same AS (SELECT doc_id AS b, min(doc_id) OVER (PARTITION BY text) AS a FROM documents WHERE text IS NOT NULL),
linked AS MATERIALIZED (SELECT a, b FROM close UNION SELECT a, b FROM same WHERE a < b),
involved AS (SELECT DISTINCT b AS k FROM linked), ordered AS (SELECT k, row_number() OVER (ORDER BY k) AS i FROM involved),
fold(i, fallen) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT o.i, CASE WHEN EXISTS (SELECT 1 FROM linked c WHERE c.b = o.k AND NOT list_contains(f.fallen, c.a)) THEN list_append(f.fallen, o.k) ELSE f.fallen END FROM fold f JOIN ordered o ON o.i = f.i + 1),
fell AS (SELECT unnest(fallen) AS k FROM (SELECT fallen FROM fold ORDER BY i DESC LIMIT 1))
SELECT d.doc_id, d.doc_id NOT IN (SELECT k FROM fell) AS kept,
  CASE WHEN d.doc_id IN (SELECT k FROM fell) THEN (SELECT min(c.a) FROM linked c WHERE c.b = d.doc_id AND c.a NOT IN (SELECT k FROM fell)) END AS duplicate_of
FROM documents d WHERE text IS NOT NULL""",
    "module_split": f"""
WITH RECURSIVE keys AS (SELECT DISTINCT repo || '/' || path AS file_key, repo || '/' || {_PARENT.format(c='path')} AS module FROM source_files WHERE repo || '/' || path IS NOT NULL),
texts AS (SELECT DISTINCT {_FP.format(c='content')} AS fp, repo || '/' || {_PARENT.format(c='path')} AS module FROM chunks WHERE length(content) >= 100 AND coalesce(symbol_type NOT IN ('package', 'import'), true) AND repo || '/' || path IS NOT NULL),
edges AS MATERIALIZED (SELECT t.module AS a, h.hub AS b FROM texts t JOIN (SELECT fp, min(module) AS hub FROM texts GROUP BY fp HAVING count(*) > 1) h USING (fp)), {_CC}
SELECT file_key, CASE WHEN {_SHARE.format(c='coalesce(r, module)')} < 0.15 THEN 'validation' ELSE 'train' END AS split FROM keys LEFT JOIN cc ON v = module""",
    "split_leakage": f"SELECT fp, count(DISTINCT split) AS splits FROM (SELECT {_FP.format(c='text')} AS fp, CASE WHEN {_SHARE.format(c='doc_id::VARCHAR')} < 0.15 THEN 'validation' ELSE 'train' END AS split FROM documents WHERE text IS NOT NULL) GROUP BY fp HAVING count(DISTINCT split) > 1",
    "shared_groups": f"""
WITH RECURSIVE rows AS (SELECT DISTINCT id, file_key, CASE WHEN length(content) >= 100 THEN {_FP.format(c='content')} END AS fp FROM chunks WHERE id IS NOT NULL),
keys AS (SELECT id, 'file:' || file_key AS key FROM rows WHERE file_key IS NOT NULL UNION SELECT id, 'text:' || fp FROM rows WHERE fp IS NOT NULL),
edges AS MATERIALIZED (SELECT DISTINCT k.id AS a, h.hub AS b FROM keys k JOIN (SELECT key, min(id) AS hub FROM keys GROUP BY key) h USING (key)), {_CC},
grouped AS (SELECT DISTINCT rows.id, coalesce(r, rows.id) AS root FROM rows LEFT JOIN cc ON v = rows.id)
SELECT root, sha256(concat_ws('|', """ + ", ".join(f"sum(('0x' || h[{1 + 8 * i}:{8 + 8 * i}])::BIGINT::HUGEINT)::VARCHAR" for i in range(8)) + """)) AS group_id, count(*) AS size FROM (SELECT root, sha256(id) AS h FROM grouped) GROUP BY root""",
    "greedy_group_split": r"""
WITH RECURSIVE named AS (SELECT coalesce(replace(regexp_extract(regexp_replace(regexp_replace(lower(repo), '^[\s/]+|[\s/]+$', '', 'g'), '\.git$', ''), '([^/:\\]*)$', 1), '_', '-'), '') AS name FROM source_files),
sizes AS (SELECT coalesce(nullif(regexp_extract(name, '([a-z]+)-[a-z]+', 1), ''), name) AS team, count(*) AS n FROM named GROUP BY 1),
ordered AS (SELECT team, n, row_number() OVER (ORDER BY n DESC, team) AS i, count(*) OVER () AS c, sum(n) OVER () AS total FROM sizes),
fold(i, test, train, validation, split, team) AS (
  SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR
  UNION ALL
  SELECT i, test + CASE WHEN pick = 'test' THEN n ELSE 0 END, train + CASE WHEN pick = 'train' THEN n ELSE 0 END, validation + CASE WHEN pick = 'validation' THEN n ELSE 0 END, pick, team
  FROM (SELECT o.i, o.n, o.team, f.test, f.train, f.validation, list_sort(list_filter([
      {'g': pow(f.test + o.n - total * 0.1, 2) - pow(f.test - total * 0.1, 2), 't': -total * 0.1, 's': 'test', 'e': f.test = 0},
      {'g': pow(f.train + o.n - total * 0.8, 2) - pow(f.train - total * 0.8, 2), 't': -total * 0.8, 's': 'train', 'e': f.train = 0},
      {'g': pow(f.validation + o.n - total * 0.1, 2) - pow(f.validation - total * 0.1, 2), 't': -total * 0.1, 's': 'validation', 'e': f.validation = 0}],
      lambda x: x.e OR c - o.i + 1 > (f.test = 0)::INT + (f.train = 0)::INT + (f.validation = 0)::INT))[1].s AS pick
    FROM fold f JOIN ordered o ON o.i = f.i + 1))
SELECT team, split FROM fold WHERE i > 0""",
    "ratio_cap": f"""
WITH rows AS (SELECT doc_id, CASE WHEN {_SHARE.format(c='doc_id::VARCHAR')} < 0.2 THEN 'validation' ELSE 'train' END AS split, repo IS NOT NULL AS linked FROM documents),
per AS (SELECT split, count(*) FILTER (linked) AS l FROM rows GROUP BY 1)
SELECT doc_id, split, linked FROM (SELECT r.*, l, row_number() OVER (PARTITION BY r.split, linked ORDER BY doc_id) AS n FROM rows r JOIN per USING (split)) WHERE linked OR n <= floor(l * 0.4 / 0.6 + 1e-9)""",
    "split_ratios": "SELECT coalesce(lang, 'none') AS split, count(*) AS total, count(*) FILTER (repo IS NOT NULL) AS linked, round(count(*) FILTER (repo IS NOT NULL) / count(*), 6) AS share FROM documents GROUP BY 1",
    "example_rows": f"WITH {_EXAMPLES} SELECT id, task, reference, sha256('user: ' || prompt || chr(10) || 'assistant: ' || answer) AS digest FROM told",
    "task_counts": f"WITH {_EXAMPLES} SELECT task, count(*) AS n FROM told GROUP BY task",
    "context_packing": f"""
WITH RECURSIVE one AS MATERIALIZED (SELECT id, c.* FROM (SELECT id, min({{'repo': repo, 'path': path, 'start_line': start_line, 'content': content}}) AS c FROM chunks WHERE id IS NOT NULL AND content IS NOT NULL GROUP BY id)),
sized AS MATERIALIZED (SELECT id, repo || '/' || {_PARENT.format(c='path')} AS module, row_number() OVER (PARTITION BY repo || '/' || {_PARENT.format(c='path')} ORDER BY NOT contains(path, '_test.'), path, start_line, id) AS k, length(content) AS n FROM one),
fold(id, module, k, used, ids) AS (
  SELECT id, module, 0::BIGINT, 0::BIGINT, []::VARCHAR[] FROM sized
  UNION ALL
  SELECT f.id, f.module, s.k, CASE WHEN s.id <> f.id AND s.n > 0 AND used + s.n <= 4000 THEN used + s.n ELSE used END, CASE WHEN s.id <> f.id AND s.n > 0 AND used + s.n <= 4000 THEN list_append(ids, s.id) ELSE ids END
  FROM fold f JOIN sized s ON s.module = f.module AND s.k = f.k + 1)
SELECT id, array_to_string(ids, ',') AS context, used FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS rn FROM fold) WHERE rn = 1""",
    "task_cycle": "SELECT n, id, task FROM (SELECT row_number() OVER (ORDER BY id, t) AS n, id, task FROM (SELECT DISTINCT id FROM chunks WHERE id IS NOT NULL), (VALUES (0, 'explain'), (1, 'test'), (2, 'review'), (3, 'document')) AS v(t, task)) WHERE n <= 250",
    "per_file_questions": "SELECT file_key, c.id AS id, 'Where is ' || c.symbol || ' declared?' AS question FROM (SELECT file_key, min({'start_line': start_line, 'id': id, 'symbol': symbol}) AS c FROM chunks WHERE symbol_type IN ('function', 'method', 'struct', 'interface') AND symbol IS NOT NULL GROUP BY file_key) ORDER BY file_key LIMIT 30",
    "claim_metrics": """
WITH a AS (SELECT matcher AS variant, match_id % 4 AS n, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS acc, round(score, 3) AS lat FROM chunk_matches),
s AS (SELECT *, n > 0 AS rev, CASE WHEN n > 1 THEN 1 ELSE 0 END AS u, CASE WHEN n = 2 THEN 1 ELSE 0 END AS c FROM a)
SELECT variant, count(*) AS cases, count(*) FILTER (rev) AS reviewed_cases, round(sum(n) FILTER (rev) / sum(n + u + c) FILTER (rev), 6) AS groundedness, round(sum(u + c) FILTER (rev) / sum(n + u + c) FILTER (rev), 6) AS hallucination,
  round(avg(acc), 6) AS location_accuracy, round(avg(lat), 6) AS latency_seconds, CASE WHEN variant < 'm' THEN round(avg(acc), 6) END AS source_accuracy FROM s GROUP BY variant""",
    "useful_facts": f"""
WITH s AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?]){_WS}+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS l FROM documents WHERE text IS NOT NULL)),
fit AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM s WHERE len(list_filter(regexp_split_to_array(s, '{_WS}+'), lambda x: x <> '')) BETWEEN 8 AND 120 AND regexp_matches(s, '{_FACT_WORDS}') AND NOT ({_any('s')} OR regexp_matches({_for_re2('s', 'private')}, '{_re2(screening.PRIVATE)}')))
SELECT doc_id, string_agg(s, chr(1) ORDER BY i) AS facts FROM fit WHERE n <= 3 GROUP BY doc_id""",
    "index_diff": r"""
WITH now AS (
  SELECT repo || '/' || path AS file_key, arg_max({'h': coalesce(lower(content_hash), sha256(content)), 'c': lower(commit_hash)}, {'a': scanned_at, 'b': commit_hash}) AS n FROM source_files GROUP BY 1),
was AS (
  SELECT f.file_key, arg_max({'h': regexp_replace(lower(f.hash), '^sha256:', ''), 'c': lower(f.commit_hash)}, {'a': r.started_at, 'b': f.written_at, 'c': f.hash, 'd': f.commit_hash}) AS w
  FROM files f JOIN runs r ON r.run_id = f.run_id WHERE r.status = 'success' AND f.hash IS NOT NULL GROUP BY 1)
SELECT coalesce(now.file_key, was.file_key) AS file_key, CASE WHEN was.file_key IS NULL THEN 'added' WHEN now.file_key IS NULL THEN 'deleted' WHEN n.h <> w.h THEN 'changed'
  WHEN NOT (starts_with(n.c, w.c) OR starts_with(w.c, n.c)) THEN 'recommitted' ELSE 'unchanged' END AS state FROM now FULL JOIN was ON was.file_key = now.file_key""",
    "table_digest": "SELECT count(*) AS rows, sha256(concat_ws('|', " + ", ".join(f"coalesce(sum(('0x' || r[{1 + 8 * i}:{8 + 8 * i}])::BIGINT::HUGEINT)::VARCHAR, '0')" for i in range(8)) + ")) AS content_hash FROM (SELECT sha256(to_json({'file_key': file_key, 'hash': hash, 'run_id': run_id})::VARCHAR) AS r FROM files)",
    "smoke_sample": "SELECT repo, path FROM (SELECT repo, path, row_number() OVER (PARTITION BY repo ORDER BY path) AS n FROM (SELECT DISTINCT repo, path FROM source_files WHERE repo IS NOT NULL AND path IS NOT NULL)) WHERE n <= 4",
    "events_tumbling": "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL",
    "events_sliding": "SELECT start, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS start FROM events) GROUP BY start",
    "events_sessions": """
WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS c FROM events),
g AS (SELECT user_id, sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM m)
SELECT user_id, count(DISTINCT s) AS sessions, max(n) AS longest FROM (SELECT user_id, s, count(*) AS n FROM g GROUP BY ALL) GROUP BY user_id""",
}
