"""Queries that build a dataset: scan, catalog, pages, evidence, facts, records and their review, with their SQL.

Scenarios are made of the table of subjects, two for each; evidence rules for this project's calls stand below. The SQL
says the same from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions import screening
from siltstone.functions import text as tx
from siltstone.operators import examples, knowledge, records
from siltstone.operators.knowledge import Rule
from siltstone.plans.corpus import _EXCLUDED, _LANG, _WS, _any, _collapse, _for_re2, _re2, findings_sql
from siltstone.plans.datasets import _FACT_WORDS, _UNIQUE, _unique_chunks
from siltstone.plans.structure import _lines
from siltstone.runtime import cut, table
from siltstone.sources import files as sources
from siltstone.sources import html

MOST_BYTES = 12_000
#: What calls of this project show, after the general rules.
PROJECT = (
    Rule("outbox_use", ("messaging", "databases"), "an outbox takes part", call_has="outbox"),
    Rule("retry_use", ("operations", "software"), "something is tried again", call_has="retry"),
    Rule("refund_use", ("payments",), "a refund takes part", call_has="refund"),
    Rule("token_use", ("security",), "a token takes part", call_has="token"),
    Rule("ledger_use", ("accounting",), "a ledger takes part", call_has="ledger"),
    Rule("hook_use", ("messaging", "software"), "a hook is called", call_has="hook"),
    Rule("vault_use", ("security", "operations"), "a vault takes part", call_has="vault"),
    Rule("wallet_use", ("payments", "accounting"), "a wallet takes part", call_has="wallet"),
)
RULES = knowledge.RULES + PROJECT


def evidence(spark: SparkSession, d: str) -> DataFrame:
    return knowledge.evidence(_unique_chunks(spark, d), RULES)


def evidence_rules(spark: SparkSession, d: str) -> DataFrame:
    return evidence(spark, d).select("evidence_id", "reference", "pattern", "call", F.array_join("families", ",").alias("families"), "observation", "snippet_hash")


def family_counts(spark: SparkSession, d: str) -> DataFrame:
    return knowledge.family_counts(evidence(spark, d), ["security", "retry", "replay"])


def scenarios(spark: SparkSession, d: str) -> DataFrame:
    """Two scenarios a subject: one of any code that shows its patterns, one of places with certain words."""
    names = table(spark, d, "subjects").filter("subject is not null").groupBy("subject").agg(F.min("scope").alias("scope"))
    each = names.select("subject", "scope", F.explode(F.array(F.lit("concept"), F.lit("failure"))).alias("kind"))
    failure = F.col("kind") == "failure"
    # subjects are a fixed, small table
    number = F.row_number().over(Window.orderBy("subject", "kind"))
    words = lambda *w: F.array(*map(F.lit, w)).cast("array<string>")
    return each.select(
        number.alias("position"), F.concat_ws("-", "subject", "kind").alias("scenario_id"), F.col("subject").alias("family"), "kind",
        F.concat(F.lit("What has to be kept in mind about "), "subject", F.when(failure, F.lit(" when a step fails?")).otherwise("?")).alias("question"),
        F.concat(F.lit("A team works on "), "scope", F.lit(" and changes one step.")).alias("premise"),
        F.concat(F.lit("What holds for "), "subject", F.lit(" must still hold after the change.")).alias("reasoning"),
        F.concat(F.lit("a test that runs the step twice and compares the state of "), "subject").alias("test"),
        words(*[r.pattern for r in PROJECT]).alias("patterns"), F.when(failure, words("audit", "sync", "hook", "store")).otherwise(words()).alias("needs"),
        F.when(failure, words()).otherwise(words("portal")).alias("avoids"), F.lit("").alias("call_ends"),
        F.lit("handbook").alias("preferred_title"), F.split("scope", "[ ,:]+").alias("keywords"),
    )


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Useful sentences of the documents with a subject by hand, one row a document and subject."""
    docs = table(spark, d, "documents").filter("text is not null")
    told = knowledge.useful_facts(docs, ["doc_id", "text", "source", "doc_kind", "lang", "repo"], "text", _FACT_WORDS)
    known = table(spark, d, "subjects").select("subject").distinct()
    labels = table(spark, d, "subject_labels").join(known, "subject", "left_semi").select("doc_id", "subject").distinct()
    cell = lambda c: F.coalesce(c, F.lit("none"))
    return told.join(labels, "doc_id").select(F.concat_ws(":", "doc_id", "subject").alias("fact_id"), F.col("subject").alias("family"), cell("source").alias("title"), cell("doc_kind").alias("section"), F.concat(F.lit("doc:"), "doc_id").alias("url"), cell("lang").alias("revision"), F.lit("internal").alias("license"), cell("repo").alias("attribution"), F.col("text").alias("content"), "facts")


def best_fact(spark: SparkSession, d: str) -> DataFrame:
    asked = scenarios(spark, d).select(F.col("scenario_id").alias("question_id"), "family", "preferred_title", "keywords")
    return knowledge.best_fact(asked, facts(spark, d))


def scenario_evidence(spark: SparkSession, d: str) -> DataFrame:
    return records.compatible_pairs(scenarios(spark, d), evidence(spark, d))


def least_used(spark: SparkSession, d: str) -> DataFrame:
    pairs = records.compatible_pairs(scenarios(spark, d), evidence(spark, d))
    return knowledge.least_used(pairs.select(F.col("position").alias("question_id"), F.col("scenario_id").alias("pattern")), pairs.select("evidence_id", F.col("scenario_id").alias("pattern")), 2)


def _built(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    # facts and evidence are read several times: they are screened once
    asked, told, found = scenarios(spark, d), cut(facts(spark, d), "facts"), cut(evidence(spark, d), "evidence")
    return asked, told, found, records.build_records(asked, told, found, 2)


def scenario_records(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d)[3].select("record_id", "scenario_id", "fact_id", "evidence_id", "linked", F.array_join("source_facts", " ").alias("source_facts"), "license", "attribution")


def scenario_gaps(spark: SparkSession, d: str) -> DataFrame:
    asked, told, _, made = _built(spark, d)
    return records.gaps(asked, told, made)


# Each change of a record, the column it changes, what the column becomes, and what is wrong with the record then.
CHANGES = {
    "none": (None, None, ""),
    "short": ("instruction", "'Why?'", "missing_or_trivial_fields"),
    "private": ("output", "output || ' See https://a.corp/x'", "sensitive_content"),
    "lost": ("fact_id", "'nobody knows'", "missing_source"),
    "family": ("family", "'geology'", "source_concept_mismatch"),
    "title": ("source_title", "source_title || '!'", "source_metadata_mismatch:source_title"),
    "license": ("license", "NULL", "source_metadata_mismatch:license"),
    "no facts": ("source_facts", "array()", "unsupported_source_fact"),
    "other facts": ("source_facts", "array('Nothing of the kind was ever written anywhere.')", "unsupported_source_fact"),
    "interpretation": ("interpretation", "'It will be fine.'", "unreviewed_engineering_interpretation"),
    "mixed": ("input", f"replace(input, '{records.SUPPOSED}', 'A case')", "facts_and_interpretation_not_separated"),
    "flag": ("linked", "NOT linked", "incorrect_linked_flag"),
    "premise": ("scenario_premise", "'Another premise.'", "changed_scenario_premise"),
    "edited": ("input", "input || ' More.'", "unreviewed_or_unsupported_generated_text"),
    "kind": ("kind", "'other'", "generated_provenance_mismatch"),
    "stale": ("snippet_hash", "'0'", "stale_or_fabricated_code"),
}


def record_validation(spark: SparkSession, d: str) -> DataFrame:
    """Every record, whole and with each change: what is found wrong with it."""
    asked, told, found, made = _built(spark, d)
    columns = made.columns
    rows = made.withColumn("change", F.explode(F.array(*map(F.lit, CHANGES)))).filter("change <> 'stale' or linked")
    out = []
    for c in columns:
        value = F.col(c)
        for name, (column, becomes, _) in CHANGES.items():
            if column == c:
                value = F.when(F.col("change") == name, F.expr(becomes)).otherwise(value)
        out.append(value.alias(c))
    changed = rows.select("change", *out)
    wrong = records.record_errors(changed, asked, told, found, ["change"])
    return wrong.groupBy("change", F.array_join("errors", ",").alias("errors")).agg(F.count("*").alias("n"))


def process_report(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    pages = docs.select(F.col("source").alias("page_id"))
    return knowledge.process_report(pages, docs.select(F.col("doc_id").alias("chunk_id")), knowledge.useful_facts(docs.filter("text is not null"), ["doc_id"], "text", _FACT_WORDS).withColumnRenamed("doc_id", "chunk_id"))


# --- review ----------------------------------------------------------------------------------------------------------

REVIEW = "id string, reference string, content_hash string, approved boolean, reviewer string, messages array<struct<role:string,content:string>>"


def _reviewed(spark: SparkSession, d: str) -> DataFrame:
    n = lambda k: F.pmod(tx.hash_number(F.col("id")), F.lit(k))
    rows = _unique_chunks(spark, d).withColumn("reference", examples.reference()).filter("reference is not null and content is not null")
    say = lambda role, what: F.struct(F.lit(role).alias("role"), what.alias("content"))
    ask = say("user", F.concat(F.lit("What is `"), F.coalesce("symbol", F.lit("this")), F.lit("`?")))
    answer = say("assistant", F.when(n(7) == 0, F.lit("  ")).otherwise(F.concat(F.lit("It is of type "), F.coalesce("symbol_type", F.lit("none")), F.lit("."))))
    return rows.select(
        "id", "reference", tx.digest(F.col("content")).alias("content_hash"), F.when(n(4) == 0, None).otherwise(n(4) > 1).alias("approved"), F.when(n(5) == 0, "  ").when(n(5) > 1, "desk").alias("reviewer"),
        F.when(n(11) == 0, F.array(ask)).otherwise(F.array(ask, answer)).alias("messages"),
    )


def review_import(spark: SparkSession, d: str) -> DataFrame:
    rows = _reviewed(spark, d)
    known = rows.filter(F.pmod(tx.hash_number(F.col("id")), F.lit(13)) == 0)
    return examples.import_reviewed(rows, known, rows.select("reference", "content_hash").distinct()).select("id", "reference", "reviewer")


# --- sources ---------------------------------------------------------------------------------------------------------


def scan_report(spark: SparkSession, d: str) -> DataFrame:
    """Every version of every file as if it were read from a folder of its repository and commit."""
    rows = table(spark, d, "source_files").filter("content is not null").select(F.concat_ws("@", "repo", "commit_hash").alias("repo"), "path", "content").distinct()
    given = rows.select("repo", "path", F.octet_length("content").alias("length"), F.encode("content", "UTF-8").alias("bytes"))
    accepted, report = sources.scan(given, MOST_BYTES)
    rows = report.unionByName(accepted.select("repo", "path", F.lit("accepted").alias("rule"), F.lit(None).cast("int").alias("line")))
    return rows.groupBy("repo", "path", "rule").agg(F.count("*").alias("n"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


def catalog_validation(spark: SparkSession, d: str) -> DataFrame:
    """A catalog with a row for each document; every so many rows something is wrong with one."""
    k = lambda n, at: F.pmod(F.col("doc_id"), F.lit(n)) == at
    own = F.concat_ws(" ", F.lit("Page"), "doc_id")
    title = F.when(k(11, 0), F.concat(F.lit("Page of "), F.coalesce("source", F.lit("none")))).otherwise(own)
    address = F.concat(F.when(k(7, 1), "http").otherwise("https"), F.lit("://en.example.org/wiki/"), F.when(k(5, 2), F.lit("Other")).otherwise(F.translate(title, " ", "_")), F.when(k(13, 3), "?x=1").otherwise(""))
    rows = table(spark, d, "documents").select(
        title.alias("title"), address.alias("url"), F.when(k(6, 4), "odd").otherwise("core").alias("category"), F.when(k(9, 5), "P7").otherwise("P1").alias("priority"), F.when(k(10, 6), " ").otherwise("retry").alias("family"),
        F.when(~k(12, 7), F.array(F.lit("t"))).alias("tags"), F.struct(F.lit("L").alias("name"), F.when(k(15, 8), "l").otherwise("https://l.example/").alias("url")).alias("license"), F.lit("about it").alias("description"),
    )
    found = sources.catalog_errors(rows, "en.example.org", ["core", "extra"], ["P0", "P1", "P2"])
    return found.select("title", F.array_join("errors", ",").alias("errors"))


def html_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The documents as pages: a heading, a paragraph for each line, and what no block should hold."""
    lines = F.split(F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), "\n")
    body = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), x, F.lit("<nav>home about contact and more links</nav>"))), "</p>\n")
    head = F.concat(F.lit("<h2>See also</h2><p>nobody should ever see these words</p><h2>"), F.lit("About "), F.coalesce("doc_kind", F.lit("none")), F.lit("</h2><script>var a = 1 < 2; let b c d e</script>"))
    pages = table(spark, d, "documents").filter("text is not null").select("doc_id", F.concat(head, body).alias("html"))
    return html.html_blocks(pages, "doc_id", "html").select("doc_id", "section", tx.digest(F.col("content")).alias("digest"))


QUERIES = {f.__name__: f for f in (evidence_rules, family_counts, best_fact, scenario_evidence, least_used, scenario_records, scenario_gaps, record_validation, process_report, review_import, scan_report, catalog_validation, html_blocks)}

# --- SQL -------------------------------------------------------------------------------------------------------------


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_applies(r: Rule) -> str:
    leaf = "regexp_extract(call, '([^.]*)$', 1)"
    parts = [f"{leaf} IN ({', '.join(map(_quoted, r.leaves))})"] if r.leaves else []
    parts += [f"call IN ({', '.join(map(_quoted, r.calls))})"] if r.calls else []
    parts += [f"ends_with(call, '{r.ends}')"] if r.ends else []
    parts += [f"contains(path, '{r.path_has}')"] if r.path_has else []
    parts += [f"contains(lower(call), '{r.call_has}')"] if r.call_has else []
    parts += [f"contains(content, '{r.content_has}')"] if r.content_has else []
    return " AND ".join(parts)


_SHOWN = "CASE " + " ".join(f"WHEN {_sql_applies(r)} THEN {{'p': '{r.pattern}', 'f': [{', '.join(map(_quoted, r.families))}], 'o': {_quoted(r.observation)}}}" for r in RULES) + " END"
_PRIVATE = f"regexp_matches({_for_re2('content', 'private')}, '{_re2(screening.PRIVATE)}')"
_EVIDENCE = f"""{_UNIQUE},
calls AS (SELECT id, repo, path, symbol, start_line, content, unnest(facts.calls) AS call FROM one WHERE code_lang = 'go' AND symbol_type IN ('function', 'method') AND content IS NOT NULL
  AND NOT ends_with(path, '_test.go') AND NOT contains(path, '/mocks/') AND NOT contains(substring(content, 1, 500), 'Code generated')),
shown AS MATERIALIZED (SELECT * FROM (SELECT *, {_SHOWN} AS s FROM calls) WHERE s IS NOT NULL AND NOT ({_any('content')}) AND NOT {_PRIVATE}),
places AS (SELECT *, {_lines('content')} AS l FROM shown),
found AS (SELECT *, list_position(list_transform(l, lambda x: contains(x, call || '(') AND NOT starts_with(regexp_replace(x, '^{_WS}+', ''), '//')), true) AS pos FROM places),
snips AS (SELECT *, start_line + greatest(pos - 3, 0) AS lo, start_line + least(pos + 4, len(l)) - 1 AS hi, array_to_string(l[greatest(pos - 2, 1) : least(pos + 4, len(l))], chr(10)) AS snippet FROM found WHERE pos > 0),
firsts AS (SELECT *, row_number() OVER (PARTITION BY s.p, sha256({_collapse('snippet')}) ORDER BY repo, path, lo, call, id) AS rn FROM snips),
evidence AS MATERIALIZED (SELECT sha256(concat_ws('|', id, s.p, call, sha256(snippet))) AS evidence_id, repo || '/' || path || ':' || lo || '-' || hi AS reference, repo, path, symbol, call, s.p AS pattern, s.f AS families, s.o AS observation, snippet FROM firsts WHERE rn = 1)"""
_SCENARIOS = f"""scenarios AS MATERIALIZED (SELECT row_number() OVER (ORDER BY subject, kind) AS position, subject || '-' || kind AS scenario_id, subject AS family, scope, kind, string_split_regex(scope, '[ ,:]+') AS keywords,
  'What has to be kept in mind about ' || subject || CASE WHEN kind = 'failure' THEN ' when a step fails?' ELSE '?' END AS question, 'A team works on ' || scope || ' and changes one step.' AS premise,
  'What holds for ' || subject || ' must still hold after the change.' AS reasoning, 'a test that runs the step twice and compares the state of ' || subject AS test
  FROM (SELECT subject, min(scope) AS scope FROM subjects WHERE subject IS NOT NULL GROUP BY 1), (VALUES ('concept'), ('failure')) AS k(kind))"""
_PLACE = "lower(concat_ws(' ', symbol, path))"
_PAIRS = f"""{_SCENARIOS},
pairs AS MATERIALIZED (SELECT DISTINCT scenario_id, position, evidence_id FROM (SELECT *, unnest(families) AS f FROM evidence) e JOIN scenarios s ON s.family = e.f
  WHERE pattern IN ({', '.join(_quoted(r.pattern) for r in PROJECT)}) AND CASE WHEN kind = 'failure' THEN regexp_matches({_PLACE}, 'audit|sync|hook|store') ELSE NOT contains({_PLACE}, 'portal') END)"""
_SENTENCES = f"""s AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?]){_WS}+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS l FROM documents WHERE text IS NOT NULL)),
fit AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM s WHERE len(list_filter(regexp_split_to_array(s, '{_WS}+'), lambda x: x <> '')) BETWEEN 8 AND 120 AND regexp_matches(s, '{_FACT_WORDS}') AND NOT ({_any('s')} OR regexp_matches({_for_re2('s', 'private')}, '{_re2(screening.PRIVATE)}')))"""
_FACTS = f"""{_SENTENCES},
told AS (SELECT doc_id, list(s ORDER BY i) AS facts FROM fit WHERE n <= 3 GROUP BY doc_id),
facts AS MATERIALIZED (SELECT d.doc_id || ':' || l.subject AS fact_id, l.subject AS family, coalesce(source, 'none') AS title, coalesce(doc_kind, 'none') AS section, coalesce(repo, 'none') AS attribution, text AS content, t.facts
  FROM told t JOIN documents d USING (doc_id) JOIN (SELECT DISTINCT doc_id, subject FROM subject_labels WHERE subject IN (SELECT subject FROM subjects)) l USING (doc_id))"""
_BEST = """best AS (SELECT scenario_id, fact_id FROM (SELECT scenario_id, fact_id, row_number() OVER (PARTITION BY scenario_id ORDER BY title <> 'handbook', section <> 'Overview', -len(list_filter(keywords, lambda w: contains(lower(content), w))), fact_id) AS rn FROM scenarios s JOIN facts f USING (family)) WHERE rn = 1)"""
_FOLD = """cands AS (SELECT position, list(evidence_id ORDER BY evidence_id) AS ids FROM pairs GROUP BY position), ordered AS (SELECT *, row_number() OVER (ORDER BY position) AS i FROM cands),
fold(i, position, took, taken) AS (
  SELECT 0::BIGINT, 0::BIGINT, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT i, position, took, list_concat(taken, took) FROM (
    SELECT o.i, o.position, f.taken, list_transform(list_sort(list_transform(o.ids, lambda c: {'n': len(list_filter(f.taken, lambda t: t = c)), 'id': c}))[1:2], lambda x: x.id) AS took FROM fold f JOIN ordered o ON o.i = f.i + 1)),
took AS (SELECT position, unnest(took) AS evidence_id FROM fold)"""
_RECORDS = f"""WITH RECURSIVE {_EVIDENCE}, {_PAIRS}, {_FACTS}, {_BEST}, {_FOLD},
linked AS (SELECT s.scenario_id, e.* FROM took t JOIN scenarios s USING (position) JOIN evidence e USING (evidence_id)),
rows AS (SELECT s.*, f.fact_id, f.title, f.section, f.attribution, f.facts, e.evidence_id, e.repo, e.path, e.symbol, e.reference, e.snippet, e.observation, e.evidence_id IS NOT NULL AS linked
  FROM scenarios s JOIN best b USING (scenario_id) JOIN facts f ON f.fact_id = b.fact_id JOIN (SELECT scenario_id, evidence_id, repo, path, symbol, reference, snippet, observation FROM linked UNION ALL SELECT scenario_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM scenarios) e USING (scenario_id)),
records AS (SELECT *, question || CASE WHEN linked THEN '{records.APPLIED}`' || symbol || '` in `' || repo || '/' || path || '`.' ELSE '' END AS instruction,
  '{records.SUPPOSED}: ' || premise || chr(10) || chr(10) || 'Facts from ' || title || ', ' || section || ':' || chr(10) || array_to_string(facts, ' ') || CASE WHEN linked THEN chr(10) || chr(10) || 'Code at ' || reference || ':' || chr(10) || '```go' || chr(10) || snippet || chr(10) || '```' ELSE '' END AS given,
  'Fact: ' || facts[1] || chr(10) || chr(10) || CASE WHEN linked THEN 'Seen in the code: ' || observation || ' [' || reference || ']' || chr(10) || chr(10) ELSE '' END || '{records.CONCLUDED}: ' || reasoning || chr(10) || chr(10) || 'To be verified: ' || test AS output FROM rows)"""
_CHANGED = "(VALUES " + ", ".join(f"({_quoted(n)}, {_quoted(e)})" for n, (_, _, e) in CHANGES.items()) + ") AS c(change, wrong)"
_N = lambda k: f"(('0x' || sha256(id)[1:8])::BIGINT % {k})"
_SCANNED = "(SELECT DISTINCT repo || '@' || commit_hash AS repo, path, content FROM source_files WHERE content IS NOT NULL)"
_SLUG = "regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"

SQL = {
    "evidence_rules": f"WITH {_EVIDENCE} SELECT evidence_id, reference, pattern, call, array_to_string(families, ',') AS families, observation, sha256(snippet) AS snippet_hash FROM evidence",
    "family_counts": f"WITH {_EVIDENCE} SELECT coalesce(w.family, h.family) AS family, coalesce(n, 0) AS n FROM (VALUES ('security'), ('retry'), ('replay')) AS w(family) FULL JOIN (SELECT family, count(*) AS n FROM (SELECT unnest(families) AS family FROM evidence) GROUP BY family) h ON h.family = w.family",
    "best_fact": f"WITH {_SCENARIOS}, {_FACTS}, {_BEST} SELECT scenario_id AS question_id, fact_id FROM best",
    "scenario_evidence": f"WITH {_EVIDENCE}, {_PAIRS} SELECT scenario_id, position, evidence_id FROM pairs",
    "least_used": f"WITH RECURSIVE {_EVIDENCE}, {_PAIRS}, {_FOLD} SELECT position AS question_id, evidence_id FROM took",
    "scenario_records": f"{_RECORDS} SELECT sha256(instruction || given || output) AS record_id, scenario_id, fact_id, evidence_id, linked, array_to_string(facts, ' ') AS source_facts, 'internal' AS license, attribution FROM records",
    "scenario_gaps": f"{_RECORDS} SELECT * FROM (SELECT scenario_id, CASE WHEN family NOT IN (SELECT family FROM facts) THEN 'no_facts' WHEN scenario_id NOT IN (SELECT scenario_id FROM linked) OR scenario_id NOT IN (SELECT scenario_id FROM best) THEN 'no_evidence' END AS reason FROM scenarios) WHERE reason IS NOT NULL",
    "record_validation": f"""{_RECORDS},
texts AS (SELECT *, instruction || chr(10) || given || chr(10) || output AS said FROM records),
judged AS MATERIALIZED (SELECT linked, ({_any('said')} OR regexp_matches({_for_re2('said', 'private')}, '{_re2(screening.PRIVATE)}')) AS secret FROM texts),
wrongs AS (SELECT change, secret, CASE WHEN change = 'family' AND linked THEN wrong || ',unrelated_code_pattern' WHEN secret AND change IN ('edited', 'kind', 'private') THEN '' ELSE wrong END AS wrong FROM judged, {_CHANGED} WHERE change <> 'stale' OR linked)
SELECT change, errors, count(*) AS n FROM (SELECT change, CASE WHEN secret AND change <> 'short' THEN array_to_string(list_filter(['sensitive_content', nullif(wrong, '')], lambda x: x IS NOT NULL), ',') ELSE wrong END AS errors FROM wrongs) GROUP BY ALL""",
    "process_report": f"WITH {_SENTENCES} SELECT (SELECT count(DISTINCT source) FROM documents) AS pages, (SELECT count(DISTINCT doc_id) FROM documents) AS chunks, (SELECT count(DISTINCT doc_id) FROM fit) AS useful, (SELECT count(DISTINCT doc_id) FROM documents) - (SELECT count(DISTINCT doc_id) FROM fit) AS skipped",
    "review_import": f"""
WITH {_UNIQUE},
rows AS (SELECT id, repo || '/' || path || ':' || start_line || '-' || end_line AS reference, CASE WHEN {_N(5)} = 0 THEN '  ' WHEN {_N(5)} > 1 THEN 'desk' END AS reviewer, CASE WHEN {_N(4)} = 0 THEN NULL ELSE {_N(4)} > 1 END AS approved,
  '`' || coalesce(symbol, 'this') || '`?' AS asked, CASE WHEN {_N(7)} = 0 THEN '  ' ELSE 'It is of type ' || coalesce(symbol_type, 'none') || '.' END AS answer, {_N(11)} > 0 AS two, {_N(13)} = 0 AS known FROM one WHERE content IS NOT NULL),
told AS (SELECT *, to_json(CASE WHEN two THEN [{{'role': 'user', 'content': 'What is ' || asked}}, {{'role': 'assistant', 'content': answer}}] ELSE [{{'role': 'user', 'content': 'What is ' || asked}}] END)::VARCHAR AS messages FROM rows WHERE reference IS NOT NULL),
good AS (SELECT * FROM told WHERE approved AND trim(reviewer) <> '' AND two AND trim(answer) <> '' AND NOT ({_any('messages')}) AND messages NOT IN (SELECT messages FROM told WHERE known))
SELECT id, reference, reviewer FROM (SELECT *, row_number() OVER (PARTITION BY messages ORDER BY id) AS rn FROM good) WHERE rn = 1""",
    "scan_report": f"""
WITH scanned AS MATERIALIZED {_SCANNED},
early AS (SELECT repo, path, content, CASE WHEN {_EXCLUDED} THEN 'excluded_path' WHEN {_LANG} IS NULL THEN 'none' WHEN strlen(content) > {MOST_BYTES} THEN 'oversized' WHEN contains(content, chr(0)) OR contains(substring(content, 1, 4096), 'DO NOT EDIT') OR contains(path, '.pb.go') OR contains(path, '.gen.') THEN 'none' END AS rule FROM scanned),
good AS MATERIALIZED (SELECT repo, path, content FROM early WHERE rule IS NULL),
hits AS MATERIALIZED ({findings_sql('good', 'repo, path')}),
rows AS (SELECT repo, path, rule, 1 AS n, NULL::INT AS first_line, NULL::INT AS last_line FROM early WHERE rule <> 'none'
  UNION ALL SELECT repo, path, 'accepted', 1, NULL, NULL FROM good WHERE NOT ({_any('content')})
  UNION ALL SELECT repo, path, rule, n, first_line, last_line FROM hits)
SELECT repo, path, rule, sum(n)::BIGINT AS n, min(first_line)::INT AS first_line, max(last_line)::INT AS last_line FROM rows GROUP BY ALL""",
    "catalog_validation": f"""
WITH rows AS (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'Page of ' || coalesce(source, 'none') ELSE 'Page ' || doc_id END AS title FROM documents),
slugs AS (SELECT {_SLUG.format(c='title')} AS slug, count(*) AS same FROM rows GROUP BY 1)
SELECT title, array_to_string(list_filter([
  CASE WHEN doc_id % 10 = 6 THEN 'missing_field' END, CASE WHEN doc_id % 7 = 1 OR doc_id % 13 = 3 THEN 'bad_url' END,
  CASE WHEN doc_id % 5 = 2 THEN 'title_mismatch' END,
  CASE WHEN doc_id % 6 = 4 THEN 'unknown_category' END, CASE WHEN doc_id % 9 = 5 THEN 'unknown_priority' END, CASE WHEN doc_id % 12 = 7 OR doc_id % 15 = 8 THEN 'bad_license_or_tags' END,
  CASE WHEN same > 1 THEN 'repeated_slug' END], lambda x: x IS NOT NULL), ',') AS errors FROM rows JOIN slugs ON slug = {_SLUG.format(c='title')}""",
    "html_blocks": f"""
WITH paras AS (SELECT doc_id, 'About ' || coalesce(doc_kind, 'none') AS section, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, doc_kind, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
clean AS (SELECT doc_id, section, i, {_collapse(f"regexp_replace({_collapse('p')}, '(?i)\\[{_WS}*(?:[0-9]+(?:{_WS}*[,–-]{_WS}*[0-9]+)*|citation needed|edit){_WS}*\\]', '', 'g')")} AS c FROM paras),
fit AS (SELECT *, row_number() OVER (PARTITION BY doc_id, replace(lower(c), 'ß', 'ss') ORDER BY i) AS rn FROM clean WHERE len(list_filter(string_split(c, ' '), lambda x: x <> '')) >= 5)
SELECT doc_id, section, sha256(c) AS digest FROM fit WHERE rn = 1""",
}
