"""Facts from articles, evidence from code, and records that join the two."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions import screening
from siltstone.functions import text as tx
from siltstone.operators.components import components
from siltstone.operators.dedup import first_by
from siltstone.runtime import cut

FEWEST_WORDS, MOST_WORDS, MOST_FACTS = 8, 120, 3
BEFORE, AFTER = 2, 5


@dataclass(frozen=True)
class Rule:
    """What calls are evidence of a pattern: by what they name last, by the whole call or its end, by what the call
    holds in lower case, by the path, by the content; `observation` says what the call shows."""

    pattern: str
    families: tuple[str, ...]
    observation: str = ""
    leaves: tuple[str, ...] = ()
    calls: tuple[str, ...] = ()
    ends: str = ""
    path_has: str = ""
    call_has: str = ""
    content_has: str = ""


# Patterns, the families they belong to and the calls that show them, the first that applies counts.
RULES = (
    Rule("domain_event", ("event_sourcing", "ddd"), "a change is applied as an event of an aggregate", leaves=("ApplyChange",), path_has="/aggregates/"),
    Rule("projection_apply", ("cqrs", "event_sourcing"), "an event is applied to a projection", ends="projection.Apply"),
    Rule("snapshot_read", ("event_sourcing",), "a snapshot is read", leaves=("ReadSnapshot",), path_has="/eventstore/"),
    Rule("snapshot_write", ("event_sourcing",), "a snapshot is written", leaves=("CreateSnapshot",), path_has="/eventstore/"),
    Rule("version_check", ("event_sourcing",), "a version is compared before it is replaced", leaves=("CheckAndUpdateVersion",), path_has="/eventstore/"),
    Rule("aggregate_load", ("event_sourcing", "cqrs", "ddd"), "an aggregate is loaded from the store of events", leaves=("Get",), call_has="eventstore"),
    Rule("outbox_write", ("outbox", "atomicity", "messaging", "consistency"), "a message is put into an outbox", leaves=("CreateOutbox",)),
    Rule("event_publish", ("messaging", "outbox", "consistency", "retry"), "a message is handed to a broker", leaves=("ProduceRawWithKey", "Publish", "Produce")),
    Rule("hmac_construction", ("authentication", "replay", "security"), "a keyed digest is set up", calls=("hmac.New",)),
    Rule("stable_refund_key", ("idempotency", "retry", "payment"), "a key is derived from a name, so it is the same each time", calls=("uuid.NewSHA1",), content_has="refundCode"),
    Rule("aggregate_save", ("concurrency", "atomicity", "consistency", "callbacks", "reconciliation", "payment"), "an aggregate is saved to the store of events", leaves=("Save",), call_has="eventstore"),
    Rule("callback_record", ("callbacks", "idempotency", "concurrency", "payment"), "a callback of a partner is recorded", leaves=("RecordPartnerCallBack",)),
    Rule("redis_queue_client", ("resilience", "retry", "messaging"), "a client of a work queue is made", calls=("asynq.NewClient",)),
    Rule("provider_query", ("reconciliation", "consistency", "settlement", "payment"), "a partner is asked for a state", leaves=("QueryRefundStatus", "QueryPaymentStatus", "QueryOrderStatus", "CheckRefundStatus")),
    Rule("callback_decode", ("callbacks", "authentication", "replay", "security"), "what a callback brings is decoded", leaves=("ProcessResultData",)),
)


def useful_facts(blocks: DataFrame, key: list[str], content: str, words: str) -> DataFrame:
    """(key, facts): the first MOST_FACTS sentences of fit length that match `words` and are safe; none, no row."""
    fit = lambda s: (F.size(tx.words(s)) >= FEWEST_WORDS) & (F.size(tx.words(s)) <= MOST_WORDS) & F.regexp_like(s, F.lit(words)) & screening.safe_prose(s)
    return blocks.select(*key, F.slice(F.filter(tx.sentences(F.col(content)), fit), 1, MOST_FACTS).alias("facts")).filter("size(facts) > 0")


def _applies(rule: Rule, call: Column) -> Column:
    out = F.lit(True)
    if rule.leaves:
        out = out & tx.call_leaf(call).isin(*rule.leaves)
    if rule.calls:
        out = out & call.isin(*rule.calls)
    if rule.ends:
        out = out & F.endswith(call, F.lit(rule.ends))
    if rule.path_has:
        out = out & F.contains("path", F.lit(rule.path_has))
    if rule.call_has:
        out = out & F.contains(F.lower(call), F.lit(rule.call_has))
    if rule.content_has:
        out = out & F.contains("content", F.lit(rule.content_has))
    return out


def evidence(chunks: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(evidence_id, repo, path, symbol, start_line, end_line, commit_hash, pattern, call, families, observation,
    snippet, snippet_hash, reference): calls that show a pattern, with the lines around the first that is no comment.

    The first rule that applies to a call counts. Go functions and methods only; no tests, mocks or generated files,
    and nothing unsafe or private. Of equal snippets of a pattern, the first by place stays.
    """
    fit = (F.col("code_lang") == "go") & F.col("symbol_type").isin("function", "method") & F.col("content").isNotNull()
    fit = fit & ~F.endswith("path", F.lit("_test.go")) & ~F.contains("path", F.lit("/mocks/")) & ~F.contains(F.substring("content", 1, 500), F.lit("Code generated"))
    shown = F.lit(None)
    for rule in reversed(rules):
        told = F.struct(F.lit(rule.pattern).alias("pattern"), F.array(*map(F.lit, rule.families)).alias("families"), F.lit(rule.observation).alias("observation"))
        shown = F.when(_applies(rule, F.col("call")), told).otherwise(shown)
    rows = chunks.filter(fit).select("id", "repo", "path", "symbol", "start_line", "commit_hash", "content", F.explode_outer("facts.calls").alias("call"))
    rows = rows.withColumn("shown", shown).filter("shown is not null").filter(screening.safe_prose(F.col("content")))
    first = F.try_element_at(F.array_compact(F.transform("ls", lambda line, i: F.when(F.contains(line, F.concat("call", F.lit("("))) & ~F.startswith(tx.collapse_ends(line), F.lit("//")), i))), F.lit(1))
    rows = rows.withColumn("ls", tx.lines(F.col("content"))).withColumn("at", first).filter("at is not null")
    low, high = F.greatest(F.col("at") - BEFORE, F.lit(0)), F.least(F.col("at") + AFTER, F.size("ls"))
    rows = rows.select("id", "repo", "path", "symbol", "commit_hash", "call", "shown.*", (F.col("start_line") + low).alias("start_line"), (F.col("start_line") + high - 1).alias("end_line"), F.array_join(F.slice("ls", low + 1, high - low), "\n").alias("snippet"))
    rows = rows.withColumn("_fp", tx.fingerprint(F.col("snippet")))
    rows = first_by(rows, ["pattern", "_fp"], ["repo", "path", "start_line", "call", "id"])
    name = tx.digest(F.concat_ws("|", "id", "pattern", "call", tx.digest(F.col("snippet"))))
    reference = F.concat("repo", F.lit("/"), "path", F.lit(":"), F.col("start_line"), F.lit("-"), F.col("end_line"))
    return rows.select(name.alias("evidence_id"), "repo", "path", "symbol", "start_line", "end_line", "commit_hash", "pattern", "call", "families", "observation", "snippet", tx.digest(F.col("snippet")).alias("snippet_hash"), reference.alias("reference"))


def family_counts(found: DataFrame, wanted: list[str]) -> DataFrame:
    """(family, n): evidence of each family, 0 for those wanted that have none."""
    spark: SparkSession = found.sparkSession
    have = found.select(F.explode("families").alias("family")).groupBy("family").agg(F.count("*").alias("n"))
    names = spark.createDataFrame([(f,) for f in wanted], "family string")
    return names.join(have, "family", "full_outer").select("family", F.coalesce("n", F.lit(0)).alias("n"))


def best_fact(questions: DataFrame, facts: DataFrame, preferred_section: str = "Overview") -> DataFrame:
    """(question_id, fact_id): of the facts of a question's family the one from its preferred title, then section, with
    most of its key words, and the least id."""
    hits = F.size(F.filter("keywords", lambda w: F.contains(F.lower("content"), w)))
    rank = F.struct((~F.col("title").eqNullSafe(F.col("preferred_title"))).alias("a"), (F.col("section") != preferred_section).alias("b"), (-hits).alias("c"), F.col("fact_id").alias("d"))
    return questions.join(facts, "family").groupBy("question_id").agg(F.min_by("fact_id", rank).alias("fact_id"))


def least_used(questions: DataFrame, found: DataFrame, per_question: int = 1) -> DataFrame:
    """(question_id, evidence_id): questions in the order of their ids, each taking of what it may take the
    `per_question` that were taken least so far; ties go to the lesser id.

    `questions` has (question_id, pattern), several rows where a question has several patterns; `found` has
    (evidence_id, pattern), several where evidence shows several. What earlier questions took decides, whatever they
    took it for, so it is a fold; questions that have no evidence in common, directly or over others, are folded apart.
    Of a pattern with much evidence only the first by id can ever be taken: before any is taken twice, all questions
    together take `per_question` times their number. So the fold's size hangs on the questions, not on the evidence.
    """
    if not 1 <= per_question <= 5:
        raise ValueError("per_question must be from 1 to 5")
    asked = cut(questions.select("question_id", "pattern").filter("question_id is not null and pattern is not null").distinct(), "asked")
    reach = per_question * asked.select("question_id").distinct().count()
    w = Window.partitionBy("pattern").orderBy("evidence_id")
    near = found.select("pattern", "evidence_id").filter("evidence_id is not null").distinct().withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= reach)
    may = cut(asked.join(near, "pattern").select("question_id", "evidence_id").distinct(), "may")
    ends = may.select(F.concat(F.lit("q"), F.col("question_id").cast("string")).alias("a"), F.concat(F.lit("e"), F.col("evidence_id").cast("string")).alias("b"))
    roots = components(ends, "a", "b").filter(F.startswith("vertex", F.lit("q"))).select(F.col("vertex").alias("_q"), "root")
    rows = may.withColumn("_q", F.concat(F.lit("q"), F.col("question_id").cast("string"))).join(roots, "_q").select("root", "question_id", "evidence_id")
    kinds = {c: may.schema[c].dataType.simpleString() for c in ("question_id", "evidence_id")}

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        taken: dict = {}
        out = []
        for question, ids in group.groupby("question_id", sort=True)["evidence_id"]:
            for e in sorted(ids, key=lambda e: (taken.get(e, 0), e))[:per_question]:
                taken[e] = taken.get(e, 0) + 1
                out.append((question, e))
        return pd.DataFrame(out, columns=["question_id", "evidence_id"])

    return rows.groupBy("root").applyInPandas(fold, f"question_id {kinds['question_id']}, evidence_id {kinds['evidence_id']}")


def process_report(pages: DataFrame, chunks: DataFrame, knowledge: DataFrame) -> DataFrame:
    """(pages, chunks, useful, skipped): how many pages (each page_id once), chunks, and chunks with and without facts."""
    counts = pages.agg(F.count_distinct("page_id").alias("pages"))
    useful = chunks.select("chunk_id").distinct().join(knowledge.select("chunk_id", F.lit(1).alias("one")).distinct(), "chunk_id", "left")
    # one row each
    return counts.crossJoin(useful.agg(F.count("*").alias("chunks"), F.count("one").alias("useful"), (F.count("*") - F.count("one")).alias("skipped")))
