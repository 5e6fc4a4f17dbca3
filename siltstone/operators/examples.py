"""Supervised examples from chunks of code, their review, and contexts for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siltstone.functions import screening
from siltstone.functions import text as tx

# Kinds of declarations examples are made of, calls that tell nothing, and what is evidence of a task.
KINDS = ["function", "method", "struct", "interface"]
TRIVIAL = ["fmt.Errorf", "errors.New", "string", "make"]
CONCURRENT = ["go_statement", "select_statement", "send_statement", "receive_statement"]
TRANSACTIONAL = ["Begin", "BeginTx", "Commit", "Rollback", "Transaction", "WithTransaction"]
FAILING = ["fmt.Errorf", "errors.New", "errors.Wrap", "errors.Is", "errors.As"]
MOST_CHARACTERS, FEWEST_LINES, FEWEST_CALLS, CALLS_PERCENT = 9000, 3, 3, 30
#: Characters of an answer that may be reviewed, and what is said in place of an unsafe one.
FEWEST_ANSWER, REFUSAL = 80, "The answer is withheld: it holds what looks like a secret."


def reference() -> Column:
    """`repo/path:start_line-end_line`."""
    return F.concat("repo", F.lit("/"), "path", F.lit(":"), F.col("start_line").cast("string"), F.lit("-"), F.col("end_line").cast("string"))


def eligible(chunks: DataFrame) -> DataFrame:
    """Go declarations that are neither too long nor too short."""
    return chunks.filter((F.col("code_lang") == "go") & F.col("symbol_type").isin(KINDS) & (F.length("content") <= MOST_CHARACTERS) & (F.size(tx.lines(F.col("content"))) >= FEWEST_LINES))


def examples(chunks: DataFrame) -> DataFrame:
    """(id, task, reference, messages): up to five examples of each eligible chunk, only what its facts support.

    One pass over the chunks; an example whose messages do not pass the screening is left out.
    """
    calls = F.coalesce("facts.calls", F.array().cast("array<string>"))
    constructs = F.coalesce("facts.constructs", F.array().cast("array<string>"))
    telling = F.filter(calls, lambda c: ~c.isin(TRIVIAL))
    quoted = lambda names: F.array_join(F.transform(names, lambda n: F.concat(F.lit("`"), n, F.lit("`"))), ", ")
    code = F.concat(F.lit("Source of "), F.col("reference"), F.lit(":\n```go\n"), F.col("content"), F.lit("\n```\n"))

    def example(task: str, when: Column, ask: str, answer: Column) -> Column:
        messages = F.array(F.struct(F.lit("user").alias("role"), F.concat(code, F.lit(ask)).alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
        return F.when(when, F.struct(F.lit(task).alias("task"), messages.alias("messages")))

    def evidence(task: str, found: Column) -> Column:
        return example(task, F.size(found) > 0, f"Which {task} constructs or calls are explicit here, and what do they show?", F.concat(F.lit("Visible here: "), quoted(found), F.lit(". That is syntax; what runs depends on what is called.")))

    sampled = (F.size(telling) >= FEWEST_CALLS) & tx.in_sample(F.concat(F.col("reference"), F.lit(":dependencies")), CALLS_PERCENT)
    doc = F.coalesce("facts.doc", F.lit(""))
    made = F.array_compact(
        F.array(
            example("dependencies", sampled, "What does it call directly?", F.concat(F.lit("It calls "), quoted(telling), F.lit(". What those call in turn is not visible here."))),
            example("function", doc != "", "What does its author say that it does?", F.concat(F.lit("The author says:\n"), doc, F.lit("\nThat is a claim, not a proof."))),
            evidence("concurrency", F.filter(constructs, lambda c: c.isin(CONCURRENT))),
            evidence("transactions", F.filter(calls, lambda c: tx.call_leaf(c).isin(TRANSACTIONAL))),
            evidence("errors", F.filter(calls, lambda c: c.isin(FAILING))),
        )
    )
    # the source stands in every prompt: it is screened once, before there are prompts, and only answers by themselves
    fit = eligible(chunks).withColumn("reference", reference()).filter("reference is not null").filter(screening.safe(F.concat(F.col("reference"), F.lit(":\n"), F.col("content"))))
    rows = fit.select("id", "reference", F.explode_outer(made).alias("e")).filter("e is not null").select("id", "e.task", "reference", "e.messages")
    return rows.filter(screening.safe(F.col("messages")[1]["content"]))


def valid_messages(messages: Column) -> Column:
    """Whether there are just two messages, a user's and an assistant's, neither blank nor unsafe."""
    roles = F.transform(messages, lambda m: m["role"])
    told = ~F.exists(messages, lambda m: m["content"].isNull() | (tx.collapse(m["content"]) == ""))
    return F.coalesce((roles == F.array(F.lit("user"), F.lit("assistant"))) & told & screening.safe(F.to_json(messages)), F.lit(False))


def messages_digest(messages: Column) -> Column:
    """A digest of messages as JSON."""
    return tx.digest(F.to_json(messages))


def import_reviewed(reviewed: DataFrame, existing: DataFrame, live: DataFrame) -> DataFrame:
    """Reviewed rows to add: approved by a named reviewer, valid, of a source that is still as it was, and not known.

    `live` has (reference, content_hash) of the sources as they are; an approved row of another state raises. Rows that
    equal each other or an existing one by their messages count once.
    """
    good = reviewed.filter(F.col("approved").eqNullSafe(F.lit(True)) & (F.trim(F.coalesce("reviewer", F.lit(""))) != ""))
    stale = good.join(live, ["reference", "content_hash"], "left_anti").limit(1).count()
    if stale:
        raise ValueError("an approved row is of a source that has changed")
    rows = good.filter(valid_messages(F.col("messages"))).withColumn("_fp", messages_digest(F.col("messages")))
    known = existing.select(messages_digest(F.col("messages")).alias("_fp")).distinct()
    w = Window.partitionBy("_fp").orderBy("id")
    return rows.join(known, "_fp", "left_anti").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_fp")


def pack_context(chunks: DataFrame, budget: int = 12_000) -> DataFrame:
    """(id, context_ids, used): for each chunk, others of its directory as far as they fit into `budget` characters.

    Tests come first, then by path and line; one that does not fit is passed over, and later ones may still. Empty
    chunks are no context. A directory's chunks are represented by their lengths, and each chunk folds over them.
    """
    module = F.concat("repo", F.lit("/"), tx.parent(F.col("path")))
    one = chunks.filter("content is not null and id is not null").groupBy("id").agg(F.min(F.struct("repo", "path", "start_line", "content")).alias("c")).select("id", "c.*")
    sized = one.select("id", module.alias("module"), (~F.contains("path", F.lit("_test."))).alias("later"), "path", "start_line", F.length("content").alias("n"))
    # once a text of some length did not fit, no later one of that length does: of each length, only the first that
    # fill the budget count, and one more for the chunk itself. So a directory's list is bounded, however large it is
    w = Window.partitionBy("module", "n").orderBy("later", "path", "start_line", "id")
    near = sized.filter((F.col("n") <= budget) & (F.col("n") > 0)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.floor(F.lit(budget) / F.col("n")) + 1)
    others = near.groupBy("module").agg(F.array_sort(F.collect_list(F.struct("later", "path", "start_line", "id", "n"))).alias("list"))

    def step(state: Column, x: Column) -> Column:
        take = (x["id"] != F.col("id")) & (state["used"] + x["n"] <= budget)
        return F.when(take, F.struct((state["used"] + x["n"]).alias("used"), F.concat(state["ids"], F.array(x["id"])).alias("ids"))).otherwise(state)

    zero = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("ids"))
    packed = sized.join(others, "module", "left").select("id", F.aggregate(F.coalesce("list", F.array().cast("array<struct<later:boolean,path:string,start_line:int,id:string,n:int>>")), zero, step).alias("s"))
    return packed.select("id", F.col("s.ids").alias("context_ids"), F.col("s.used").alias("used"))


def task_cycle(chunks: DataFrame, key: str, tasks: list[str], limit: int) -> DataFrame:
    """(n, key, task): the first `limit` of all tasks for the first chunk, all for the second, and so on, by `key`."""
    need = -(-limit // len(tasks))
    # the limit is the feature: no more chunks are needed
    first = chunks.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key).limit(need)
    each = first.select(key, F.posexplode(F.array(*map(F.lit, tasks))).alias("t", "task"))
    w = Window.orderBy(key, "t")
    return each.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= limit).select("n", key, "task")


def per_file_questions(chunks: DataFrame, limit: int = 30) -> DataFrame:
    """(file_key, id, question): a question about the first named declaration of each of the first `limit` files."""
    fit = chunks.filter(F.col("symbol_type").isin(KINDS) & F.col("symbol").isNotNull())
    first = fit.groupBy("file_key").agg(F.min(F.struct("start_line", "id", "symbol")).alias("c"))
    return first.orderBy("file_key").limit(limit).select("file_key", "c.id", F.concat(F.lit("Where is "), "c.symbol", F.lit(" declared?")).alias("question"))


def teacher_answers(candidates: DataFrame) -> DataFrame:
    """The rows (.., reference, answer) whose answer may be reviewed: long enough, citing its source, and safe."""
    answer = tx.collapse_ends(F.coalesce("answer", F.lit("")))
    return candidates.filter((F.length(answer) >= FEWEST_ANSWER) & F.contains(answer, F.col("reference")) & screening.safe(answer)).withColumn("answer", answer)


def ask_teacher(prompts: DataFrame, model: Callable[[list[str]], list[str]]) -> DataFrame:
    """`prompts` (.., prompt, reference) with the `answer` of a model, as far as it may be reviewed.

    `model` is any function of a list of prompts, called where the rows are, in batches; nothing here opens connections.
    """
    schema = T.StructType([*prompts.schema.fields, T.StructField("answer", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(answer=model(batch["prompt"].tolist()))

    return teacher_answers(prompts.mapInPandas(run, schema))


def check_training_data(rows: DataFrame) -> int:
    """How many rows (messages) a training gets; raises where there are none, or one that no training should see.

    Each has two messages at least, none blank, the last of them the assistant's, and is safe.
    """
    m = F.col("messages")
    told = ~F.exists(m, lambda x: x["content"].isNull() | (tx.collapse(x["content"]) == ""))
    good = F.coalesce((F.size(m) >= 2) & (F.element_at(m, -1)["role"] == "assistant") & told & screening.safe(F.array_join(F.transform(m, lambda x: x["content"]), "\n")), F.lit(False))
    counts = rows.agg(F.count("*").alias("n"), F.count_if(~good).alias("bad")).first()
    if not counts["n"] or counts["bad"]:
        raise ValueError(f"{counts['bad']} of {counts['n']} rows cannot be trained on")
    return counts["n"]


def fit_length(rows: DataFrame, most_tokens: int, without: DataFrame | None = None) -> DataFrame:
    """Rows (messages) of at most `most_tokens` estimated tokens, with `answer_at`, where the last message begins.

    What stands before `answer_at` is not learned. Rows whose messages are those of `without` are left out.
    """
    sizes = F.transform("messages", lambda m: tx.piece_count(m["content"]))
    pieces = F.aggregate(sizes, F.lit(0), lambda a, n: a + n)
    head = F.aggregate(F.slice(sizes, 1, F.size("messages") - 1), F.lit(0), lambda a, n: a + n)
    out = rows.withColumn("tokens", F.greatest(F.lit(1), F.floor(pieces * 4 / 3).cast("int"))).withColumn("answer_at", F.floor(head * 4 / 3).cast("int")).filter(F.col("tokens") <= most_tokens)
    if without is None:
        return out
    known = without.select(messages_digest(F.col("messages")).alias("_fp")).distinct()
    return out.withColumn("_fp", messages_digest(F.col("messages"))).join(known, "_fp", "left_anti").drop("_fp")


def pack_answer_context(hits: DataFrame, budget: int) -> DataFrame:
    """(query_id, context_ids, used): of each query's hits (query_id, rank, id, content) whole chunks in order of rank,
    as far as they fit into `budget` estimated tokens; one that does not fit is passed over. Hits are few by nature."""
    listed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", tx.estimated_tokens(F.col("content")).alias("n")))).alias("list"))
    zero = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("ids"))
    step = lambda s, x: F.when(s["used"] + x["n"] <= budget, F.struct((s["used"] + x["n"]).alias("used"), F.concat(s["ids"], F.array(x["id"].cast("string"))).alias("ids"))).otherwise(s)
    return listed.select("query_id", F.aggregate("list", zero, step).alias("s")).select("query_id", F.col("s.ids").alias("context_ids"), F.col("s.used").alias("used"))


def screened_answers(answers: DataFrame, column: str = "answer") -> DataFrame:
    """Answers with a refusal in place of what is unsafe."""
    return answers.withColumn(column, F.when(screening.safe(F.col(column)), F.col(column)).otherwise(F.when(F.col(column).isNotNull(), F.lit(REFUSAL))))
