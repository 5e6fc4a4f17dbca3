"""What tools and the command line call: each a DataFrame, or files written from one."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import dedup, evaluation, examples, retrieval, splits
from siltstone.runtime import session
from siltstone.sources import files as sources
from siltstone.sources import sinks
from siltstone.streaming.index import Index, parse

#: What an architecture question is asked with besides its own words.
ARCHITECTURE_WORDS = "architecture event transaction outbox projection"
TASKS = ["explain", "test", "review", "document"]


def _ask(index: Index, query: str, k: int, mode: str = "hybrid") -> DataFrame:
    return index.search(index.spark.createDataFrame([(0, query)], "query_id int, query string"), k, mode)


def search_code(index: Index, query: str, k: int = 5, mode: str = "hybrid") -> DataFrame:
    return _ask(index, query, k, mode)


def find_symbol(index: Index, symbol: str) -> DataFrame:
    return index.find_symbol(symbol)


def architecture_context(index: Index, query: str) -> DataFrame:
    return _ask(index, f"{query} {ARCHITECTURE_WORDS}", 8)


def similar_implementation(index: Index, code: str) -> DataFrame:
    return _ask(index, code, 8)


def context_of(index: Index, query: str, budget: int = 2000) -> DataFrame:
    """The chunks for an answer to `query` that fit together into `budget` estimated tokens."""
    hits = _ask(index, query, 5).join(index.read("chunks").select("id", "content"), "id")
    return examples.pack_answer_context(hits, budget)


def answer(index: Index, query: str, model: Callable[[str], str], budget: int = 2000) -> str:
    """What a model says to `query` and its context; an answer that holds what looks like a secret is withheld."""
    spark = index.spark
    ids = context_of(index, query, budget).select(F.explode("context_ids").alias("id"))
    # a handful of chunks within the budget
    parts = [r["content"] for r in index.read("chunks").join(ids, "id").orderBy("id").select("content").collect()]
    said = model("\n\n".join([*parts, query]))
    return examples.screened_answers(spark.createDataFrame([(said,)], "answer string")).first()["answer"]


# --- jobs ------------------------------------------------------------------------------------------------------------


def scan_workspace(spark: SparkSession, settings: sources.Settings, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, report) of all repositories of a workspace."""
    found = [sources.scan_repository(spark, r, settings.most_bytes) for r in sources.discover(settings.workspace)]
    if not found:
        raise ValueError(f"no repository in {settings.workspace}")
    accepted, report = found[0]
    for a, r in found[1:]:
        accepted, report = accepted.unionByName(a), report.unionByName(r)
    return (sources.first_files(accepted, limit) if limit else accepted), report


def build_dataset(files: DataFrame, folder: str, fraction: float = 0.15) -> None:
    """Examples of all files, split by modules that share no text, written with their provenance.

    Of chunks with the same text, whatever its white space, the first by place makes examples.
    """
    chunks = parse(files, "report").filter("symbol_type <> 'syntax_error'")
    split = splits.module_split(files, chunks, fraction)
    first = dedup.exact(chunks.filter("content is not null"), "content", ["file_key", "start_line", "id"])
    made = examples.examples(first).join(first.select("id", "file_key"), "id")
    sinks.export_dataset(made, split, folder)


def teacher_prompts(files: DataFrame, limit: int) -> DataFrame:
    """(n, id, task, reference, prompt, context_ids): the first `limit` tasks for a teacher, with other chunks of the
    directory as context."""
    chunks = parse(files, "report").filter("symbol_type <> 'syntax_error'")
    tasks = examples.task_cycle(chunks, "id", TASKS, limit)
    rows = chunks.withColumn("reference", examples.reference()).select("id", "reference", "content")
    prompt = F.concat("task", F.lit(" the following, citing "), "reference", F.lit(":\n"), "content")
    return tasks.join(rows, "id").join(examples.pack_context(chunks), "id").select("n", "id", "task", "reference", prompt.alias("prompt"), "context_ids")


def import_reviewed(spark: SparkSession, reviewed: str, existing: str, files: DataFrame, schema: str) -> DataFrame:
    """Reviewed rows (JSON lines) to add to existing ones, of sources that are as they were."""
    chunks = parse(files, "report").filter("symbol_type <> 'syntax_error'").withColumn("reference", examples.reference())
    live = chunks.select("reference", F.sha2("content", 256).alias("content_hash"))
    return examples.import_reviewed(sources.read_json_lines(spark, reviewed, schema), sources.read_json_lines(spark, existing, schema), live)


def evaluate(index: Index, cases: DataFrame, k: int = 5) -> DataFrame:
    """(cases, recall): mean recall of cases (case_id, question, file_key) over the files of the first `k` results."""
    asked = cases.select(F.col("case_id").alias("query_id"), F.col("question").alias("query")).distinct()
    hits = index.search(asked, k).join(index.read("chunks").select("id", "file_key"), "id")
    found = retrieval.recall(cases.select("case_id", "file_key"), hits.select(F.col("query_id").alias("case_id"), "file_key", "rank"), k)
    return found.agg(F.count("*").alias("cases"), F.round(F.avg("recall"), 6).alias("recall"))


def training_config(rows: DataFrame, template: Mapping, overrides: Mapping | None = None) -> dict:
    """The settings of a training: a template with overrides of known names, once its data have been checked."""
    unknown = set(overrides or {}) - set(template)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return {**template, **(overrides or {}), "rows": examples.check_training_data(rows)}


# --- command line ----------------------------------------------------------------------------------------------------


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="siltstone")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("scan", "index", "dataset", "teacher"):
        one = commands.add_parser(name)
        one.add_argument("--workspace", default=".")
        one.add_argument("--limit", type=int)
        one.add_argument("--out", required=True)
    for name in ("search", "architecture", "similar", "context"):
        one = commands.add_parser(name)
        one.add_argument("text")
        one.add_argument("--index", required=True)
        one.add_argument("-k", type=int, default=5)
        one.add_argument("--mode", choices=retrieval.MODES, default="hybrid")
    one = commands.add_parser("find-symbol")
    one.add_argument("text")
    one.add_argument("--index", required=True)
    one = commands.add_parser("evaluate")
    one.add_argument("cases")
    one.add_argument("--index", required=True)
    one.add_argument("-k", type=int, default=5)
    one = commands.add_parser("summarize")
    one.add_argument("responses")
    return parser


RESPONSES = "variant string, reviewer string, supported int, unsupported int, contradicted int, location_accuracy double, latency_seconds double, source_accuracy double"


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """scan, index, dataset and teacher over a workspace; searches, find-symbol and evaluate over an index; summarize."""
    args = _arguments().parse_args(argv)
    spark = spark or session()
    show = lambda df: [print(row) for row in df.toJSON().collect()]
    if args.command in ("scan", "index", "dataset", "teacher"):
        if args.limit is not None and args.limit < 1:
            raise SystemExit("--limit must be at least 1")
        settings = sources.Settings(workspace=args.workspace)
        accepted, report = scan_workspace(spark, settings, args.limit if args.command != "teacher" else None)
        if args.command == "scan":
            sinks.write_json_lines(report, f"{args.out}/report")
            sinks.write_json_lines(accepted.drop("content"), f"{args.out}/manifest")
        elif args.command == "index":
            index = Index(spark, args.out)
            try:
                print(json.dumps(vars(index.update(accepted))))
            finally:
                index.close()
        elif args.command == "dataset":
            build_dataset(accepted, args.out)
        else:
            sinks.write_json_lines(teacher_prompts(accepted, args.limit or 14), args.out)
        return
    if args.command == "summarize":
        show(evaluation.variant_summary(sources.read_json_lines(spark, args.responses, RESPONSES)))
        return
    index = Index(spark, args.index, write=False)
    if args.command == "find-symbol":
        show(find_symbol(index, args.text))
    elif args.command == "evaluate":
        show(evaluate(index, sources.read_json_lines(spark, args.cases, "case_id string, question string, file_key string"), args.k))
    elif args.command == "search":
        show(search_code(index, args.text, args.k, args.mode))
    else:
        show({"architecture": architecture_context, "similar": similar_implementation, "context": context_of}[args.command](index, args.text))


if __name__ == "__main__":
    main()
