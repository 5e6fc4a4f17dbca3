"""Records that join facts of articles with evidence from code: compatible pairs, their texts, and what is wrong with any.

Scenarios, facts and evidence are tables that a project brings; nothing of their contents is fixed here.

* scenarios: (position, scenario_id, family, kind, question, premise, reasoning, test, patterns, needs, avoids,
  call_ends). `needs` and `avoids` are words of which one must, or none may, stand in symbol and path.
* facts: (fact_id, family, title, section, url, revision, license, attribution, content, facts).
* evidence: as `knowledge.evidence` gives it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import screening
from siltstone.functions import text as tx
from siltstone.operators import components, dedup, evaluation, knowledge, retrieval, splits
from siltstone.runtime import cut

SCENARIOS = "position int, scenario_id string, family string, kind string, question string, premise string, reasoning string, test string, patterns array<string>, needs array<string>, avoids array<string>, call_ends string"
#: Characters that every text of a record has at least.
FEWEST = 25
#: Marks of what is supposed and what is concluded, which keep both apart from facts.
SUPPOSED, CONCLUDED, APPLIED = "Supposed case", "Conclusion for that case", " Apply it to "
#: What a record tells of its source, and the column of the facts that it must equal.
SOURCE_FIELDS = {"source_title": "title", "source_url": "url", "source_revision": "revision", "section": "section", "license": "license", "attribution": "attribution"}


def compatible() -> Column:
    """Whether a row of scenario and evidence columns fits: the pattern, the words of the place, the end of the call."""
    place = F.lower(F.concat_ws(" ", "symbol", "path"))
    has = lambda words: F.exists(words, lambda w: F.contains(place, w))
    none = F.array().cast("array<string>")
    needs, avoids = F.coalesce("needs", none), F.coalesce("avoids", none)
    return F.coalesce(F.array_contains("patterns", F.col("pattern")) & ((F.size(needs) == 0) | has(needs)) & ~has(avoids) & F.endswith("call", F.coalesce("call_ends", F.lit(""))), F.lit(False))


def compatible_pairs(scenarios: DataFrame, found: DataFrame) -> DataFrame:
    """(scenario_id, position, evidence_id) of the pairs of one family that fit.

    Scenarios are the small side by their nature; the planner broadcasts them where they are.
    """
    each = found.withColumn("family", F.explode("families"))
    return each.join(scenarios.select("scenario_id", "position", "family", "patterns", "needs", "avoids", "call_ends"), "family").filter(compatible()).select("scenario_id", "position", "evidence_id").distinct()


def _texts(linked: Column) -> tuple[Column, Column, Column]:
    """(instruction, input, output) from the columns of a scenario, its fact and its evidence."""
    place = F.concat(F.lit("`"), "symbol", F.lit("` in `"), "repo", F.lit("/"), "path", F.lit("`."))
    instruction = F.concat("question", F.when(linked, F.concat(F.lit(APPLIED), place)).otherwise(""))
    code = F.concat(F.lit("\n\nCode at "), "reference", F.lit(":\n```go\n"), "snippet", F.lit("\n```"))
    given = F.concat(F.lit(f"{SUPPOSED}: "), "premise", F.lit("\n\nFacts from "), "title", F.lit(", "), "section", F.lit(":\n"), F.array_join("facts", " "), F.when(linked, code).otherwise(""))
    seen = F.when(linked, F.concat(F.lit("Seen in the code: "), "observation", F.lit(" ["), "reference", F.lit("]\n\n"))).otherwise("")
    output = F.concat(F.lit("Fact: "), F.get("facts", F.lit(0)), F.lit("\n\n"), seen, F.lit(f"{CONCLUDED}: "), "reasoning", F.lit("\n\nTo be verified: "), "test")
    return instruction, given, output


def build_records(scenarios: DataFrame, facts: DataFrame, found: DataFrame, per_scenario: int = 2) -> DataFrame:
    """(record_id, instruction, input, output, fact_id, family, the source fields, source_facts, scenario_id, kind,
    scenario_premise, interpretation, linked, evidence_id, snippet_hash).

    Each scenario of a family with facts gives a record without code, and one for each of the `per_scenario` evidence
    that was used least before, in the order of the scenarios' positions. Its fact is the best of its family: see
    `knowledge.best_fact`, with the columns preferred_title, preferred_section and keywords, if the scenarios have them.
    """
    have = set(scenarios.columns)
    hints = {"preferred_title": F.lit(None).cast("string"), "keywords": F.array().cast("array<string>")}
    asked = scenarios.select(F.col("scenario_id").alias("question_id"), "family", *[F.col(c) if c in have else v.alias(c) for c, v in hints.items()])
    best = knowledge.best_fact(asked, facts.select("fact_id", "family", "title", "section", "content")).withColumnRenamed("question_id", "scenario_id")
    chosen = scenarios.join(best, "scenario_id").join(facts.drop("family"), "fact_id")
    pairs = compatible_pairs(scenarios, found)
    # a pair is allowed by itself: the scenario stands for its own pattern, and its evidence shows it
    order = F.struct("position", "scenario_id")
    took = knowledge.least_used(
        pairs.select(F.format_string("%012d|%s", "position", "scenario_id").alias("question_id"), F.col("scenario_id").alias("pattern")),
        pairs.select("evidence_id", F.col("scenario_id").alias("pattern")),
        per_scenario,
    ).select(F.split_part("question_id", F.lit("|"), F.lit(2)).alias("scenario_id"), "evidence_id")
    code = took.join(found, "evidence_id").select("scenario_id", "evidence_id", "repo", "path", "symbol", "reference", "snippet", "snippet_hash", "observation")
    bare = chosen.select("scenario_id", *[F.lit(None).cast(code.schema[c].dataType).alias(c) for c in code.columns if c != "scenario_id"])
    rows = chosen.join(code.unionByName(bare), "scenario_id").withColumn("linked", F.col("evidence_id").isNotNull()).withColumn("_order", order)
    instruction, given, output = _texts(F.col("linked"))
    texts = rows.withColumns({"instruction": instruction, "input": given, "output": output})
    source = [F.col(column).alias(name) for name, column in SOURCE_FIELDS.items()]
    return texts.select(tx.digest(F.concat("instruction", "input", "output")).alias("record_id"), "instruction", "input", "output", "fact_id", "family", *source, F.col("facts").alias("source_facts"), "scenario_id", "kind", F.col("premise").alias("scenario_premise"), F.col("reasoning").alias("interpretation"), "linked", "evidence_id", "snippet_hash")


def gaps(scenarios: DataFrame, facts: DataFrame, records: DataFrame) -> DataFrame:
    """(scenario_id, reason): scenarios without facts (`no_facts`), or without code (`no_evidence`)."""
    known = facts.select("family").distinct().withColumn("known", F.lit(True))
    linked = records.filter("linked").select("scenario_id").distinct().withColumn("linked", F.lit(True))
    rows = scenarios.select("scenario_id", "family").join(known, "family", "left").join(linked, "scenario_id", "left")
    return rows.select("scenario_id", F.when(F.col("known").isNull(), "no_facts").when(F.col("linked").isNull(), "no_evidence").alias("reason")).filter("reason is not null")


def record_errors(records: DataFrame, scenarios: DataFrame, facts: DataFrame, found: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(record_id, errors): what is wrong with each record, none an empty list.

    A record is checked against its fact, its scenario and its evidence as they are now; what was made by
    `build_records` from them has no errors. Records too short for anything else, or of unknown facts, are not checked
    further. Columns of the records named in `keep` come out too.
    """
    short = lambda c: F.length(tx.collapse(F.coalesce(c, F.lit("")))) < FEWEST
    # a record's own columns are told from those it is checked against
    rows = records.select([F.col(c).alias(f"r_{c}") for c in records.columns])
    rows = rows.join(facts.withColumnRenamed("family", "fact_family").withColumn("has_fact", F.lit(True)), F.col("r_fact_id") == F.col("fact_id"), "left")
    rows = rows.join(scenarios.withColumn("has_scenario", F.lit(True)), F.col("r_scenario_id") == F.col("scenario_id"), "left")
    live = found.select("evidence_id", "repo", "path", "symbol", "pattern", "call", "families", "observation", "snippet", "reference", F.col("snippet_hash").alias("live_hash"))
    rows = rows.join(live, F.col("r_evidence_id") == F.col("evidence_id"), "left")
    trivial = short("r_instruction") | short("r_input") | short("r_output")
    linked, alive = F.col("r_evidence_id").isNotNull(), F.col("evidence_id").isNotNull()
    scenario, fact = F.col("has_scenario").isNotNull(), F.col("has_fact").isNotNull()
    fresh = alive & F.col("live_hash").eqNullSafe(F.col("r_snippet_hash"))
    within = lambda a, b: F.coalesce(F.contains(b, a), F.lit(False))
    quoted = F.forall("r_source_facts", lambda f: within(f, F.col("content")) & within(f, F.col("r_input")))
    when = lambda condition, name: F.when(F.coalesce(condition, F.lit(False)), name)
    instruction, given, output = _texts(linked)
    again = F.col("r_instruction").eqNullSafe(instruction) & F.col("r_input").eqNullSafe(given) & F.col("r_output").eqNullSafe(output)
    sensitive = when(~screening.safe_prose(F.concat_ws("\n", "r_instruction", "r_input", "r_output")), "sensitive_content")
    errors = [
        when(~F.col("r_family").eqNullSafe(F.col("fact_family")), "source_concept_mismatch"),
        *[when(~F.col(f"r_{name}").eqNullSafe(F.col(column)), f"source_metadata_mismatch:{name}") for name, column in SOURCE_FIELDS.items()],
        when(F.coalesce(F.size("r_source_facts"), F.lit(0)) <= 0, "unsupported_source_fact"),
        when((F.size("r_source_facts") > 0) & ~quoted, "unsupported_source_fact"),
        when(~scenario | ~F.col("r_interpretation").eqNullSafe(F.col("reasoning")) | ~within(F.col("reasoning"), F.col("r_output")), "unreviewed_engineering_interpretation"),
        when(~F.contains("r_input", F.lit(SUPPOSED)) | ~F.contains("r_output", F.lit(CONCLUDED)), "facts_and_interpretation_not_separated"),
        when(~F.col("r_linked").eqNullSafe(linked), "incorrect_linked_flag"),
        when(alive & scenario & ~compatible(), "scenario_pattern_mismatch"),
        when(linked & ~fresh, "stale_or_fabricated_code"),
        when(fresh & ~(within(F.col("snippet"), F.col("r_input")) & within(F.col("reference"), F.col("r_output")) & within(F.col("observation"), F.col("r_output"))), "decorative_code_reference"),
        when(fresh & ~F.array_contains("families", F.col("r_family")), "unrelated_code_pattern"),
        when(scenario & ~F.col("r_scenario_premise").eqNullSafe(F.col("premise")), "changed_scenario_premise"),
    ]
    first = F.array_compact(F.array(sensitive, *errors))
    # only what is right in all else is compared with what would be made from the same
    provenance = F.col("r_kind").eqNullSafe(F.col("kind")) & F.col("r_record_id").eqNullSafe(tx.digest(F.concat(instruction, given, output))) & F.col("r_source_facts").eqNullSafe(F.col("facts"))
    last = F.array_compact(F.array(when(~again, "unreviewed_or_unsupported_generated_text"), when(again & ~provenance, "generated_provenance_mismatch")))
    told = tx.let(first, lambda e: F.when(F.size(e) > 0, e).otherwise(last))
    found_errors = F.when(trivial, F.array(F.lit("missing_or_trivial_fields"))).when(~fact, F.array_compact(F.array(sensitive, F.lit("missing_source")))).otherwise(told)
    return rows.select(*[F.col(f"r_{c}").alias(c) for c in keep], F.col("r_record_id").alias("record_id"), found_errors.alias("errors"))


def deduplicate(records: DataFrame, least: float = 0.92) -> DataFrame:
    """(record_id, kept, duplicate_of): records whose questions and premises are nearly the same, or the same.

    A record with code stays rather than one without; what else decides is the lesser id.
    """
    if not 0.7 <= least <= 1:
        raise ValueError("least must be from 0.7 to 1")
    texts = cut(records.select("record_id", (~F.col("linked")).alias("bare"), tx.similarity_text(F.col("instruction"), F.col("scenario_premise"), APPLIED).alias("text")).filter("text is not null"), "texts")
    links = dedup.close_vectors(retrieval.tf_idf(texts, "record_id", "text"), "record_id", least).unionByName(dedup.equal_texts(texts, "record_id", "text"))
    return dedup.greedy(texts, "record_id", ["bare", "record_id"], links)


def split_records(records: DataFrame, found: DataFrame, least: float = 0.5, shares: Mapping[str, float] | None = None) -> DataFrame:
    """`records` with `split`: those that share a fact, a scenario, a file or a snippet are split together, and of each
    split only so many without code are kept that those with code are at least the part `least`."""
    place = found.select("evidence_id", F.concat("repo", F.lit("/"), "path").alias("file"))
    told = records.select("record_id", "fact_id", "scenario_id", "evidence_id", "snippet_hash").join(place, "evidence_id", "left")
    named = [F.concat(F.lit(f"{c}:"), c) for c in ("fact_id", "scenario_id", "file", "snippet_hash")]
    keys = told.select("record_id", F.explode(F.array_compact(F.array(*named))).alias("key")).distinct()
    grouped = cut(components.shared_key_groups(records.select("record_id"), "record_id", keys), "grouped")
    split = splits.greedy_split(grouped.groupBy("root").agg(F.count("*").alias("n")), "root", "n", shares)
    placed = records.join(grouped.join(split, "root").select("record_id", "split"), "record_id")
    return splits.ratio_cap(placed, "record_id", "split", "linked", least)


def dataset_errors(split: DataFrame, errors: DataFrame, keys: list[str], least: float = 0.5) -> DataFrame:
    """(subject, reason, n): what is wrong with a dataset of records with a `split`; nothing, if it may be used.

    Splits with fewer linked records than `least`, at least half, errors of records, and keys of provenance that stand
    in more than one split.
    """
    ratios = evaluation.split_ratios(split, "split", "linked")
    few = ratios.filter(F.col("linked") < F.col("total") * max(0.5, least)).select(F.col("split").alias("subject"), F.lit("below_minimum_code_coverage").alias("reason"), F.col("total").alias("n"))
    wrong = errors.select(F.explode("errors").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).select(F.lit("records").alias("subject"), "reason", "n")
    out = few.unionByName(wrong)
    for key in keys:
        shared = splits.leakage(split.filter(F.col(key).isNotNull()), key, "split").agg(F.count("*").alias("n")).filter("n > 0")
        out = out.unionByName(shared.select(F.lit(key).alias("subject"), F.lit("cross_split_provenance_leakage").alias("reason"), "n"))
    return out
