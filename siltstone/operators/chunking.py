"""Cutting texts into chunks: structural sections, section runs, token budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions import text as tx

#: Version of the chunkers, part of what an index must match.
VERSION = "chunks-1"
#: Lines of a chunk at most; tokens of a batch at most and, for a remark, at least.
WINDOW, MOST_TOKENS, FEW_TOKENS = 160, 1000, 300

# How a line begins a section in each language; other languages begin one at empty lines.
BOUNDARIES: dict[str, str] = {
    "markdown": r"^#{1,6}\s+",
    "sql": r"(?i)^\s*(CREATE|ALTER|COMMENT|BEGIN|COMMIT)(\W|$)",
    "protobuf": r"^\s*(message|service|enum|rpc|package|import)(\W|$)",
    "yaml": r"^(---|[A-Za-z_][\w.-]*\s*:)",
    "json": r'^\s{0,2}"[^"\n]+"\s*:',
    "shell": r"^(function\s+\w+|\w+\s*\(\s*\))",
}
OTHER = r"^$"


def begins_section(line: Column, language: Column) -> Column:
    """Whether a line begins a section in a language."""
    out = F.regexp_like(line, F.lit(OTHER))
    for name, pattern in BOUNDARIES.items():
        out = F.when(language == name, F.regexp_like(line, F.lit("(?u)" + tx.respell(pattern)))).otherwise(out)
    return out


def sections(files: DataFrame, key: list[str], content: str, language: str, window: int = WINDOW) -> DataFrame:
    """(key, start_line, end_line, symbol, symbol_type, content): files cut at their languages' boundaries.

    A section longer than `window` lines becomes several chunks of the same symbol. Chunks of blank lines are left out.
    All is done within the row, by array functions: no line leaves its file, so nothing is shuffled. A file is taken
    apart once, and each of its lines is looked at and put together once, so the time is in proportion to its length.
    Null contents have no chunks.
    """
    shape = "array<struct<start_line:int,end_line:int,symbol:string,content:string>>"

    def cut_lines(ls: Column) -> Column:
        marks = F.transform(ls, lambda line, i: F.when((i == 0) | begins_section(line, F.col(language)), i))
        return tx.let(F.array_compact(marks), lambda starts: pieces(ls, starts))

    def pieces(ls: Column, starts: Column) -> Column:
        stop = lambda i: F.coalesce(F.get(starts, i + 1), F.size(ls))
        spans = F.transform(starts, lambda at, i: F.transform(F.sequence(at, stop(i) - 1, F.lit(window)), lambda lo: F.struct(at.alias("head"), lo.alias("lo"), F.least(lo + window, stop(i)).alias("hi"))))
        return F.transform(F.flatten(spans), lambda s: piece(ls, s))

    def piece(ls: Column, s: Column) -> Column:
        label = F.substring(tx.collapse_ends(F.get(ls, s["head"])), 1, 100)
        symbol = F.when(label == "", F.concat(F.lit("section-"), s["head"] + 1)).otherwise(label)
        body = F.array_join(F.slice(ls, s["lo"] + 1, s["hi"] - s["lo"]), "\n")
        return F.struct((s["lo"] + 1).alias("start_line"), s["hi"].alias("end_line"), symbol.alias("symbol"), body.alias("content"))

    found = F.when(F.length(content) > 0, tx.let(tx.lines(F.col(content)), cut_lines)).cast(shape)
    # outer: an inner explode would have the optimiser evaluate the whole array once more, as a filter
    rows = files.select(*key, F.explode_outer(found).alias("c")).filter("c is not null")
    return rows.select(*key, "c.start_line", "c.end_line", "c.symbol", F.lit("section").alias("symbol_type"), "c.content").filter(F.regexp_like("content", F.lit(rf"[^{tx.WS[1:]}")))


def chunk_id(repo: str, path: str, start_line: str, symbol: str) -> Column:
    """The id of a chunk: 32 digits of the digest of its place and symbol."""
    return F.substring(tx.digest(F.concat(F.col(repo), F.lit("/"), F.col(path), F.lit(":"), F.col(start_line).cast("string"), F.lit(":"), F.col(symbol))), 1, 32)


def section_runs(blocks: DataFrame, page: str, position: str, section: str, content: str) -> DataFrame:
    """(page, run, section, blocks, content): consecutive blocks of one section together; a section may come again."""
    w = Window.partitionBy(page).orderBy(position)
    changed = F.coalesce((~F.lag(section).over(w).eqNullSafe(F.col(section))).cast("int"), F.lit(1))
    runs = blocks.withColumn("run", F.sum(changed).over(w))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(content).alias("c"))))
    out = runs.groupBy(page, "run", section).agg(F.count("*").alias("blocks"), ordered.alias("parts"))
    return out.select(page, "run", section, "blocks", F.array_join(F.transform("parts", lambda x: x["c"]), "\n\n").alias("content"))


def token_batches(df: DataFrame, key: list[str], content: str, most: int = MOST_TOKENS, few: int = FEW_TOKENS) -> DataFrame:
    """(key, part, content, estimated_tokens, size_note): texts in batches of at most `most` estimated tokens.

    Units are paragraphs, and the sentences of paragraphs over the budget; they are added to a batch while it stays
    within. The estimate is additive over units, so a fold over their counts decides. A single sentence over the budget
    is a batch of its own, noted `oversized`.
    """
    limit = F.lit(most)
    paragraphs = F.filter(F.split(F.col(content), r"\n\n+"), lambda p: tx.collapse(p) != "")
    tokens_of = lambda n: F.greatest(F.lit(1), F.floor(n * 4 / 3))
    unit = lambda s: F.struct(s.alias("s"), tx.piece_count(s).alias("n"))
    units = F.flatten(F.transform(paragraphs, lambda p: F.when(tx.estimated_tokens(p) > limit, F.transform(tx.sentences(p), unit)).otherwise(F.array(unit(p)))))
    base = df.select(*key, units.alias("units")).filter("size(units) > 0")

    def step(state: Column, u: Column) -> Column:
        fits = (state["n"] == 0) | (tokens_of(state["n"] + u["n"]) <= limit)
        at = F.when(fits, state["at"]).otherwise(state["at"] + 1)
        n = F.when(fits, state["n"] + u["n"]).otherwise(u["n"])
        return F.struct(n.alias("n"), at.alias("at"), F.concat(state["out"], F.array(at)).alias("out"))

    start = F.struct(F.lit(0).alias("n"), F.lit(1).alias("at"), F.array().cast("array<int>").alias("out"))
    folded = F.aggregate("units", start, step, lambda s: s["out"])
    base = base.withColumn("parts", folded)
    parts = base.select("*", F.explode(F.array_distinct("parts")).alias("part"))
    mine = F.filter(F.arrays_zip(F.col("units"), F.col("parts").alias("parts")), lambda z: z["parts"] == F.col("part"))
    out = parts.select(*key, "part", F.transform(mine, lambda z: z["units"]).alias("mine"))
    n = F.aggregate("mine", F.lit(0), lambda a, u: a + u["n"])
    estimate = tokens_of(n).cast("int")
    note = F.when(estimate > most, "oversized").when(estimate < few, "short").otherwise("target")
    return out.select(*key, "part", F.array_join(F.transform("mine", lambda u: u["s"]), "\n\n").alias("content"), estimate.alias("estimated_tokens"), note.alias("size_note"))
