"""Screening of paths and contents: what must not enter a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as tx

#: Version of the rules, part of what an index must match.
VERSION = "screening-2"

# Directories whose files are left out.
BLOCKED_DIRECTORIES = [".git", "vendor", "node_modules", "dist", "build", "generated", ".terraform", ".venv", "__pycache__", "fixtures", "testdata", "logs", "dumps"]
#: A part of a path that tells of secrets or data.
BLOCKED_PART = r"(?i)(^\.env($|\.)|credentials|secrets?|\.pem$|\.key$|\.p12$|\.pfx$|\.tfstate|id_rsa|id_ed25519|\.sqlite|\.db$|\.log$|dump|customer[_-]?data)"
# Suffixes and the languages they stand for.
LANGUAGES = {".go": "go", ".md": "markdown", ".sql": "sql", ".proto": "protobuf", ".yaml": "yaml", ".yml": "yaml", ".json": "json", ".sh": "shell", ".bash": "shell"}

# Names of the rules and what they match, as Python's `re` reads them.
RULES: dict[str, str] = {
    "private_key": r"-----BEGIN (?:[A-Z ]+ )?PRIVATE KEY-----",
    "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "provider_token": r"\b(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|sk-[A-Za-z0-9_-]{20,}|xox[baprs]-[A-Za-z0-9-]{10,})",
    "credential_literal": r"""(?i)["'`]?\b(?:password|passwd|pwd|api[_-]?key|access[_-]?key|secret|token|authorization|client[_-]?secret)["'`]?\s*(?::=|[:=])\s*["'`][^"'`\n]{4,}["'`]""",
    "credential_yaml": r"(?im)^\s*(?:password|passwd|api[_-]?key|secret|token|client[_-]?secret)\s*:\s*\S+",
    "credential_url": r"(?i)(?:https?|postgres(?:ql)?|mysql|redis|mongodb)://[^\s/]+:[^\s/@]+@|[?&](?:token|key|secret|password|signature|credential)=[^&\s]+",
    "kubernetes_secret": r"""(?im)^\s*kind\s*:\s*["']?Secret["']?\s*$""",
    "kubernetes_secret_json": r"""(?i)["']kind["']\s*:\s*["']Secret["']""",
    "uuid_literal": r"\b[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}\b",
    "email_literal": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "opaque_literal": r"""["'][A-Za-z0-9+/=_-]{32,}["']""",
    "customer_literal": r"""(?i)["']?(?:customer[_-]?id|account[_-]?(?:id|number)|card[_-]?number|phone|email|merchant[_-]?id)["']?\s*[:=]\s*(?:["'][^"'\n]+["']|\d{5,})""",
    "environment_value": r"(?m)^\s*(?:export\s+)?[A-Z][A-Z0-9_]{2,}\s*=\s*\S+",
    "sql_data": r"(?i)\b(?:INSERT\s+INTO|COPY\s+\S+\s+FROM)\b",
}
#: What else must not stand in texts about private systems: addresses and internal hosts.
PRIVATE = r"(?i)https?://\S+|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b[\w.-]+\.(?:internal|local|corp|lan)\b"

BORDER = rf"(?:(?<=[{tx.WORD}])(?![{tx.WORD}])|(?<![{tx.WORD}])(?=[{tx.WORD}]))"


def java(pattern: str) -> str:
    """A rule for Java: case as Unicode has it, word borders by Python's words, and line borders that know LF only."""
    return "(?du)" + tx.respell(pattern, BORDER)


def path_excluded(path: Column) -> Column:
    """Whether any part of a path is a blocked directory or looks like secrets or data."""
    return F.exists(F.split(path, "/"), lambda p: p.isin(BLOCKED_DIRECTORIES) | F.regexp_like(p, F.lit(BLOCKED_PART)))


def language_of(path: Column) -> Column:
    """The language of a path's suffix, null for others; suffixes are in lower case, and a bare `.go` has none."""
    suffix = F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)
    return F.try_element_at(F.create_map(*[x for kv in LANGUAGES.items() for x in map(F.lit, kv)]), suffix)


def generated(path: Column, content: Column) -> Column:
    """Whether a file says in its first 4,096 characters that it is generated, or its path does."""
    return F.contains(F.substring(content, 1, 4096), F.lit("DO NOT EDIT")) | F.contains(path, F.lit(".pb.go")) | F.contains(path, F.lit(".gen."))


def readable(content: Column) -> Column:
    """Whether bytes are UTF-8 text without NUL."""
    return F.is_valid_utf8(content.cast("string")) & ~F.contains(content.cast("string"), F.lit("\0"))


def rule_counts(text: Column) -> Column:
    """A map of each rule to its matches in a text."""
    return F.create_map(*[x for name, pattern in RULES.items() for x in (F.lit(name), F.regexp_count(text, F.lit(java(pattern))))])


def safe(text: Column) -> Column:
    """Whether no rule matches. The cheap and frequent rules come first, and the first match ends the search."""
    out = F.lit(True)
    for name in sorted(RULES, key=lambda n: (n.startswith(("credential", "customer", "environment")), len(RULES[n]))):
        out = out & ~F.regexp_like(text, F.lit(java(RULES[name])))
    return out


def safe_prose(text: Column) -> Column:
    """Safe, and without addresses or internal hosts."""
    return safe(text) & ~F.regexp_like(text, F.lit(java(PRIVATE)))


def findings(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, rule, line): one row for every match of a rule, at the line where the match begins.

    Each rule is a literal expression, so it is compiled once. A mark is set before every match, and the lines that
    have marks are counted out; only texts that a rule matches at all are taken apart for it. It is one pass over the
    rows, and no copy of a text leaves its row.
    """
    mark = F.lit("\u0001")
    # a text's own marks, should it have any, become another control character
    own = F.translate(F.col(text), "\u0001", "\u0002")

    def lines_of(name: str, pattern: str) -> Column:
        marked = F.split(F.regexp_replace(own, F.lit(java(pattern)), F.lit("\u0001$0")), "\n")
        counted = F.transform(marked, lambda s, i: F.struct(F.lit(name).alias("rule"), (i + 1).alias("line"), (F.length(s) - F.length(F.replace(s, mark, F.lit("")))).alias("n")))
        return F.when(F.regexp_like(own, F.lit(java(pattern))), F.filter(counted, lambda x: x["n"] > 0))

    found = F.flatten(F.array_compact(F.array(*[lines_of(n, p) for n, p in RULES.items()])))
    # outer: an inner explode would have the optimiser evaluate the whole array once more, as a filter
    rows = df.select(*key, F.explode_outer(found).alias("f")).filter("f is not null")
    return rows.select(*key, "f.rule", F.col("f.line").alias("line"), F.explode(F.sequence(F.lit(1), "f.n")).alias("_i")).drop("_i")
