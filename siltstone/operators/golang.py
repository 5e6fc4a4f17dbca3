"""Top-level declarations of Go files, by an own scanner.

The scanner knows Go's lexical structure (comments, strings, runes, brackets) and from that finds where declarations
begin and end; a file whose brackets, strings or declarations do not close is refused, as by a parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from siltstone.runtime import ship

_TOKEN = re.compile(
    r"""(?P<space>[ \t\r\f]+)|(?P<line>\n)|(?P<comment>//[^\n]*|/\*.*?\*/)|(?P<raw>`[^`]*`)|(?P<string>"(?:\\.|[^"\\\n])*")"""
    r"""|(?P<rune>'(?:\\.|[^'\\\n])+')|(?P<name>[^\W\d]\w*)|(?P<number>\.?\d[\w.]*(?:(?<=[eEpP])[+-]\w+)?)"""
    r"""|(?P<op><-|:=|\.\.\.|&&|\|\||<<=?|>>=?|&\^=?|\+\+|--|[-+*/%&|^=!<>]=|[-+*/%&|^=!<>~])|(?P<mark>[()\[\]{},;.:])""",
    re.S,
)
_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, {")", "]", "}"}
_STARTS = ("package", "import", "const", "var", "type", "func")
#: Tokens after which a line's end ends the statement.
_ENDERS = ("name", "number", "string", "raw", "rune")
_KEYWORDS_GO_ON = frozenset("package import const var type func struct interface map chan go defer select switch case default if else for range goto".split())
# Constructs that are evidence.
CONSTRUCTS = {"go": "go_statement", "defer": "defer_statement", "select": "select_statement", "if": "if_statement", "return": "return_statement"}

SYNTAX_ERROR = "syntax_error"


@dataclass
class Token:
    kind: str
    text: str
    start: int
    line: int


class GoSyntaxError(ValueError):
    """A file that is no Go source; says `line N`."""


def scan(text: str) -> list[Token]:
    """The tokens of a file, comments and line ends among them, without white space and a leading byte-order mark."""
    out, at, line = [], int(text.startswith("\ufeff")), 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise GoSyntaxError(f"line {line + 1}")
        if m.lastgroup != "space":
            out.append(Token(m.lastgroup, m[0], at, line))
        line += m[0].count("\n")
        at = m.end()
    return out


def _calls(body: list[Token], text: str) -> set[str]:
    """What is called: the operand before each `(` that is no keyword, conversion of a bracket or declaration."""
    found: set[str] = set()
    code = [t for t in body if t.kind not in ("comment", "line")]
    for i, t in enumerate(code):
        if t.text != "(" or not i:
            continue
        j = i - 1
        while j >= 0:
            s = code[j]
            if s.text in (")", "]"):
                # back over a bracketed part
                depth, want = 0, {")": "(", "]": "["}[s.text]
                while j >= 0:
                    depth += (code[j].text == s.text) - (code[j].text == want)
                    if not depth:
                        break
                    j -= 1
                j -= 1
                continue
            if s.kind == "name" and (j == 0 or code[j - 1].text != "."):
                break
            if s.kind == "name":
                j -= 2
                continue
            j = -2
        if j < 0:
            continue
        first = code[j]
        if first.text in _KEYWORDS_GO_ON or first.text == "return" or code[i - 1].kind not in ("name", "mark"):
            continue
        if j and code[j - 1].text == "func" or (j > 1 and code[j - 1].text == ")" and _receiver(code, j - 1)):
            continue
        found.add(text[first.start : code[i - 1].start + len(code[i - 1].text)])
    return found


def _receiver(code: list[Token], close: int) -> bool:
    """Whether the bracket that ends at `close` is a method's receiver."""
    depth = 0
    for k in range(close, -1, -1):
        depth += (code[k].text == ")") - (code[k].text == "(")
        if not depth:
            return k > 0 and code[k - 1].text == "func"
    return False


def _constructs(body: list[Token]) -> set[str]:
    out = set()
    code = [t for t in body if t.kind not in ("comment", "line")]
    for i, t in enumerate(code):
        if t.kind == "name" and t.text in CONSTRUCTS:
            out.add(CONSTRUCTS[t.text])
        elif t.text == "<-":
            left = code[i - 1] if i else None
            sends = left is not None and (left.kind in _ENDERS and left.text not in _KEYWORDS_GO_ON | {"return"} or left.text in (")", "]", "}"))
            if left is not None and left.text == "chan" or i + 1 < len(code) and code[i + 1].text == "chan":
                continue
            if sends:
                out.add("send_statement")
            elif left is not None and left.text in (":=", "=", "{", ":", ";", "case"):
                pass
    # a receive is a statement only as a case of select
    for i, t in enumerate(code):
        if t.text == "case":
            depth = 0
            for k in range(i + 1, len(code)):
                s = code[k].text
                depth += (s in _OPEN) - (s in _CLOSE)
                if s == ":" and not depth:
                    break
                if s == "<-" and code[k - 1].text in ("case", ":=", "=") and not depth:
                    out.add("receive_statement")
    return out


def declarations(text: str) -> list[dict]:
    """Each top-level declaration: start_line, end_line (from 1), symbol, symbol_type, doc, package, imports, calls,
    constructs. A comment that ends on the line before belongs to it, with all comments since the last declaration."""
    tokens = scan(text)
    package, imports, out = "", [], []
    pending: list[Token] = []
    i = 0
    while i < len(tokens):
        t = tokens[i]
        if t.kind == "comment":
            pending.append(t)
            i += 1
            continue
        if t.kind == "line" or t.text == ";":
            i += 1
            continue
        if t.text not in _STARTS:
            raise GoSyntaxError(f"line {t.line + 1}")
        stack: list[str] = []
        j, last = i, None
        while j < len(tokens):
            s = tokens[j]
            if s.kind == "line" or s.text == ";":
                if not stack and last is not None and (last.kind in _ENDERS and not (last.kind == "name" and last.text in _KEYWORDS_GO_ON) or last.text in _CLOSE or last.text in ("++", "--") or s.text == ";"):
                    break
            elif s.kind != "comment":
                if s.text in _OPEN and s.kind == "mark":
                    stack.append(_OPEN[s.text])
                elif s.text in _CLOSE and s.kind == "mark":
                    if not stack or stack.pop() != s.text:
                        raise GoSyntaxError(f"line {s.line + 1}")
                last = s
            j += 1
        if stack or last is None:
            raise GoSyntaxError(f"line {t.line + 1}")
        body = [x for x in tokens[i:j] if x.start <= last.start]
        end_line = last.line + last.text.count("\n")
        code = [x for x in body if x.kind not in ("comment", "line")]
        kind, symbol = _named(code, text)
        if t.text == "package":
            package = symbol
        if t.text == "import":
            imports += [x.text[1:-1] for x in code if x.kind == "string"]
        start, doc = t.line, ""
        if pending and pending[-1].line + pending[-1].text.count("\n") + 1 >= t.line:
            start, doc = pending[0].line, "\n".join(c.text for c in pending)
        pending = []
        out.append({"start_line": start + 1, "end_line": end_line + 1, "symbol": symbol, "symbol_type": kind, "doc": doc, "calls": [] if t.text == "type" else sorted(_calls(body, text)), "constructs": sorted(_constructs(body))})
        i = j
    return [d | {"package": package, "imports": imports} for d in out]


def _named(code: list[Token], text: str) -> tuple[str, str]:
    """(symbol_type, symbol) of a declaration's tokens."""
    word = code[0].text
    if len(code) < 2:
        raise GoSyntaxError(f"line {code[0].line + 1}")
    if word == "package":
        return word, code[1].text
    if word == "import":
        return word, word
    if word == "func":
        if code[1].text != "(":
            return "function", code[1].text
        depth = 0
        for k, t in enumerate(code[1:], 1):
            depth += (t.text == "(") - (t.text == ")")
            if not depth:
                break
        if k + 1 >= len(code) or code[k + 1].kind != "name":
            raise GoSyntaxError(f"line {code[0].line + 1}")
        return "method", text[code[1].start : code[k].start + 1] + "." + code[k + 1].text
    # specs are the group's statements, or the one after the word
    grouped = code[1].text == "("
    specs: list[list[Token]] = [[]]
    depth = 0
    line = None
    for t in code[2:-1] if grouped else code[1:]:
        if grouped and not depth and specs[-1] and (t.text == ";" or t.line != line and specs[-1][-1].text not in (",", "=") and specs[-1][-1].kind != "op"):
            specs.append([])
        if t.text != ";":
            specs[-1].append(t)
        depth += (t.text in _OPEN) - (t.text in _CLOSE)
        line = t.line + t.text.count("\n")
    specs = [s for s in specs if s]
    names, kind = [], word
    for s in specs:
        names.append(s[0].text)
        if word in ("const", "var"):
            for k in range(1, len(s) - 1, 2):
                if s[k].text != ",":
                    break
                names.append(s[k + 1].text)
    if word == "type" and len(specs) == 1:
        s = specs[0]
        rest = s[1:]
        if rest and rest[0].text == "[" and len(rest) > 2 and rest[1].kind == "name" and rest[2].text != "]":
            depth = 0
            for k, t in enumerate(rest):
                depth += (t.text == "[") - (t.text == "]")
                if not depth:
                    rest = rest[k + 1 :]
                    break
        if rest and rest[0].text == "=":
            rest = rest[1:]
        if rest and rest[0].text in ("struct", "interface"):
            kind = rest[0].text
    return kind, ", ".join(names) or word


#: What is told of a declaration.
FACTS = "struct<package:string,imports:array<string>,calls:array<string>,constructs:array<string>,doc:string>"


def go_chunks(files: DataFrame, key: list[str], content: str, on_error: str = "raise") -> DataFrame:
    """(key, start_line, end_line, symbol, symbol_type, content, facts): the declarations of Go files.

    A file that is no Go source raises, or with on_error="skip" has no chunks, or with on_error="report" one of type
    SYNTAX_ERROR at the line where it fails, without symbol, content and facts. Null contents have none either.
    """
    if on_error not in ("raise", "skip", "report"):
        raise ValueError("on_error must be raise, skip or report")
    ship(files.sparkSession)
    kinds = ", ".join(f"{files.schema[k].name} {files.schema[k].dataType.simpleString()}" for k in key)
    schema = f"{kinds}, start_line int, end_line int, symbol string, symbol_type string, content string, facts {FACTS}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                text = row[-1]
                if text is None:
                    continue
                try:
                    found = declarations(text.rstrip("\n") + "\n")
                except GoSyntaxError as e:
                    if on_error == "raise":
                        raise
                    if on_error == "report":
                        line = int(str(e).split()[-1])
                        rows.append((*row[:-1], line, line, None, SYNTAX_ERROR, None, None))
                    continue
                lines = text.splitlines()
                for d in found:
                    facts = {k: d[k] for k in ("package", "imports", "calls", "constructs", "doc")}
                    rows.append((*row[:-1], d["start_line"], d["end_line"], d["symbol"], d["symbol_type"], "\n".join(lines[d["start_line"] - 1 : d["end_line"]]), facts))
            yield pd.DataFrame(rows, columns=[*key, "start_line", "end_line", "symbol", "symbol_type", "content", "facts"])

    return files.select(*key, content).mapInPandas(run, schema)
