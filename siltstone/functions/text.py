"""Scalar text functions, all as built-in column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split knows it, spelled out for Java's regular expressions.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
#: Line ends as Python's str.splitlines knows them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


#: What a class of Python's `re` holds, as the inside of a class of another engine.
SPACE, DIGIT, WORD = r"\s\x0b\x1c-\x1f\x85\p{Z}", r"\p{Nd}", r"\p{L}\p{N}_"


def respell(pattern: str, border: str | None = None, hexadecimal: str = "\\x{:02x}") -> str:
    """A pattern of Python's `re` for an engine whose classes know ASCII only.

    `\\s`, `\\d`, `\\w` and their opposites become what they are in Python; `\\b` becomes `border`, or stays. `hexadecimal` is how the engine
    writes a character by its number.
    """
    space = re.sub(r"\\x([0-9a-f]{2})", lambda m: hexadecimal.format(int(m[1], 16)), SPACE)
    out, inside, at = [], False, 0
    while at < len(pattern):
        one = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        at += len(one)
        if one == "[" and not inside:
            inside = True
        elif one == "]" and inside:
            inside = False
        elif one in (r"\s", r"\d", r"\w"):
            held = {"s": space, "d": DIGIT, "w": WORD}[one[1]]
            one = held if inside else f"[{held}]"
        elif one in (r"\S", r"\W"):
            one = f"[^{space if one[1] == 'S' else WORD}]"
        elif one == r"\b" and border is not None:
            one = border
        out.append(one)
    return "".join(out)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row, however often `body` uses it, in lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-case word tokens; camelCase words are taken apart, digits stay with their word."""
    apart = F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2")
    return F.regexp_extract_all(F.lower(apart), F.lit("[a-z][a-z0-9]*"), F.lit(0))


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text, in hex."""
    return F.sha2(text, 256)


def collapse(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, WS + "+", " "))


def fingerprint(text: Column) -> Column:
    """Digest of a text whatever its white space."""
    return digest(collapse(text))


def caseless_fingerprint(text: Column) -> Column:
    """Digest of a text whatever its case (full folding of the German sharp s)."""
    return digest(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")))


def slug(text: Column) -> Column:
    """A file name for a title: lower case, one `_` for anything but letters and digits, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def piece_count(text: Column) -> Column:
    """Words, and other characters that are not white space."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]"))


def estimated_tokens(text: Column) -> Column:
    """A third more than the pieces, at least 1."""
    return F.greatest(F.lit(1), F.floor(piece_count(text) * 4 / 3).cast("int"))


def sentences(text: Column) -> Column:
    """Split after `.`, `!` or `?` where white space and a capital or digit follow."""
    return F.split(text, rf"(?<=[.!?]){WS}+(?=[A-Z0-9])")


def words(text: Column) -> Column:
    """The parts between white space."""
    return F.filter(F.split(text, WS + "+"), lambda x: x != "")


def without_citations(text: Column) -> Column:
    """Without `[1]`, `[2-4]`, `[edit]`, `[citation needed]`; white space collapsed."""
    return collapse(F.regexp_replace(text, r"(?i)\[\s*(?:\d+(?:\s*[,–-]\s*\d+)*|citation needed|edit)\s*\]", ""))


def hash_number(text: Column) -> Column:
    """The first 32 bits of the digest as a number."""
    return F.conv(F.substring(digest(text), 1, 8), 16, 10).cast("long")


def in_sample(text: Column, percent: int) -> Column:
    """Whether a text falls into a fixed sample of so many percent."""
    return hash_number(text) % 100 < percent


def hash_share(text: Column) -> Column:
    """A fixed number in [0, 1) for a text."""
    return hash_number(text) / F.lit(float(1 << 32))


def call_leaf(call: Column) -> Column:
    """What a dotted call names last."""
    return F.regexp_extract(call, r"([^.]*)$", 1)


def parent(path: Column) -> Column:
    """The directory of a path, `.` at the top."""
    found = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(found == "", ".").otherwise(found)


def lines(text: Column) -> Column:
    """The lines of a text, without their ends; an end at the very end begins no line, and no text has no lines."""
    trimmed = let(F.split(text, LINE_END), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(trimmed)


def line_slice(text: Column, first: Column, last: Column) -> Column:
    """Lines `first` to `last` of a text, counted from 1, joined by LF."""
    return F.array_join(F.slice(lines(text), first, F.greatest(last - first + 1, F.lit(0))), "\n")


def similarity_text(instruction: Column, premise: Column, mark: str) -> Column:
    """What of an instruction stands before `mark`, and the premise: the text two records are compared by."""
    return F.concat(F.split_part(instruction, F.lit(mark), F.lit(1)), F.lit(" "), premise)


def page_title(url: Column) -> Column:
    """The title that an article's address names: what follows `/wiki/`, unquoted, with blanks."""
    return F.translate(F.url_decode(F.regexp_extract(F.parse_url(url, F.lit("PATH")), "^/wiki/(.+)$", 1)), "_", " ")


def collapse_ends(text: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")
