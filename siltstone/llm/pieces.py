"""Splitting oversized items at natural boundaries (problem 2).

A text over the limits becomes consecutive pieces, each within them. Cuts are chosen by dynamic programming over all
boundaries: the least sum of the cuts' penalties (blank lines before a declaration are cheap, the middle of a block is
dear, the middle of a line dearer) and of the squared deviations of the pieces' sizes from an even share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import ship

MAX_LINES, MAX_CHARS = 160, 8000
#: Lines longer than this share of the character limit may also be cut inside, in segments of about SEGMENT of it.
LONG_LINE, SEGMENT = 1 / 8, 1 / 40
#: What a size off the even share by its whole length costs, in penalties.
BALANCE = 2.0

_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+\Z")
_OPENS = re.compile(r"(?i)(?:#{1,6}\s|---|func\b|type\b|class\b|def\b|const\b|var\b|message\b|service\b|enum\b|create\b|alter\b|insert\b|begin\b|function\b|[\w.-]+\s*\(\)\s*\{|[\w.\"'-]+:\s*$|//|/\*|--\s)")
_CLOSES = re.compile(r"[\]})]+[;,]?\s*$|(?i:end|fi|done|esac)\b;?\s*$")


def line_count(text: Column) -> Column:
    """Lines of `text`: one ends with LF, CRLF or a lone CR, and an end at the very end begins no further line."""
    without = lambda s: F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))
    ends = without("\n") + without("\r") - F.floor(without("\r\n") / 2)
    return ends + F.when(F.length(text) == 0, 0).when(F.substring(text, -1, 1).isin("\n", "\r"), 0).otherwise(1)


def oversized(text: Column, max_lines: int = MAX_LINES, max_chars: int = MAX_CHARS) -> Column:
    """Whether `text` has more lines or code points than the limits."""
    # a text of n lines has at least n - 1 characters: short ones need no count
    return (F.length(text) > max_chars) | ((F.length(text) >= max_lines) & (line_count(text) > max_lines))


def _segments(line: str, most: int) -> Iterator[tuple[str, float]]:
    """Parts of a long line of at most `most` characters, each with the penalty of a cut after it."""
    body = line.rstrip("\r\n")
    at = 0
    while len(body) - at > most:
        window = body[at : at + most]
        for marks, penalty in ((". ", 3.0), ("; ", 3.0), ("},", 3.0), (", ", 3.5), (",", 3.5), (" ", 4.0), ("\t", 4.0)):
            cut = window.rfind(marks, most // 2)
            if cut >= 0:
                size = cut + len(marks)
                break
        else:
            size, penalty = most, 6.0
        yield body[at : at + size], penalty
        at += size
    yield line[at:], 0.0


def _units(text: str, max_chars: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(units, their line numbers from 0, the penalty of a cut before each): lines, long ones in segments."""
    units: list[str] = []
    numbers: list[int] = []
    penalties: list[float] = []
    before = ""
    fenced = False
    for number, line in enumerate(_LINE.findall(text)):
        bare = line.strip()
        indent = len(line) - len(line.lstrip())
        if not bare:
            # cut after blank lines, not before them
            penalty = 3.0
        elif not before and number:
            penalty = 0.2 if _OPENS.match(line) else 0.4 + min(indent, 8) / 10
        elif _OPENS.match(line):
            penalty = 0.8
        elif _CLOSES.match(before) and not before[0].isspace():
            penalty = 0.6
        else:
            penalty = 1.5 + min(indent, 16) / 16
        if fenced:
            penalty += 1.5
        fenced ^= bare.startswith("```")
        before = line.rstrip("\r\n") if bare else ""
        parts = [(line, 0.0)] if len(line) <= max_chars * LONG_LINE else _segments(line, max(1, int(max_chars * SEGMENT)))
        for part, after in parts:
            units.append(part)
            numbers.append(number)
            penalties.append(penalty)
            penalty = after
    return units, np.array(numbers), np.array(penalties)


def cut_points(text: str, max_lines: int = MAX_LINES, max_chars: int = MAX_CHARS, overlap: int = 0) -> list[tuple[int, int, str]]:
    """The pieces of `text` as (first line, last line, content), lines from 0.

    Each piece but the first begins with the last `overlap` lines of the one before, or with as many of them as leave
    room for what comes next. Where a cut lies in a line too long for that, the overlap is of so many segments of it,
    half of the character limit at most. Without the overlaps, the pieces spell `text`. A text within the limits is one
    piece, an empty one none.
    """
    units, line, penalty = _units(text, max_chars)
    n = len(units)
    if n == 0:
        return []
    chars = np.concatenate([[0], np.cumsum([len(u) for u in units])])
    every = np.arange(n)
    start = every.copy()
    if overlap:
        # where no whole line fits
        back = np.maximum(every - overlap, 0)
        while (wide := (chars[every] - chars[back] > max_chars // 2) | (line[np.maximum(every - 1, 0)] - line[back] >= max_lines // 2)).any():
            back[wide] += 1
        start = back
        first_unit = np.searchsorted(line, np.arange(line[-1] + 1))
        for k in range(1, overlap + 1):
            # before the cut at i, from the line k - 1 lines above that of the last unit
            at = first_unit[np.maximum(line[np.maximum(every - 1, 0)] - k + 1, 0)]
            fits = (chars[1:] - chars[at] <= max_chars) & (line - line[at] < max_lines)
            start = np.where(fits, np.minimum(at, every), start)
        start = np.maximum.accumulate(start)
    need = max(1.0, chars[-1] / max_chars, (line[-1] + 1) / max_lines)
    even = 1.0 / np.ceil(need)
    best, last = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
    best[0] = 0.0
    first = 0
    for j in range(1, n + 1):
        while chars[j] - chars[start[first]] > max_chars or line[j - 1] - line[start[first]] >= max_lines:
            first += 1
        i = np.arange(first, j)
        share = np.maximum((chars[j] - chars[i]) / max(1, chars[-1]), (line[j - 1] - line[i] + 1) / (line[-1] + 1))
        cost = best[i] + BALANCE * ((share - even) / even) ** 2
        k = int(np.argmin(cost))
        best[j] = cost[k] + (penalty[j] if j < n else 0.0)
        last[j] = i[k]
    ends = []
    j = n
    while j > 0:
        ends.append((int(last[j]), j))
        j = int(last[j])
    return [(int(line[start[i]]), int(line[j - 1]), "".join(units[start[i] : j])) for i, j in reversed(ends)]


def split_oversized(df: DataFrame, key: str, text: str, start_line: str, max_lines: int = MAX_LINES, max_chars: int = MAX_CHARS, overlap: int = 0) -> DataFrame:
    """(key, piece, start_line, end_line, content): the pieces of every text over the limits, in the file's lines.

    Texts within the limits, empty and null ones have no pieces. Rows that repeat key, start line and text come out
    once. A null start line counts as 1 (the text's own lines). Lines end with LF, CRLF or a lone CR, and the pieces
    keep them. A piece that begins or ends inside a long line has that line's number. Null keys and further columns
    change nothing. Only oversized rows leave the scan's stage.
    """
    if overlap < 0 or overlap > max_lines // 2:
        raise ValueError("overlap must be from 0 to half of max_lines")
    if max_lines < 2 or max_chars < 16:
        raise ValueError("limits under 2 lines or 16 characters leave no room to cut")
    ship(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(start_line).cast("int"), F.lit(1)).alias("at"), F.col(text).alias("text")).filter(oversized(F.col("text"), max_lines, max_chars)).distinct()
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start_line", T.IntegerType()), T.StructField("end_line", T.IntegerType()), T.StructField("content", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (k, p, at + a, at + b, s)
                for k, at, t in zip(batch["key"], batch["at"], batch["text"])
                for p, (a, b, s) in enumerate(cut_points(t, max_lines, max_chars, overlap))
            ]
            yield pd.DataFrame(found, columns=schema.names)

    return rows.mapInPandas(run, schema).withColumnRenamed("key", key)
