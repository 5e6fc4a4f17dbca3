"""Byte-pair encoding of whole texts in linear time (problem 7).

The vocabulary is a public one, given as a rank file: lines of a token in base64 and its rank. Ranks are the ids, and
lower ranks merge first. Three facts make the encoding linear in the text:

* The encoding of a piece is the only sequence of tokens that spells it and in which every two neighbours are
  *compatible*, that is, would come out of the merges next to each other. Compatibility depends on the two tokens
  alone, so it is remembered by pair.
* If some encoding of a prefix ends at a place, there is only one; so a place from which all tokens failed once needs
  no second visit.
* The longest token at every place comes from one pass of an Aho-Corasick automaton. It is built over the tokens
  spelled backwards, with each byte as its Latin-1 character, and runs over the piece backwards: the first match it
  reports at a place is then the longest that begins there.

The encoder starts with the longest token at each place and backtracks to the next shorter one where neighbours are
incompatible. Pieces are what the vocabulary's split pattern cuts; their ids are remembered, most recur.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import ship

# The split pattern of the byte_bpe_50k vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII only, in classes that the faster `re` knows.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Pieces remembered by a worker before it forgets all of them, and the longest that is remembered.
CACHE_PIECES, CACHE_LENGTH = 1 << 18, 64


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the installed public vocabulary `name` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts by the rank file at `path`. Special tokens' strings are ordinary text."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ids = {base64.b64decode(t).decode("latin-1"): int(r) for t, r in pairs}
        self.spelling = {r: t for t, r in self.ids.items()}
        self.split = regex.compile(pattern)
        self.split_ascii = re.compile(ASCII_PATTERN) if pattern == PATTERN else None
        self.automaton = ahocorasick.Automaton()
        for text, rank in self.ids.items():
            self.automaton.add_word(text[::-1], rank)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.spelling):
            self._learn(rank)
        self.known: dict[str, tuple[int, ...]] = {}

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of `token`, or -1."""
        found = self.shorter.get(token)
        if found is None:
            text = self.spelling[token]
            found = next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), -1)
            self.shorter[token] = found
        return found

    def _learn(self, token: int) -> None:
        """Find the two lower tokens that merge last into `token`; called in the order of ranks."""
        text, head = self.spelling[token], self._prefix(token)
        while head >= 0:
            tail = self.ids.get(text[len(self.spelling[head]) :], -1)
            if 0 <= tail < token and head < token and self._fit(head, tail):
                self.merged[head, tail] = token
                self.halves[token] = (head, tail)
                return
            head = self._prefix(head)
        self.halves[token] = None

    def _fit(self, left: int, right: int) -> bool:
        """Whether `left` and `right` can stand side by side in an encoding.

        Undo their merges from the highest rank down. They cannot, if at some moment the two at the border would have
        merged before what was just undone came about.
        """
        bound = 1 << 62
        while True:
            joint = self.merged.get((left, right))
            if joint is not None and joint < bound:
                return False
            a, b = self.halves[left], self.halves[right]
            if left > right and a is not None or b is None:
                if a is None:
                    return True
                bound, left = left, a[1]
            else:
                # of equal rank, the left one is merged first
                bound, right = right + 1, b[0]

    def _may_follow(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.compatible.get(key)
        if found is None:
            if len(self.compatible) > 1 << 20:
                self.compatible.clear()
            found = self.compatible[key] = self._fit(left, right)
        return found

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one piece, given with a Latin-1 character for each byte."""
        whole = self.ids.get(text)
        if whole is not None:
            return (whole,)
        n = len(text)
        longest = [-1] * n
        at = -1
        for end, rank in self.automaton.iter(text[::-1]):
            if end != at:
                at = end
                longest[n - 1 - end] = rank
        lengths, open_at = self.spelling, bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        while pos < n:
            end = pos + len(lengths[token])
            if open_at[end] and (not out or self._may_follow(out[-1], token)):
                out.append(token)
                pos = end
                if pos < n:
                    token = longest[pos]
                continue
            token = self._prefix(token)
            while token < 0:
                # nothing leads on from here
                open_at[pos] = 0
                token = out.pop()
                pos -= len(lengths[token])
                token = self._prefix(token)
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """The ids of `text`."""
        split = self.split_ascii if self.split_ascii and text.isascii() else self.split
        known, out = self.known, []
        for p in split.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p.encode("utf-8", "surrogatepass").decode("latin-1"))
                if len(p) <= CACHE_LENGTH:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    known[p] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of `ids`."""
        return "".join(self.spelling[i] for i in ids).encode("latin-1").decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary."""
    return Encoder(path)


def token_ids(df: DataFrame, key: str, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids): the token ids of each row's `text`, one row for every row of `df`.

    An empty text has no ids: an empty list. A null text counts as empty and has an empty list too, never null. Blank,
    very long and repeated texts are encoded as any other, as a whole. Rows with a null key keep it. Other columns are
    ignored. No shuffle: one pass over the two columns.
    """
    ship(df.sparkSession)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # found where it runs: machines need not have it in the same place
        one = encoder(vocabulary or vocabulary_path())
        for batch in batches:
            lists = [one.encode(t) if t else [] for t in batch.column(1).to_pylist()]
            starts = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=starts[1:])
            flat = np.fromiter((i for x in lists for i in x), np.int32, int(starts[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))], names=[key, "ids"])

    return df.select(key, F.col(text)).mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, tokens): how many ids each row's `text` has; 0 for empty and null ones."""
    ship(df.sparkSession)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # found where it runs: machines need not have it in the same place
        one = encoder(vocabulary or vocabulary_path())
        for batch in batches:
            sizes = [len(one.encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=[key, "tokens"])

    return df.select(key, F.col(text)).mapInArrow(run, schema)
