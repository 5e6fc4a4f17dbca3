"""Blocks of text from HTML pages, with the standard library's parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.operators.dedup import first_by
from siltstone.runtime import ship

# Elements and classes without text of the article, elements that have no end, headings left out.
SKIPPED = {"script", "style", "nav", "footer", "table"}
SKIPPED_CLASSES = {"ad", "navbox", "infobox", "metadata", "mw-editsection", "reflist", "hatnote", "toc", "sidebar", "noprint"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
EXCLUDED_HEADINGS = {"references", "external links", "see also", "further reading", "notes", "bibliography", "history", "sources", "citations"}
_BLOCKS = {"p", "li", "pre", *(f"h{i}" for i in range(1, 7))}


class _Reader(HTMLParser):
    """Collects (section, text). A paragraph ends where the next block begins, as browsers close it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self.section, self.muted = "Overview", 0
        self.skipping: list[str] = []
        self.open: str | None = None
        self.parts: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = dict(attrs)
        if self.skipping:
            if tag not in VOID:
                self.skipping.append(tag)
            return
        classes = set((given.get("class") or "").split())
        if tag in SKIPPED or classes & SKIPPED_CLASSES or tag == "sup" and "reference" in classes:
            if tag not in VOID:
                self.skipping.append(tag)
            return
        if tag == "math":
            self.parts.append(given.get("alttext") or "")
            self.skipping.append(tag)
            return
        if tag in _BLOCKS and self.open not in ("li", "pre"):
            self.finish()
            self.open = tag
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if self.skipping:
            if tag in self.skipping:
                while self.skipping.pop() != tag:
                    pass
            return
        if tag == self.open:
            self.finish()

    def handle_data(self, data: str) -> None:
        if not self.skipping and self.open:
            self.parts.append(data)

    def finish(self) -> None:
        text = " ".join("".join(self.parts).split())
        tag, self.open, self.parts = self.open, None, []
        if not tag or not text:
            return
        if tag[0] == "h" and len(tag) == 2:
            level, name = int(tag[1]), text.lower()
            if self.muted and level > self.muted:
                return
            self.muted = level if name in EXCLUDED_HEADINGS or name.startswith("history ") else 0
            self.section = text
        elif not self.muted:
            self.blocks.append((self.section, text))


def page_blocks(html: str) -> list[tuple[str, str]]:
    """(section, text) of each block of a page, in order."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.finish()
    return reader.blocks


def html_blocks(pages: DataFrame, key: str, html: str, fewest_words: int = 5) -> DataFrame:
    """(key, position, section, content): the blocks of pages, without citations, short ones and repeated ones."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, s, t) for k, h in zip(batch[key], batch[html]) if h is not None for i, (s, t) in enumerate(page_blocks(h))]
            yield pd.DataFrame(rows, columns=[key, "position", "section", "content"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(key, html).mapInPandas(run, f"{key} {kind}, position int, section string, content string")
    rows = rows.withColumn("content", tx.without_citations(F.col("content"))).filter(F.size(tx.words(F.col("content"))) >= fewest_words)
    return first_by(rows.withColumn("fp", tx.caseless_fingerprint(F.col("content"))), [key, "fp"], ["position"]).drop("fp")
