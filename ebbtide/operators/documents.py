"""HTML documents to typed elements, each with its place in the source.

What is shown of a document is not a part of its source: scripts and comments vanish, inline tags become spaces, entities
become characters. Every step therefore keeps a map of offsets: a list of pieces, each with its place before and after
the step. An element found in what is left is carried back through the maps, so ``substring(html, start + 1, end - start)``
is the markup of that element and nothing else of the document. Built-in expressions cannot say where a match lies, so
the split runs in Python on batches of documents, one row in and one row out; all that follows is built-in.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the element split.
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
INLINE = r"(?i)</?(?:a|b|i|u|em|strong|span|small|sup|sub|br|code|font)\b[^>]*>"
BLOCK = (
    r"(?is)<nav\b.*?</nav>|<header\b.*?</header>|<footer\b.*?</footer>|<table\b.*?</table>|"
    r"<figure\b.*?</figure>|<[^>]+>[^<]*|[^<]+"
)
TAG = r"(?s)<[^>]*>"
TAG_NAME = r"^</?([a-zA-Z0-9]+)"
# Character entities of the documents; the ampersand comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©",
            "&middot;": "·", "&amp;": "&"}
ELEMENT = "struct<id: int, type: string, content: string, page_id: int, start: int, end: int>"
KINDS = {"title": "title", "nav": "page_header", "header": "page_header", "footer": "page_footer", "table": "table", "figure": "figure",
         "img": "figure", **{f"h{i}": "section_header" for i in range(1, 7)}}


class Offsets:
    """Places in a text after some pieces were replaced, and where they lie in the text before."""

    def __init__(self, before: str, pattern: re.Pattern, by: str):
        self.new, self.old, parts, at, size = [0], [0], [], 0, 0
        for m in pattern.finditer(before):
            parts += [before[at:m.start()], by]
            size += m.start() - at
            # The replacement stands for the whole match; what follows starts behind it.
            self.new += [size, size + len(by)]
            self.old += [m.start(), m.end()]
            at, size = m.end(), size + len(by)
        self.text = "".join(parts) + before[at:]

    def start(self, place: int) -> int:
        """Where the character at ``place`` starts in the text before."""
        k = bisect.bisect_right(self.new, place) - 1
        return self.old[k] + place - self.new[k]

    def end(self, place: int) -> int:
        """Behind the character in front of ``place``."""
        if place == 0:
            return 0
        k = bisect.bisect_right(self.new, place - 1) - 1
        behind = self.old[k] + place - self.new[k]
        # The end of a replacement is the end of what it stands for.
        return self.old[k + 1] if k + 1 < len(self.new) and self.new[k + 1] == place and self.new[k + 1] - self.new[k] != self.old[k + 1] - self.old[k] else behind


_hidden, _inline, _block, _tag, _name = (re.compile(p, re.ASCII) for p in (HIDDEN, INLINE, BLOCK, TAG, TAG_NAME))
_blank = re.compile(r"[ \t\n\x0B\f\r]+")


def plain_text(fragment: str) -> str:
    """Text of a fragment: no tags, entities decoded, white space collapsed."""
    text = _tag.sub(" ", fragment)
    for entity, character in ENTITIES.items():
        text = text.replace(entity, character)
    return _blank.sub(" ", text).strip(" ")


def elements_of(html: str) -> list[tuple]:
    """(id, type, content, page, start, end) of every element with text, in document order."""
    seen = Offsets(html, _hidden, "")
    flat = Offsets(seen.text, _inline, " ")
    out = []
    for m in _block.finditer(flat.text):
        content = plain_text(m.group())
        if content:
            tag = _name.match(m.group())
            kind = KINDS.get(tag.group(1).lower(), "text") if tag else "text"
            out.append((len(out), kind, content, 0, seen.start(flat.start(m.start())), seen.end(flat.end(m.end()))))
    return out


def plain(fragment: Column) -> Column:
    """``plain_text`` as an expression."""
    text = F.regexp_replace(fragment, TAG, " ")
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def source_text(html: Column, start: Column, end: Column) -> Column:
    """The plain text of a piece of the source."""
    piece = F.substring(html, start + 1, end - start)
    return plain(F.regexp_replace(F.regexp_replace(piece, HIDDEN, ""), INLINE, " "))


def _split(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([[dict(zip(("id", "type", "content", "page_id", "start", "end"), e)) for e in elements_of(html)] for html in batch])


def parse_documents(df: DataFrame, key: str, html: str, out: str = "parsed") -> DataFrame:
    """Add ``{document: {pages, elements}, metadata, error_status}``; an element has its ``start`` and ``end`` in the source.

    Every run of visible text lands in exactly one element, in document order. Broken
    markup gives elements of type text and never an error; a document without any text
    gets an error status. One row in, one row out: nothing is shuffled.
    """
    source = F.coalesce(F.col(html), F.lit(""))
    split = F.pandas_udf(_split, f"array<{ELEMENT}>")
    staged = df.withColumn("_elements", split(source))
    return staged.withColumn(out, F.struct(
        F.struct(
            F.array(F.struct(F.lit(0).alias("id"))).alias("pages"), F.col("_elements").alias("elements")
        ).alias("document"),
        F.struct(F.col(key).cast("string").alias("document_id"), F.length(source).alias("length")).alias("metadata"),
        F.when(source == "", "empty document").when(F.size("_elements") == 0, "no text").alias("error_status"),
    )).drop("_elements")


def elements_on_page(parsed: str = "parsed", page: int = 0) -> Column:
    """The elements of one page; a missing type reads as text."""
    return F.transform(
        F.filter(F.col(f"{parsed}.document.elements"), lambda e: e["page_id"] == page),
        lambda e: e.withField("type", F.coalesce(e["type"], F.lit("text"))))


def element_text(parsed: str = "parsed", kinds: tuple[str, ...] = ("text",)) -> Column:
    """The contents of the elements of some types, one line each."""
    wanted = F.filter(F.col(f"{parsed}.document.elements"), lambda e: e["type"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda e: e["content"]), "\n")


def as_variant(parsed: str = "parsed") -> Column:
    return F.parse_json(F.to_json(F.col(parsed)))
