"""Anchors of web pages as a table function that joins laterally; the tokenizer is lenient and reads every character once.

A tag that the page ends in is dropped with what follows it, so nothing is ever read again from an earlier place. Comments, declarations,
scripts and styles hold no tags; names and attributes are in any case, values with either quote or none; the last of repeated attributes counts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

RAW = ("script", "style")
_markup = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])|</")
_name = re.compile(r"[^\s/>]++")
_attribute = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|["'][\s\S]*+|[^\s>]*+))?+""")
_gap = re.compile(r"[\s/]*+")


def tokens(page: str) -> Iterator[tuple[str, str, object]]:
    """("text", "", characters), ("open", name, attributes) and ("close", name, None) in order."""
    at, end = 0, len(page)
    while at < end:
        hit = _markup.search(page, at)
        start = hit.start() if hit else end
        if start > at:
            yield "text", "", html.unescape(page[at:start])
        if not hit:
            return
        mark, at = hit[0], hit.end()
        if mark == "<!--":
            stop = page.find("-->", at)
            at = end if stop < 0 else stop + 3
        elif not mark[-1].isalpha():  # declarations, instructions and end tags without a name
            stop = page.find(">", at)
            at = end if stop < 0 else stop + 1
        else:
            name = _name.match(page, at - 1)
            at = name.end()
            found: dict[str, str | None] = {}
            closed = False
            while at < end:
                gap = _gap.match(page, at)
                if gap.end() < end and page[gap.end()] == ">":
                    closed, at = page[gap.start() : gap.end()].endswith("/"), gap.end() + 1
                    break
                one = _attribute.match(page, at)
                if one is None:
                    return
                value = one[2]
                if value is not None and value[:1] in ("'", '"') and (len(value) < 2 or value[-1] != value[0]):
                    return  # the page ends in a quoted value
                if value is not None:
                    value = html.unescape(value[1:-1] if value[:1] in ("'", '"') else value)
                found[one[1].lower()] = value
                at = one.end()
            else:
                return
            tag = name[0].lower()
            if mark[1] == "/":
                yield "close", tag, None
                continue
            yield "open", tag, found
            if closed:
                yield "close", tag, None
            elif tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                yield "text", "", page[at : stop.start() if stop else end]
                at = stop.start() if stop else end


def anchors(page: str | None, base: str | None) -> Iterator[tuple[str, str]]:
    """(text, absolute address) of every anchor that has an address and an end tag; white space in the text becomes single spaces."""
    address, words = None, []
    for kind, name, value in tokens(page or ""):
        if kind == "text":
            if address is not None:
                words.append(value)
        elif name == "a" and kind == "open":
            address, words = value.get("href"), []
        elif name == "a" and address is not None:
            try:
                whole = urljoin(base or "", address)
            except ValueError:  # no address by any rule
                whole = address
            yield " ".join("".join(words).split()), whole
            address = None


@F.udtf(returnType="text string, url string", useArrow=True)
class Anchors:
    """Lateral table function (html, base) -> (text, url)."""

    def eval(self, page: str, base: str):
        yield from anchors(page, base)


def page_links(pages: DataFrame) -> DataFrame:
    """page_id, text and absolute url of every anchor."""
    ship(pages.sparkSession)
    return pages.select("page_id", "url", "html").withColumnRenamed("url", "_base").lateralJoin(Anchors(F.col("html").outer(), F.col("_base").outer())).select("page_id", "text", "url")
