"""What needs an HTML parser: Arrow-batched, with the standard library's."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class FeedLinks(HTMLParser):
    """Hrefs of links that are children of an element with jsaction inside a feed."""

    def __init__(self):
        super().__init__()
        self.open: list[tuple[str, bool, bool]] = []  # tag, is a feed, has jsaction
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "a" and given.get("href") and self.open:
            parent = self.open[-1]
            inside = any(feed for _, feed, _ in self.open[:-1])
            if parent[0] == "div" and parent[2] and inside:
                self.found.append(given["href"])
        if tag not in VOID:
            self.open.append((tag, tag == "div" and given.get("role") == "feed", "jsaction" in given))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return


def feed_links_of(html: str | None) -> list[str]:
    parser = FeedLinks()
    parser.feed(html or "")
    return parser.found


@F.pandas_udf(T.ArrayType(T.StringType()))
def feed_links(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The links of a result feed, in document order."""
    for html in pages:
        yield html.map(feed_links_of)
