"""E-mail mining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
MAILTO = r"""(?i)<a\s[^>]*?href\s*=\s*["']mailto:([^"'>]*)["']"""


def mailto_emails(html: Column) -> Column:
    """Valid addresses of mailto links, distinct, in document order."""
    raw = F.transform(F.regexp_extract_all(html, F.lit(MAILTO), F.lit(1)), lambda x: F.btrim(F.substring_index(x, "?", 1)))
    return F.array_distinct(F.filter(raw, lambda x: F.rlike(x, F.lit(f"^{ADDRESS}$"))))


def text_emails(body: Column) -> Column:
    """Addresses anywhere in a body, distinct, in order."""
    return F.array_distinct(F.regexp_extract_all(body, F.lit(ADDRESS), F.lit(0)))


def page_emails(html: Column) -> Column:
    """Those of mailto links, or if there are none those of the body."""
    links = mailto_emails(html)
    return F.when(F.size(links) > 0, links).otherwise(text_emails(html))
