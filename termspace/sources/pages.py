"""Web pages: the same extraction by native expressions, as HTML is no XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column -> pattern whose first group holds the value. Fixed values.
PAGE_STYLE = {
    "lang": r'<html[^>]*\slang="([^"]*)"',
    "title": r"<title>([^<]*)</title>",
    "h1": r"<h1>([^<]*)</h1>",
    "links": r'<a[^>]*\shref="([^"]*)"',
}

_ARTICLE = r"(?s)<article[\s>].*?</article>"
_TAG = r"<[^>]*>"


def article_html(html: Column | str) -> Column:
    """The first article block of a page, empty if there is none."""
    return F.regexp_extract(html, _ARTICLE, 0)


def page_metadata(df: DataFrame, html: str = "html", style: dict[str, str] = PAGE_STYLE) -> DataFrame:
    """Add one list column per style entry: all values the pattern finds."""
    found = {name: F.regexp_extract_all(html, F.lit(pattern), F.lit(1)) for name, pattern in style.items()}
    return df.withColumns(found)


def page_paragraphs(df: DataFrame, html: str = "html") -> DataFrame:
    """Add ``fulltext``: the paragraphs of the article block, without tags, joined by a space.

    Closing tags are often missing, so a paragraph ends where the next begins.
    """
    pieces = F.split(article_html(html), r"<p>")
    # Whatever stands before the first paragraph is no paragraph.
    paragraphs = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    texts = F.transform(paragraphs, lambda p: F.regexp_replace(p, _TAG, ""))
    return df.withColumn("fulltext", F.array_join(texts, " "))
