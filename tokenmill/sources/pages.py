"""S4 re-aimed: the page source is the already-crawled ``pages`` table.

Title, first paragraph and links come out of the HTML with built-in regex
functions; pages whose title cannot be read go to a reject table (Q11)
instead of being dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions import text as TX
from tokenmill.sources.tables import spread, table

# HTML entities decoded in titles and paragraphs (``&amp;``
# last, so that an escaped entity is not decoded twice).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"),
            ("&amp;", "&"))

TITLE_RE = r"(?s)<title>(.*?)</title>"
FIRST_PARAGRAPH_RE = r"(?s)<article>.*?<p>(.*?)(?:</p>|<p>|</article>)"
LINK_RE = r'<a href="/([^"]*)"'


def unescape(col: Column) -> Column:
    for ent, ch in ENTITIES:
        col = F.replace(col, F.lit(ent), F.lit(ch))
    return col


def strip_tags(col: Column) -> Column:
    return F.regexp_replace(col, r"<[^>]*>", "")


def first_word_key(col: Column) -> Column:
    """Lower-cased first whitespace-delimited word (the link-matching key)."""
    return F.lower(F.element_at(TX.words(col), 1))


def extract_pages(pages: DataFrame, clean_mode: str = "reference") -> DataFrame:
    """S4 + P1: page_id, raw title, cleaned title and summary, links, title key."""
    raw_title = unescape(F.regexp_extract("html", TITLE_RE, 1))
    para = unescape(strip_tags(F.regexp_extract("html", FIRST_PARAGRAPH_RE, 1)))
    return pages.select(
        "page_id",
        raw_title.alias("raw_title"),
        TX.clean_text(raw_title, clean_mode).alias("title"),
        TX.clean_text(para, clean_mode).alias("summary"),
        F.regexp_extract_all("html", F.lit(LINK_RE), 1).alias("links"),
        first_word_key(F.regexp_extract("html", TITLE_RE, 1)).alias("title_key"),
    )


def read_pages(spark: SparkSession, sf_dir: str, clean_mode: str = "reference") -> tuple[DataFrame, DataFrame]:
    """(pages, rejects): P2 keeps pages with a readable title."""
    from tokenmill.operators.sequence import filter_computed
    ex = extract_pages(spread(table(spark, sf_dir, "pages"), "page_id"), clean_mode)
    ok = filter_computed(ex, F.col("title").isNotNull() & (F.col("title") != ""))
    bad = ex.where(F.col("title").isNull() | (F.col("title") == "")).select(
        "page_id", F.lit("no title").alias("reason"))
    return ok, bad
