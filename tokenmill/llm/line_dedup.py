"""Line dedup by site-relative frequency.

A page's html is cut into lines at its block elements, tags removed.  Within
each host, a line's frequency is the share of the host's pages that hold it;
lines above ``MAX_SHARE`` on at least ``MIN_PAGES`` pages are boilerplate and
leave every page of the host.  A page counts once for a line it repeats.

Lines are hashed (two 64-bit hashes), made distinct within the page and
counted by (host, line) with map-side combination, so neither a crowded host
nor a line on every page meets in one task before it is summed.  A host has at
most (lines a page) / MAX_SHARE boilerplate lines; these come back to the
pages as one array a host, in an equi-join that Spark splits when a host is
hot.  Page text is not exploded again.

Defined cases: null or empty html has no lines and an empty text; pages
without a readable url form the host ''; a host with fewer than ``MIN_PAGES``
pages loses nothing; repeated rows count as pages; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

MAX_SHARE = 0.5
MIN_PAGES = 3
#: Parts that the pages and lines of one host are dealt to.
SALTS = 32

# Patterns that Java's and RE2's engines read alike.
HIDDEN = (r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
          r"|<noscript\b.*?(?:</noscript\s*>|\z)|<template\b.*?(?:</template\s*>|\z)|<head\b.*?(?:</head\s*>|<body\b[^<>]*>|\z)")
BREAK = (r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr"
         r"|html|li|main|nav|ol|p|pre|section|table|td|tfoot|th|thead|tr|ul)\b[^<>]*>")
TAG = r"<[^<>]*>"
BLANK = r"[\x09-\x0D\x20]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def page_lines(page: Column) -> Column:
    """The lines of a page, white space collapsed, empty ones left out."""
    text = F.regexp_replace(F.coalesce(page, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(text, BLANK, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAK, "\n"), TAG, "")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, " +", " "))), lambda x: x != "")


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h"), F.xxhash64(line, F.lit(1)).alias("g"))


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _for_each_salt(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def dedup_lines(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: page_id, host, text (kept lines, joined by line
    feeds), n_lines, n_dropped."""
    pages = df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host(F.col(f"`{url_col}`").cast("string")).alias("host"),
                      page_lines(F.col(f"`{html_col}`").cast("string")).alias("lines"))
    pages = T.store(pages, "page-lines")
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform("lines", _key))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    common = (counts.withColumn("salt", _salt("line"))
              .join(_for_each_salt(totals), ["host", "salt"])).where(F.col("n") / F.col("pages") > max_share)
    drop = common.groupBy("host").agg(F.collect_list("line").alias("drop"))
    out = pages.withColumn("salt", _salt("page_id", "lines")).join(_for_each_salt(drop), ["host", "salt"], "left").withColumn(
        "kept", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
            F.filter("lines", lambda x: ~F.array_contains(F.col("drop"), _key(x)))))
    return out.select("page_id", "host", F.array_join("kept", "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"),
                      (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))
