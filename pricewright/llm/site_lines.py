"""Boilerplate lines by how many of a site's pages have them.

A line of a page is what stands between two block tags of its HTML. For each
host, the pages that contain a line are divided by all its pages; lines above a
ratio are dropped from every page of that host. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import salted_left_join, salts_of_large_keys
from pricewright.session import staged

RATIO = 0.2
LEAST_PAGES = 2

# What ends a line, what vanishes, and the signs trimmed off a line.
BLOCKS = (r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
          r"|</?(?:p|div|li|ul|ol|h[1-6]|br|tr|td|th|table|nav|article|section|header|footer|title|body|head|html"
          r"|main|aside)\b[^>]*>")
TAGS = r"(?s)<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
BLANKS = " \t\r\n"


def page_lines(html: Column) -> Column:
    """The non-blank lines of a page, in order."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), BLOCKS, "\n"), TAGS, "")
    trimmed = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))
    return F.filter(trimmed, lambda line: line != "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def line_digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(lines: DataFrame, totals: DataFrame, ratio: float = RATIO,
                least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, digests``: lines above the ratio, from rows of ``host, lines`` and ``host, all_pages``.

    A host has fewer than (mean lines of its pages / ratio) such lines, so one array holds them.
    """
    each = lines.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    counted = each.groupBy("host", line_digest(F.col("line")).alias("digest")).agg(F.count(F.lit(1)).alias("pages"))
    often = counted.filter(F.col("pages") >= least_pages).join(totals, "host").filter(
        F.col("pages") > F.col("all_pages") * ratio)
    return often.groupBy("host").agg(F.collect_list("digest").alias("digests"))


def without_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES,
                        key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, host, n_lines, n_dropped, kept`` (the lines that stay, joined by line feeds).

    A line is dropped when more than ``ratio`` of its host's pages, and at least
    ``least_pages``, contain it. Null HTML has no lines; a null address or one
    without a host belongs to host ''. Repeated rows are pages of their own. An
    empty table gives an empty result. Pages of large hosts meet their host's lines
    in as many tasks as their share of all pages asks for.
    """
    lines = staged(pages.select(F.col(key).cast("long").alias("page_id"), host_of(F.col(url)).alias("host"),
                                page_lines(F.col(html).cast("string")).alias("lines")), "lines")
    totals = staged(lines.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages")), "hosts")
    often = boilerplate(lines, totals, ratio, least_pages)
    met = salted_left_join(lines, often, "host", salts_of_large_keys(totals, "host", "all_pages"), "page_id")
    none = F.expr("cast(array() as array<binary>)")
    kept = F.filter("lines", lambda line: ~F.array_contains(F.coalesce("digests", none), line_digest(line)))
    return met.withColumn("stay", kept).select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
        F.array_join("stay", "\n").alias("kept"))
