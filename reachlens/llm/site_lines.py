"""Line dedup by site-relative frequency.

Lines are counted once per page and host. A line is boilerplate on a host if it
is on more than a given share of the host's pages, and is dropped there; the
same line stays on hosts where it is rare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

#: A line goes if it is on more than this share of its site's pages, and on so many pages at least: two pages that share a line prove nothing.
RATIO, MIN_COPIES = 0.1, 3
#: Tags that end a line.
LINE_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"
HOST = "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"


def host(url: Column) -> Column:
    """Lower-case host of an address; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def html_lines(page: Column) -> Column:
    """Visible lines of a page: scripts, styles and comments go, block tags end lines, other tags vanish."""
    text = F.regexp_replace(F.coalesce(page, F.lit("")), "(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>", " ")
    text = F.regexp_replace(text, "[ \\t-\\r]+", " ")
    text = F.regexp_replace(text, f"(?i)</?(?:{LINE_TAGS})(?:[ /][^>]*)?>", "\n")
    return text_lines(F.regexp_replace(text, "<[^>]*>", ""))


def text_lines(text: Column) -> Column:
    """Lines of a text without the spaces around them; empty lines vanish."""
    return F.array_remove(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t]*\\n[ \\t\\n]*", "\n"), "\n"), "")


def drop_site_boilerplate(pages: DataFrame, lines: Column, site: Column, id_col: str = "page_id", ratio: float = RATIO, min_copies: int = MIN_COPIES) -> DataFrame:
    """One row per page: page_id, site, n_lines, n_dropped, text (the lines kept, joined by line ends).

    ``lines`` and ``site`` are expressions over ``pages``. A line goes if it is
    on more than ``ratio`` of its site's pages and on ``min_copies`` pages at
    least, whatever the size of the site. Lines are trimmed, repeats in a page count once, null pages
    have no lines, and rows count as pages even if their id repeats. A site has
    at most (mean distinct lines of a page) / ratio such lines, so they fit one
    row by site; the sums before that are taken in partial aggregates, and a
    hot site's pages are never brought together.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), site.alias("site"), F.transform(lines, lambda x: F.trim(x)).alias("lines"))
    rows = stored(rows, "page-lines")
    key = lambda x: F.unhex(F.sha2(x, 256))
    sizes = rows.groupBy("site").agg(F.count("*").alias("pages"))
    sizes = stored(sizes, "site-pages")
    counts = rows.select("site", F.explode(F.transform(F.array_distinct("lines"), key)).alias("line")).groupBy("site", "line").agg(F.count("*").alias("n"))
    common = counts.filter(F.col("n") >= min_copies).join(sizes, "site").filter(F.col("n") > ratio * F.col("pages"))
    boiler = stored(common.groupBy("site").agg(F.collect_list("line").alias("boiler")), "site-boilerplate")
    out = rows.join(boiler, "site", "left")
    kept = F.when(F.col("boiler").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("boiler"), key(x))))
    out = out.withColumn("kept", kept)
    return out.select("page_id", "site", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
