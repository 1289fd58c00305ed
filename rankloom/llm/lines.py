"""Line dedup by site-relative frequency, with DataFrame functions only.

A line is boilerplate of a host if it stands on more than ``ratio`` of the host's pages, and on at
least ``least`` pages. Lines are counted once for each page by two 64-bit hashes and summed before
the exchange, so a line on a third of all pages is a counter, not a group. A host has at most
1 / ratio times its lines a page as boilerplate. These short lists are written and measured: small
ones are broadcast, so that the pages of a large host stay where they were read; beyond the bound
they meet the pages in an equi-join in which adaptive execution splits the large host.

Defined results: a null or empty text has no lines; a page without host keeps all its lines and
counts for none; repeated pages each count; blank lines are not lines; pages of any length are read
whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.tables import unused, written
from rankloom.operators.joins import lookup_join

RATIO = 0.1
LEAST = 5

#: Patterns that mean the same to Spark and to DuckDB.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
UNSEEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
INLINE = r"(?i)</?(?:a|b|i|em|strong|span)(?:[ \t\r\n][^>]*)?>"
TAG = r"<[^>]*>"
BREAK = r"[\r\n]+"
BLANK = " \t"


def host(url: Column) -> Column:
    """Lower-cased host of a URL; null if there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def html_text(html: Column) -> Column:
    """Visible text of a page: tags that break lines become line breaks."""
    seen = F.regexp_replace(html, UNSEEN, "\n")
    return F.regexp_replace(F.regexp_replace(seen, INLINE, ""), TAG, "\n")


def text_lines(text: Column) -> Column:
    """Trimmed lines that are not blank; an empty array for null."""
    split = F.transform(F.split(F.coalesce(text, F.lit("")), BREAK), lambda x: F.btrim(x, F.lit(BLANK)))
    return F.filter(split, lambda x: x != "")


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(host, keys): hashes of each host's boilerplate lines; ``pages`` has host and lines."""
    sited = pages.where(F.col("host").isNotNull())
    totals = sited.groupBy("host").agg(F.count("*").alias("pages"))
    single = sited.select("host", F.explode(F.transform(F.array_distinct("lines"), _key)).alias("key"))
    counts = single.groupBy("host", "key").agg(F.count("*").alias("holding")).where(F.col("holding") >= least)
    held = lookup_join(counts, written(totals, "hosts"), "host")
    common = held.where(F.col("holding") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """``pages`` with host, n_lines, n_dropped and the text of the lines that stay.

    The four columns follow the given ones; names that are taken get an underscore at the end.
    """
    names = {}
    for name in ("host", "n_lines", "n_dropped", "kept_text"):
        names[name] = unused(pages, name)
    lines = pages.select(F.struct("*").alias("row"), host.alias("host"), text_lines(text).alias("lines"))
    common = written(boilerplate(lines.select("host", "lines"), ratio, least), "boilerplate")
    marked = lookup_join(lines, common, "host", how="left")
    keys = F.coalesce("keys", F.array().cast("array<struct<h1:bigint,h2:bigint>>"))
    kept = F.filter("lines", lambda x: ~F.array_contains(F.col("common"), _key(x)))
    found = marked.withColumn("common", keys).withColumn("kept", kept)
    return found.select(
        "row.*",
        F.col("host").alias(names["host"]),
        F.size("lines").cast("long").alias(names["n_lines"]),
        (F.size("lines") - F.size("kept")).cast("long").alias(names["n_dropped"]),
        F.array_join("kept", "\n").alias(names["kept_text"]),
    )
