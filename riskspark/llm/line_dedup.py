"""Site-relative line de-duplication (numbered operator 9), in DataFrame functions only.

A line is boilerplate of its host when the share of the host's pages that contain it exceeds
``ratio``; a line of one page only is no repetition, whatever its share. Such lines are removed
from every page of that host.

Pages are split into lines in place and only line hashes are shuffled: counted per (host,
line) with map-side sums, and met again with the few boilerplate lines to list, per page, what
to remove. A host with a third of all pages is spread over its lines, a line on a third of all
pages is a hot join key of a plain inner join, whose skewed side AQE splits. Text moves once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import stage, stage_dir

RATIO = 0.1
#: One page is no repetition.
MIN_PAGES = 2
#: White space that does not count at the ends of a line.
_BLANK = " \t\r\u000b\f"


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_text(html: Column) -> Column:
    """Visible text of a page, one line per block element: scripts, styles, comments and tags go, basic entities are read."""
    t = F.regexp_replace(html, r"(?is)<!--.*?-->|<(?:script|style)[^>]*>.*?</(?:script|style)>", " ")
    t = F.regexp_replace(t, r"[\r\n]+", " ")
    t = F.regexp_replace(t, r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|nav|header|footer|article|section|title)(?:\s[^>]*)?/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return t


def _line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("l1"), F.xxhash64(F.lit(1), line).alias("l2"))


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


def line_dedup(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(row, text, n_lines, n_removed): each input row as a struct, with its cleaned text.

    Lines are split at \\n and compared without white space at their ends; blank lines are
    neither counted nor removed. A page counts once for a line however often it repeats it,
    and all its occurrences go. A page without boilerplate keeps its text unchanged, byte for
    byte; a page of nothing else becomes empty.

    Null text stays null with no lines; pages without a host are one host of their own; equal
    rows count as pages each and each comes back; an empty table gives no rows. Input columns
    come back inside ``row`` whatever their names.
    """
    spark = pages.sparkSession
    base = pages.select(F.struct("*").alias("row"), F.coalesce(F.concat(F.lit("h"), host), F.lit("none")).alias("host"),
                        text.alias("text"))
    base = base.select("row", "host", "text", F.xxhash64(F.col("row"), "text").alias("k1"),
                       F.xxhash64(F.lit(1), F.col("row"), "text").alias("k2"))
    trimmed = F.filter(F.transform(F.split("text", "\n"), _trim), lambda x: x != "")
    lines = base.select("host", "k1", "k2", F.explode(F.array_distinct(F.transform(trimmed, _line_key))).alias("l"))
    seen = lines.groupBy("host", "l").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    total = base.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    common = stage(seen.join(total, "host").where(F.col("n") > F.col("pages") * F.lit(float(ratio))).select("host", "l"),
                   f"{stage_dir(spark)}/boilerplate")
    hits = lines.join(common, ["host", "l"]).groupBy("host", "k1", "k2").agg(F.collect_set("l").alias("drop"))
    out = base.join(hits, ["host", "k1", "k2"], "left")
    gone = lambda x: F.array_contains(F.col("drop"), _line_key(_trim(x)))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~gone(x)), "\n")
    n_lines = F.coalesce(F.size(trimmed), F.lit(0)).cast("long")
    removed = F.size(F.filter(F.split("text", "\n"), gone)).cast("long")
    hit = F.col("drop").isNotNull()
    return out.select("row", F.when(hit, kept).otherwise(F.col("text")).alias("text"),
                      F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_lines).alias("n_lines"),
                      F.when(hit, removed).otherwise(F.lit(0).cast("long")).alias("n_removed"))
