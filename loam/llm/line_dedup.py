"""Boilerplate lines by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.common import stage

#: A line is boilerplate when more than this share of its host's pages hold it, with so many standard errors to spare.
RATIO, SPREAD = 0.1, 2.0
#: ASCII white space, trimmed from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: A host with more than this part of all pages is hot (so at most as many hosts are); its pages meet its boilerplate
#: in SALTS groups.
HOT_PART, SALTS = 1024, 64


def url_host(url: Column) -> Column:
    """Host of a URL: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def html_lines(html: Column) -> Column:
    """Text of a page with every tag turned into a line break (scripts, styles and comments go)."""
    quiet = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "\n")
    return F.regexp_replace(quiet, r"<[^>]*>", "\n")


def surely_above(n: Column, pages: Column, ratio: float, spread: float) -> Column:
    """Whether the share ``n / pages`` lies above ``ratio``: the lower end of its score interval (Wilson) does."""
    n, pages, z = n.cast("double"), pages.cast("double"), spread * spread
    return n + z / 2 - spread * F.sqrt(n * (pages - n) / pages + z / 4) > ratio * (pages + z)


def line_dedup(
    pages: DataFrame,
    id_col: str = "page_id",
    host_col: str = "host",
    text_col: str = "text",
    ratio: float = RATIO,
    spread: float = SPREAD,
) -> DataFrame:
    """Drop the lines that more than ``ratio`` of a host's pages hold, and at least two of them.

    One rule for hosts of every size: the share has to lie above the ratio by
    ``spread`` standard errors (see :func:`surely_above`).  So a line on both
    pages of a host of two is boilerplate, and one on two pages of nineteen is
    not; on large hosts the ratio alone decides.

    Returns ``id_col, host_col, n_lines, n_dropped, text``: ``n_lines`` and
    ``n_dropped`` count lines with text (trimmed of ASCII white space), ``text`` joins the lines that stay.

    Pages of a host and pages holding a line are counted by grouped sums
    (combined before the shuffle, so a hot host or line costs one row a task).
    The shares of a host's lines sum to its mean number of lines a page, so
    at most ``mean / ratio`` lines of a host can be boilerplate: the list per
    host is short by arithmetic, whatever the number of pages.  Pages meet it
    in an equi-join on the host; pages of hot hosts are dealt out over several
    copies of their host's list.

    Edge cases: a null text has no lines; blank lines are kept out of both
    counts; a null host is a host of its own; a line twice on one page counts
    once for the share and is dropped twice; a page row that is repeated
    counts as another page; an empty table gives an empty result; other
    columns are ignored.
    """
    base = pages.select(
        pages[id_col].alias("_id"),
        pages[host_col].alias("_host"),
        F.filter(
            F.transform(F.split(F.coalesce(pages[text_col], F.lit("")), "\n"), lambda x: F.trim(x, F.lit(BLANKS))), lambda x: x != ""
        ).alias("_lines"),
    )
    totals = stage(base.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages")), "line-hosts")
    every = totals.agg(F.coalesce(F.sum("_pages"), F.lit(0))).first()[0]
    hot = F.broadcast(
        totals.where(F.col("_pages") * HOT_PART > every).select(F.col("_host").alias("_hot_host"), F.lit(True).alias("_hot"))
    )
    held = (
        base.select("_host", F.explode(F.array_distinct("_lines")).alias("_line"))
        .groupBy("_host", F.sha2("_line", 256).alias("_sha"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    boiler = (
        held.alias("h")
        .join(totals.alias("t"), F.col("h._host").eqNullSafe(F.col("t._host")))
        .where(surely_above(F.col("_n"), F.col("_pages"), ratio, spread))
        .groupBy(F.col("t._host").alias("_bhost"))
        .agg(F.collect_list("_sha").alias("_boiler"))
    )
    salt = F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int")
    rows = base.join(hot, F.col("_host").eqNullSafe(F.col("_hot_host")), "left").withColumn(
        "_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0))
    ).drop("_hot", "_hot_host")
    copies = F.sequence(F.lit(0), F.when(F.col("_hot"), F.lit(SALTS - 1)).otherwise(F.lit(0)))
    boiler = boiler.join(hot, F.col("_bhost").eqNullSafe(F.col("_hot_host")), "left").select(
        "_bhost", "_boiler", F.explode(copies).alias("_bsalt")
    )
    same = F.col("_host").eqNullSafe(F.col("_bhost")) & (F.col("_salt") == F.col("_bsalt"))
    rows = rows.join(boiler, same, "left")
    stay = F.when(F.col("_boiler").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda x: ~F.array_contains("_boiler", F.sha2(x, 256)))
    )
    return rows.withColumn("_stay", stay).select(
        F.col("_id").alias(id_col),
        F.col("_host").alias(host_col),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_stay")).cast("long").alias("n_dropped"),
        F.array_join("_stay", "\n").alias("text"),
    )
