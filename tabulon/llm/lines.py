"""Line removal by site-relative frequency: lines that too many pages of one host carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import SPACES, stored


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(SPACES)))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) == ""


def boilerplate_lines(pages: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """Per host the hashes of its boilerplate lines: host, lines.

    A page counts once per line, however often it has it. The lists are short: if a
    page has m lines on average, a host has at most m / max_ratio such lines.
    """
    own = pages.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).alias("text"))
    totals = own.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: ~_blank(x)), _key))
    counts = own.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.where(F.col("n") >= 2)
        .join(totals.where(F.col("pages") >= min_pages), "host")
        .where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def drop_boilerplate(
    pages: DataFrame,
    *,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = 0.1,
    min_pages: int = 10,
) -> DataFrame:
    """Drop from every page the lines that more than ``max_ratio`` of its host's pages carry.

    Returns all columns of ``pages`` with the new text, and n_lines and n_dropped
    (columns of these names are replaced). Lines are what lies between line feeds;
    they are compared without white space at their ends, by a 64-bit hash. Blank lines
    stay. Hosts of fewer than ``min_pages`` pages are left alone: there a ratio says
    nothing, and a line on one page only is no boilerplate.

    A null text stays null with no lines; a null host is a host of its own; repeated
    rows count as pages each; an empty table gives an empty result. The hosts' lists
    are written first, so that Spark knows their size: a small table of lists is
    broadcast, and for a large one the pages are joined on the host, where the
    adaptive skew join splits a large host.
    """
    lists = stored(boilerplate_lines(pages, host_col, text_col, max_ratio, min_pages), "boilerplate")
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")
    own = pages.select(
        row, F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.split(text_col, "\n").alias("all")
    )
    df = own.join(lists, "host", "left").withColumn(
        "kept",
        F.when(F.col("lines").isNull(), F.col("all")).otherwise(
            F.filter("all", lambda x: _blank(x) | ~F.array_contains("lines", _key(x)))
        ),
    )
    n_lines = F.when(F.col("all").isNull(), 0).otherwise(F.size("all")).cast("long")
    n_kept = F.when(F.col("all").isNull(), 0).otherwise(F.size("kept")).cast("long")
    ours = {"n_lines": n_lines, "n_dropped": n_lines - n_kept}
    columns = [
        F.array_join("kept", "\n").alias(c) if c == text_col else F.col("row")[c].alias(c)
        for c in pages.columns
        if c not in ours
    ]
    return df.select(*columns, *[value.alias(name) for name, value in ours.items()])
