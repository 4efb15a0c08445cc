"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them; ``u > v`` in all rows."""
    moved = edges.join(_least(edges), "u").where(F.col("v") != F.col("m"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        _least(edges).select("u", F.col("m").alias("v"))
    )


def components(links: DataFrame) -> DataFrame:
    """The least node of each linked node's component: node, component.

    ``links`` has long columns u and v, in any direction; nulls and self-links are
    ignored. Nodes without links do not appear. Each round is written to the shared
    scratch folder; the rounds end when every node points at the least node of
    its component, after a number of rounds that grows with the logarithm of the links.
    The minima are combined in each task before the shuffle, so a node with very
    many links costs one row per task, and the adaptive skew join splits its rows.
    """
    edges = (
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges = stored(edges, "links")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)).where("u <> v").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
