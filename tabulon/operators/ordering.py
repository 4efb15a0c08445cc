"""Positions, running totals and quantiles in a total order, without a one-task window.

A window without partition keys moves every row to one task. Here the table is
range-sorted once, each sorted partition is totalled, and only those totals (one
row per partition) are accumulated in one place.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import materialised

_PART, _ROW = "_sorted_part", "_sorted_row"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _sorted_parts(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Sort, then pin each row's partition and place in it by writing them down."""
    marked = df.orderBy(*order).withColumn(_ROW, F.monotonically_increasing_id())
    return materialised(marked).select(
        "*", F.shiftrightunsigned(_ROW, _ROW_BITS).alias(_PART)
    )


def _totals_before(parts: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Per sorted partition, the sums over all earlier partitions: one row per partition."""
    totals = parts.groupBy(_PART).agg(*[value.alias(name) for name, value in sums.items()])
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        _PART, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums]
    )


def with_positions(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """Add the 0-based place of each row in the given order, which must be total."""
    parts = _sorted_parts(df, order)
    before = _totals_before(parts, {"_before": F.count(F.lit(1))})
    within = F.col(_ROW).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per sorted partition, so the broadcast is bounded by the partition count.
    return parts.join(F.broadcast(before), _PART).select(
        *df.columns, (F.col("_before") + within).alias(out)
    )


def with_running_totals(
    df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, str]
) -> DataFrame:
    """Add inclusive running sums ``{new column: summed column}`` in a total order.

    Aggregate to one row per ordering key first: equal keys share one sorted
    partition, so a hot key would otherwise fill it.
    """
    parts = _sorted_parts(df, order)
    before = _totals_before(parts, {f"_{new}": F.sum(old) for new, old in totals.items()})
    inside = (
        Window.partitionBy(_PART)
        .orderBy(_ROW)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return parts.join(F.broadcast(before), _PART).select(
        *df.columns,
        *[(F.sum(old).over(inside) + F.col(f"_{new}")).alias(new) for new, old in totals.items()],
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Order statistics ``ceil(p * n)`` of a numeric column; null and NaN are left out.

    Values are counted before they are sorted, so a repeated value costs one row.
    The driver sees one total per sorted partition and the requested quantiles.
    """
    value = F.col(column).cast("double")
    counts = (
        df.select((value + F.lit(0.0)).alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parts = _sorted_parts(counts, ["value"])
    sizes = parts.groupBy(_PART).agg(F.sum("n").alias("n")).orderBy(_PART).collect()
    total = sum(row["n"] for row in sizes)
    if total == 0:
        return []
    # p * n can sit a rounding error above a whole number; that must not skip a row.
    ranks = [max(1, math.ceil(p * total - 1e-9)) for p in probabilities]
    # Only the few sorted partitions that hold a wanted rank are looked into.
    wanted, reached = [], 0
    for row in sizes:
        inside = [(i, rank - reached) for i, rank in enumerate(ranks) if 0 < rank - reached <= row["n"]]
        wanted += [(row[_PART], i, local) for i, local in inside]
        reached += row["n"]
    running = Window.partitionBy(_PART).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, 0)
    near = (
        parts.where(F.col(_PART).isin([part for part, _, _ in wanted]))
        .withColumn("reached", F.sum("n").over(running))
        .agg(
            *[
                F.min(F.when((F.col(_PART) == part) & (F.col("reached") >= local), F.col("value"))).alias(f"q{i}")
                for part, i, local in wanted
            ]
        )
        .first()
    )
    return [near[f"q{i}"] for i in range(len(ranks))]


def frequency_ranks(df: DataFrame, column: str, out: str = "rank") -> DataFrame:
    """Distinct non-null values ranked from 0 by falling count, equal counts by value."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_positions(counts, [F.desc("n"), F.asc(column)], out)


def dense_ids(df: DataFrame, column: str, out: str) -> DataFrame:
    """Map each distinct id to 0..n-1 in id order, for libraries that need 32-bit ids."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return with_positions(distinct, [column], "_dense").select(
        column, F.col("_dense").cast("int").alias(out)
    )
