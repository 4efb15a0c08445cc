"""Vectors as whole numbers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_numbers(
    vectors: DataFrame, id_col: str, vector_col: str, factor: int = 256, length: int | None = None
) -> DataFrame:
    """``vec_id, weights``: each component x as floor(factor * x), x as a double.

    Vectors that are null or hold null or non-finite components are left out, and so are
    those of another length, if one is given.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    if length is not None:
        good = good & (F.size(v) == length)
    return vectors.where(v.isNotNull() & good).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x * factor)).alias("weights"),
    )


def extent(rows: DataFrame) -> tuple[int, int, int]:
    """How many rows there are, their greatest length, and a bound on the magnitude of the components."""
    below = F.array_max(F.transform("weights", lambda w: F.greatest(w, F.bitwise_not(w))))
    row = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("weights")).alias("length"), F.max(below).alias("below")
    ).first()
    return row["n"], row["length"] or 0, (row["below"] or 0) + 1
