"""Shared helpers: scratch tables, running ids and Arrow batches of bounded size."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.session import scratch_path

#: ASCII white space, as in ``[\x20\x09-\x0D]``: what separates words everywhere in this package.
SPACES = " \t\n\x0b\x0c\r"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    It cuts the lineage, survives lost executors, and lets Spark plan with the
    written size, so that a small table is broadcast only because it is small.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_batch(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the path of the Python workers.

    Workers of a local session do not have the driver's path. On a cluster the
    package is installed or sent along with the job, and the setting does no harm.
    """
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])
    return df.mapInArrow(work, schema)


def words_of(text: Column | str) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; none for null."""
    parts = F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.array_remove(parts, "")


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def sub_batches(batches: Iterable[pa.RecordBatch], limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes, or a single row."""
    for batch in batches:
        rows = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def offsets_before(counts: DataFrame, order: list[str], n: str, out: str) -> DataFrame:
    """Sum of ``n`` over earlier rows of a table with one row per task (or task and bucket).

    The window has no partition key, so this is only for such small tables.
    """
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(earlier), F.lit(0)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reading_tasks(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Spread a table of few rows over the cores when its files give fewer tasks."""
    with suppress(TypeError, ValueError):
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            return df.repartition(cores)
    return df
