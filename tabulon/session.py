"""Session settings, reliable materialisation and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "tabulon", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost together with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tabulon-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for tables that are written and read back."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written copy.

    Used where a later step relies on values that a recomputation could change
    (row positions after a sort) or where the lineage should be cut.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, so that plans know its size.

    A join broadcasts such a table if it is small, and only then.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, key: str, dealt: bool = False) -> DataFrame:
    """Like :func:`written`, in as many buckets by ``key`` as the session shuffles into.

    Joins and sums by ``key`` over such tables shuffle nothing. Rows that lie by ``key`` already (``dealt``) are
    written where they are.
    """
    spark, parts = df.sparkSession, _session_parts(df)
    table = f"{name}_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(parts, key)
    rows.write.bucketBy(parts, key).sortBy(key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def spread(df: DataFrame) -> DataFrame:
    """At least as many partitions as the session shuffles into, for work that costs far more than reading."""
    parts = _session_parts(df)
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)


def _session_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def held(*frames: DataFrame, balanced: bool = False) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames that an iterative fit reads many times, and let go afterwards.

    ``balanced`` deals the rows into as many partitions as the session shuffles into,
    whatever their number: seeded fits depend on it. Frames that were kept before
    stay kept.
    """
    if balanced:
        frames = tuple(frame.repartition(_session_parts(frame)) for frame in frames)
    kept = [frame for frame in frames if not frame.is_cached]
    for frame in kept:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames
    finally:
        for frame in kept:
            frame.unpersist()
