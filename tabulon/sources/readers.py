"""Scans. Schemas are explicit, so no scan is paid for guessing types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions import path_part

# The column layouts of the external files the jobs accept.
RATING_SCHEMA = "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT"
MOVIE_SCHEMA = "movieId BIGINT, title STRING, genres STRING"


def string_schema(names: str) -> T.StructType:
    """A schema of nullable strings from blank-separated names."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names.split()])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None
) -> DataFrame:
    """CSV with a header line in every file.

    Without a schema the types are inferred, at the price of one more pass over
    the files. Quotes inside a quoted field are doubled, as in RFC 4180.
    """
    reader = spark.read.option("header", "true").option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def read_lines(
    spark: SparkSession, path: str | list[str], min_partitions: int | None = None
) -> DataFrame:
    """Text lines in column ``value``; ``min_partitions`` asks for smaller splits."""
    reader = spark.read
    if min_partitions is None:
        return reader.text(path)
    lines = reader.text(path)
    if lines.rdd.getNumPartitions() >= min_partitions:
        return lines
    return lines.repartition(min_partitions)


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole files under ``<topic>/<id>`` as ``id, text, topic``."""
    files = spark.read.text(path, wholetext=True)
    location = F.col("_metadata.file_path")
    return files.select(
        path_part(location, 1).alias("id"),
        F.col("value").alias("text"),
        path_part(location, 2).alias("topic"),
    )


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label, features``; a given dimension saves the scan that would look for it."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def run_sql(df: DataFrame, view: str, statement: str) -> DataFrame:
    """Register ``df`` under ``view`` and run one SQL statement over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(statement)
