"""Stand-in inputs: the test tables in the shapes the jobs expect, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators import features, unsupervised
from tabulon.session import spread
from tabulon.sources import read_table

# The test customers are numbered from 0, so the new user takes a number below them.
NEW_USER = -1

NEW_RATINGS_SQL = f"""new_ratings AS (
  SELECT CAST({NEW_USER} AS BIGINT) AS user_id, p_partkey AS item_id, CAST(1 + p_size % 10 AS DOUBLE) AS rating
  FROM part WHERE p_partkey % 97 = 1)"""
RATINGS_SQL = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, avg(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
BASKETS_SQL = """pairs AS (
  SELECT DISTINCT l_orderkey AS basket, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
INSURANCE_SQL = """insurance AS (
  SELECT l_orderkey * 100 + l_linenumber AS id, l_returnflag AS cat1, l_linestatus AS cat2,
         p_type AS cat3, p_brand AS cat4, p_name AS cat5, l_quantity AS cont1,
         l_discount AS cont2, l_tax AS cont3, CAST(p_size AS DOUBLE) AS cont4,
         p_retailprice AS cont5, l_quantity * p_retailprice * (1 - l_discount) AS loss
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
# Lower-cased words split at single white-space characters, trailing empties dropped.
WORDS_SQL = r"""words AS (
  SELECT doc_id, regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s') AS words
  FROM documents)"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """``user_id, item_id, rating``: mean quantity per customer and part."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.avg("l_quantity").alias("rating"))
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title")
    )


def new_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The new user rates every 97th part, by its size; the user's number is minus that remainder."""
    return read_table(spark, folder, "part").where("p_partkey % 97 = 1").select(
        (-(F.col("p_partkey") % 97)).cast("long").alias("user_id"),
        F.col("p_partkey").alias("item_id"),
        (1 + F.col("p_size") % 10).cast("double").alias("rating"),
    )


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    """``basket, items``: the distinct brands of each order."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item")
    )
    return unsupervised.baskets(rows, "basket", "item")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; text is costly to take apart, so it is spread over the cores."""
    return spread(read_table(spark, folder, "documents"))


def topics(spark: SparkSession, folder: str) -> DataFrame:
    """``id, text, topic``: documents with their language as topic."""
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("topic")
    )


def scored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, label, score``: the quality label against the length of the document."""
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    lengths = documents(spark, folder).select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return labels.join(lengths, "doc_id")


def insurance(spark: SparkSession, folder: str) -> DataFrame:
    """``id, cat1..cat5, cont1..cont5, loss`` from order lines and their parts."""
    lines = read_table(spark, folder, "lineitem")
    parts = read_table(spark, folder, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_returnflag").alias("cat1"),
        F.col("l_linestatus").alias("cat2"),
        F.col("p_type").alias("cat3"),
        F.col("p_brand").alias("cat4"),
        F.col("p_name").alias("cat5"),
        F.col("l_quantity").alias("cont1"),
        F.col("l_discount").alias("cont2"),
        F.col("l_tax").alias("cont3"),
        F.col("p_size").cast("double").alias("cont4"),
        F.col("p_retailprice").alias("cont5"),
        (F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("loss"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``vec_id, label, features`` of the embedding table."""
    rows = read_table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    return features.array_as_vector(rows, "embedding").drop("embedding")


def line_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with quantity, discount and tax as a vector."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    return features.vectorised(lines, ["l_quantity", "l_discount", "l_tax"])


def priced_orders(spark: SparkSession, folder: str) -> DataFrame:
    """``id, priority, status, label``: order price by priority class."""
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("label"),
    )
