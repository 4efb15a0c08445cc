"""Queries over the scans and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import fields_of_line, items_of_line, path_part
from tabulon.operators.features import vector_columns
from tabulon.plans import inputs
from tabulon.plans.model_queries import group_tree
from tabulon.plans.registry import query, rounded
from tabulon.session import scratch_path
from tabulon.sources import (
    MOVIE_SCHEMA,
    RATING_SCHEMA,
    read_csv,
    read_documents,
    read_libsvm,
    read_lines,
    read_table,
    run_sql,
    write_csv,
    write_libsvm,
    write_lines,
)

RECORDS_PER_FILE = 1000

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_CUSTOMER_SCHEMA = (
    "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
)


@query("scan_csv", _CUSTOMER_SQL)
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "customer-csv")
    write_csv(read_table(spark, folder, "customer"), path)
    return read_csv(spark, path, _CUSTOMER_SCHEMA)


@query("scan_csv_inferred", _CUSTOMER_SQL)
def scan_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "customer-csv")
    write_csv(read_table(spark, folder, "customer"), path)
    found = read_csv(spark, path)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query(
    "scan_text",
    """SELECT count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars,
              min(line) AS first_line, max(line) AS last_line
       FROM (SELECT l_orderkey || '|' || l_partkey || '|' || l_returnflag AS line FROM lineitem)""",
)
def scan_text(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    lines = read_table(spark, folder, "lineitem").select(
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_returnflag").alias("line")
    )
    write_lines(lines, "line", path)
    return read_lines(spark, path).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("value")).alias("n_chars"),
        F.min("value").alias("first_line"),
        F.max("value").alias("last_line"),
    )


@query(
    "parse_ratings",
    f"WITH {inputs.RATINGS_SQL} SELECT user_id, item_id, round(rating, 6) + 0.0 AS rating FROM ratings",
)
def parse_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Rating lines with a header in every file, parsed to typed columns without the time."""
    path = scratch_path(spark, "ratings")
    rows = inputs.ratings(spark, folder).select(
        F.col("user_id").alias("userId"),
        F.col("item_id").alias("movieId"),
        "rating",
        F.unix_date(F.lit("2015-04-01").cast("date")).alias("timestamp"),
    )
    write_csv(rows, path)
    header = "userId,movieId,rating,timestamp"
    lines = read_lines(spark, path).where(F.col("value") != header)
    fields = lines.select(fields_of_line("value", RATING_SCHEMA).alias("f"))
    return fields.select(
        F.col("f.userId").cast("long").alias("user_id"),
        F.col("f.movieId").cast("long").alias("item_id"),
        rounded("f.rating", 6).alias("rating"),
    )


@query(
    "parse_items",
    """SELECT p_partkey AS item_id, p_name || ', "' || p_brand || '"' AS title, p_type AS first_genre,
              CAST(2 AS INTEGER) AS n_genres FROM part""",
)
def parse_items(spark: SparkSession, folder: str) -> DataFrame:
    """Item lines whose quoted titles hold commas and quotes, and whose genres are split at bars."""
    path = scratch_path(spark, "items")
    rows = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("movieId"),
        F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"')).alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )
    write_csv(rows, path)
    lines = read_lines(spark, path).where(F.col("value") != "movieId,title,genres")
    fields = lines.select(fields_of_line("value", MOVIE_SCHEMA).alias("f")).select("f.*")
    genres = F.split("genres", r"\|")
    return fields.select(
        F.col("movieId").cast("long").alias("item_id"),
        "title",
        genres[0].alias("first_genre"),
        F.size(genres).alias("n_genres"),
    )


@query(
    "parse_baskets",
    r"""SELECT conv_id, turn, CAST(len(items) AS INTEGER) AS n_items, items[1] AS first_item,
               items[-1] AS last_item
        FROM (SELECT conv_id, turn,
                     string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), ' ') AS items
              FROM conversations)""",
)
def parse_baskets(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations")
    parsed = rows.select("conv_id", "turn", items_of_line("text").alias("items"))
    return parsed.select(
        "conv_id",
        "turn",
        F.size("items").alias("n_items"),
        F.element_at("items", 1).alias("first_item"),
        F.element_at("items", -1).alias("last_item"),
    )


@query(
    "scan_wholetext",
    r"""SELECT page_id, string_split(url, '/')[-2] AS topic, CAST(length(html) AS INTEGER) AS n_chars,
               md5(regexp_replace(html, '[\r\n]', ' ', 'g')) AS digest
        FROM pages""",
)
def scan_wholetext(spark: SparkSession, folder: str) -> DataFrame:
    """Pages bundled to text files per topic, read as whole files and taken apart again.

    The bundle size is bounded, so a large topic becomes many files, not a large one.
    """
    path = scratch_path(spark, "pages")
    pages = read_table(spark, folder, "pages")
    one_line = F.regexp_replace("html", r"[\r\n]", " ")
    pages.select(
        path_part("url", 2).alias("topic"),
        F.concat_ws("\t", F.col("page_id").cast("string"), one_line).alias("value"),
    ).write.partitionBy("topic").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    files = read_documents(spark, f"{path}/*")
    records = files.select(
        F.substring_index("topic", "=", -1).alias("topic"),
        F.explode(F.split(F.rtrim(F.col("text"), F.lit("\n")), "\n")).alias("record"),
    )
    html = F.expr("substring(record, instr(record, '\t') + 1)")
    return records.select(
        F.substring_index("record", "\t", 1).cast("long").alias("page_id"),
        "topic",
        F.length(html).alias("n_chars"),
        F.md5(html).alias("digest"),
    )


@query(
    "scan_libsvm",
    """SELECT CAST(l_orderkey AS DOUBLE) AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2
       FROM lineitem""",
)
def scan_libsvm(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "libsvm")
    write_libsvm(inputs.line_vectors(spark, folder), path, label="l_orderkey")
    return vector_columns(read_libsvm(spark, path, num_features=3), "features", ["f0", "f1", "f2"])


@query(
    "sql_topic_counts",
    "SELECT source AS topic, count(*) AS cnt FROM documents GROUP BY source ORDER BY cnt DESC, topic LIMIT 8",
)
def sql_topic_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.documents(spark, folder).select("doc_id", F.col("source").alias("topic"), "text")
    return run_sql(
        rows,
        "topic_documents",
        "SELECT topic, count(*) AS cnt FROM topic_documents GROUP BY topic ORDER BY cnt DESC, topic LIMIT 8",
    )


@query(
    "export_predictions",
    """SELECT o_orderkey AS id, round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 2) + 0.0 AS loss
       FROM orders""",
)
def export_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions written as ``id, loss`` with a header, and read back."""
    path = scratch_path(spark, "submission")
    predicted = group_tree(spark, folder, "tree", maxDepth=5)
    write_csv(predicted.select("id", F.col("prediction").alias("loss")), path)
    return read_csv(spark, path, "id BIGINT, loss DOUBLE").select("id", rounded("loss", 2).alias("loss"))
