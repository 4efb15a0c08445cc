"""Queries over the relational operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import path_part, prefix_label, token_count, token_count_udf
from tabulon.operators import features, tables
from tabulon.plans import inputs
from tabulon.plans.registry import query, rounded
from tabulon.sources import read_table

R, N = inputs.RATINGS_SQL, inputs.NEW_RATINGS_SQL
SHARES = {"train": 6, "validation": 2, "test": 2}
_PART_SQL = "CASE WHEN {0} % 10 < 6 THEN 'train' WHEN {0} % 10 < 8 THEN 'validation' ELSE 'test' END"


@query(
    "top_rated_items",
    f"""WITH {R}, stats AS (SELECT item_id, count(*) AS n_ratings, avg(rating) AS mean_rating
                            FROM ratings GROUP BY 1)
        SELECT item_id, p_name AS title, round(mean_rating, 6) + 0.0 AS score, n_ratings
        FROM stats JOIN part ON item_id = p_partkey WHERE n_ratings >= 25
        ORDER BY mean_rating DESC, item_id LIMIT 25""",
)
def top_rated_items(spark: SparkSession, folder: str) -> DataFrame:
    """The 25 best-rated items with at least 25 ratings, and their titles."""
    stats = tables.item_stats(inputs.ratings(spark, folder))
    scored = stats.select("item_id", F.col("mean_rating").alias("score"), "n_ratings")
    titled = scored.join(inputs.items(spark, folder), "item_id")
    best = tables.top_supported(titled, min_count=25, k=25)
    return best.select("item_id", "title", rounded("score", 6).alias("score"), "n_ratings")


@query(
    "item_counts_avg",
    f"""WITH {R} SELECT item_id, count(*) AS n_ratings, round(avg(rating), 6) + 0.0 AS mean_rating
        FROM ratings GROUP BY 1""",
)
def item_counts_avg(spark: SparkSession, folder: str) -> DataFrame:
    stats = tables.item_stats(inputs.ratings(spark, folder))
    return stats.withColumn("mean_rating", rounded("mean_rating", 6))


@query(
    "select_features",
    f"""WITH {inputs.INSURANCE_SQL}, arity AS (
          SELECT 'cat1' AS feature, count(DISTINCT cat1) AS n FROM insurance
          UNION ALL SELECT 'cat2', count(DISTINCT cat2) FROM insurance
          UNION ALL SELECT 'cat3', count(DISTINCT cat3) FROM insurance
          UNION ALL SELECT 'cat4', count(DISTINCT cat4) FROM insurance
          UNION ALL SELECT 'cat5', count(DISTINCT cat5) FROM insurance)
        SELECT feature, 'idx_' || feature AS indexed_name, CASE WHEN n <= 32 THEN n END AS n_distinct,
               n <= 32 AS kept FROM arity""",
)
def select_features(spark: SparkSession, folder: str) -> DataFrame:
    """Category columns by name, kept if trees with 32 bins can split on them."""
    data = inputs.insurance(spark, folder)
    found = tables.column_arity(data, tables.matching_columns(data, "cat"), limit=32)
    return found.withColumn("indexed_name", F.concat(F.lit("idx_"), "feature"))


@query(
    "filter_prefix",
    "SELECT doc_id, source, n_chars FROM documents WHERE source LIKE 'src1%'",
)
def filter_prefix(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return tables.with_prefix(docs, "source", "src1")


@query(
    "label_from_prefix",
    "SELECT doc_id, lang AS topic, CAST(lang LIKE 'en%' AS DOUBLE) AS label FROM documents",
)
def label_from_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("topic"), prefix_label("lang", "en").alias("label")
    )


@query(
    "unrated_items",
    f"""WITH {N} SELECT p_partkey AS item_id, p_name AS title FROM part
        WHERE p_partkey NOT IN (SELECT item_id FROM new_ratings)""",
)
def unrated_items(spark: SparkSession, folder: str) -> DataFrame:
    return tables.unrated_items(inputs.items(spark, folder), inputs.new_ratings(spark, folder))


@query(
    "candidate_pairs",
    f"""WITH {N} SELECT CAST({inputs.NEW_USER} AS BIGINT) AS user_id, p_partkey AS item_id FROM part
        WHERE p_partkey NOT IN (SELECT item_id FROM new_ratings WHERE user_id = {inputs.NEW_USER})""",
)
def candidate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return tables.candidate_pairs(
        inputs.items(spark, folder), inputs.new_ratings(spark, folder), inputs.NEW_USER
    )


@query(
    "ratings_with_new_user",
    f"""WITH {R}, {N}, both_parts AS (SELECT * FROM ratings UNION ALL SELECT * FROM new_ratings)
        SELECT user_id, count(*) AS n_ratings, round(avg(rating), 6) + 0.0 AS mean_rating
        FROM both_parts GROUP BY 1""",
)
def ratings_with_new_user(spark: SparkSession, folder: str) -> DataFrame:
    both = tables.union_all(inputs.ratings(spark, folder), inputs.new_ratings(spark, folder))
    return both.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), rounded(F.avg("rating"), 6).alias("mean_rating")
    )


def _split_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return tables.with_modular_split(inputs.ratings(spark, folder), "user_id", SHARES)


_ERRORS_SQL = f"""WITH {R}, parts AS (SELECT *, {_PART_SQL.format('user_id')} AS part FROM ratings),
  means AS (SELECT item_id, avg(rating) AS prediction FROM parts WHERE part = 'train' GROUP BY 1),
  errors AS (SELECT user_id, item_id, rating, prediction,
                    (rating - prediction) * (rating - prediction) AS squared_error
             FROM parts JOIN means USING (item_id) WHERE part = 'test')"""


def _mean_rating_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors on the test part of the item means learned on the training part."""
    parts = _split_ratings(spark, folder)
    means = (
        parts.where("part = 'train'")
        .groupBy("item_id")
        .agg(F.avg("rating").alias("prediction"))
    )
    test = parts.where("part = 'test'").select("user_id", "item_id", "rating")
    predictions = test.select("user_id", "item_id").join(means, "item_id")
    return tables.matched_errors(test, predictions)


@query(
    "rating_errors",
    f"""{_ERRORS_SQL} SELECT user_id, item_id, round(rating, 6) + 0.0 AS rating,
        round(prediction, 6) + 0.0 AS prediction, round(squared_error, 3) + 0.0 AS squared_error
        FROM errors""",
)
def rating_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _mean_rating_errors(spark, folder).select(
        "user_id",
        "item_id",
        rounded("rating", 6).alias("rating"),
        rounded("prediction", 6).alias("prediction"),
        rounded("squared_error", 3).alias("squared_error"),
    )


@query(
    "rmse_baseline",
    f"{_ERRORS_SQL} SELECT count(*) AS n, round(sqrt(avg(squared_error)), 6) + 0.0 AS rmse FROM errors",
)
def rmse_baseline(spark: SparkSession, folder: str) -> DataFrame:
    total = tables.root_mean_square(_mean_rating_errors(spark, folder))
    return total.withColumn("rmse", rounded("rmse", 6))


@query(
    "item_title_counts",
    f"""WITH {R}, stats AS (SELECT item_id, count(*) AS n_ratings, max(rating) AS score
                            FROM ratings GROUP BY 1)
        SELECT item_id, p_name AS title, round(score, 6) + 0.0 AS score, n_ratings
        FROM stats JOIN part ON item_id = p_partkey""",
)
def item_title_counts(spark: SparkSession, folder: str) -> DataFrame:
    stats = inputs.ratings(spark, folder).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.max("rating").alias("score")
    )
    titled = inputs.items(spark, folder).join(stats, "item_id")
    return titled.select("item_id", "title", rounded("score", 6).alias("score"), "n_ratings")


@query(
    "split_counts",
    f"""WITH {R}, parts AS (SELECT {_PART_SQL.format('user_id')} AS part FROM ratings)
        SELECT part, count(*) AS n FROM parts GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM parts""",
)
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.part_counts(_split_ratings(spark, folder))


@query(
    "key_split",
    f"""SELECT o_orderkey, {_PART_SQL.format('o_orderkey')} AS part FROM orders""",
)
def key_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    return tables.with_modular_split(orders, "o_orderkey", SHARES)


@query("distinct_topics", "SELECT DISTINCT lang AS topic FROM documents")
def distinct_topics(spark: SparkSession, folder: str) -> DataFrame:
    return tables.distinct_values(read_table(spark, folder, "documents").select(F.col("lang").alias("topic")), "topic")


@query(
    "dedup_rows",
    """SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem""",
)
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return tables.drop_duplicate_rows(lines.select("l_orderkey", "l_returnflag", "l_linestatus"))


@query(
    "limit_rows",
    "SELECT doc_id AS id, lang AS topic, md5(text) AS digest FROM documents ORDER BY doc_id LIMIT 5",
)
def limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("topic"))
    rows = tables.first_rows(docs, ["id"], 5)
    return rows.select("id", "topic", F.md5("text").alias("digest"))


_UNION_SQL = """both_parts AS (SELECT p_brand AS value FROM part
  UNION ALL SELECT p_type FROM part)"""


@query(
    "index_union",
    f"""WITH {_UNION_SQL}, counts AS (SELECT value, count(*) AS n FROM both_parts GROUP BY 1)
        SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS DOUBLE) AS value_index
        FROM counts""",
)
def index_union(spark: SparkSession, folder: str) -> DataFrame:
    """One index over a training and a test column, so that it covers the values of both."""
    part = read_table(spark, folder, "part")
    train = part.select(F.col("p_brand").alias("value"))
    test = part.select(F.col("p_type").alias("value"))
    both = tables.union_all(train, test)
    return features.index_by_join(both.distinct(), "value", "value_index", vocabulary=both)


@query("random_split")
def random_split(spark: SparkSession, folder: str) -> DataFrame:
    """Seeded 6:2:2 random split of the ratings, counted per part."""
    return tables.part_counts(_random_parts(spark, folder))


def _random_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = tables.random_split(inputs.ratings(spark, folder), [6, 2, 2], seed=0)
    named = [
        part.select(F.lit(name).alias("part"), "user_id", "item_id")
        for name, part in zip(SHARES, parts)
    ]
    return tables.union_all(*named)


@query(
    "random_split_whole",
    f"""WITH {R} SELECT user_id, item_id, 1::BIGINT AS n_parts FROM ratings""",
)
def random_split_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Every rating falls in exactly one part of the random split."""
    parts = _random_parts(spark, folder)
    return parts.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n_parts"))


@query("hash_split")
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """Split of the ratings by a hash of the pair: the same rows on any cluster."""
    split = tables.with_split(inputs.ratings(spark, folder), ["user_id", "item_id"], SHARES, seed=0)
    return tables.part_counts(split)


@query("sample_rows")
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return tables.sample_rows(lines, fraction=0.1, seed=10)


@query(
    "sample_share",
    "SELECT count(*) AS n_rows, true AS near_fraction FROM lineitem",
)
def sample_share(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a ten percent sample is within five standard deviations of its expected size."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey")
    sampled = tables.sample_rows(lines, fraction=0.1, seed=10)
    marked = tables.union_all(
        lines.select(F.lit(1).alias("row"), F.lit(0).alias("drawn")),
        sampled.select(F.lit(0).alias("row"), F.lit(1).alias("drawn")),
    )
    totals = marked.agg(F.sum("row").alias("n_rows"), F.sum("drawn").alias("n"))
    off = F.abs(F.col("n") - F.col("n_rows") * 0.1)
    near = off <= 5 * F.sqrt(F.col("n_rows") * 0.09)
    return totals.select("n_rows", near.alias("near_fraction"))


@query("take_sample")
def take_sample(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source")
    return tables.take_sample(docs, 20, seed=10)


@query(
    "take_sample_size",
    "SELECT least(count(*), 20) AS n, least(count(*), 20) AS n_distinct FROM documents",
)
def take_sample_size(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed-size sample has exactly that many rows, all of them different."""
    docs = read_table(spark, folder, "documents").select("doc_id")
    return tables.take_sample(docs, 20, seed=10).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_distinct")
    )


@query(
    "path_parts",
    "SELECT page_id, string_split(url, '/')[-1] AS id, string_split(url, '/')[-2] AS topic FROM pages",
)
def path_parts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages").select(
        "page_id", path_part("url", 1).alias("id"), path_part("url", 2).alias("topic")
    )


_TOKENS_SQL = f"WITH {inputs.WORDS_SQL} SELECT doc_id, CAST(len(words) AS INTEGER) AS tokens FROM words"


@query("token_counts", _TOKENS_SQL)
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenize(inputs.documents(spark, folder), "text")
    return words.select("doc_id", token_count("words").alias("tokens"))


@query("token_counts_udf", _TOKENS_SQL)
def token_counts_udf(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenize(inputs.documents(spark, folder), "text")
    return words.select("doc_id", token_count_udf("words").alias("tokens"))


@query(
    "arithmetic",
    """SELECT l_orderkey, l_linenumber,
              round(sqrt(l_quantity * l_quantity + l_tax) - l_discount, 6) + 0.0 AS length,
              CAST(trunc(l_extendedprice) AS BIGINT) - CAST(trunc(l_quantity) AS BIGINT) AS whole
       FROM lineitem""",
)
def arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    """Powers, roots, products, differences and casts as column expressions."""
    length = F.sqrt(F.col("l_quantity") ** 2 + F.col("l_tax")) - F.col("l_discount")
    whole = F.col("l_extendedprice").cast("long") - F.col("l_quantity").cast("long")
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rounded(length, 6).alias("length"),
        whole.alias("whole"),
    )
