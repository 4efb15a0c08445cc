"""Shapes of physical plans that decide whether a query holds at scale."""

import re

import __spark_entry__ as entry_points
import pytest
from pyspark.sql import functions as F
from tabulon.operators import features, tables
from tabulon.plans import inputs
from tabulon.sources import read_table

QUERIES = entry_points.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefix_filter_is_pushed_down(spark, folder):
    text = plan(QUERIES["filter_prefix"](spark, folder))
    assert "StringStartsWith(source,src1)" in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,source:string,n_chars:bigint>", text)


def test_ratings_read_only_their_columns(spark, folder):
    text = plan(inputs.ratings(spark, folder))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_item_stats_aggregate_before_the_shuffle(spark, folder):
    text = plan(tables.item_stats(inputs.ratings(spark, folder)))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(item_id")


def test_top_per_user_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("user_id"), F.col("id").alias("item_id"), F.rand(1).alias("score"))
    text = plan(tables.top_per_user(df, 5))
    assert "25, Partial" in text or "5, Partial" in text


def test_top_rows_need_no_full_sort(spark, folder):
    for name in ("top_rated_items", "limit_rows", "sql_topic_counts", "take_sample"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, folder)), name


RELATIONAL = (
    "top_rated_items item_counts_avg item_title_counts rating_errors rmse_baseline unrated_items "
    "candidate_pairs select_features ratings_with_new_user split_counts index_union tf_idf count_vectors "
    "sample_share string_index_by_join count_vectors_top3"
).split()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_join_and_no_python_rows(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


@pytest.mark.parametrize("name", ["top_rated_items", "new_user_recommendations", "tf_idf", "unrated_items"])
def test_joins_do_without_broadcast(spark, folder, name):
    """With automatic broadcasts off every join is a shuffled equi-join and the result stays."""
    before = QUERIES[name](spark, folder).collect()
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        df = QUERIES[name](spark, folder)
        text = plan(df)
        assert "Broadcast" not in text and "CartesianProduct" not in text
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, before))
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_udf_form_is_batched(spark, folder):
    text = plan(QUERIES["token_counts_udf"](spark, folder))
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text


def test_tokens_read_two_columns(spark, folder):
    words = features.tokenize(read_table(spark, folder, "documents"), "text").select("doc_id", "words")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(words)


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_term_weights_take_the_text_apart_once(spark, folder):
    text = final_plan(QUERIES["tf_idf"](spark, folder))
    assert text.count("FileScan") == 1 and text.count("Generate explode") == 1


def test_titles_and_counts_read_the_lines_once(spark, folder):
    text = final_plan(QUERIES["item_title_counts"](spark, folder))
    assert len(re.findall(r"FileScan parquet \[l_", text)) == 1


def test_a_hot_label_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        label = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id")))
        rows = spark.range(9000).repartition(8).select("id", label.alias("label"))
        indexed = features.index_by_join(rows, "label", "i")
        assert "skew=true" in final_plan(indexed)
        assert indexed.where("label = 'hot'").agg(F.count("i"), F.max("i")).first() == (3000, 0.0)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
