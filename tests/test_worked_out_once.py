"""Tabular fits and tests work their rows out once."""

from pyspark.sql import functions as F

from tabulon.operators import evaluate, features, supervised
from tabulon.plans import inputs, jobs, recommend_queries


def rows(spark, n=300):
    i = F.col("id")
    cat = F.concat(F.lit("c"), (i % 4).cast("string"))
    return spark.range(0, n, 1, 3).select("id", cat.alias("cat1"), (i % 7).cast("double").alias("cont1"), (i % 4 * 10 + i % 7).cast("double").alias("loss"))


def counted(spark, df, column):
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    return df.withColumn(column, F.udf(count, df.schema[column].dataType)(column)), seen


def test_fit_and_test_read_held_rows(spark):
    data = features.vectorised(rows(spark), ["cont1"]).select("id", F.col("loss").alias("label"), "features")
    data, seen = counted(spark, data, "label")
    found = supervised.indexed_regressor_metrics(data, "forest", "id % 3 > 0", "id % 3 = 0", numTrees=3).collect()
    assert seen.value == 300 and found[0]["n"] == 100


def test_same_metrics_as_fit_then_test(spark):
    data = jobs.prepare_table(rows(spark))[0].rows
    ours = supervised.indexed_regressor_metrics(data, "forest", "id % 3 > 0", "id % 3 = 0", numTrees=3).first()
    model = supervised.fit_indexed_regressor(data, "forest", "id % 3 > 0", numTrees=3)
    theirs = evaluate.regression_metrics(model.transform(data.where("id % 3 = 0"))).first()
    assert all(abs(a - b) < 1e-9 for a, b in zip(ours, theirs, strict=True))


def test_index_reads_its_categories_once_and_holds_nothing(spark, monkeypatch):
    kept = []
    fit = features.fit_string_index
    monkeypatch.setattr(features, "fit_string_index", lambda df, *rest: kept.append(df.is_cached) or fit(df, *rest))
    train, seen = counted(spark, rows(spark), "cat1")
    data = jobs.prepare_table(train)[0]
    assert kept == [False] and seen.value == 300 and data.arity == 4


def test_saved_model_reads_ratings_once(spark, folder, monkeypatch):
    seen = []
    ratings = inputs.ratings

    def watched(*where):
        rows, count = counted(spark, ratings(*where).withColumn("rating", F.col("rating").cast("double")), "rating")
        seen.append((rows, count))
        return rows

    monkeypatch.setattr(inputs, "ratings", watched)
    found = recommend_queries.als_save_load(spark, folder).first()
    assert len(seen) == 1 and seen[0][1].value == ratings(spark, folder).count() == found["n"] and found["max_change"] == 0
