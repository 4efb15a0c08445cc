"""Properties that hold whatever the data: on random tables, hot keys and the test tables."""

import math
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tabulon.operators import (
    evaluate,
    features,
    ordering,
    recommend,
    supervised,
    tables,
    tuning,
    unsupervised,
)
from tabulon.plans import inputs, jobs
from tabulon.session import held, spread

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def hot_values(n=3000, seed=3):
    """A third of the rows share one value, the others are mostly different."""
    draw = random.Random(seed)
    return [7 if draw.random() < 1 / 3 else draw.randrange(10_000) for _ in range(n)]


# --- positions, totals, quantiles --------------------------------------------


def test_positions_with_a_hot_value(spark):
    rows = list(enumerate(hot_values()))
    df = spark.createDataFrame(rows, "id long, v long").repartition(7)
    placed = ordering.with_positions(df, ["v", "id"]).collect()
    expected = {id_: i for i, (id_, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert {r["id"]: r["position"] for r in placed} == expected


def test_running_totals(spark):
    counts = Counter(hot_values())
    df = spark.createDataFrame(list(counts.items()), "v long, n long").repartition(5)
    found = ordering.with_running_totals(df, [F.desc("v")], {"reached": "n"}).collect()
    total = 0
    for row in sorted(found, key=lambda r: -r["v"]):
        total += counts[row["v"]]
        assert row["reached"] == total


@SLOW
@given(
    st.lists(st.sampled_from([0.0, 1.0, 2.5, -3.0, 7.0, float("nan"), None]), min_size=1, max_size=60),
    st.integers(2, 6),
)
def test_exact_quantiles_are_order_statistics(spark, values, buckets):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    wanted = [i / buckets for i in range(1, buckets)]
    expected = [kept[math.ceil(p * len(kept) - 1e-9) - 1] for p in wanted] if kept else []
    assert ordering.exact_quantiles(df, "v", wanted) == expected


def test_quantile_of_a_hot_value(spark):
    values = hot_values()
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
    ordered = sorted(values)
    probabilities = [0.01, 0.25, 1 / 3, 0.5, 0.99, 1.0]
    expected = [float(ordered[math.ceil(p * len(ordered) - 1e-9) - 1]) for p in probabilities]
    assert ordering.exact_quantiles(df, "v", probabilities) == expected


def test_frequency_ranks(spark):
    values = [f"v{v}" for v in hot_values(600)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    ranks = {r["v"]: r["rank"] for r in ordering.frequency_ranks(df, "v").collect()}
    expected = sorted(Counter(values).items(), key=lambda kv: (-kv[1], kv[0]))
    assert ranks == {value: i for i, (value, _) in enumerate(expected)}


def test_dense_ids_are_small_and_stable(spark):
    ids = [10**12 + i * 17 for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids for _ in range(2)], "k long").repartition(5)
    for shuffled in (df, df.repartition(3)):
        codes = {r["k"]: r["code"] for r in ordering.dense_ids(shuffled, "k", "code").collect()}
        assert codes == {k: i for i, k in enumerate(ids)}


# --- splits and samples ------------------------------------------------------


def test_key_split_is_whole_and_repeats(spark):
    df = spark.range(5000)
    weights = {"a": 6, "b": 2, "c": 2}
    first = tables.with_split(df, ["id"], weights, seed=1)
    again = tables.with_split(df.repartition(7), ["id"], weights, seed=1)
    assert first.exceptAll(again).count() == 0
    shares = {r["part"]: r["n"] / 5000 for r in tables.part_counts(first).collect()}
    assert shares["all"] == 1 and abs(shares["a"] - 0.6) < 0.03 and abs(shares["c"] - 0.2) < 0.03
    other = tables.with_split(df, ["id"], weights, seed=2)
    assert first.exceptAll(other).count() > 0


def test_folds_cover_all_rows(spark):
    folds = tables.with_fold(spark.range(3000), ["id"], 3).groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == {0, 1, 2} and sum(r["count"] for r in folds) == 3000


def test_random_split_is_disjoint_and_whole(spark):
    parts = tables.random_split(spark.range(1000).repartition(4), [7, 3], seed=0)
    ids = [r["id"] for part in parts for r in part.collect()]
    assert sorted(ids) == list(range(1000))


def test_take_sample(spark):
    df = spark.range(100).repartition(3)
    assert len({r["id"] for r in tables.take_sample(df, 12).collect()}) == 12
    assert tables.take_sample(df, 200).count() == 100


def test_sample_keeps_no_row_twice(spark):
    found = [r["id"] for r in tables.sample_rows(spark.range(2000), 0.1).collect()]
    assert len(found) == len(set(found)) and 100 < len(found) < 300


# --- tables ------------------------------------------------------------------


def test_arity_is_exact_up_to_the_limit(spark):
    rows = [(f"a{i % 3}", f"b{i % 33}", f"c{i}", None) for i in range(2000)]
    df = spark.createDataFrame(rows, "cat1 string, cat2 string, cat3 string, cat4 string")
    found = {r["feature"]: (r["n_distinct"], r["kept"]) for r in tables.column_arity(df, df.columns, 32).collect()}
    assert found == {"cat1": (3, True), "cat2": (None, False), "cat3": (None, False), "cat4": (0, True)}


def test_top_per_user_with_a_hot_user(spark):
    draw = random.Random(1)
    rows = [(0 if i % 3 == 0 else i % 50, i, round(draw.random(), 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, score double").repartition(6)
    found = {}
    for r in tables.top_per_user(df, 5).collect():
        found.setdefault(r["user_id"], []).append((r["place"], r["item_id"]))
    for user in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == user), key=lambda r: (-r[2], r[1]))[:5]
        assert sorted(found[user]) == [(i + 1, r[1]) for i, r in enumerate(best)]


def test_baskets_with_a_hot_key(spark):
    rows = [(0 if i % 3 == 0 else i % 100, f"i{i % 7}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, item string").repartition(5)
    found = {r["k"]: r["items"] for r in unsupervised.baskets(df, "k", "item").collect()}
    expected = {}
    for k, item in rows:
        expected.setdefault(k, set()).add(item)
    assert found == {k: sorted(v) for k, v in expected.items()}


def test_spread_only_widens(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == parts
    wide = spark.range(100).repartition(parts + 3)
    assert spread(wide) is wide


def test_held_frames_are_dealt_by_the_setting_and_let_go(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows in (5, 5000):
        with held(spark.range(rows).coalesce(1), balanced=True) as (dealt,):
            assert dealt.is_cached and dealt.count() == rows and dealt.rdd.getNumPartitions() == parts
        assert not dealt.is_cached
    before = spark.range(7).cache()
    with held(before) as (same,):
        assert same is before
    assert before.is_cached
    before.unpersist()


# --- evaluation --------------------------------------------------------------


def test_metrics_agree_with_the_library(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    draw = random.Random(5)
    rows = [(draw.random() * 10, draw.random() * 10) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = evaluate.regression_metrics(df).first()
    names = {"mse": "mse", "rmse": "rmse", "mae": "mae", "r2": "r2", "var": "explained_variance"}
    for metric, name in names.items():
        assert RegressionEvaluator(metricName=metric).evaluate(df) == pytest.approx(ours[name])


def test_order_of_label_and_prediction_matters(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    right = evaluate.regression_metrics(df).first()
    turned = evaluate.regression_metrics(df, "prediction", "label").first()
    assert right["mse"] == turned["mse"] and right["r2"] != turned["r2"]


def test_threshold_table_with_a_hot_score(spark):
    draw = random.Random(2)
    rows = [(float(draw.random() < 0.4), 0.5 if draw.random() < 1 / 3 else round(draw.random(), 2)) for _ in range(900)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(5)
    table = {r["threshold"]: r for r in evaluate.threshold_table(df).collect()}
    assert set(table) == {score for _, score in rows}
    positives = sum(label for label, _ in rows)
    for threshold, row in table.items():
        tp = sum(1 for label, score in rows if score >= threshold and label == 1)
        fp = sum(1 for label, score in rows if score >= threshold and label == 0)
        assert (row["tp"], row["fp"]) == (tp, fp)
        assert row["tpr"] == pytest.approx(tp / positives)
        assert row["f1"] == pytest.approx(2 * tp / (tp + fp + positives))
    curve = sorted(((r["fpr"], r["tpr"]) for r in table.values())) + [(1.0, 1.0)]
    area, last = 0.0, (0.0, 0.0)
    for point in curve:
        area += (point[0] - last[0]) * (point[1] + last[1]) / 2
        last = point
    assert evaluate.area_under_roc(df).first()["auc"] == pytest.approx(area)


def test_best_threshold_is_the_best_row(spark):
    rows = [(1.0, 0.9), (1.0, 0.8), (0.0, 0.7), (1.0, 0.6), (0.0, 0.2)]
    table = evaluate.threshold_table(spark.createDataFrame(rows, "label double, score double"))
    assert evaluate.best_threshold(table).first()["threshold"] == 0.6


def test_library_threshold_measure_agrees(spark, folder):
    lines = inputs.line_vectors(spark, folder)
    rows = lines.withColumn("label", (F.col("l_extendedprice") + F.col("l_quantity") * 1000 > 75_000).cast("double"))
    model = supervised.fit_logistic(rows, reg=0.01, elastic_net=0.0)
    library = model.summary.fMeasureByThreshold.agg(F.max("F-Measure")).first()[0]
    scored = supervised.with_probability(model.transform(rows), "score")
    assert evaluate.threshold_table(scored).agg(F.max("f1")).first()[0] == pytest.approx(library, abs=2e-3)


def test_glm_p_values(spark, folder):
    rows = inputs.line_vectors(spark, folder).withColumnRenamed("l_extendedprice", "label")
    table = supervised.glm_summary_table(spark, supervised.fit_glm(rows, reg=0.0), ["q", "d", "t"]).collect()
    t = {r["term"]: r["value"] for r in table if r["statistic"] == "t_value"}
    p = {r["term"]: r["value"] for r in table if r["statistic"] == "p_value"}
    assert set(t) == set(p) == {"q", "d", "t", "(intercept)"}
    for term in t:  # with thousands of rows the t distribution is close to the normal one
        assert p[term] == pytest.approx(math.erfc(abs(t[term]) / math.sqrt(2)), abs=2e-3)


# --- models ------------------------------------------------------------------


def test_importances_sum_to_one(spark, folder):
    data = jobs.prepare_table(inputs.insurance(spark, folder), dropped=("cat3", "cat5"))[0]
    assert data.names == ["idx_cat1", "idx_cat2", "idx_cat4"] + [f"cont{i}" for i in range(1, 6)]
    model = supervised.fit_indexed_regressor(data.rows, "forest", max_categories=32, numTrees=3)
    stage = supervised.model_stage(model)
    table = supervised.importance_table(spark, stage, data.names)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    summary = supervised.tree_summary(spark, stage).first()
    assert summary["n_trees"] == 3 and summary["depth"] <= 5


def test_index_covers_the_test_table(spark):
    train = spark.createDataFrame([(i, "ab"[i % 2], float(i), float(i)) for i in range(40)], "id long, cat1 string, cont1 double, loss double")
    test = spark.createDataFrame([(1, "z", 1.0)], "id long, cat1 string, cont1 double")
    ready, scoring = jobs.prepare_table(train, [test])
    run = jobs.regress_table(ready, "forest", grid={"numTrees": (2,), "maxDepth": (2,)}, folds=2)
    assert run.predictions(scoring).columns == ["id", "loss"] and run.predictions(scoring).count() == 1
    parts = {r["part"]: r["n"] for r in run.metrics().collect()}
    assert sum(parts.values()) == 40


def test_mixture_weights_sum_to_one(spark, folder):
    model = unsupervised.fit_mixture(inputs.line_vectors(spark, folder), k=2, max_iter=5)
    table = unsupervised.mixture_table(spark, model).select("cluster", "weight").distinct()
    assert table.agg(F.sum("weight")).first()[0] == pytest.approx(1.0)


def test_topic_fit_agrees_with_the_library(spark, folder):
    docs = inputs.documents(spark, folder).select("doc_id", "text")
    words = jobs.text_tokens(docs)
    vocabulary = features.fit_vocabulary(words, "filtered", vocab_size=200, min_df=2)
    vectors = vocabulary.transform(words).select("doc_id", "features")
    model = unsupervised.fit_topics(vectors, k=3, max_iter=3)
    ours = unsupervised.topic_fit(model, vectors).first()
    assert ours["log_perplexity"] == pytest.approx(model.logPerplexity(vectors), rel=1e-3)
    assert unsupervised.topic_table(model, vocabulary.vocabulary, 3).count() == 9


def test_text_classifier_beats_chance(spark, folder):
    from tabulon.plans.model_queries import text_classifier_auc

    assert text_classifier_auc(spark, folder).first()["auc"] > 0.8


# --- recommender -------------------------------------------------------------


def rank_one(spark, users=range(30), items=range(20), seed=4):
    draw = random.Random(seed)
    rows = [
        (u, i, (1.0 + u % 4) * (1.0 + i % 3)) for u in users for i in items if draw.random() < 0.6
    ]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


EXACT = {"rank": 1, "iterations": 15, "reg": 1e-6}


def test_ids_beyond_32_bits(spark, tmp_path):
    base = 10**12
    ratings = rank_one(spark, [base + u for u in range(30)], [base + i for i in range(20)])
    fitted = recommend.fit_als(ratings, **EXACT)
    assert fitted.users is not None and fitted.items is not None
    predicted = fitted.predict(ratings)
    assert predicted.where("abs(prediction - rating) > 0.01").count() == 0 and predicted.count() == ratings.count()
    recommend.save_recommender(fitted, str(tmp_path / "m"))
    again = recommend.load_recommender(spark, str(tmp_path / "m"))
    assert again.predict(ratings).exceptAll(predicted).count() == 0


def test_unknown_pairs_are_dropped(spark):
    fitted = recommend.fit_als(rank_one(spark), **EXACT)
    pairs = spark.createDataFrame([(1, 1), (999, 1), (1, 999), (10**12, 1)], "user_id long, item_id long")
    assert [(r["user_id"], r["item_id"]) for r in fitted.predict(pairs).collect()] == [(1, 1)]


def test_rank_search_marks_one_best(spark):
    ratings = rank_one(spark)
    found = recommend.search_rank(ratings, ratings, ranks=(1, 2), iterations=5, reg=0.01).collect()
    assert [r["rank"] for r in found] == [1, 2] and sum(r["best"] for r in found) == 1


def test_many_users_make_no_pair_rows(spark):
    fitted = recommend.fit_als(rank_one(spark), **EXACT)
    items = spark.range(25).select(F.col("id").alias("item_id"))
    users = fitted.user_factors().select("user_id")
    rated = spark.createDataFrame([], "user_id long, item_id long")
    found = recommend.top_items(fitted, items, users, rated, k=3, digits=2, block_items=4)
    assert found.count() == 3 * users.count()
    pairs = users.crossJoin(items).select("user_id", "item_id")
    best = tables.top_per_user(fitted.predict(pairs).withColumnRenamed("prediction", "score"), 3, 2)
    mine = tables.top_per_user(found, 3, 2)
    key = lambda df: sorted((r["user_id"], r["place"], r["item_id"]) for r in df.collect())
    assert key(mine) == key(best)


def test_recommendations_for_several_users(spark):
    ratings = rank_one(spark)
    items = spark.createDataFrame([(i, f"t{i}") for i in range(25)], "item_id long, title string")
    new = spark.createDataFrame(
        [(u, i, u * -1.0 * (1.0 + i % 3)) for u in (-1, -2) for i in range(6)],
        "user_id long, item_id long, rating double",
    )
    found = jobs.recommend(ratings, items, new, users=[-1, -2], k=4, min_count=15, digits=2, **EXACT).collect()
    counts = {r["item_id"]: r["n_ratings"] for r in tables.item_stats(ratings).collect()}
    for user in (-1, -2):
        rows = sorted((r for r in found if r["user_id"] == user), key=lambda r: r["place"])
        best = sorted(
            (i for i in range(25) if counts.get(i, 0) >= 15 and i >= 6), key=lambda i: (-(1 + i % 3), i)
        )[:4]
        assert [r["item_id"] for r in rows] == best
        for r in rows:
            assert r["score"] == pytest.approx(-user * (1.0 + r["item_id"] % 3), abs=0.01)
            assert r["n_ratings"] == counts[r["item_id"]]


def test_both_recommendation_routes_agree(spark, folder):
    from tabulon.plans.recommend_queries import new_user_recommendations, top_recommendations

    keys = ["item_id", "title", "n_ratings"]
    one = new_user_recommendations(spark, folder).select(*keys).collect()
    two = top_recommendations(spark, folder).select(*keys).collect()
    assert sorted(one) == sorted(two)


def test_scores_are_the_predictions_of_all_candidate_pairs(spark, folder):
    items, fresh = inputs.items(spark, folder), inputs.new_ratings(spark, folder)
    fitted = jobs.recommend_model(inputs.ratings(spark, folder), fresh, iterations=3)
    pairs = tables.candidate_pairs(items, fresh, inputs.NEW_USER)
    predicted = {r["item_id"]: r["prediction"] for r in fitted.predict(pairs).collect()}
    scored = recommend.score_users(fitted, items.select("item_id"), [inputs.NEW_USER])
    scores = {r["item_id"]: r["score"] for r in scored.collect()}
    rated = {row["item_id"] for row in fresh.collect()}
    assert set(predicted) == set(scores) - rated
    assert all(scores[i] == pytest.approx(predicted[i], abs=1e-4) for i in predicted)


def test_search_results_table(spark):
    rows = spark.createDataFrame([(i, float(i), float(2 * i)) for i in range(60)], "id long, x double, label double")
    data = tables.with_fold(features.vectorised(rows, ["x"]), ["id"], 3)
    tree = supervised.tree_regressor("tree", "features", "label")
    grid = tuning.param_grid({tree.maxDepth: (1, 4)})
    model = tuning.cross_validate(tree, grid, evaluate.rmse_evaluator(), data)
    table = tuning.metric_table(spark, model, larger_is_better=False).orderBy("point").collect()
    assert [r["maxDepth"] for r in table] == [1.0, 4.0] and [r["best"] for r in table] == [False, True]
    assert model.bestModel.getMaxDepth() == 4
