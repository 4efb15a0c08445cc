"""Small literal inputs with results worked out by hand."""

import math

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabulon.functions import fields_of_line, prefix_label, token_count, token_count_udf
from tabulon.operators import features, principal, supervised, tables, tuning, unsupervised
from tabulon.plans import jobs
from tabulon.sources.readers import MOVIE_SCHEMA, RATING_SCHEMA


def column(df, name):
    return [row[name] for row in df.collect()]


def array_column(df, name, places=4):
    return [[round(v, places) for v in row[0]] for row in df.select(vector_to_array(name)).collect()]


def vectors(spark, rows):
    df = spark.createDataFrame([(i, list(row)) for i, row in enumerate(rows)], "id long, a array<double>")
    return df.coalesce(1).select("id", array_to_vector("a").alias("features"))


def test_binarize_is_strict(spark):
    df = spark.createDataFrame([(2.5,), (-1.0,), (2.51,)], "x double").coalesce(1)
    assert column(features.binarize(df, "x", "b", threshold=2.5), "b") == [0.0, 0.0, 1.0]


def test_bucketize_half_open(spark):
    df = spark.createDataFrame([(v,) for v in (-7.0, 10.0, 19.9, 20.0, 1e6)], "x double").coalesce(1)
    cut = features.bucketize(df, "x", "b", splits=(-math.inf, 10.0, 20.0, math.inf))
    assert column(cut, "b") == [0.0, 1.0, 1.0, 2.0, 2.0]


def test_bucketize_rejects_nan_unless_told(spark):
    df = spark.createDataFrame([(float("nan"),), (3.0,)], "x double").coalesce(1)
    splits = (0.0, 2.0, 4.0)
    with pytest.raises(Exception):
        features.bucketize(df, "x", "b", splits).collect()
    assert column(features.bucketize(df, "x", "b", splits, handle_invalid="keep"), "b") == [2.0, 1.0]


WEIGHTS = [4.0, 7.0, 1.0, 9.0, 12.0, 3.0]


def test_quantile_bins(spark):
    df = spark.createDataFrame(list(enumerate(WEIGHTS)), "id long, weight double").coalesce(1)
    assert features.quantile_splits(df, "weight", 3) == [-math.inf, 3.0, 7.0, math.inf]
    for error in (None, 0.001):
        binned = features.quantile_bins(df, "weight", "bin", 3, relative_error=error).orderBy("id")
        assert column(binned, "bin") == [1.0, 2.0, 0.0, 2.0, 2.0, 1.0]


TRIPLES = [(3.0, -2.0, 0.5), (6.0, 1.0, -1.5), (9.0, 4.0, 2.0)]


def test_maxabs_scale(spark):
    scaled = features.maxabs_scale(vectors(spark, TRIPLES), "features").orderBy("id")
    assert array_column(scaled, "scaled") == [[0.3333, -0.5, 0.25], [0.6667, 0.25, -0.75], [1.0, 1.0, 1.0]]


def test_standard_scale(spark):
    scaled = features.standard_scale(vectors(spark, TRIPLES), "features").orderBy("id")
    third = math.sqrt(37 / 12)  # sample deviation of 0.5, -1.5 and 2
    want = [[a / 3, b / 3, c / third] for a, b, c in TRIPLES]
    assert array_column(scaled, "scaled") == [[round(v, 4) for v in row] for row in want]


def test_polynomial_order(spark):
    expanded = features.expand_polynomial(vectors(spark, [(1.0, 2.0), (-1.0, 3.0)]), "features").orderBy("id")
    want = [[x, x * x, x**3, y, x * y, x * x * y, y * y, x * y * y, y**3] for x, y in ((1.0, 2.0), (-1.0, 3.0))]
    assert array_column(expanded, "expanded") == want


SIDES = list(enumerate(["north", "north", "east", "south", "east", "north"]))
SIDE_INDEX = [0.0, 0.0, 1.0, 2.0, 1.0, 0.0]


def test_string_index_one_hot_and_back(spark):
    df = spark.createDataFrame(SIDES, "id long, side string")
    model = features.fit_string_index(df, ["side"], ["i"])
    assert list(model.labelsArray[0]) == ["north", "east", "south"]
    indexed = model.transform(df)
    assert column(indexed.orderBy("id"), "i") == SIDE_INDEX
    hot = features.one_hot(indexed, ["i"], ["v"]).orderBy("id")
    assert array_column(hot, "v") == [[float(i == 0), float(i == 1)] for i in SIDE_INDEX]
    back = features.indices_to_labels(indexed, "i", "again", model.labelsArray[0])
    assert back.where("again <> side").count() == 0


def test_string_index_by_join_agrees_for_any_number_of_labels(spark):
    df = spark.createDataFrame(SIDES, "id long, side string")
    assert column(features.index_by_join(df, "side", "i").orderBy("id"), "i") == SIDE_INDEX
    wide = spark.range(3000).select(F.col("id"), F.concat(F.lit("v"), F.col("id") % 1500).alias("side"))
    one = features.index_by_join(wide, "side", "i").orderBy("id").collect()
    two = features.fit_string_index(wide, ["side"], ["i"]).transform(wide).orderBy("id").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in two]


@pytest.mark.parametrize("label", ["up", None])
def test_both_indexes_reject_unseen_and_null_labels(spark, label):
    df = spark.createDataFrame(SIDES, "id long, side string")
    odd = spark.createDataFrame([(9, label)], "id long, side string")
    with pytest.raises(Exception):
        features.fit_string_index(df, ["side"], ["i"]).transform(odd).collect()
    with pytest.raises(Exception):
        features.index_by_join(odd, "side", "i", vocabulary=df).collect()


def test_stop_words(spark):
    rows = [(0, ["This", "is", "the", "green", "house"]), (1, ["WE", "row", "and", "sing"])]
    df = spark.createDataFrame(rows, "id long, raw array<string>")
    kept = column(features.remove_stop_words(df, "raw").orderBy("id"), "filtered")
    assert kept == [["green", "house"], ["row", "sing"]]


def test_restated_stop_words_are_the_library_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    from tabulon.plans.feature_queries import ENGLISH_STOP_WORDS

    assert sorted(ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


LINES = ["Two boats left The harbour", "rain;wind;and;more;rain", "no boats came back"]


def test_tokenizers_and_counts(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "id long, line string")
    plain = features.tokenize(df, "line").orderBy("id")
    assert column(plain.select(token_count("words").alias("n")), "n") == [5, 1, 4]
    by_pattern = features.tokenize_pattern(df, "line").orderBy("id")
    assert column(by_pattern.select(token_count_udf("words").alias("n")), "n") == [5, 5, 4]
    assert column(plain, "words")[0] == ["two", "boats", "left", "the", "harbour"]


def test_token_counts_of_null_agree(spark):
    df = spark.createDataFrame([(None,), (["one"],)], "words array<string>").coalesce(1)
    both = df.select(token_count("words").alias("a"), token_count_udf("words").alias("b")).collect()
    assert [tuple(r) for r in both] in ([(-1, -1), (1, 1)], [(None, -1), (1, 1)])


BASKETS_OF_WORDS = [(0, "oak elm oak".split()), (1, "elm ash oak".split()), (2, "ash fir".split())]


def test_count_vectors(spark):
    df = spark.createDataFrame(BASKETS_OF_WORDS, "id long, words array<string>")
    model = features.fit_vocabulary(df, "words", min_df=2)
    assert model.vocabulary == ["oak", "ash", "elm"]
    counts = features.vector_terms(model.transform(df), "features", "id", model.vocabulary)
    want = {(0, "oak", 2.0), (0, "elm", 1.0), (1, "elm", 1.0), (1, "ash", 1.0), (1, "oak", 1.0), (2, "ash", 1.0)}
    assert set(map(tuple, counts.collect())) == want
    assert set(map(tuple, features.count_terms(df, "id", "words").collect())) == want | {(2, "fir", 1.0)}


def test_vocabulary_takes_all_terms_or_the_first(spark):
    df = spark.createDataFrame(BASKETS_OF_WORDS, "id long, words array<string>")
    assert features.fit_vocabulary(df, "words").vocabulary == ["oak", "ash", "elm", "fir"]
    assert features.fit_vocabulary(df, "words", vocab_size=2).vocabulary == ["oak", "ash"]
    with pytest.raises(ValueError):
        features.fit_vocabulary(df, "words", min_df=4)


def test_hashed_terms(spark):
    df = features.tokenize(spark.createDataFrame(list(enumerate(LINES)), "id long, line string"), "line")
    hashed = features.hash_terms(df, "words", num_features=16)
    assert [sum(row[0]) for row in hashed.orderBy("id").select(vector_to_array("raw_features")).collect()] == [5.0, 1.0, 4.0]
    weights = features.fit_idf(hashed, "raw_features").idf.toArray()
    known = {round(math.log(4 / (1 + d)), 6) for d in range(4)}
    assert {round(float(w), 6) for w in weights} <= known


def test_term_weights_agree_with_vector_weights(spark):
    df = spark.createDataFrame(BASKETS_OF_WORDS, "id long, words array<string>")
    model = features.fit_vocabulary(df, "words", out="counts")
    vectors_ = model.transform(df)
    for min_df in (0, 2):
        by_vector = features.fit_idf(vectors_, "counts", min_doc_freq=min_df).transform(vectors_)
        expected = features.vector_terms(by_vector, "features", "id", model.vocabulary)
        found = features.weigh_terms(df, "id", "words", documents=3, min_doc_freq=min_df)
        key = lambda rows: sorted((r["id"], r["term"], round(r["value"], 9)) for r in rows)
        assert key(found.collect()) == key(expected.where("value <> 0").collect())


def test_ngrams(spark):
    df = spark.createDataFrame([(0, LINES[2].split()), (1, ["alone"])], "id long, words array<string>")
    assert column(features.join_ngrams(df, "words").orderBy("id"), "ngrams") == [["no boats", "boats came", "came back"], []]


def test_sql_stage(spark):
    df = spark.createDataFrame([(0, 5), (1, 8)], "id long, n int")
    done = features.sql_stage(df, "SELECT id, n % 3 AS left_over FROM __THIS__ WHERE n > 5")
    assert [tuple(r) for r in done.collect()] == [(1, 2)]


def test_formula(spark):
    paints = ["red", "blue", "red", "green", "blue", "red"]
    rows = [(i, paint, 10 - i, float(i % 2)) for i, paint in enumerate(paints)]
    df = spark.createDataFrame(rows, "id long, paint string, age long, sold double")
    shaped = features.apply_formula(df, "sold ~ paint + age").orderBy("id")
    want = [[float(p == "red"), float(p == "blue"), float(age)] for _, p, age, _ in rows]
    assert array_column(shaped, "features") == want
    assert column(shaped, "label") == [0.0, 1.0, 0.0, 1.0, 0.0, 1.0]


def test_itemsets_and_rules(spark):
    rows = [(0, ["tea", "milk"]), (1, ["tea", "milk", "jam"]), (2, ["tea", "jam"]), (3, ["milk"])]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    model = unsupervised.fit_itemsets(df, min_support=0.5, min_confidence=0.6)
    found = {r["items"]: r["freq"] for r in unsupervised.itemset_table(model).collect()}
    assert found == {"tea": 3, "milk": 3, "jam": 2, "milk,tea": 2, "jam,tea": 2}
    assert unsupervised.rule_table(model).count() == 4
    predicted = unsupervised.predict_by_rules(model, df, "id").orderBy("id")
    assert column(predicted, "prediction") == [["jam"], [], ["milk"], ["tea"]]
    assert column(predicted, "prediction") == column(model.transform(df).orderBy("id"), "prediction")
    assert "Join" in predicted._jdf.queryExecution().toString()


def test_pca(spark):
    shares = principal.fit_pca(vectors(spark, [(3.0, 0.0), (-3.0, 0.0), (0.0, 1.0), (0.0, -1.0)]), "features", k=2).shares
    assert [round(float(v), 6) for v in shares] == [0.9, 0.1]


def test_sparse_entries_of_both_kinds(spark):
    rows = [(0, Vectors.sparse(4, [(0, 2.5), (2, -1.0)])), (1, Vectors.dense([0.0, 0.0, 6.0])), (2, Vectors.sparse(2, []))]
    df = spark.createDataFrame(rows, ["id", "features"])
    found = df.select("id", F.inline(features.sparse_entries("features")))
    assert sorted(map(tuple, found.collect())) == [(0, 0, 2.5), (0, 2, -1.0), (1, 2, 6.0)]


def test_word_vectors(spark):
    rows = [(i, text.replace(";", " ").split()) for i, text in enumerate(LINES)]
    df = spark.createDataFrame(rows, "id long, text array<string>")
    model = features.fit_word_vectors(df, "text", size=3, min_count=0)
    assert model.getVectors().count() == len({w for _, words in rows for w in words})
    assert all(len(v) == 3 for v in array_column(model.transform(df), "vector"))


#: A text is about the sea if it has the word "ship".
SEA = [(i, f"word{i} {'ship' if i % 2 else 'barn'} word{i % 5}", float(i % 2)) for i in range(20)]


def test_small_text_search(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF

    from tabulon.operators import evaluate

    train = spark.createDataFrame(SEA, "id long, text string, label double")
    words = features.tokenize(train, "text", "words").withColumn("fold", (F.col("id") % 4 / 2).cast("int"))
    hashing = HashingTF(inputCol="words", outputCol="features")
    logistic = LogisticRegression(maxIter=8)
    grid = tuning.param_grid({hashing.numFeatures: [64, 512], logistic.regParam: [0.05, 0.5]})
    model = tuning.cross_validate(Pipeline(stages=[hashing, logistic]), grid, evaluate.auc_evaluator(), words, folds=2)
    scoring = spark.createDataFrame([(1, "a ship at night"), (2, "the old barn")], "id long, text string")
    scored = supervised.with_probability(model.transform(features.tokenize(scoring, "text"))).orderBy("id")
    assert column(scored, "prediction") == [1.0, 0.0]
    table = tuning.metric_table(spark, model, larger_is_better=True).collect()
    assert len(table) == 4 and sum(r["best"] for r in table) == 1


def test_text_job_learns(spark):
    train = spark.createDataFrame(SEA, "id long, text string, label double")
    model = jobs.classify_text(jobs.text_tokens(train), num_features=512)
    scored = model.transform(jobs.text_tokens(train))
    assert scored.where("prediction = label").count() == len(SEA)


def test_feature_columns():
    assert tables.feature_columns(["id", "catA", "size", "label", "catB"]) == ["idx_catA", "size", "idx_catB"]


def test_lines_with_quotes_and_large_ids(spark):
    lines = ['7,"A ""b"", c",x|y', "3000000000,plain,z"]
    df = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    parsed = df.select(fields_of_line("value", MOVIE_SCHEMA).alias("f")).select("f.*")
    assert [tuple(r) for r in parsed.collect()] == [(7, 'A "b", c', "x|y"), (3000000000, "plain", "z")]


def test_a_bad_id_is_an_error(spark):
    df = spark.createDataFrame([("x9,4,3.5,11",)], "value string")
    with pytest.raises(Exception):
        df.select(fields_of_line("value", RATING_SCHEMA)).collect()


def test_prefixes_are_not_patterns(spark):
    df = spark.createDataFrame([("a_c",), ("abc",), (None,)], "x string").coalesce(1)
    assert column(df.select(prefix_label("x", "a_").alias("p")), "p") == [1.0, 0.0, None]
    assert column(tables.with_prefix(df, "x", "a_"), "x") == ["a_c"]
