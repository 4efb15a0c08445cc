"""Queries over models, mining, evaluation and tuning.

Where a fit has a closed form, the check SQL states it and the query calls the
same function as the general case, with parameters that make the form exact.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import prefix_label
from tabulon.operators import evaluate, features, gram, principal, supervised, tables, topics, tuning, unsupervised, variational
from tabulon.plans import inputs, jobs
from tabulon.plans.feature_queries import STOPS
from tabulon.plans.registry import query, rounded
from tabulon.session import written
from tabulon.sources import read_table

NAMES = ["l_quantity", "l_discount", "l_tax"]


def _rounded_all(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(c, places) for c in columns})


# --- linear models -----------------------------------------------------------


def _priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("label")
    )
    return features.vectorised(lines, ["l_quantity"])


@query(
    "linear_regression",
    f"""WITH {inputs.INSURANCE_SQL}, m AS (
          SELECT corr(loss / 1000, cont1) AS r, stddev_pop(loss / 1000) AS sy, stddev_pop(cont1) AS sx,
                 avg(loss / 1000) AS my, avg(cont1) AS mx FROM insurance),
        f AS (SELECT *, sign(r) * greatest(abs(r) - 0.8 * 0.3 / sy, 0) / (1 + 0.2 * 0.3 / sy) * sy / sx AS b FROM m)
        SELECT 'cont1' AS term, round(b, 4) + 0.0 AS coefficient FROM f
        UNION ALL SELECT '(intercept)', round(my - b * mx, 4) + 0.0 FROM f""",
)
def linear_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Elastic net with the usual parameters; with one feature it has a closed form."""
    return _rounded_all(
        supervised.linear_table(spark, supervised.fit_linear(_quantity_loss(spark, folder)), ["cont1"]),
        4,
        "coefficient",
    )


def _quantity_loss(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.insurance(spark, folder).select("cont1", (F.col("loss") / 1000).alias("label"))
    return features.vectorised(rows, ["cont1"])


@query("elastic_net_three")
def elastic_net_three(spark: SparkSession, folder: str) -> DataFrame:
    """Elastic net on three features."""
    rows = inputs.line_vectors(spark, folder).withColumnRenamed("l_extendedprice", "label")
    model = supervised.fit_linear(rows)
    return _rounded_all(supervised.linear_table(spark, model, NAMES), 4, "coefficient")


@query("linear_summary")
def linear_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.line_vectors(spark, folder).withColumnRenamed("l_extendedprice", "label")
    found = supervised.linear_summary_table(spark, supervised.fit_linear(rows))
    return _rounded_all(found, 4, "first_objective", "last_objective", "rmse", "r2")


@query(
    "ols_fit",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT 'l_quantity' AS term, round(b, 4) + 0.0 AS coefficient FROM f
       UNION ALL SELECT '(intercept)', round(a, 4) + 0.0 FROM f""",
)
def ols_fit(spark: SparkSession, folder: str) -> DataFrame:
    model = supervised.fit_linear(_priced_lines(spark, folder), reg=0.0, elastic_net=0.0, solver="normal")
    return _rounded_all(supervised.linear_table(spark, model, ["l_quantity"]), 4, "coefficient")


@query(
    "ols_residuals",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT l_orderkey, l_linenumber, round(l_extendedprice - a - b * l_quantity, 3) + 0.0 AS residual FROM lineitem, f""",
)
def ols_residuals(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced_lines(spark, folder)
    model = supervised.fit_linear(rows, reg=0.0, elastic_net=0.0, solver="normal")
    residuals = supervised.residual_table(model.transform(rows))
    return residuals.select("l_orderkey", "l_linenumber", rounded("residual", 3).alias("residual"))


@query(
    "ols_summary",
    """WITH f AS (SELECT regr_r2(l_extendedprice, l_quantity) AS r2, regr_slope(l_extendedprice, l_quantity) AS b,
                         regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT round(sqrt(avg((l_extendedprice - a - b * l_quantity) * (l_extendedprice - a - b * l_quantity))), 3) + 0.0 AS rmse,
              round(max(r2), 6) + 0.0 AS r2 FROM lineitem, f""",
)
def ols_summary(spark: SparkSession, folder: str) -> DataFrame:
    model = supervised.fit_linear(_priced_lines(spark, folder), reg=0.0, elastic_net=0.0, solver="normal")
    return supervised.linear_summary_table(spark, model).select(
        rounded("rmse", 3).alias("rmse"), rounded("r2", 6).alias("r2")
    )


@query(
    "glm_regularised",
    f"""WITH {inputs.INSURANCE_SQL}, m AS (
          SELECT corr(loss / 1000, cont1) AS r, stddev_pop(loss / 1000) AS sy, stddev_pop(cont1) AS sx,
                 avg(loss / 1000) AS my, avg(cont1) AS mx FROM insurance),
        f AS (SELECT *, r / (1 + 0.3 / sy) * sy / sx AS b FROM m)
        SELECT 'cont1' AS term, round(b, 4) + 0.0 AS coefficient FROM f
        UNION ALL SELECT '(intercept)', round(my - b * mx, 4) + 0.0 FROM f""",
)
def glm_regularised(spark: SparkSession, folder: str) -> DataFrame:
    """Gaussian model with an L2 penalty of 0.3."""
    model = supervised.fit_glm(_quantity_loss(spark, folder))
    return _rounded_all(supervised.linear_table(spark, model, ["cont1"]), 4, "coefficient")


_GLM_SQL = """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                   count(*) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx, avg(l_quantity) AS xm,
                   var_pop(l_extendedprice) * count(*) AS null_dev FROM lineitem),
  d AS (SELECT sum((l_extendedprice - a - b * l_quantity) * (l_extendedprice - a - b * l_quantity)) AS dev FROM lineitem, f),
  s AS (SELECT *, dev / (n - 2) AS disp FROM f, d),
  e AS (SELECT *, sqrt(disp / sxx) AS se_b, sqrt(disp * (1.0 / n + xm * xm / sxx)) AS se_a FROM s)"""


@query(
    "glm_fit",
    f"""{_GLM_SQL} SELECT 'l_quantity' AS term, round(b, 4) + 0.0 AS coefficient FROM e
        UNION ALL SELECT '(intercept)', round(a, 4) + 0.0 FROM e""",
)
def glm_fit(spark: SparkSession, folder: str) -> DataFrame:
    model = supervised.fit_glm(_priced_lines(spark, folder), reg=0.0)
    return _rounded_all(supervised.linear_table(spark, model, ["l_quantity"]), 4, "coefficient")


@query(
    "glm_summary",
    f"""{_GLM_SQL} SELECT term, statistic, round(value / power, 6) + 0.0 AS value FROM (
          SELECT 'l_quantity' AS term, 'std_error' AS statistic, se_b AS value, 1.0 AS power FROM e
          UNION ALL SELECT '(intercept)', 'std_error', se_a, 1.0 FROM e
          UNION ALL SELECT 'l_quantity', 't_value', b / se_b, 1.0 FROM e
          UNION ALL SELECT '(intercept)', 't_value', a / se_a, 1.0 FROM e
          UNION ALL SELECT '(fit)', 'dispersion', disp, 1e9 FROM e
          UNION ALL SELECT '(fit)', 'null_deviance', null_dev, 1e15 FROM e
          UNION ALL SELECT '(fit)', 'deviance', dev, 1e15 FROM e
          UNION ALL SELECT '(fit)', 'df_null', n - 1, 1.0 FROM e
          UNION ALL SELECT '(fit)', 'df_residual', n - 2, 1.0 FROM e
          UNION ALL SELECT '(fit)', 'aic', n * (ln(2 * pi() * dev / n) + 1) + 2 + 4, 1e3 FROM e)""",
)
def glm_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Summary statistics; the large ones are given in billions and the like."""
    model = supervised.fit_glm(_priced_lines(spark, folder), reg=0.0)
    found = supervised.glm_summary_table(spark, model, ["l_quantity"]).where("statistic <> 'p_value'")
    power = (
        F.when(F.col("statistic") == "dispersion", 1e9)
        .when(F.col("statistic").isin("null_deviance", "deviance"), 1e15)
        .when(F.col("statistic") == "aic", 1e3)
        .otherwise(1.0)
    )
    return found.withColumn("value", rounded(F.col("value") / power, 6))


def _binary_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Whether price and a bonus per piece exceed a bound, from quantity, discount and tax."""
    rows = inputs.line_vectors(spark, folder)
    total = F.col("l_extendedprice") + F.col("l_quantity") * 1000
    return rows.withColumn("label", (total > 75_000).cast("double"))


@query("logistic")
def logistic(spark: SparkSession, folder: str) -> DataFrame:
    model = supervised.fit_logistic(_binary_lines(spark, folder), reg=0.01)
    return _rounded_all(supervised.logistic_table(spark, model, NAMES), 4, "coefficient")


@query("logistic_objective")
def logistic_objective(spark: SparkSession, folder: str) -> DataFrame:
    model = supervised.fit_logistic(_binary_lines(spark, folder), reg=0.01)
    return _rounded_all(supervised.objective_table(spark, model), 6, "objective")


@query("logistic_roc")
def logistic_roc(spark: SparkSession, folder: str) -> DataFrame:
    """The ROC points of the training summary, with the area under them."""
    model = supervised.fit_logistic(_binary_lines(spark, folder), reg=0.01)
    area = float(model.summary.areaUnderROC)
    return model.summary.roc.select(
        rounded("FPR", 6).alias("fpr"), rounded("TPR", 6).alias("tpr"), F.lit(round(area, 6)).alias("auc")
    )


@query(
    "logistic_score_equations",
    """WITH d AS (SELECT CAST(l_extendedprice + l_quantity * 1000 > 75000 AS DOUBLE) AS y, l_quantity, l_discount, l_tax FROM lineitem)
       SELECT round(avg(y), 5) + 0.0 AS share, round(avg(y * l_quantity), 5) + 0.0 AS by_quantity,
              round(avg(y * l_discount), 5) + 0.0 AS by_discount, round(avg(y * l_tax), 5) + 0.0 AS by_tax FROM d""",
)
def logistic_score_equations(spark: SparkSession, folder: str) -> DataFrame:
    """Without a penalty, the fitted probabilities match the labels in every feature's moment."""
    rows = _binary_lines(spark, folder)
    model = supervised.fit_logistic(rows, reg=0.0, elastic_net=0.0, max_iter=100, tol=1e-10)
    scored = supervised.with_probability(model.transform(rows))
    moments = {"by_quantity": "l_quantity", "by_discount": "l_discount", "by_tax": "l_tax"}
    return scored.agg(
        rounded(F.avg("p"), 5).alias("share"),
        *[rounded(F.avg(F.col("p") * F.col(c)), 5).alias(name) for name, c in moments.items()],
    )


def _one_hot_priority(spark: SparkSession, folder: str, label: str) -> DataFrame:
    orders = inputs.priced_orders(spark, folder).withColumnRenamed("label", "price")
    indexed = features.index_by_join(orders, "priority", "priority_index")
    hot = features.one_hot(indexed, ["priority_index"], ["features"])
    if label == "dear":
        return hot.withColumn("label", (F.col("price") > 250_000).cast("double"))
    return features.index_by_join(hot, "status", "label")


_GROUP_RATES_SQL = """SELECT o_orderpriority AS priority, count(*) AS n, round(avg(CAST(o_totalprice > 250000 AS DOUBLE)), 4) + 0.0 AS p
  FROM orders GROUP BY 1"""


def _group_rates(spark: SparkSession, folder: str, family: str) -> DataFrame:
    """Without a penalty, a logistic fit on one-hot groups gives the group rates."""
    rows = _one_hot_priority(spark, folder, "dear")
    model = supervised.fit_logistic(
        rows, reg=0.0, elastic_net=0.0, max_iter=200, tol=1e-10, family=family
    )
    scored = supervised.with_probability(model.transform(rows))
    return scored.groupBy("priority").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("p"), 4).alias("p")
    )


@query("logit_groups", _GROUP_RATES_SQL)
def logit_groups(spark: SparkSession, folder: str) -> DataFrame:
    return _group_rates(spark, folder, "auto")


@query("logistic_multinomial_family", _GROUP_RATES_SQL)
def logistic_multinomial_family(spark: SparkSession, folder: str) -> DataFrame:
    return _group_rates(spark, folder, "multinomial")


@query("multinomial_coefficients")
def multinomial_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficient matrix and intercepts of the multinomial family on two classes."""
    model = supervised.fit_logistic(_binary_lines(spark, folder), reg=0.01, elastic_net=0.0, family="multinomial")
    return _rounded_all(supervised.logistic_table(spark, model, NAMES), 4, "coefficient")


@query(
    "multiclass_logit_groups",
    """WITH g AS (SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS c FROM orders GROUP BY 1, 2)
       SELECT priority, status, round(c / sum(c) OVER (PARTITION BY priority), 4) + 0.0 AS p FROM g""",
)
def multiclass_logit_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The same with three classes: the share of each status in each priority."""
    rows = _one_hot_priority(spark, folder, "status")
    model = supervised.fit_logistic(rows, reg=0.0, elastic_net=0.0, max_iter=300, tol=1e-10)
    classes = rows.select("status", F.col("label").cast("int").alias("class")).distinct()
    shares = model.transform(rows).select("priority", F.posexplode(vector_to_array("probability")).alias("class", "p"))
    means = shares.groupBy("priority", "class").agg(rounded(F.avg("p"), 4).alias("p"))
    return means.join(classes, "class").select("priority", "status", "p")


@query("multiclass_logistic")
def multiclass_logistic(spark: SparkSession, folder: str) -> DataFrame:
    """Ten embedding classes with the elastic net: predictions counted against labels."""
    rows = inputs.vectors(spark, folder)
    model = supervised.fit_logistic(rows, reg=0.01, elastic_net=0.8)
    return model.transform(rows).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("mlp")
def mlp(spark: SparkSession, folder: str) -> DataFrame:
    """Perceptron 4-5-4-3: four axes of the embeddings to three groups of labels."""
    rows = inputs.vectors(spark, folder)
    axes = principal.fit_pca(rows, "features", "axes", k=4).transform(rows)
    data = axes.select("vec_id", F.col("axes").alias("features"), (F.col("label") % 3).cast("double").alias("label"))
    split = tables.with_split(data, ["vec_id"], {"train": 6, "test": 4}, seed=1234)
    model = supervised.fit_perceptron(split.where("part = 'train'"))
    return evaluate.accuracy(model.transform(split.where("part = 'test'")))


@query(
    "mlp_separable",
    "SELECT o_orderstatus AS status, o_orderstatus AS predicted, count(*) AS n FROM orders GROUP BY 1, 2",
)
def mlp_separable(spark: SparkSession, folder: str) -> DataFrame:
    """The perceptron 4-5-4-3 on classes that three indicators and a constant tell apart."""
    orders = read_table(spark, folder, "orders").select("o_orderstatus")
    index = features.fit_string_index(orders, ["o_orderstatus"], ["label"])
    hot = index.transform(orders).withColumns(
        {**{f"is_{i}": (F.col("label") == i).cast("double") for i in range(3)}, "one": F.lit(1.0)}
    )
    rows = features.vectorised(hot, ["is_0", "is_1", "is_2", "one"])
    model = supervised.fit_perceptron(rows)
    named = features.indices_to_labels(model.transform(rows), "prediction", "predicted", index.labelsArray[0])
    return named.groupBy(F.col("o_orderstatus").alias("status"), "predicted").agg(F.count(F.lit(1)).alias("n"))


# --- trees -------------------------------------------------------------------


def _group_model(spark: SparkSession, folder: str, kind: str, **params):
    orders = inputs.priced_orders(spark, folder)
    index = features.fit_string_index(orders, ["priority"], ["priority_index"])
    indexed = index.transform(orders)
    rows = features.vectorised(indexed, ["priority_index"])
    return rows, supervised.fit_indexed_regressor(rows, kind, max_categories=5, **params)


def group_tree(spark: SparkSession, folder: str, kind: str, **params) -> DataFrame:
    """Order price predicted from the priority class alone, by the general tree job.

    With one categorical feature and depth to spare, a regression tree ends in one
    leaf per category, so its predictions are the group means.
    """
    rows, model = _group_model(spark, folder, kind, **params)
    return model.transform(rows)


_GROUP_MEANS_SQL = """SELECT o_orderpriority AS priority, count(*) AS n, round(avg(o_totalprice), 2) + 0.0 AS prediction
  FROM orders GROUP BY 1"""


def _group_predictions(df: DataFrame) -> DataFrame:
    return df.groupBy("priority", rounded("prediction", 2).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("tree_regress", _GROUP_MEANS_SQL)
def tree_regress(spark: SparkSession, folder: str) -> DataFrame:
    return _group_predictions(group_tree(spark, folder, "tree", maxDepth=5))


@query("forest_regress_exact", _GROUP_MEANS_SQL)
def forest_regress_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Ten trees on all rows and features are ten times the same tree, and so is their mean."""
    params = {"numTrees": 10, "bootstrap": False, "featureSubsetStrategy": "all"}
    return _group_predictions(group_tree(spark, folder, "forest", maxDepth=5, **params))


@query("gbt_regress_exact", _GROUP_MEANS_SQL)
def gbt_regress_exact(spark: SparkSession, folder: str) -> DataFrame:
    """One boosting round is one tree."""
    return _group_predictions(group_tree(spark, folder, "boosted", maxDepth=5, maxIter=1))


@query(
    "tree_rare_value",
    """WITH d AS (SELECT CASE WHEN l_orderkey = (SELECT min(l_orderkey) FROM lineitem) THEN 25.5 ELSE l_quantity END::DOUBLE AS x FROM lineitem)
       SELECT x, CASE WHEN x = 25.5 THEN 1000000.0 WHEN x < 25.5 THEN 10.0 ELSE 20.0 END::DOUBLE AS prediction, count(*) AS n
       FROM d GROUP BY 1, 2""",
)
def tree_rare_value(spark: SparkSession, folder: str) -> DataFrame:
    """A value that only the lines of one order have, in the middle of the others: its bin is a split of its own."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    one = lines.agg(F.min("l_orderkey")).first()[0]
    x = F.when(F.col("l_orderkey") == one, 25.5).otherwise(F.col("l_quantity").cast("double"))
    rows = lines.select(x.alias("x"))
    target = F.when(F.col("x") == 25.5, 1e6).when(F.col("x") < 25.5, 10.0).otherwise(20.0)
    rows = rows.withColumn("label", target)
    tree = supervised.tree_regressor("tree", "features", "label", maxDepth=2)
    model = supervised.fit_binned_tree(rows, ["x"], tree, bins=64)
    return model.transform(rows).groupBy("x", rounded("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "linear_cv",
    """WITH d AS (SELECT l_orderkey % 3 AS fold, l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y FROM lineitem),
         g AS (SELECT r.reg, m.mix, f.fold FROM (VALUES (0.0::DOUBLE), (0.1::DOUBLE), (2.0::DOUBLE)) r(reg),
                      (VALUES (0.0::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE)) m(mix), (SELECT DISTINCT fold FROM d) f),
         s AS (SELECT f.fold, avg(x) AS mx, avg(y) AS my, var_pop(x) AS v, covar_pop(x, y) AS c FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY 1),
         b AS (SELECT reg, mix, fold, mx, my,
                      sign(c) * greatest(abs(c) - reg * mix * sqrt(v), 0) / (v * (1 + reg * (1 - mix))) AS b FROM g JOIN s USING (fold)),
         e AS (SELECT reg, mix, fold, count(*) AS n, sqrt(avg((y - my - b * (x - mx)) * (y - my - b * (x - mx)))) AS rmse
               FROM b JOIN d USING (fold) GROUP BY 1, 2, 3),
         m AS (SELECT reg, mix FROM e GROUP BY 1, 2 ORDER BY round(avg(rmse), 6), reg, mix LIMIT 1)
       SELECT reg, mix AS elastic_net, fold::INTEGER AS fold, n, round(rmse, 4) + 0.0 AS rmse, (reg, mix) IN (SELECT (reg, mix) FROM m) AS best FROM e""",
)
def linear_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Three-fold error of price on quantity for nine penalties, from one scan."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", F.col("l_extendedprice").alias("label"))
    rows = features.vectorised(lines.withColumn("fold", F.col("l_orderkey") % 3), ["l_quantity"])
    found = gram.linear_search(rows, regs=(0.0, 0.1, 2.0), elastic_nets=(0.0, 0.5, 1.0)).table(spark)
    return found.withColumn("rmse", rounded("rmse", 4))


def _group_majority(spark: SparkSession, folder: str, kind: str, label: str, **params) -> DataFrame:
    """With one categorical feature the predicted class is the majority of its group."""
    orders = inputs.priced_orders(spark, folder)
    dear = F.when(F.col("label") > 250_000, "dear").otherwise("cheap")
    named = orders.withColumn("dear", dear).drop("label")
    indexed = features.fit_string_index(named, ["priority"], ["priority_index"]).transform(named)
    rows = features.vectorised(indexed, ["priority_index"])
    model = supervised.fit_indexed_classifier(
        rows, kind, label=label, max_categories=5, maxDepth=5, **params
    )
    return model.transform(rows).groupBy("priority", F.col("predicted_label").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _majority_sql(label: str) -> str:
    return f"""WITH d AS (SELECT o_orderpriority AS priority, {label} AS label FROM orders),
      g AS (SELECT priority, label, count(*) AS c FROM d GROUP BY 1, 2),
      t AS (SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) AS place FROM d GROUP BY 1)
    SELECT priority, arg_max(label, c * 100 - place) AS predicted, CAST(sum(c) AS BIGINT) AS n
    FROM g JOIN t USING (label) GROUP BY 1"""


_DEAR_SQL = "CASE WHEN o_totalprice > 250000 THEN 'dear' ELSE 'cheap' END"


@query("tree_majority", _majority_sql("o_orderstatus"))
def tree_majority(spark: SparkSession, folder: str) -> DataFrame:
    return _group_majority(spark, folder, "tree", "status")


@query("forest_majority", _majority_sql("o_orderstatus"))
def forest_majority(spark: SparkSession, folder: str) -> DataFrame:
    """The vote of ten trees that are all the same."""
    params = {"numTrees": 10, "bootstrap": False, "featureSubsetStrategy": "all"}
    return _group_majority(spark, folder, "forest", "status", **params)


@query("gbt_majority", _majority_sql(_DEAR_SQL))
def gbt_majority(spark: SparkSession, folder: str) -> DataFrame:
    return _group_majority(spark, folder, "boosted", "dear", maxIter=1)


def _with_parts(rows: DataFrame, key: str) -> DataFrame:
    """70 and 30 percent of the rows, by key."""
    return tables.with_split(rows, [key], {"train": 7, "test": 3}, seed=1)


def _classes(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.vectors(spark, folder).withColumn("label", F.col("label").cast("string"))


def _classified(rows: DataFrame, kind: str, **params) -> DataFrame:
    """Test predictions of an indexed tree classifier, counted against the labels."""
    parts = _with_parts(rows, "vec_id")
    model = supervised.fit_indexed_classifier(parts, kind, "part = 'train'", **params)
    predicted = model.transform(parts.where("part = 'test'"))
    return predicted.groupBy("label", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


@query("tree_classify")
def tree_classify(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(_classes(spark, folder), "tree")


@query("forest_classify")
def forest_classify(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(_classes(spark, folder), "forest", numTrees=10)


@query("gbt_classify")
def gbt_classify(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted trees know two classes: labels below five against the others."""
    rows = inputs.vectors(spark, folder).withColumn(
        "label", F.when(F.col("label") < 5, "low").otherwise("high")
    )
    return _classified(rows, "boosted", maxIter=10)


def _line_features(spark: SparkSession, folder: str) -> jobs.TabularData:
    return jobs.prepare_table(inputs.insurance(spark, folder), dropped=("cat3", "cat5"))[0]


def _regressed(spark: SparkSession, folder: str, kind: str, **params) -> DataFrame:
    """Test metrics of an indexed tree regressor on the insurance table."""
    parts = _with_parts(_line_features(spark, folder).rows, "id")
    found = supervised.indexed_regressor_metrics(parts, kind, "part = 'train'", "part = 'test'", max_categories=32, **params)
    return _rounded_all(found, 4, "mse", "rmse", "mae", "r2", "explained_variance")


@query("forest_regress")
def forest_regress(spark: SparkSession, folder: str) -> DataFrame:
    return _regressed(spark, folder, "forest")


@query("gbt_regress")
def gbt_regress(spark: SparkSession, folder: str) -> DataFrame:
    return _regressed(spark, folder, "boosted", maxIter=10)


@query("forest_summary")
def forest_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_features(spark, folder).rows
    model = supervised.fit_indexed_regressor(rows, "forest", max_categories=32, numTrees=20)
    return supervised.tree_summary(spark, supervised.model_stage(model))


@query(
    "tree_summary",
    """SELECT 'DecisionTreeRegressionModel' AS model, CAST(1 AS INTEGER) AS n_trees,
              CAST(2 * count(DISTINCT o_orderpriority) - 1 AS INTEGER) AS n_nodes FROM orders""",
)
def tree_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A binary tree with one leaf per category has one inner node fewer than leaves."""
    rows, model = _group_model(spark, folder, "tree", maxDepth=5)
    return supervised.tree_summary(spark, supervised.model_stage(model)).drop("depth")


@query("feature_importances")
def feature_importances(spark: SparkSession, folder: str) -> DataFrame:
    data = _line_features(spark, folder)
    model = supervised.fit_indexed_regressor(data.rows, "forest", max_categories=32, numTrees=20)
    found = supervised.importance_table(spark, supervised.model_stage(model), data.names)
    return _rounded_all(found, 6, "importance")


# --- clusters and topics -----------------------------------------------------


@query(
    "kmeans",
    "SELECT 2::BIGINT AS n_clusters, count(*) AS n, 0.0::DOUBLE AS max_gap FROM embeddings",
)
def kmeans(spark: SparkSession, folder: str) -> DataFrame:
    """Two clusters of the embeddings; at convergence every centre is its members' mean."""
    rows = inputs.vectors(spark, folder)
    model = unsupervised.fit_kmeans(rows, k=2, seed=1, max_iter=200, tol=0.0)
    assigned = model.transform(rows).select(
        "prediction", F.posexplode(vector_to_array("features")).alias("axis", "member")
    )
    means = assigned.groupBy("prediction", "axis").agg(
        F.count(F.lit(1)).alias("n"), F.avg("member").alias("mean")
    )
    centres = unsupervised.centre_table(spark, model).withColumnRenamed("cluster", "prediction")
    joined = means.join(centres, ["prediction", "axis"])
    per_cluster = joined.groupBy("prediction").agg(
        F.max("n").alias("n"), F.max(F.abs(F.col("mean") - F.col("value"))).alias("gap")
    )
    return per_cluster.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum("n").alias("n"),
        rounded(F.max("gap"), 6).alias("max_gap"),
    )


@query("kmeans_assignments")
def kmeans_assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of each embedding."""
    rows = inputs.vectors(spark, folder)
    model = unsupervised.fit_kmeans(rows, k=2, seed=1)
    return model.transform(rows).select("vec_id", "prediction")


@query(
    "kmeans_two_points",
    """SELECT CAST(l_linestatus = 'O' AS DOUBLE) AS centre, count(*) AS n FROM lineitem GROUP BY 1""",
)
def kmeans_two_points(spark: SparkSession, folder: str) -> DataFrame:
    """Rows on two distinct points: the centres are the points, the clusters their rows."""
    lines = read_table(spark, folder, "lineitem").select(
        (F.col("l_linestatus") == "O").cast("double").alias("open")
    )
    rows = features.vectorised(lines, ["open"])
    model = unsupervised.fit_kmeans(rows, k=2, seed=1)
    centres = unsupervised.centre_table(spark, model).select("cluster", rounded("value", 6).alias("centre"))
    sizes = model.transform(rows).groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return sizes.join(centres, "cluster").select("centre", "n")


_SQUARES = "list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * v))"


@query(
    "silhouette",
    f"""WITH x AS (SELECT vec_id, label, embedding, {_SQUARES} AS sq FROM embeddings),
      dims AS (SELECT label, d, avg(CAST(v AS DOUBLE)) AS m FROM (SELECT label, unnest(embedding) AS v,
               generate_subscripts(embedding, 1) AS d FROM x) GROUP BY 1, 2),
      cl AS (SELECT label, count(*) AS n, avg(sq) AS sq FROM x GROUP BY 1),
      flat AS (SELECT vec_id, label, sq, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS d FROM x),
      dots AS (SELECT f.vec_id, f.label, f.sq, m.label AS other, sum(f.v * m.m) AS dot
               FROM flat f JOIN dims m USING (d) GROUP BY 1, 2, 3, 4),
      dist AS (SELECT vec_id, dots.label, other, n, dots.sq + cl.sq - 2 * dot AS dist FROM dots JOIN cl ON cl.label = other),
      ab AS (SELECT vec_id, max(n) FILTER (WHERE label = other) AS n,
                    max(dist * n / greatest(n - 1, 1)) FILTER (WHERE label = other) AS a,
                    min(dist) FILTER (WHERE label <> other) AS b FROM dist GROUP BY 1)
      SELECT round(avg(CASE WHEN n = 1 OR a = b THEN 0.0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END), 6) + 0.0 AS silhouette FROM ab""",
)
def silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """Silhouette of the given embedding labels taken as clusters."""
    rows = inputs.vectors(spark, folder).withColumnRenamed("label", "prediction")
    return _rounded_all(evaluate.silhouette(rows), 6, "silhouette")


@query("gmm")
def gmm(spark: SparkSession, folder: str) -> DataFrame:
    """Two Gaussians over quantity, discount and tax of all order lines."""
    rows = inputs.line_vectors(spark, folder)
    model = unsupervised.fit_mixture(rows, k=2, seed=0, max_iter=100)
    found = unsupervised.mixture_table(spark, model)
    return _rounded_all(found, 4, "weight", "mean", "variance")


@query(
    "gmm_moments",
    """SELECT CAST(axis AS INTEGER) AS axis, round(m, 5) + 0.0 AS mean, round(sq, 2) + 0.0 AS mean_square FROM (
         SELECT 0 AS axis, avg(l_quantity) AS m, avg(l_quantity * l_quantity) AS sq FROM lineitem
         UNION ALL SELECT 1, avg(l_discount), avg(l_discount * l_discount) FROM lineitem
         UNION ALL SELECT 2, avg(l_tax), avg(l_tax * l_tax) FROM lineitem)""",
)
def gmm_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Whatever optimum is found, the mixture has the mean and mean square of the data."""
    rows = inputs.line_vectors(spark, folder)
    model = unsupervised.fit_mixture(rows, k=2, seed=0, max_iter=100)
    parts = unsupervised.mixture_table(spark, model)
    square = F.col("variance") + F.col("mean") * F.col("mean")
    return parts.groupBy("axis").agg(
        rounded(F.sum(F.col("weight") * F.col("mean")), 5).alias("mean"),
        rounded(F.sum(F.col("weight") * square), 2).alias("mean_square"),
    )


def _topic_model(spark: SparkSession, folder: str) -> tuple[variational.VariationalTopics, DataFrame]:
    """Topics over all terms of two documents or more, and the documents' entries."""
    words = jobs.text_tokens(inputs.documents(spark, folder).select("doc_id", "text"))
    entries = variational.term_entries(words, "filtered")
    return variational.fit_variational(entries, k=10, rounds=10, min_df=2, seed=1), entries


@query("lda_topics")
def lda_topics(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = _topic_model(spark, folder)
    return _rounded_all(model.heaviest_terms(3), 6, "weight")


@query(
    "lda_mix",
    f"""WITH {inputs.WORDS_SQL}, kept AS (
          SELECT doc_id, unnest(list_filter(words, lambda w: NOT list_contains({STOPS}, w))) AS term FROM words),
        known AS (SELECT term FROM kept GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2),
        covered AS (SELECT DISTINCT doc_id FROM kept JOIN known USING (term))
        SELECT d.doc_id, CASE WHEN c.doc_id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS total
        FROM documents d LEFT JOIN covered c USING (doc_id)""",
)
def lda_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Sum of the topic shares per document: one, or zero where no term is in the vocabulary."""
    model, entries = _topic_model(spark, folder)
    total = F.aggregate("shares", F.lit(0.0), lambda s, v: s + v)
    return model.documents(entries, "doc_id").select("doc_id", rounded(total, 6).alias("total"))


@query("lda_fit")
def lda_fit(spark: SparkSession, folder: str) -> DataFrame:
    model, entries = _topic_model(spark, folder)
    found = model.fit_table(entries, "doc_id")
    return _rounded_all(found, 4, "log_likelihood", "log_perplexity")


@query(
    "topic_sets",
    """WITH t AS (SELECT DISTINCT l_orderkey AS id, l_orderkey % 2 AS side, CASE l_orderkey % 2 WHEN 0 THEN 'even ' ELSE 'odd ' END || p_brand AS term
                 FROM lineitem JOIN part ON l_partkey = p_partkey)
       SELECT DISTINCT term, min(term) OVER (PARTITION BY side) AS first_of_topic, n AS n_documents
       FROM t JOIN (SELECT side, count(DISTINCT id) AS n FROM t GROUP BY side) USING (side)""",
)
def topic_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as documents over two sets of brands without a common one: each topic holds one set and its orders."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    side = F.when(F.col("l_orderkey") % 2 == 0, "even ").otherwise("odd ")
    counts = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("id"), F.concat(side, "p_brand").alias("term"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    model = topics.fit_topic_tables(counts, k=2, rounds=20)
    orders = model.documents.groupBy(topics.heaviest("shares").alias("topic")).agg(F.count(F.lit(1)).alias("n_documents"))
    terms = model.terms.select("term", topics.heaviest("weights").alias("topic"))
    first = terms.groupBy("topic").agg(F.min("term").alias("first_of_topic"))
    return terms.join(first.join(orders, "topic"), "topic").select("term", "first_of_topic", "n_documents")


# --- itemsets ----------------------------------------------------------------

_SUPPORT, _CONFIDENCE = 0.01, 0.13
_SETS_SQL = f"""WITH {inputs.BASKETS_SQL}, n AS (SELECT count(DISTINCT basket) AS n FROM pairs),
  s1 AS (SELECT item AS a, count(*) AS freq FROM pairs GROUP BY 1),
  s2 AS (SELECT x.item AS a, y.item AS b, count(*) AS freq FROM pairs x JOIN pairs y
         ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2),
  s3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq FROM pairs x JOIN pairs y
         ON x.basket = y.basket AND x.item < y.item JOIN pairs z ON y.basket = z.basket AND y.item < z.item GROUP BY 1, 2, 3),
  splits AS (SELECT [a] AS ante, b AS cons, freq FROM s2 UNION ALL SELECT [b], a, freq FROM s2
             UNION ALL SELECT [a, b], c, freq FROM s3 UNION ALL SELECT [a, c], b, freq FROM s3
             UNION ALL SELECT [b, c], a, freq FROM s3),
  antes AS (SELECT [a] AS ante, freq FROM s1 UNION ALL SELECT [a, b], freq FROM s2),
  rules AS (SELECT p.ante, p.cons, p.freq / CAST(s.freq AS DOUBLE) AS confidence,
                   p.freq / CAST(s.freq AS DOUBLE) / (t.freq / CAST(n AS DOUBLE)) AS lift, p.freq / CAST(n AS DOUBLE) AS support
            FROM splits p JOIN antes s ON s.ante = p.ante JOIN s1 t ON t.a = p.cons, n
            WHERE p.freq >= ceil({_SUPPORT} * n) AND p.freq / CAST(s.freq AS DOUBLE) >= {_CONFIDENCE})"""


@query(
    "frequent_itemsets",
    f"""{_SETS_SQL} SELECT a AS items, CAST(1 AS INTEGER) AS n_items, freq FROM s1, n WHERE freq >= ceil({_SUPPORT} * n)
        UNION ALL SELECT a || ',' || b, 2, freq FROM s2, n WHERE freq >= ceil({_SUPPORT} * n)
        UNION ALL SELECT a || ',' || b || ',' || c, 3, freq FROM s3, n WHERE freq >= ceil({_SUPPORT} * n)""",
)
def frequent_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    """Brands bought together in at least one percent of the orders."""
    model = unsupervised.fit_itemsets(inputs.baskets(spark, folder), min_support=_SUPPORT)
    return unsupervised.itemset_table(model)


@query(
    "association_rules",
    f"""{_SETS_SQL} SELECT array_to_string(ante, ',') AS antecedent, cons AS consequent, round(confidence, 6) + 0.0 AS confidence,
        round(lift, 6) + 0.0 AS lift, round(support, 6) + 0.0 AS support FROM rules""",
)
def association_rules(spark: SparkSession, folder: str) -> DataFrame:
    model = unsupervised.fit_itemsets(
        inputs.baskets(spark, folder), min_support=_SUPPORT, min_confidence=_CONFIDENCE
    )
    return _rounded_all(unsupervised.rule_table(model), 6, "confidence", "lift", "support")


_PREDICTED_SQL = f"""{_SETS_SQL}, b AS (SELECT basket, list(item) AS items FROM pairs GROUP BY 1), fired AS (
    SELECT DISTINCT basket, cons FROM b JOIN rules ON list_has_all(items, ante) AND NOT list_contains(items, cons))
  SELECT b.basket, coalesce(string_agg(f.cons, ',' ORDER BY f.cons), '') AS predicted
  FROM b LEFT JOIN fired f USING (basket) GROUP BY 1"""


def _predicted(df: DataFrame) -> DataFrame:
    return df.select("basket", F.array_join(F.sort_array("prediction"), ",").alias("predicted"))


@query("rule_predictions", _PREDICTED_SQL)
def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    baskets = written(inputs.baskets(spark, folder), "baskets")
    model = unsupervised.fit_itemsets(baskets, min_support=_SUPPORT, min_confidence=_CONFIDENCE)
    return _predicted(unsupervised.predict_by_rules(model, baskets, "basket"))


# --- evaluation --------------------------------------------------------------


@query(
    "regression_metrics",
    """WITH d AS (SELECT l_extendedprice AS y, 2000 * l_quantity AS p FROM lineitem)
       SELECT count(*) AS n, round(avg((y - p) * (y - p)), 2) + 0.0 AS mse, round(sqrt(avg((y - p) * (y - p))), 4) + 0.0 AS rmse,
              round(avg(abs(y - p)), 4) + 0.0 AS mae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) + 0.0 AS r2,
              round(var_pop(p) + (avg(p) - avg(y)) * (avg(p) - avg(y)), 2) + 0.0 AS explained_variance FROM d""",
)
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction")
    )
    found = evaluate.regression_metrics(lines)
    found = _rounded_all(found, 2, "mse", "explained_variance")
    return _rounded_all(_rounded_all(found, 4, "rmse", "mae"), 6, "r2")


@query(
    "accuracy",
    """WITH d AS (SELECT avg(CAST((l_extendedprice > 50000) = (l_quantity > 25) AS DOUBLE)) AS a, count(*) AS n FROM lineitem)
       SELECT n, round(a, 6) + 0.0 AS accuracy, round(1 - a, 6) + 0.0 AS test_error FROM d""",
)
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        (F.col("l_extendedprice") > 50_000).cast("double").alias("label"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
    )
    return _rounded_all(evaluate.accuracy(lines), 6, "accuracy", "test_error")


_SCORES_SQL = """d AS (SELECT doc_id, quality AS label, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)),
  g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q FROM d GROUP BY 1),
  t AS (SELECT score AS threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(q) OVER w AS BIGINT) AS fp,
               sum(p) OVER () AS np, sum(q) OVER () AS nq FROM g WINDOW w AS (ORDER BY score DESC))"""


@query(
    "auc",
    f"""WITH {_SCORES_SQL}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM d)
        SELECT round((sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
               / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)), 6) + 0.0 AS auc FROM r""",
)
def auc(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_all(evaluate.area_under_roc(inputs.scored_labels(spark, folder)), 6, "auc")


@query(
    "roc_curve",
    f"""WITH {_SCORES_SQL} SELECT threshold, tp, fp, round(fp / CAST(nq AS DOUBLE), 6) + 0.0 AS fpr,
        round(tp / CAST(np AS DOUBLE), 6) + 0.0 AS tpr FROM t""",
)
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    table = evaluate.threshold_table(inputs.scored_labels(spark, folder))
    return _rounded_all(table, 6, "fpr", "tpr").select("threshold", "tp", "fp", "fpr", "tpr")


@query(
    "best_threshold",
    f"""WITH {_SCORES_SQL}, f AS (SELECT threshold, 2.0 * tp / CAST(tp + fp + np AS DOUBLE) AS f1 FROM t)
        SELECT threshold, round(f1, 6) + 0.0 AS f1 FROM f ORDER BY f.f1 DESC, threshold DESC LIMIT 1""",
)
def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    table = evaluate.threshold_table(inputs.scored_labels(spark, folder))
    return _rounded_all(evaluate.best_threshold(table), 6, "f1")


# --- whole jobs --------------------------------------------------------------


def _labelled_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, labelled by whether its topic starts with ``en``; split 8:2."""
    labelled = inputs.topics(spark, folder).withColumn("label", prefix_label("topic", "en"))
    return tables.with_split(jobs.text_tokens(labelled), ["id"], {"train": 8, "test": 2}, seed=2018)


@query("text_classifier")
def text_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Test documents with probability and prediction."""
    rows = _labelled_tokens(spark, folder)
    model = jobs.classify_text(rows.where("part = 'train'"))
    scored = supervised.with_probability(model.transform(rows.where("part = 'test'")))
    return scored.select("id", "topic", rounded("p", 4).alias("p"), "prediction", "label")


@query("text_classifier_auc")
def text_classifier_auc(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled_tokens(spark, folder)
    model = jobs.classify_text(rows.where("part = 'train'"))
    scored = model.transform(rows.where("part = 'test'"))
    return _rounded_all(evaluate.area_under_roc(scored, score="rawPrediction"), 6, "auc")


@query("text_cv")
def text_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Area under ROC per grid point, three folds."""
    rows = _labelled_tokens(spark, folder).where("part = 'train'")
    model = jobs.tune_text(rows, num_features=(1_000, 10_000, 100_000), min_doc_freq=(0, 10, 100))
    return _rounded_all(tuning.metric_table(spark, model, larger_is_better=True), 6, "metric")


def _regression_run(spark: SparkSession, folder: str, kind: str, grid: dict) -> jobs.RegressionRun:
    return jobs.regress_table(_line_features(spark, folder), kind, grid=grid)


@query("loss_regression_forest")
def loss_regression_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Training and validation metrics of the searched forest."""
    run = _regression_run(spark, folder, "forest", {"numTrees": (5, 20), "maxDepth": (4, 6)})
    return _rounded_all(run.metrics(), 4, "mse", "rmse", "mae", "r2", "explained_variance")


@query("loss_regression_cv")
def loss_regression_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Error per grid point of the forest search, three folds."""
    run = _regression_run(spark, folder, "forest", {"numTrees": (5, 20), "maxDepth": (4, 6)})
    return _rounded_all(run.search_metrics(), 4, "metric")


@query("loss_regression_gbt")
def loss_regression_gbt(spark: SparkSession, folder: str) -> DataFrame:
    """Training and validation metrics of the searched boosted trees."""
    run = _regression_run(spark, folder, "boosted", {"maxIter": (5, 20), "maxDepth": (4, 6)})
    return _rounded_all(run.metrics(), 4, "mse", "rmse", "mae", "r2", "explained_variance")


def _priority_run(spark: SparkSession, folder: str) -> jobs.RegressionRun:
    """The whole regression job where its answer is known: one useful category, trees on all rows."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("cat1"),
        F.lit(1.0).alias("cont1"),
        F.col("o_totalprice").alias("loss"),
    )
    return jobs.regress_table(
        jobs.prepare_table(orders)[0],
        grid={"numTrees": (3, 6), "maxDepth": (5,)},
        split=F.when(F.col("id") % 10 < 7, "train").otherwise("validation"),
        fold=(F.col("id") % 3).cast("int"),
        bootstrap=False,
        featureSubsetStrategy="all",
    )


@query(
    "loss_regression_exact",
    """WITH d AS (SELECT CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'validation' END AS part,
                         o_orderpriority AS g, o_totalprice AS y FROM orders),
         m AS (SELECT g, avg(y) AS p FROM d WHERE part = 'train' GROUP BY 1)
       SELECT part, round(sqrt(avg((y - p) * (y - p))), 2) + 0.0 AS rmse, round(avg(abs(y - p)), 2) + 0.0 AS mae,
              round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2
       FROM d JOIN m USING (g) GROUP BY 1""",
)
def loss_regression_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of the group means of the training part, on both parts."""
    found = _priority_run(spark, folder).metrics()
    return found.select(
        "part", rounded("rmse", 2).alias("rmse"), rounded("mae", 2).alias("mae"), rounded("r2", 6).alias("r2")
    )


@query(
    "loss_regression_cv_exact",
    """WITH d AS (SELECT o_orderkey % 3 AS fold, o_orderpriority AS g, o_totalprice AS y FROM orders WHERE o_orderkey % 10 < 7),
         m AS (SELECT f.fold, g, avg(y) AS p FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY 1, 2),
         e AS (SELECT d.fold, sqrt(avg((y - p) * (y - p))) AS rmse FROM d JOIN m USING (fold, g) GROUP BY 1)
       SELECT "numTrees", 5.0::DOUBLE AS "maxDepth", round(avg(rmse), 2) + 0.0 AS metric
       FROM e, (VALUES (3.0::DOUBLE), (6.0::DOUBLE)) v("numTrees") GROUP BY 1""",
)
def loss_regression_cv_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Three-fold error of each point of the job's grid."""
    found = _priority_run(spark, folder).search_metrics()
    return found.select("numTrees", "maxDepth", rounded("metric", 2).alias("metric"))


@query(
    "feature_importances_exact",
    "SELECT * FROM (VALUES ('idx_cat1', 1.0::DOUBLE), ('cont1', 0.0::DOUBLE)) v(feature, importance)",
)
def feature_importances_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The only useful column has all the importance."""
    return _priority_run(spark, folder).importances()


def _mostly_right(scored: DataFrame) -> DataFrame:
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return scored.agg(F.count(F.lit(1)).alias("n"), (right > 0.95).alias("mostly_right"))


def _language_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, with one more token that tells the label, 20 times over."""
    labelled = inputs.topics(spark, folder).withColumn("label", prefix_label("topic", "en"))
    told = F.repeat(F.when(F.col("label") == 1, "insular ").otherwise("continental "), 20)
    return jobs.text_tokens(labelled.withColumn("text", F.concat(told, "text")))


@query("text_classifier_accuracy", "SELECT count(*) AS n, true AS mostly_right FROM documents WHERE doc_id % 10 >= 8")
def text_classifier_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """One token decides the label, so the text job errs on a few very long documents at most."""
    rows = _language_tokens(spark, folder)
    model = jobs.classify_text(rows.where("id % 10 < 8"))
    return _mostly_right(model.transform(rows.where("id % 10 >= 8")))


@query(
    "label_unlabelled",
    "SELECT count(*) AS n, true AS mostly_right FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def label_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    """The small text job: search hash size and penalty on the labelled documents, score all others."""
    rows = _language_tokens(spark, folder).withColumnRenamed("id", "doc_id")
    known = read_table(spark, folder, "labels").select("doc_id").distinct()
    pipeline = jobs.text_pipeline()
    hashing, _, logistic = pipeline.getStages()
    grid = tuning.param_grid({hashing.numFeatures: (100, 1_000, 10_000), logistic.regParam: (0.1, 0.01)})
    train = rows.join(known, "doc_id", "left_semi").withColumn("fold", (F.col("doc_id") % 2).cast("int"))
    model = tuning.cross_validate(
        pipeline, grid, evaluate.auc_evaluator(), train.select("filtered", "label", "fold"), folds=2
    )
    others = rows.join(known, "doc_id", "left_anti")
    return _mostly_right(model.transform(others))


@query(
    "param_grid_cv",
    """WITH d AS (SELECT o_orderkey % 3 AS fold, o_orderpriority AS g, o_totalprice AS y FROM orders),
         folds AS (SELECT DISTINCT fold FROM d),
         flat AS (SELECT f.fold, avg(y) AS m FROM folds f JOIN d ON d.fold <> f.fold GROUP BY 1),
         deep AS (SELECT f.fold, g, avg(y) AS m FROM folds f JOIN d ON d.fold <> f.fold GROUP BY 1, 2),
         errors AS (SELECT 0.0::DOUBLE AS depth, d.fold, sqrt(avg((y - m) * (y - m))) AS rmse FROM d JOIN flat USING (fold) GROUP BY 1, 2
                    UNION ALL SELECT 5.0::DOUBLE, d.fold, sqrt(avg((y - m) * (y - m))) FROM d JOIN deep USING (fold, g) GROUP BY 1, 2),
         points AS (SELECT depth, avg(rmse) AS metric FROM errors GROUP BY 1)
       SELECT bins AS "maxBins", depth AS "maxDepth", round(metric, 2) + 0.0 AS metric
       FROM points, (VALUES (8.0::DOUBLE), (32.0::DOUBLE)) v(bins)""",
)
def param_grid_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Three-fold error of every point of a depth by bins grid, folds given by the order key."""
    orders = inputs.priced_orders(spark, folder)
    index = features.fit_string_index(orders, ["priority"], ["priority_index"])
    indexed = index.transform(orders)
    rows = features.vectorised(indexed, ["priority_index"]).select(
        "features", "label", (F.col("id") % 3).cast("int").alias("fold")
    )
    tree = supervised.tree_regressor("tree", "features", "label")
    grid = tuning.param_grid({tree.maxDepth: (0, 5), tree.maxBins: (8, 32)})
    model = tuning.cross_validate(tree, grid, evaluate.rmse_evaluator(), rows, folds=3)
    found = tuning.metric_table(spark, model, larger_is_better=False)
    return found.select("maxBins", "maxDepth", rounded("metric", 2).alias("metric"))
