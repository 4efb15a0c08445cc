"""Rules applied by counted antecedents: against the library, on long and odd baskets, and by plan."""

import random
import re

import __spark_entry__ as entry_points
from pyspark.sql import functions as F
from tabulon.operators import unsupervised


def predictions(df):
    return sorted((r["id"], tuple(sorted(r["prediction"]))) for r in df.collect())


def random_baskets(spark, n=300, items=30, seed=4):
    draw = random.Random(seed)
    rows = [(i, draw.sample([f"i{k}" for k in range(items)], draw.randint(1, 9)) + (["i0", "i1"] if i % 3 else [])) for i in range(n)]
    return spark.createDataFrame([(i, sorted(set(b))) for i, b in rows], "id long, items array<string>")


def test_same_as_the_library(spark):
    df = random_baskets(spark)
    model = unsupervised.fit_itemsets(df, min_support=0.04, min_confidence=0.2)
    assert model.associationRules.count() > 100
    assert predictions(unsupervised.predict_by_rules(model, df, "id")) == predictions(model.transform(df))


def test_odd_baskets(spark):
    model = unsupervised.fit_itemsets(random_baskets(spark), min_support=0.04, min_confidence=0.2)
    rows = [(1, None, "x"), (2, [], "x"), (3, ["i0"], "x"), (3, ["i0"], "y"), (4, ["i0", None, "i0"], "x"), (5, ["unknown"], "x"), (None, ["i0"], "x")]
    df = spark.createDataFrame(rows, "id long, items array<string>, item string")
    found = unsupervised.predict_by_rules(model, df, "id")
    assert found.columns == ["id", "items", "item", "prediction"] and found.count() == len(rows)
    by_id = {r["id"]: r["prediction"] for r in found.collect()}
    assert by_id[1] == by_id[2] == by_id[5] == by_id[None] == []
    assert "i1" in by_id[3] and by_id[3] == by_id[4] and "i0" not in by_id[3]
    assert unsupervised.predict_by_rules(model, df.limit(0), "id").collect() == []


def test_tasks_by_meetings(spark, monkeypatch):
    """Baskets are dealt into tasks by what they meet, and small tasks are not put together again."""
    df = random_baskets(spark)
    model = unsupervised.fit_itemsets(df, min_support=0.04, min_confidence=0.2)
    rules = model.associationRules.select("antecedent", F.col("consequent")[0].alias("consequent"))
    postings, _ = unsupervised.rule_postings(rules)
    met = df.select(F.explode("items").alias("item")).join(postings, "item").count()
    monkeypatch.setattr(unsupervised, "TASK_ROWS", met // 50, raising=False)
    found = unsupervised.predict_by_rules(model, df, "id")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert min(int(n) for n in re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\), REPARTITION_BY_NUM", text)) >= 50
    assert predictions(found) == predictions(model.transform(df))


def test_a_basket_of_ten_thousand_items(spark):
    """Every rule i -> i + 1 up to 10,000 fires for the items it holds; half of the consequents are there."""
    n = 10_000
    rules = spark.range(n).select(
        F.array(F.concat(F.lit("i"), "id")).alias("antecedent"), F.concat(F.lit("i"), F.col("id") + 1).alias("consequent")
    )
    pairs = spark.range(n).select(
        F.array(F.concat(F.lit("i"), "id"), F.concat(F.lit("i"), F.col("id") + 2)).alias("antecedent"),
        F.concat(F.lit("both"), "id").alias("consequent"),
    )
    entries = spark.range(0, n, 2).select(F.lit(1).alias("id"), F.concat(F.lit("i"), F.col("id")).alias("item"))
    entries = entries.union(spark.createDataFrame([(2, "i7"), (2, "i8"), (2, "i10")], entries.schema))
    postings, follows = unsupervised.rule_postings(rules.union(pairs))
    found = {}
    for row in unsupervised.fired_rules(entries, postings, follows, "id").collect():
        found.setdefault(row["id"], set()).add(row["item"])
    assert found[1] == {f"i{k + 1}" for k in range(0, n, 2)} | {f"both{k}" for k in range(0, n - 2, 2)}
    assert found[2] == {"i9", "i11", "both8"}


def test_no_list_travels(spark):
    """With or without broadcasts, no exchange of the search carries a list."""
    df = random_baskets(spark)
    model = unsupervised.fit_itemsets(df, min_support=0.04, min_confidence=0.2)
    rules = model.associationRules.select("antecedent", F.col("consequent")[0].alias("consequent"))
    postings, follows = unsupervised.rule_postings(rules)
    entries = df.select("id", F.explode("items").alias("item")).distinct().checkpoint()
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    want = None
    for limit in ("64m", "-1"):
        before = {key: spark.conf.get(key, None) for key in keys}
        try:
            for key in keys:
                spark.conf.set(key, limit)
            fired = unsupervised.fired_rules(entries, postings, follows, "id")
            rows = sorted(map(tuple, fired.collect()))
            mode = fired.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            text = fired._jdf.queryExecution().explainString(mode)
            ran = fired._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        exchanges = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", text)
        names = {re.sub(r"#\d+L?", "", c.strip()) for e in exchanges for c in e.split(",")}
        assert exchanges and names <= {"id", "item", "antecedent_id", "n_items", "n", "count", "consequent", "held", "max"}
        if limit != "-1":
            assert len(re.findall(r" Exchange ", ran)) == 1
        assert want is None or rows == want
        want = rows


def test_query_without_python(spark, folder):
    text = entry_points.queries()["rule_predictions"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
