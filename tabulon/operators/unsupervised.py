"""Clusters, mixtures, topics, frequent itemsets and rules."""

from __future__ import annotations

from pyspark.ml import clustering as mcl
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.features import term_table
from tabulon.operators.mixture import Mixture, fit_blocks
from tabulon.session import held, scratch_path, written

# Applying rules inside the library ships every rule to every task; here they stay tables.

#: Rows of items that meet antecedents, per task of ``predict_by_rules``: its counts lie in memory.
TASK_ROWS = 500_000


def fit_kmeans(
    df: DataFrame, features: str = "features", k: int = 2, seed: int = 1, max_iter: int = 20, tol: float = 1e-4
) -> mcl.KMeansModel:
    with held(df.select(features), balanced=True) as (rows,):
        return mcl.KMeans(featuresCol=features, k=k, seed=seed, maxIter=max_iter, tol=tol).fit(rows)


def centre_table(spark: SparkSession, model: mcl.KMeansModel) -> DataFrame:
    rows = [
        (cluster, axis, float(value))
        for cluster, centre in enumerate(model.clusterCenters())
        for axis, value in enumerate(centre)
    ]
    return spark.createDataFrame(rows, "cluster int, axis int, value double")


def fit_mixture(
    df: DataFrame, features: str = "features", k: int = 2, seed: int = 0, max_iter: int = 100
) -> Mixture:
    return fit_blocks(df, features, k, seed, max_iter)


def mixture_table(spark: SparkSession, model: Mixture) -> DataFrame:
    """``cluster, weight, axis, mean, variance``: the diagonal of each covariance."""
    rows = []
    for cluster, (weight, mean, cov) in enumerate(zip(model.weights, model.means, model.covariances)):
        rows += [
            (cluster, float(weight), axis, float(mean[axis]), float(cov[axis][axis]))
            for axis in range(len(mean))
        ]
    return spark.createDataFrame(
        rows, "cluster int, weight double, axis int, mean double, variance double"
    )


def fit_topics(
    df: DataFrame,
    features: str = "features",
    k: int = 10,
    max_iter: int = 10,
    seed: int = 1,
    optimizer: str = "online",
) -> mcl.LDAModel:
    lda = mcl.LDA(featuresCol=features, k=k, maxIter=max_iter, seed=seed, optimizer=optimizer)
    with held(df.select(features), balanced=True) as (rows,):
        return lda.fit(rows)


def topic_fit(model: mcl.LDAModel, df: DataFrame, features: str = "features") -> DataFrame:
    """One row: lower bound on the log likelihood, and the perplexity bound per token.

    The perplexity bound is the likelihood bound over the token count with its sign
    turned, so one inference pass over the corpus gives both.
    """
    weight = F.aggregate(F.unwrap_udt(features)["values"], F.lit(0.0), lambda s, v: s + v)
    tokens = df.agg(F.sum(weight)).first()[0]
    likelihood = float(model.logLikelihood(df))
    return df.sparkSession.createDataFrame(
        [(likelihood, -likelihood / tokens)], "log_likelihood double, log_perplexity double"
    )


def topic_table(model: mcl.LDAModel, vocabulary: list[str], n_terms: int = 3) -> DataFrame:
    """``topic, place, term, weight`` of the heaviest terms per topic."""
    topics = model.describeTopics(n_terms)
    heaviest = topics.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "entry")
    ).select(
        "topic",
        "place",
        F.col("entry.termIndices").alias("index"),
        F.col("entry.termWeights").alias("weight"),
    )
    return heaviest.join(term_table(topics, vocabulary), "index").select(
        "topic", "place", "term", "weight"
    )


# --- itemsets ----------------------------------------------------------------


def baskets(rows: DataFrame, key: str, item: str, out: str = "items") -> DataFrame:
    """One array of distinct items per key.

    Repeats are dropped by the partial aggregates of each task, so a key with many
    rows sends no more than its distinct items.
    """
    return rows.where(F.col(item).isNotNull()).groupBy(key).agg(
        F.sort_array(F.collect_set(item)).alias(out)
    )


def fit_itemsets(
    df: DataFrame,
    items: str = "items",
    min_support: float = 0.2,
    min_confidence: float = 0.6,
    partitions: int | None = None,
) -> FPGrowthModel:
    """Frequent itemsets and rules with a single consequent.

    A fitted model mines anew whenever its itemsets are read, so it is saved once
    and the loaded copy, which reads them from a table, is returned.
    """
    growth = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if partitions is not None:
        growth = growth.setNumPartitions(partitions)
    path = scratch_path(df.sparkSession, "itemsets")
    with held(df.select(items), balanced=True) as (rows,):
        growth.fit(rows).write().save(path)
    return FPGrowthModel.load(path)


def itemset_table(model: FPGrowthModel) -> DataFrame:
    return model.freqItemsets.select(
        F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",").alias("items"),
        F.size("items").alias("n_items"),
        "freq",
    )


def rule_table(model: FPGrowthModel) -> DataFrame:
    """``antecedent, consequent, confidence, lift, support`` with joined item names."""
    return model.associationRules.select(
        F.array_join(F.sort_array(F.col("antecedent").cast("array<string>")), ",").alias("antecedent"),
        F.array_join(F.col("consequent").cast("array<string>"), ",").alias("consequent"),
        "confidence",
        "lift",
        "support",
    )


def rule_postings(rules: DataFrame, antecedent: str = "antecedent", consequent: str = "consequent") -> tuple[DataFrame, DataFrame]:
    """An inverted file ``item, antecedent_id, n_items`` and what follows, ``antecedent_id, consequent, held``.

    Rules with one antecedent share its postings. An empty antecedent has none, so its rules never fire.
    Each consequent also follows from itself, marked as held: so a basket finds what it has on
    the way on which it finds what it is offered.
    """
    numbered = rules.select(F.sort_array(F.array_distinct(antecedent)).alias("items"), F.col(consequent).alias("consequent"))
    own = numbered.select(F.array("consequent").alias("items"), F.lit(True).alias("held"))
    heads = numbered.select("items", F.lit(False).alias("held")).unionAll(own).distinct()
    heads = written(heads.withColumn("antecedent_id", F.monotonically_increasing_id()), "antecedents")
    postings = heads.select(F.explode("items").alias("item"), "antecedent_id", F.size("items").alias("n_items"))
    follows = numbered.join(heads.where(~F.col("held")), "items").select("antecedent_id", "consequent", "held").distinct()
    selves = heads.where("held").select("antecedent_id", F.col("items")[0].alias("consequent"), "held")
    return postings, written(follows.unionAll(selves), "consequents")


def fired_rules(entries: DataFrame, postings: DataFrame, follows: DataFrame, key: str, dealt: bool = False) -> DataFrame:
    """``key, item``: consequents of the antecedents whose items all are among the basket's, less what it holds.

    ``entries`` has one row ``key, item`` for each item of a basket. A basket meets an
    antecedent once for each shared item; these rows shrink to one count per basket and
    antecedent, and an antecedent has fired if the count reaches its length. No row
    carries a list, so a basket of n items costs n rows and not their square. The entries
    are dealt out by basket, unless they lie so (``dealt``), so with rules small enough to be broadcast nothing else
    is shuffled. A null item matches nothing.
    """
    rows = entries if dealt else entries.repartition(key)
    met = rows.join(postings, "item").groupBy(key, "antecedent_id", "n_items").agg(F.count(F.lit(1)).alias("n"))
    fired = met.where(F.col("n") == F.col("n_items")).join(follows, "antecedent_id")
    offered = fired.groupBy(key, F.col("consequent").alias("item")).agg(F.max("held").alias("held"))
    return offered.where(~F.col("held")).select(key, "item")


def predict_by_rules(model: FPGrowthModel, df: DataFrame, key: str, items: str = "items") -> DataFrame:
    """Add ``prediction``: consequents of all matching rules that the basket does not hold yet, sorted.

    ``key`` names a basket: rows that share one are taken as one basket, and each gets its predictions.
    A null or empty basket gets an empty list; null items are left out. ``df`` is read three times. Baskets are dealt
    into as many tasks as their meetings with antecedents ask for (``TASK_ROWS``), which are counted before.
    """
    held_items = df.select(F.col(key), F.explode(items).alias("item")).where(F.col("item").isNotNull())
    rules = model.associationRules.select("antecedent", F.col("consequent")[0].alias("consequent"))
    postings, follows = rule_postings(rules)
    entries = held_items.repartition(_tasks_to_meet(held_items, postings), key).distinct()
    found = fired_rules(entries, postings, follows, key, dealt=True)
    predicted = found.groupBy(key).agg(F.sort_array(F.collect_list("item")).alias("_prediction"))
    nothing = F.array().cast(df.schema[items].dataType)
    return df.join(predicted, key, "left").select(*df.columns, F.coalesce("_prediction", nothing).alias("prediction"))


def _tasks_to_meet(entries: DataFrame, postings: DataFrame) -> int:
    """As many tasks as the session shuffles into, or more if one would meet more than ``TASK_ROWS`` postings."""
    lengths = postings.groupBy("item").agg(F.count(F.lit(1)).alias("length"))
    counts = entries.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    met = counts.join(lengths, "item").agg(F.sum(F.col("n") * F.col("length"))).first()[0] or 0
    return max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-met // TASK_ROWS))
