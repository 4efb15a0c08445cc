"""Queries over the feature transformers."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators import features, principal, skipgrams, variational
from tabulon.plans import inputs
from tabulon.plans.registry import query, rounded
from tabulon.sources import read_table

W = inputs.WORDS_SQL

# The library's English stop words, restated for the check SQL (fixed values).
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

STOPS = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH_STOP_WORDS) + "]"


def _lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *columns)


def _digest(words: str) -> list[Column]:
    """Count and digest of a token list: as strict as the tokens themselves, and short."""
    return [F.size(words).alias("n"), F.md5(F.array_join(words, " ")).alias("digest")]


# --- numbers -----------------------------------------------------------------


@query(
    "binarize",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity > 25.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS large
       FROM lineitem""",
)
def binarize(spark: SparkSession, folder: str) -> DataFrame:
    return features.binarize(_lines(spark, folder, "l_quantity"), "l_quantity", "large", threshold=25.0)


@query(
    "bucketize",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < -500 THEN 0.0::DOUBLE WHEN c_acctbal < 0 THEN 1.0::DOUBLE
         WHEN c_acctbal < 5000 THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS bucket FROM customer""",
)
def bucketize(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    edges = [-math.inf, -500.0, 0.0, 5000.0, math.inf]
    return features.bucketize(customers, "c_acctbal", "bucket", edges)


_BINS_SQL = """WITH ranked AS (
    SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS r, count(*) OVER () AS n
    FROM lineitem),
  edges AS (SELECT max(v) FILTER (WHERE r = CAST(ceil(n / 3.0) AS BIGINT)) AS e1,
                   max(v) FILTER (WHERE r = CAST(ceil(n * 2 / 3.0) AS BIGINT)) AS e2 FROM ranked)"""


@query(
    "quantile_bins",
    f"""{_BINS_SQL} SELECT l_orderkey, l_linenumber, l_extendedprice,
          CASE WHEN l_extendedprice < e1 THEN 0.0::DOUBLE WHEN l_extendedprice < e2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS bin
        FROM lineitem, edges""",
)
def quantile_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Three bins at exact order statistics of all order lines."""
    lines = _lines(spark, folder, "l_extendedprice")
    return features.quantile_bins(lines, "l_extendedprice", "bin", buckets=3)


def _scaled(spark: SparkSession, folder: str, scale) -> DataFrame:
    lines = inputs.line_vectors(spark, folder).select("l_orderkey", "l_linenumber", "features")
    out = features.vector_columns(
        scale(lines, "features", "scaled").drop("features"), "scaled", ["quantity", "discount", "tax"]
    )
    return out.select(
        "l_orderkey", "l_linenumber", *[rounded(c, 6).alias(c) for c in ("quantity", "discount", "tax")]
    )


def _scaled_sql(divisor: str) -> str:
    columns = ", ".join(
        f"round(l_{c} / (SELECT {divisor.format('l_' + c)} FROM lineitem), 6) + 0.0 AS {c}"
        for c in ("quantity", "discount", "tax")
    )
    return f"SELECT l_orderkey, l_linenumber, {columns} FROM lineitem"


@query("maxabs_scale", _scaled_sql("max(abs({}))"))
def maxabs_scale(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, features.maxabs_scale)


@query("standard_scale", _scaled_sql("stddev_samp({})"))
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, features.standard_scale)


_POLY = ["x", "x2", "x3", "y", "xy", "x2y", "y2", "xy2", "y3"]


@query(
    "poly_expand",
    """SELECT l_orderkey, l_linenumber, x, round(x*x, 6) + 0.0 AS x2, round(x*x*x, 6) + 0.0 AS x3, y,
          round(x*y, 6) + 0.0 AS xy, round(x*x*y, 6) + 0.0 AS x2y, round(y*y, 6) + 0.0 AS y2,
          round(x*y*y, 6) + 0.0 AS xy2, round(y*y*y, 6) + 0.0 AS y3
       FROM (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount AS y FROM lineitem)""",
)
def poly_expand(spark: SparkSession, folder: str) -> DataFrame:
    pairs = features.vectorised(_lines(spark, folder, "l_quantity", "l_discount"), ["l_quantity", "l_discount"])
    expanded = features.expand_polynomial(pairs, "features", "expanded", degree=3)
    out = features.vector_columns(
        expanded.select("l_orderkey", "l_linenumber", "expanded"), "expanded", _POLY
    )
    return out.select("l_orderkey", "l_linenumber", *[rounded(c, 6).alias(c) for c in _POLY])


@query(
    "assemble",
    """SELECT l_orderkey, l_linenumber, l_quantity AS v0, l_discount AS v1, l_tax AS v2 FROM lineitem""",
)
def assemble(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.line_vectors(spark, folder).select("l_orderkey", "l_linenumber", "features")
    return features.vector_columns(lines, "features", ["v0", "v1", "v2"])


@query(
    "vector_round_trip",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width,
              round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 6) + 0.0 AS total,
              CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[-1] AS DOUBLE) AS last_value
       FROM embeddings""",
)
def vector_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return inputs.vectors(spark, folder).select(
        "vec_id",
        F.size(values).alias("width"),
        rounded(total, 6).alias("total"),
        F.element_at(values, 1).alias("first_value"),
        F.element_at(values, -1).alias("last_value"),
    )


# --- categories --------------------------------------------------------------

_RANKS_SQL = """ranks AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS r
  FROM part GROUP BY p_brand)"""


@query(
    "string_index",
    f"""WITH {_RANKS_SQL} SELECT p_partkey, p_brand, CAST(r AS DOUBLE) AS brand_index FROM part JOIN ranks USING (p_brand)""",
)
def string_index(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    return features.index_by_join(parts, "p_brand", "brand_index")


@query(
    "string_index_by_join",
    """WITH ranks AS (SELECT c_name, row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS r
                      FROM customer GROUP BY c_name)
       SELECT c_custkey, CAST(r AS DOUBLE) AS name_index FROM customer JOIN ranks USING (c_name)""",
)
def string_index_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a column with as many labels as rows, kept in a table."""
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    return features.index_by_join(customers, "c_name", "name_index").drop("c_name")


@query(
    "index_to_string",
    "SELECT p_partkey, p_brand, p_brand AS brand_again FROM part",
)
def index_to_string(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    index = features.fit_string_index(parts, ["p_brand"], ["brand_index"])
    back = features.indices_to_labels(
        index.transform(parts), "brand_index", "brand_again", index.labelsArray[0]
    )
    return back.drop("brand_index")


@query(
    "one_hot",
    """WITH ranks AS (SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS r
                      FROM orders GROUP BY 1)
       SELECT o_orderkey, o_orderstatus, CAST(r = 0 AS DOUBLE) AS first_class, CAST(r = 1 AS DOUBLE) AS second_class
       FROM orders JOIN ranks USING (o_orderstatus)""",
)
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    indexed = features.index_by_join(orders, "o_orderstatus", "status_index")
    encoded = features.one_hot(indexed, ["status_index"], ["hot"]).drop("status_index")
    return features.vector_columns(encoded, "hot", ["first_class", "second_class"])


@query(
    "r_formula",
    """WITH ranks AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS r
                      FROM customer GROUP BY 1)
       SELECT c_custkey, CAST(r = 0 AS DOUBLE) AS s0, CAST(r = 1 AS DOUBLE) AS s1, CAST(r = 2 AS DOUBLE) AS s2,
              CAST(r = 3 AS DOUBLE) AS s3, CAST(c_nationkey AS DOUBLE) AS nation, c_acctbal AS label
       FROM customer JOIN ranks USING (c_mktsegment)""",
)
def r_formula(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").drop("c_name")
    shaped = features.apply_formula(customers, "c_acctbal ~ c_mktsegment + c_nationkey")
    kept = shaped.select("c_custkey", "label", "features")
    return features.vector_columns(kept, "features", ["s0", "s1", "s2", "s3", "nation"])


@query(
    "vector_index",
    """WITH statuses AS (SELECT status, row_number() OVER (ORDER BY status) - 1 AS r
                         FROM (SELECT DISTINCT ascii(o_orderstatus) AS status FROM orders))
       SELECT o_orderkey, CAST(r AS DOUBLE) AS status, o_totalprice AS price
       FROM orders JOIN statuses ON status = ascii(o_orderstatus)""",
)
def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    """A three-valued entry becomes categorical, the price stays continuous."""
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.ascii("o_orderstatus").cast("double").alias("code"), "o_totalprice"
    )
    shaped = features.vectorised(orders, ["code", "o_totalprice"]).select("o_orderkey", "features")
    model = features.fit_vector_index(shaped, "features", "indexed", max_categories=4)
    indexed = model.transform(shaped).drop("features")
    return features.vector_columns(indexed, "indexed", ["status", "price"])


# --- text --------------------------------------------------------------------


@query(
    "tokenize",
    f"""WITH {W} SELECT doc_id, CAST(len(words) AS INTEGER) AS n, md5(array_to_string(words, ' ')) AS digest FROM words""",
)
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenize(inputs.documents(spark, folder), "text")
    return words.select("doc_id", *_digest("words"))


@query(
    "regex_tokenize",
    r"""WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z_0-9]'), lambda w: w <> '') AS words
                       FROM documents)
        SELECT doc_id, CAST(len(words) AS INTEGER) AS n, md5(array_to_string(words, ' ')) AS digest FROM words""",
)
def regex_tokenize(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenize_pattern(inputs.documents(spark, folder), "text")
    return words.select("doc_id", *_digest("words"))


@query(
    "remove_stopwords",
    f"""WITH {W}, kept AS (SELECT doc_id, list_filter(words, lambda w: NOT list_contains({STOPS}, w)) AS words FROM words)
        SELECT doc_id, CAST(len(words) AS INTEGER) AS n, md5(array_to_string(words, ' ')) AS digest FROM kept""",
)
def remove_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenize(inputs.documents(spark, folder), "text")
    return features.remove_stop_words(words, "words").select("doc_id", *_digest("filtered"))


@query(
    "ngrams",
    f"""WITH {W}, grams AS (SELECT doc_id, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS words FROM words)
        SELECT doc_id, CAST(len(words) AS INTEGER) AS n, md5(array_to_string(words, ' ')) AS digest FROM grams""",
)
def ngrams(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenize(inputs.documents(spark, folder), "text")
    return features.join_ngrams(words, "words", n=2).select("doc_id", *_digest("ngrams"))


_PAIRS = f"{W}, pairs AS (SELECT doc_id, unnest(words) AS term FROM words)"


@query(
    "count_vectors",
    f"WITH {_PAIRS} SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS value FROM pairs GROUP BY 1, 2",
)
def count_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of all terms of all documents."""
    words = features.tokenize(inputs.documents(spark, folder), "text")
    return features.count_terms(words, "doc_id", "words")


@query(
    "count_vectors_top3",
    f"""WITH {_PAIRS}, top AS (SELECT term FROM pairs GROUP BY term HAVING count(DISTINCT doc_id) >= 2
                               ORDER BY count(*) DESC, term LIMIT 3)
        SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS value FROM pairs JOIN top USING (term) GROUP BY 1, 2""",
)
def count_vectors_top3(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over the three most frequent terms found in at least two documents."""
    words = features.tokenize(inputs.documents(spark, folder), "text").select("doc_id", "words")
    model = features.fit_vocabulary(words, "words", vocab_size=3, min_df=2)
    return features.vector_terms(model.transform(words), "features", "doc_id", model.vocabulary)


@query(
    "tf_idf",
    f"""WITH {_PAIRS}, n AS (SELECT count(*) AS n FROM documents),
          df AS (SELECT term, count(DISTINCT doc_id) AS df FROM pairs GROUP BY 1),
          tf AS (SELECT doc_id, term, count(*) AS tf FROM pairs GROUP BY 1, 2)
        SELECT doc_id, term, round(tf * ln((n + 1.0) / (df + 1.0)), 6) + 0.0 AS value
        FROM tf JOIN df USING (term), n WHERE df < n""",
)
def tf_idf(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of all terms of all documents."""
    documents = read_table(spark, folder, "documents").count()
    words = features.tokenize(inputs.documents(spark, folder), "text")
    weighted = features.weigh_terms(words, "doc_id", "words", documents)
    return weighted.withColumn("value", rounded("value", 6))


@query(
    "tf_idf_vectors",
    f"""WITH {_PAIRS}, n AS (SELECT count(*) AS n FROM documents),
          top AS (SELECT term, count(DISTINCT doc_id) AS df FROM pairs GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2
                  ORDER BY count(*) DESC, term LIMIT 1000),
          tf AS (SELECT doc_id, term, count(*) AS tf FROM pairs GROUP BY 1, 2)
        SELECT doc_id, term, round(tf * ln((n + 1.0) / (df + 1.0)), 6) + 0.0 AS value
        FROM tf JOIN top USING (term), n WHERE df < n""",
)
def tf_idf_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The same in vectors over the thousand most frequent terms."""
    words = features.tokenize(inputs.documents(spark, folder), "text").select("doc_id", "words")
    counted = features.fit_vocabulary(words, "words", out="counts", vocab_size=1000, min_df=2)
    vectors = counted.transform(words).drop("words")
    weighted = features.fit_idf(vectors, "counts").transform(vectors)
    entries = features.vector_terms(weighted, "features", "doc_id", counted.vocabulary)
    return entries.withColumn("value", rounded("value", 6))


@query(
    "hashing_tf",
    f"WITH {W} SELECT doc_id, CAST(len(words) AS DOUBLE) AS total FROM words",
)
def hashing_tf(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed term counts; whatever the buckets, they add up to the number of tokens."""
    words = features.tokenize(inputs.documents(spark, folder), "text")
    hashed = features.hash_terms(words, "words", num_features=1000)
    entries = features.sparse_entries("raw_features")
    total = F.aggregate(entries, F.lit(0.0), lambda s, e: s + e["value"])
    return hashed.select("doc_id", total.alias("total"))


@query("word2vec")
def word2vec(spark: SparkSession, folder: str) -> DataFrame:
    """Document vectors of size 3, the means of their word vectors."""
    words = features.tokenize(inputs.documents(spark, folder), "text").select("doc_id", "words")
    vectors = skipgrams.fit_skip_grams(words, "words", size=3, min_count=0, seed=1)
    out = skipgrams.document_vectors(variational.term_entries(words, "words"), vectors, 3)
    return out.select("doc_id", *[rounded(c, 6).alias(c) for c in ("v0", "v1", "v2")])


@query(
    "word2vec_mean_gap",
    f"""WITH {W} SELECT doc_id, CAST(len(words) AS BIGINT) AS n, 0.0::DOUBLE AS gap FROM words""",
)
def word2vec_mean_gap(spark: SparkSession, folder: str) -> DataFrame:
    """Distance of each document vector from the mean of its word vectors, which is none."""
    words = features.tokenize(inputs.documents(spark, folder), "text").select("doc_id", "words")
    vectors = skipgrams.fit_skip_grams(words, "words", size=3, min_count=0, seed=1)
    by_word = vectors.withColumnRenamed("vector", "w")
    tokens = words.select("doc_id", F.explode("words").alias("word")).join(by_word, "word")
    axes = range(3)
    means = tokens.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col("w")[i]).alias(f"m{i}") for i in axes]
    )
    whole = skipgrams.document_vectors(variational.term_entries(words, "words"), vectors, 3)
    gap = F.greatest(*[F.abs(F.col(f"m{i}") - F.col(f"v{i}")) for i in axes])
    return means.join(whole, "doc_id").select("doc_id", "n", rounded(gap, 4).alias("gap"))


# --- whole tables ------------------------------------------------------------


@query(
    "sql_transform",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) + 0.0 AS revenue
       FROM lineitem WHERE l_quantity > 0""",
)
def sql_transform(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder, "l_quantity", "l_extendedprice", "l_discount")
    statement = """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue
                   FROM __THIS__ WHERE l_quantity > 0"""
    done = features.sql_stage(lines, statement)
    return done.withColumn("revenue", rounded("revenue", 6))


@query(
    "pca_variance",
    """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS d,
                         covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem),
            e AS (SELECT (a + d) / 2 AS m, sqrt((a - d) * (a - d) / 4 + b * b) AS s FROM c)
       SELECT CAST(axis AS INTEGER) AS axis,
              round(CASE WHEN axis = 0 THEN (m + s) ELSE (m - s) END / (2 * m), 6) + 0.0 AS variance
       FROM e, (VALUES (0), (1)) v(axis)""",
)
def pca_variance(spark: SparkSession, folder: str) -> DataFrame:
    """Share of variance along the two axes of quantity and price."""
    lines = features.vectorised(
        _lines(spark, folder, "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"]
    )
    model = principal.fit_pca(lines, "features", k=2)
    shares = [(i, float(v)) for i, v in enumerate(model.shares)]
    found = spark.createDataFrame(shares, "axis int, variance double")
    return found.withColumn("variance", rounded("variance", 6))


@query(
    "pca_components",
    """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS d,
                         covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem),
            e AS (SELECT a, b, (a + d) / 2 - sqrt((a - d) * (a - d) / 4 + b * b) AS low FROM c),
            u AS (SELECT a - low AS p, b AS q, sqrt((a - low) * (a - low) + b * b) AS n FROM e)
       SELECT CAST(axis AS INTEGER) AS axis, name AS "column",
              round(CASE WHEN axis = 0 AND name = 'l_quantity' THEN p / n WHEN axis = 0 THEN q / n
                         WHEN name = 'l_quantity' THEN q / n ELSE -p / n END
                    * CASE WHEN axis = 0 AND abs(p) >= abs(q) THEN sign(p) WHEN axis = 0 THEN sign(q)
                           WHEN abs(q) >= abs(p) THEN sign(q) ELSE -sign(p) END, 9) + 0.0 AS loading
       FROM u, (VALUES (0), (1)) v(axis), (VALUES ('l_quantity'), ('l_extendedprice')) w(name)""",
)
def pca_components(spark: SparkSession, folder: str) -> DataFrame:
    """Loadings of quantity and price on both axes; the larger one of an axis is positive."""
    names = ["l_quantity", "l_extendedprice"]
    lines = features.vectorised(_lines(spark, folder, *names), names)
    found = principal.axis_table(lines, principal.fit_pca(lines, "features", k=2), names)
    return found.withColumn("loading", rounded("loading", 9))


@query("pca_project")
def pca_project(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings on their three main axes; the largest entry of an axis is positive."""
    rows = inputs.vectors(spark, folder)
    model = principal.fit_pca(rows, "features", k=3)
    projected = model.transform(rows).select("vec_id", "pca")
    out = features.vector_columns(projected, "pca", ["a0", "a1", "a2"])
    return out.select("vec_id", *[rounded(c, 6).alias(c) for c in ("a0", "a1", "a2")])


@query(
    "pca_rotation",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * v)), 6) + 0.0 AS squared_length
        FROM embeddings""",
)
def pca_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """On all 64 axes the projection is a rotation, so it keeps every length."""
    rows = inputs.vectors(spark, folder)
    projected = principal.fit_pca(rows, "features", k=64).transform(rows)
    length = F.aggregate(vector_to_array("pca"), F.lit(0.0), lambda s, v: s + v * v)
    return projected.select("vec_id", rounded(length, 6).alias("squared_length"))
