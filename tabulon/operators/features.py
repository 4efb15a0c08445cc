"""Feature transformers on columns, categories, text and vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import feature as mf
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators.ordering import exact_quantiles, frequency_ranks

# --- numbers -----------------------------------------------------------------


def binarize(df: DataFrame, column: str, out: str, threshold: float = 5.1) -> DataFrame:
    """1.0 where the value is strictly above the threshold, else 0.0."""
    return mf.Binarizer(threshold=threshold, inputCol=column, outputCol=out).transform(df)


def bucketize(
    df: DataFrame,
    column: str,
    out: str,
    splits: Sequence[float] = (-math.inf, -0.5, 0.0, 0.5, math.inf),
    handle_invalid: str = "error",
) -> DataFrame:
    """Number of the half-open bucket ``[low, high)`` that holds the value."""
    bucketizer = mf.Bucketizer(
        splits=list(splits), inputCol=column, outputCol=out, handleInvalid=handle_invalid
    )
    return bucketizer.transform(df)


def quantile_splits(df: DataFrame, column: str, buckets: int = 3) -> list[float]:
    """Exact quantile edges with infinite ends; equal edges collapse."""
    inner = exact_quantiles(df, column, [i / buckets for i in range(1, buckets)])
    return [-math.inf, *sorted(set(inner) - {-math.inf, math.inf}), math.inf]


def quantile_bins(
    df: DataFrame, column: str, out: str, buckets: int = 3, relative_error: float | None = None
) -> DataFrame:
    """Bucket number by quantile: exact by default, sketched if an error is allowed."""
    if relative_error:
        binner = mf.QuantileDiscretizer(
            numBuckets=buckets, inputCol=column, outputCol=out, relativeError=relative_error
        )
        return binner.fit(df).transform(df)
    return bucketize(df, column, out, quantile_splits(df, column, buckets))


def fit_bins(
    df: DataFrame, columns: Sequence[str], outputs: Sequence[str], bins: int = 32, accuracy: int = 10_000, handle_invalid: str = "error"
) -> mf.Bucketizer:
    """Bins for several columns with edges taken from all rows.

    A column with at most ``bins`` distinct values gets a bin for each, however rare it
    is. Other columns get a bin for their least and for their largest value and bins of
    about equal size between, from quantile sketches (rank error of one in ``accuracy``) that are
    built in each task and merged. That is one scan, and a second one for the distinct values of the columns that
    seem to have few. Nulls and NaNs are not looked at; ``handle_invalid`` says what
    becomes of them in the result.
    """
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    inner = [i / (bins - 1) for i in range(1, bins - 1)]
    sketch = df.agg(
        *[
            F.struct(
                F.approx_count_distinct(v).alias("n"),
                F.percentile_approx(v, inner, accuracy).alias("inner"),
                F.min(v).alias("low"),
                F.max(v).alias("high"),
            ).alias(f"c{i}")
            for i, v in enumerate(values.values())
        ]
    ).first()
    few = [i for i in range(len(columns)) if sketch[i]["n"] <= 2 * bins]
    distinct: dict[int, list[float]] = {i: [] for i in few}
    if few:
        entries = F.array(*[F.struct(F.lit(i).alias("column"), values[columns[i]].alias("value")) for i in few])
        found = df.select(F.inline(entries)).where(F.col("value").isNotNull()).distinct().orderBy("column", "value")
        for row in found.collect():
            distinct[row["column"]].append(row["value"] + 0.0)
    splits = []
    for i in range(len(columns)):
        if i in distinct and len(distinct[i]) <= bins:
            edges = distinct[i][1:] or distinct[i] or [0.0]
        else:
            edges = [math.nextafter(sketch[i]["low"], math.inf), *(sketch[i]["inner"] or []), sketch[i]["high"]]
        splits.append([-math.inf, *sorted(set(edges) - {-math.inf, math.inf}), math.inf])
    return mf.Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=list(outputs), handleInvalid=handle_invalid)


def vectorised(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Assemble numeric and vector columns to one vector; a null is an error."""
    assembler = mf.VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error")
    return assembler.transform(df)


def array_as_vector(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


def vector_as_array(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.withColumn(out, vector_to_array(column))


def vector_columns(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per entry."""
    kept = [c for c in df.columns if c != column]
    values = vector_to_array(column)
    return df.select(*kept, *[values[i].alias(name) for i, name in enumerate(names)])


def maxabs_scale(df: DataFrame, column: str, out: str = "scaled") -> DataFrame:
    """Divide each vector entry by its largest magnitude; zeros stay zero."""
    return mf.MaxAbsScaler(inputCol=column, outputCol=out).fit(df).transform(df)


def standard_scale(
    df: DataFrame, column: str, out: str = "scaled", with_std: bool = True, with_mean: bool = False
) -> DataFrame:
    """Divide each vector entry by its sample standard deviation."""
    scaler = mf.StandardScaler(inputCol=column, outputCol=out, withStd=with_std, withMean=with_mean)
    return scaler.fit(df).transform(df)


def expand_polynomial(df: DataFrame, column: str, out: str = "expanded", degree: int = 3) -> DataFrame:
    return mf.PolynomialExpansion(degree=degree, inputCol=column, outputCol=out).transform(df)


# --- categories --------------------------------------------------------------


def fit_string_index(
    df: DataFrame, columns: Sequence[str], outputs: Sequence[str], handle_invalid: str = "error"
) -> mf.StringIndexerModel:
    """One fit for all columns: index by falling frequency, equal counts by value.

    The fitted model holds all labels and marks its output as categorical, which
    trees need. For columns of very many labels see :func:`index_by_join`.
    """
    indexer = mf.StringIndexer(
        inputCols=list(columns), outputCols=list(outputs), handleInvalid=handle_invalid
    )
    return indexer.fit(df)


def index_by_join(df: DataFrame, column: str, out: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """The same index for any number of labels, from a table of ranks and a join.

    ``vocabulary`` is the frame whose values are counted, ``df`` by default. The
    rank table has one row per label; a hot label is split by adaptive skew joins.
    A null or a label that the vocabulary lacks is an error, as in the fitted model.
    """
    ranks = frequency_ranks(df if vocabulary is None else vocabulary, column, out)
    ranks = ranks.select(column, F.col(out).cast("double").alias("_rank"))
    shown = F.coalesce(F.col(column).cast("string"), F.lit("null"))
    unknown = F.raise_error(F.concat(F.lit(f"no index for this label of {column}: "), shown)).cast("double")
    return df.join(ranks, column, "left").select(*df.columns, F.coalesce("_rank", unknown).alias(out))


def indices_to_labels(df: DataFrame, column: str, out: str, labels: Sequence[str]) -> DataFrame:
    return mf.IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def one_hot(df: DataFrame, columns: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Indicator vectors; the last category is all zero."""
    encoder = mf.OneHotEncoder(inputCols=list(columns), outputCols=list(outputs))
    return encoder.fit(df).transform(df)


def apply_formula(
    df: DataFrame, formula: str, features: str = "features", label: str = "label"
) -> DataFrame:
    """R-style formula: string terms one-hot encoded, numbers passed, label as double."""
    model = mf.RFormula(formula=formula, featuresCol=features, labelCol=label)
    return model.fit(df).transform(df)


def fit_vector_index(
    df: DataFrame, column: str, out: str, max_categories: int = 4, handle_invalid: str = "error"
) -> mf.VectorIndexerModel:
    """Entries with at most ``max_categories`` distinct values become categorical."""
    indexer = mf.VectorIndexer(
        inputCol=column, outputCol=out, maxCategories=max_categories, handleInvalid=handle_invalid
    )
    return indexer.fit(df)


# --- text --------------------------------------------------------------------


def tokenize(df: DataFrame, column: str, out: str = "words") -> DataFrame:
    """Lower-case and split at single white-space characters."""
    return mf.Tokenizer(inputCol=column, outputCol=out).transform(df)


def tokenize_pattern(df: DataFrame, column: str, out: str = "words", pattern: str = r"\W") -> DataFrame:
    """Lower-case and split at a pattern; empty tokens are dropped."""
    return mf.RegexTokenizer(inputCol=column, outputCol=out, pattern=pattern).transform(df)


def remove_stop_words(
    df: DataFrame, column: str, out: str = "filtered", words: Sequence[str] | None = None
) -> DataFrame:
    """Drop stop words, by default the library's English list, ignoring case."""
    remover = mf.StopWordsRemover(inputCol=column, outputCol=out, caseSensitive=False)
    if words is not None:
        remover = remover.setStopWords(list(words))
    return remover.transform(df)


def join_ngrams(df: DataFrame, column: str, out: str = "ngrams", n: int = 2) -> DataFrame:
    return mf.NGram(n=n, inputCol=column, outputCol=out).transform(df)


def fit_vocabulary(
    df: DataFrame, column: str, out: str = "features", vocab_size: int | None = None, min_df: int = 1
) -> mf.CountVectorizerModel:
    """A term-count model over the most frequent terms found in ``min_df`` documents.

    Terms rank by corpus count, equal counts by term, so unlike the library's own
    fit the index does not change between runs. All such terms are taken, and reach
    the driver, unless ``vocab_size`` asks for the first ones only.
    """
    def tally(terms, total: int, documents: int):
        return F.transform(
            terms,
            lambda term: F.struct(
                term.alias("term"),
                F.lit(total).alias("total"),
                F.lit(documents).alias("documents"),
            ),
        )

    # Each occurrence adds to the total, each distinct term once to the documents;
    # one explode feeds both sums, and they shrink to one row per term before the shuffle.
    both = F.concat(tally(F.col(column), 1, 0), tally(F.array_distinct(column), 0, 1))
    ranked = (
        df.select(F.inline(both))
        .groupBy("term")
        .agg(F.sum("total").alias("total"), F.sum("documents").alias("documents"))
        .where(F.col("documents") >= min_df)
        .orderBy(F.desc("total"), "term")
    )
    if vocab_size is not None:
        ranked = ranked.limit(vocab_size)
    terms = [row["term"] for row in ranked.select("term").collect()]
    return mf.CountVectorizerModel.from_vocabulary(terms, inputCol=column, outputCol=out)


def sparse_entries(column: str) -> Column:
    """Non-zero entries of a vector column as an array of ``(index, value)`` structs."""
    raw = F.unwrap_udt(column)
    index = F.when(raw["type"] == 0, raw["indices"]).otherwise(
        F.sequence(F.lit(0), F.size(raw["values"]) - 1)
    )
    pairs = F.zip_with(
        index, raw["values"], lambda i, v: F.struct(i.alias("index"), v.alias("value"))
    )
    return F.filter(pairs, lambda pair: pair["value"] != 0)


def term_table(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``index, term`` rows of a vocabulary held on the driver."""
    return df.sparkSession.createDataFrame(list(enumerate(terms)), "index int, term string")


def vector_terms(df: DataFrame, column: str, key: str, vocabulary: Sequence[str]) -> DataFrame:
    """Non-zero entries of a term vector as ``key, term, value`` rows."""
    entries = df.select(key, F.inline(sparse_entries(column)))
    words = term_table(df, vocabulary)
    return entries.join(words, "index").select(key, "term", "value")


def count_terms(df: DataFrame, key: str, column: str) -> DataFrame:
    """``key, term, value``: term counts per document over all terms, without a vocabulary.

    Unlike a vector over a vocabulary this has no limit on the number of terms. The
    outer explode keeps Spark from testing the token array below the exchange, which
    would take the text apart once more.
    """
    terms = df.select(key, F.explode_outer(column).alias("term")).where(F.col("term").isNotNull())
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).cast("double").alias("value"))


def weigh_terms(
    df: DataFrame, key: str, column: str, documents: int, min_doc_freq: int = 0
) -> DataFrame:
    """``key, term, value``: term counts times ``ln((N + 1) / (df + 1))``, zeros left out.

    The text is taken apart once: the counts per document and term are also what
    the frequencies are counted from. They shrink to a row per term before they
    are shuffled and meet the counts in a join on the term, to which a term brings
    one row per document that has it.
    """
    counts = count_terms(df, key, column)
    frequency = (
        counts.groupBy("term")
        # Asking for the value keeps both uses of the counts alike, so their exchange is reused.
        .agg(F.count_if(F.col("value") > 0).alias("df"))
        .where(F.col("df") >= min_doc_freq)
    )
    weight = F.log((F.lit(documents) + 1.0) / (F.col("df") + 1.0))
    weighted = counts.join(frequency, "term")
    return weighted.select(key, "term", (F.col("value") * weight).alias("value")).where(
        F.col("value") != 0
    )


def hash_terms(df: DataFrame, column: str, out: str = "raw_features", num_features: int = 20) -> DataFrame:
    return mf.HashingTF(inputCol=column, outputCol=out, numFeatures=num_features).transform(df)


def fit_idf(df: DataFrame, column: str, out: str = "features", min_doc_freq: int = 0) -> mf.IDFModel:
    """Weights ``ln((N + 1) / (df + 1))``; terms below ``min_doc_freq`` weigh 0."""
    return mf.IDF(inputCol=column, outputCol=out, minDocFreq=min_doc_freq).fit(df)


def fit_word_vectors(
    df: DataFrame,
    column: str,
    out: str = "vector",
    size: int = 3,
    min_count: int = 0,
    seed: int = 1,
    partitions: int = 8,
) -> mf.Word2VecModel:
    """Skip-gram word vectors; a document vector is the mean over its words.

    The library keeps the whole vocabulary in each task: raise ``min_count`` if it
    does not fit there. The text is trained in ``partitions`` parts, on which the
    vectors depend; one part, the library's default, would be one task.
    """
    model = mf.Word2Vec(
        vectorSize=size,
        minCount=min_count,
        inputCol=column,
        outputCol=out,
        seed=seed,
        numPartitions=partitions,
    )
    return model.fit(df)


# --- whole tables ------------------------------------------------------------


def sql_stage(df: DataFrame, statement: str) -> DataFrame:
    """One SQL statement over the table, which it calls ``__THIS__``."""
    return mf.SQLTransformer(statement=statement).transform(df)
