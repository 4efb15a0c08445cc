"""Skip-gram vectors as a table: every word has one, document vectors are means, blocks and odd texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import skipgrams, variational
from tabulon.plans import feature_queries


def test_words_used_alike_come_near():
    """Seen from their common mean, words that stand among the same words turn the same way."""
    draw = np.random.default_rng(1)
    kinds = draw.integers(0, 2, 4000)
    tokens = (kinds[:, None] * 6 + draw.integers(0, 6, (4000, 8))).ravel()
    words = [f"{k}{i}" for k in "ab" for i in range(6)]
    found = skipgrams.train_block(np.repeat(np.arange(4000), 8), tokens, words, 3, 3, 0.1, 1)
    found = found - found.mean(axis=1, keepdims=True)
    unit = found / np.sqrt((found**2).sum(axis=0))
    near = unit.T @ unit
    assert near[:6, :6].mean() > 0.8 and near[6:, 6:].mean() > 0.8 and near[:6, 6:].mean() < 0


def test_tables(spark):
    rows = [(1, ["a", "b", "a"]), (1, ["c"]), (None, ["b", None]), (4, []), (5, None), (6, ["a", "b", "c", "d", "e", "f"])]
    df = spark.createDataFrame(rows, "doc_id long, words array<string>").repartition(2)
    found = {}
    for block in (1 << 20, 2):
        vectors = skipgrams.fit_skip_grams(df, "words", size=3, block=block)
        found = {r["word"]: np.array(r["vector"]) for r in vectors.collect()}
        assert set(found) == set("abcdef") and all(np.isfinite(v).all() and len(v) == 3 for v in found.values())
    docs = skipgrams.document_vectors(variational.term_entries(df, "words"), vectors, 3).collect()
    got = sorted((str(r["doc_id"]), *np.round([r["v0"], r["v1"], r["v2"]], 9)) for r in docs)
    mean = lambda words: np.round(np.mean([found[w] for w in words], axis=0), 9) if words else np.zeros(3)
    assert got == sorted((str(i), *mean([w for w in words or () if w])) for i, words in rows)
    often = skipgrams.fit_skip_grams(df, "words", min_count=3)
    assert {r["word"] for r in often.collect()} == {"a", "b"}
    assert skipgrams.fit_skip_grams(df.limit(0), "words").collect() == []


def test_queries_keep_no_vocabulary_in_one_place(spark, folder, monkeypatch):
    """Before, the library collected all words on the driver."""
    monkeypatch.setattr(feature_queries.features, "fit_word_vectors", lambda *a, **k: pytest.fail("collects the vocabulary"))
    assert feature_queries.word2vec(spark, folder).agg(F.count_if(F.isnan("v0") | F.col("v0").isNull())).first()[0] == 0
