"""Word vectors by sums over pairs: counts, information and fit against plain versions."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import words


def sentences(seed=1, n=300):
    """Words a0-a4 stand where the others of their kind stand, and so do b0-b4; x and y go with either."""
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = "ab"[i % 2]
        middle = [f"{kind}{k}" for k in draw.integers(0, 5, 2)]
        rows.append([f"{kind}left", middle[0], "x", middle[1], f"{kind}right", "y"])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, words array<string>").repartition(3)


def plain_counts(rows, window):
    n = collections.Counter()
    for r in rows:
        for i in range(len(r)):
            for j in range(len(r)):
                if i != j and abs(i - j) <= window:
                    n[r[i], r[j]] += 1
    return n


def test_counts_and_information(spark):
    rows = [*sentences(n=40), [], ["alone"], ["x", "x", "y"]]
    counts = words.pair_counts(frame(spark, rows), "words", 3)
    want = plain_counts(rows, 3)
    assert {(r["word"], r["context"]): r["n"] for r in counts.collect()} == dict(want)
    of = collections.Counter()
    for (w, _), n in want.items():
        of[w] += n
    total = sum(of.values())
    info = {k: math.log(n * total / of[k[0]] / of[k[1]]) for k, n in want.items()}
    found = {(r["word"], r["context"]): r["x"] for r in words.mutual_information(counts).collect()}
    assert found == pytest.approx({k: v for k, v in info.items() if v > 0})


def test_fit_is_least_squares_over_all_pairs(spark):
    """A last half step is the best choice for all pairs, unseen ones as zero."""
    df = frame(spark, sentences(n=60))
    pairs = words.mutual_information(words.pair_counts(df, "words", 2)).checkpoint()
    contexts = pairs.select("context").distinct().withColumn("vector", F.array(*[F.xxhash64(F.lit(i), "context") % 1000 / 1000.0 for i in range(3)])).checkpoint()
    found = {r["word"]: r["vector"] for r in words._half(pairs, contexts, "word", "context", 3, 0.05).collect()}
    v = {r["context"]: np.array(r["vector"]) for r in contexts.collect()}
    x = {(r["word"], r["context"]): r["x"] for r in pairs.collect()}
    table = np.array(list(v.values()))
    for word in found:
        target = np.array([x.get((word, c), 0.0) for c in v])
        assert found[word] == pytest.approx(np.linalg.solve(table.T @ table + 0.05 * np.eye(3), table.T @ target))


def test_words_used_alike_are_nearest(spark):
    vectors = words.fit_word_tables(frame(spark, sentences()), "words", size=6, window=2, rounds=4)
    near = collections.defaultdict(dict)
    for r in words.alike(vectors, k=2).collect():
        near[r["word"]][r["place"]] = r["other"]
    for kind in "ab":
        for k in range(5):
            assert [near[f"{kind}{k}"][p][0] for p in (0, 1)] == [kind, kind]
            assert near[f"{kind}{k}"][0] in {f"{kind}{j}" for j in range(5)}


def test_odd_texts(spark):
    rows = [None, [], ["one"], [None, "a", "b"], ["a", None]]
    df = spark.createDataFrame([(r,) for r in rows], "words array<string>")
    found = words.fit_word_tables(df, "words", size=2, rounds=1)
    assert {r["word"] for r in found.collect()} == {"a", "b"}
    assert words.fit_word_tables(df.limit(0), "words", size=2, rounds=1).collect() == []
    frequent = words.fit_word_tables(frame(spark, [*sentences(), ["rare", "x"]]), "words", size=2, rounds=1, min_count=5)
    assert "rare" not in {r["word"] for r in frequent.collect()}
