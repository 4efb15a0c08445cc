"""Term-at-a-time search against plain versions."""

import math

import numpy as np
import pytest
from checking import compare, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tabulon.llm.queries  # noqa: F401
from tabulon.llm import topk
from tabulon.plans.registry import CHECK_SQL, QUERIES


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def plain_top(rows, is_query, k):
    """Best rows of each distinct (id, vector) query: lists of query_id, rank, vec_id, score."""
    kept = {
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, v in kept:
        if is_query(i):
            best = sorted((-product(v, w), j) for j, w in kept if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), max_size=6), min_size=1, max_size=30), st.lists(st.integers(-9, 9), max_size=8))
def test_postings(rows, query):
    sizes = np.array([len(r) for r in rows])
    postings = topk.Postings(sizes, np.array([x for r in rows for x in r], np.int64))
    q = np.array(query, np.int64)
    assert postings.scores(np.flatnonzero(q), q[q != 0]).tolist() == [product(r, query) for r in rows]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.integers(1, 9))
def test_best_of(scores, k):
    ids = np.random.default_rng(len(scores)).permutation(len(scores))
    found = topk.best_of(np.array(scores, np.int64), ids, k)
    want = sorted(range(len(scores)), key=lambda p: (-scores[p], ids[p]))[:k]
    assert found.tolist() == want


def odd_vectors():
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=6).round(1)).tolist()) for i in range(1700)]
    rows += [(2000 + i, rows[7][1]) for i in range(900)]  # a third are copies: ties by id
    rows += [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (51, [0.0] * 6), (100, [0.0] * 6), (52, []), (150, []), (53, [9.0] * 9)]
    rows += [(None, [5.0] * 6), (200, None), (201, [1.0, None]), (250, [math.nan] * 6), (300, [math.inf]), (10**12, [0.5] * 6)]
    return rows


@pytest.mark.parametrize("most", [1 << 16, 7])
def test_top_k(spark, monkeypatch, most):
    monkeypatch.setattr(topk, "MOST_QUERIES", most)
    monkeypatch.setattr(topk, "ROWS", 100)
    rows = odd_vectors()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, query string, rank int")
    found = topk.top_k(df.repartition(5), F.col("vec_id") % 50 == 0, k=5)
    assert sorted(map(tuple, found.collect())) == plain_top(rows, lambda i: i % 50 == 0, 5)


def test_small_tables(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in (50, 3, 4)], "vec_id long, embedding array<float>")
    def search(rows):
        return sorted(map(tuple, topk.top_k(rows, F.col("vec_id") % 50 == 0).collect()))
    assert [r[2] for r in search(df)] == [4, 3]  # all, if fewer than k
    assert search(df.where("vec_id = 50")) == [] == search(df.limit(0)) == search(df.where("vec_id = 3"))
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame([(50, [1e30])], "vec_id long, embedding array<double>"), F.col("vec_id") == 50)


def test_sql(spark, folder):
    assert compare(QUERIES["op13_topk"](spark, folder), duck(folder), CHECK_SQL["op13_topk"]) is None
