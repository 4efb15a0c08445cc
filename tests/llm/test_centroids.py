"""The centroid search and the clustering against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from checking import compare, duck
from hypothesis import given, settings
from hypothesis import strategies as st

import tabulon.llm.queries  # noqa: F401
from tabulon.llm.centroids import Codebook, cluster
from tabulon.plans.registry import CHECK_SQL, QUERIES


def plain_nearest(vectors, centroids):
    distance = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    return distance.argmin(1), distance.min(1)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 50), st.sampled_from([1, 2, 5, 64]), st.sampled_from([1, 3, 300, 1 << 22]))
def test_search(seed, k, d, size):
    draw = np.random.default_rng(seed)
    centroids = draw.integers(-size, size + 1, (k, d))
    centroids[k // 2 :] = centroids[: k - k // 2]  # equal centroids: the smaller number wins
    vectors = np.concatenate([draw.integers(-size, size + 1, (40, d)), centroids, centroids + draw.integers(-1, 2, (k, d))])
    number, distance, _ = Codebook(centroids).nearest(vectors)
    want = plain_nearest(vectors, centroids)
    assert number.tolist() == want[0].tolist() and distance.tolist() == want[1].tolist()


def test_search_rejects():
    """Vectors near one of many spread centroids are measured against few of them."""
    draw = np.random.default_rng(4)
    centroids = draw.integers(-300, 300, (200, 64)) + draw.integers(-200, 200, (200, 1))
    vectors = centroids[draw.integers(0, 200, 5000)] + draw.integers(-9, 10, (5000, 64))
    number, _, taken = Codebook(centroids).nearest(vectors)
    assert number.tolist() == plain_nearest(vectors, centroids)[0].tolist()
    assert taken < 0.1 * 200 * 5000


def plain_clusters(rows, k, rounds, length):
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = {i: "" if i is None else str(i) for i, _ in kept}
    centroids = [w for _, w in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{name[r[0]]}".encode()).hexdigest(), r[1]))[:k]]

    def near(w):
        return min((sum((a - b) ** 2 for a, b in zip(w, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, w in kept:
            held.setdefault(near(w)[1], []).append(w)
        for n, ws in held.items():
            centroids[n] = [sum(x) // len(ws) for x in zip(*ws)]
    return centroids, [(i, near(w)[1], near(w)[0]) for i, w in kept]


def test_odd_rows(spark):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.normal(size=8) / 3).astype(np.float32).tolist()) for i in range(80)]
    rows += [(100 + i, rows[0][1]) for i in range(60)]  # a group of copies
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[9][1]), (None, rows[10][1])]
    bad = [(200, None), (201, []), (202, [0.5] * 7), (203, [0.5] * 7 + [None]), (204, [math.inf] + [0.5] * 7), (205, [math.nan] * 8)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + bad], "vec_id long, embedding array<float>, cluster string, weights string").repartition(5)
    for k, rounds in ((12, 3), (500, 1)):
        found = cluster(df, k=k, rounds=rounds, length=8)
        centroids, members = plain_clusters(rows, k, rounds, 8)
        assert found.centroids == centroids
        assert sorted(map(tuple, found.members.collect()), key=str) == sorted(members, key=str)
        assert sum(int(r["inertia"]) for r in found.sizes().collect()) == sum(m[2] for m in members)
    for none in (df.limit(0), df.where("vec_id >= 200")):
        found = cluster(none, length=8)
        assert found.centroids == [] and found.members.collect() == []
    with pytest.raises(ValueError):
        cluster(spark.createDataFrame([(1, [1e30, 2.0])], "vec_id long, embedding array<double>"), length=2)


def test_sql(spark, folder):
    assert compare(QUERIES["op12_centroids"](spark, folder), duck(folder), CHECK_SQL["op12_centroids"]) is None


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op12_centroids"](spark, str(tmp_path)).collect() == []
