"""Factorisation by parts of normal equations: against a plain version, the library, and with a hot item."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import factors, recommend


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double").repartition(parts)


def low_rank(seed=1, users=40, items=25, rank=2, kept=0.7):
    draw = np.random.default_rng(seed)
    u, v = draw.uniform(0.5, 2, (users, rank)), draw.uniform(0.5, 2, (items, rank))
    return [(i, j, float(u[i] @ v[j])) for i in range(users) for j in range(items) if draw.random() < kept]


def plain(rows, starts, rank, iterations, reg):
    items, users = dict(starts), {}
    for _ in range(iterations):
        for mine, other, key in ((users, items, 0), (items, users, 1)):
            for k in {r[key] for r in rows}:
                own = [(other[r[1 - key]], r[2]) for r in rows if r[key] == k]
                f, y = np.array([f for f, _ in own]), np.array([y for _, y in own])
                mine[k] = np.linalg.solve(f.T @ f + reg * len(own) * np.eye(rank), f.T @ y)
    return users, items


def test_same_as_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(factors, "NUMBERS", 64)
    monkeypatch.setattr(factors, "SYSTEMS", 7)
    rows = low_rank(users=30, items=20) + [(3, 4, 2.5), (3, 4, 2.5)]
    ids = spark.range(20).withColumnRenamed("id", "item_id")
    start = [(F.lit(0.1) + F.pmod(F.xxhash64(F.lit(9), F.lit(j), "item_id"), F.lit(1 << 20)) / float(1 << 20)).alias(f"f{j}") for j in range(3)]
    starts = {r[0]: np.array(r[1:]) for r in ids.select("item_id", *start).collect()}
    users, items = plain(rows, starts, 3, 2, 0.05)
    odd = [(None, 1, 1.0), (1, None, 1.0), (1, 1, None)]
    model = factors.fit_factors(frame(spark, rows + odd), rank=3, iterations=2, reg=0.05, seed=9)
    for found, want, key in ((model.user_factors(), users, "user_id"), (model.item_factors(), items, "item_id")):
        got = {r[key]: np.array(r["features"]) for r in found.collect()}
        assert got.keys() == want.keys() and max(np.abs(got[k] - want[k]).max() for k in want) < 1e-8


def test_as_good_as_the_library(spark):
    rows = low_rank(2)
    ours = factors.fit_factors(frame(spark, rows), rank=2, iterations=6, reg=0.01)
    theirs = recommend.fit_als(frame(spark, rows), rank=2, iterations=6, reg=0.01)
    errors = [m.predict(frame(spark, rows)).agg(F.avg((F.col("rating") - F.col("prediction")) ** 2)).first()[0] for m in (ours, theirs)]
    assert errors[0] < 1.2 * errors[1] + 1e-3
    assert ours.predict(frame(spark, [(1, 1, 0.0), (999, 1, 0.0), (1, 999, 0.0)])).count() == 1


def test_a_third_of_all_ratings_on_one_item(spark):
    """The hot item's ratings stay where they are: a task sends sums, and the solving tasks read few rows."""
    users = 6000
    level = lambda u, i: (1.0 + u % 5) * (1.0 + i % 3)
    rows = [(u, 0, level(u, 0)) for u in range(users)] + [(u, 1 + (u * 7 + k) % 50, level(u, 1 + (u * 7 + k) % 50)) for u in range(users) for k in range(2)]
    df = frame(spark, rows, 8)
    model = factors.fit_factors(df, rank=1, iterations=2, reg=0.1, seed=9)
    ids = spark.range(51).withColumnRenamed("id", "item_id")
    start = F.lit(0.1) + F.pmod(F.xxhash64(F.lit(9), F.lit(0), "item_id"), F.lit(1 << 20)) / float(1 << 20)
    v = np.array([r[0] for r in ids.orderBy("item_id").select(start).collect()])
    u_of, i_of, y = (np.array(c) for c in zip(*rows))
    for _ in range(2):
        u = np.bincount(u_of, v[i_of] * y) / (np.bincount(u_of, v[i_of] ** 2) + 0.1 * np.bincount(u_of))
        v = np.bincount(i_of, u[u_of] * y) / (np.bincount(i_of, u[u_of] ** 2) + 0.1 * np.bincount(i_of))
    found = {r["item_id"]: r["features"][0] for r in model.items.collect()}
    assert len(found) == 51 and max(abs(found[i] - v[i]) for i in found) < 1e-8
    add, _ = factors._half_step(1, 0.1)
    joined = df.select(F.col("item_id").alias("key"), "rating", F.array(F.lit(1.0)).alias("features"))
    sums = joined.mapInArrow(add, "key long, n long, sums array<double>")
    hot = sums.where("key = 0").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n")).first()
    assert hot["n"] == users and hot["parts"] <= 8 * 2


def test_open_systems_and_empty_tables(spark):
    model = factors.fit_factors(frame(spark, [(1, 1, 2.0), (2, 1, 4.0)]), rank=3, iterations=2, reg=0.0)
    found = {r["user_id"]: r["prediction"] for r in model.predict(frame(spark, [(1, 1, 0.0), (2, 1, 0.0)])).collect()}
    assert found == pytest.approx({1: 2.0, 2: 4.0})
    empty = factors.fit_factors(frame(spark, [(1, 1, 2.0)]).limit(0), rank=2, iterations=1)
    assert empty.users.collect() == [] == empty.items.collect()


def test_best_items_from_these_factors(spark):
    model = factors.fit_factors(frame(spark, low_rank(3, 20, 15)), rank=2, iterations=3)
    items = spark.range(15).withColumnRenamed("id", "item_id")
    users = spark.range(20).withColumnRenamed("id", "user_id")
    none = spark.createDataFrame([], "user_id long, item_id long")
    assert recommend.top_items(model, items, users, none, k=3).count() == 60
