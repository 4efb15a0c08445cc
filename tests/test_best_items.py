"""The bounded search for the best items of many users against a full comparison."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import recommend


def half_up(x, digits):
    return math.copysign(math.floor(abs(x) * 10**digits + 0.5), x)


def factors(spark, name, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"{name} long, features array<float>")


def full_search(users, items, rated, k, digits):
    out = {}
    for u, taste in users:
        scores = [(np.array(taste, np.float32).astype(float) @ np.array(f, np.float32).astype(float), i) for i, f in items if (u, i) not in rated]
        out[u] = [i for _, i in sorted((-half_up(s, digits), i) for s, i in scores)][:k]
    return out


def search(spark, users, items, rated, k, digits, block_items):
    known = spark.createDataFrame(sorted(rated), "user_id long, item_id long")
    found = recommend.best_items(factors(spark, "item_id", items), factors(spark, "user_id", users).repartition(3), known, k, digits, block_items)
    return {r["user_id"]: r for r in found.collect()}


@pytest.mark.parametrize("cell", [1024, 16])
def test_against_a_full_search(spark, monkeypatch, cell):
    monkeypatch.setattr(recommend, "CELL_USERS", cell)
    draw = np.random.default_rng(1)
    items = [(i, draw.normal(size=4) * draw.gamma(1.0)) for i in range(500)]
    items += [(1000 + i, items[3][1]) for i in range(200)] + [(2000, [0.0] * 4)]
    users = [(u, draw.normal(size=4)) for u in range(60)] + [(100, [0.0] * 4), (-5, [1e-9] * 4)]
    rated = {(u, int(i)) for u in range(0, 60, 2) for i in draw.choice(500, 90, replace=False)}
    rated |= {(7, i) for i, _ in items[:-4]}  # four items are left
    found = search(spark, users, items, rated, 6, 3, 32)
    want = full_search(users, items, rated, 6, 3)
    assert {u: r["best"] for u, r in found.items()} == want
    assert len(found[7]["best"]) == 4
    blocks = math.ceil(len(items) / 32)
    assert max(r["met"] for r in found.values()) <= blocks and found[7]["met"] == blocks


def test_most_blocks_are_skipped(spark):
    """Item lengths fall off as popularity does: a user is scored against a few of 100 blocks."""
    draw = np.random.default_rng(2)
    items = [(i, draw.normal(size=8) * 0.99**i) for i in range(2000)]
    users = [(u, draw.normal(size=8)) for u in range(300)]
    found = search(spark, users, items, set([(0, 0)]), 5, 6, 20)
    assert {u: r["best"] for u, r in found.items()} == full_search(users, items, {(0, 0)}, 5, 6)
    skipped = [100 - r["met"] for r in found.values()]
    assert min(skipped) > 60 and sum(skipped) / len(skipped) > 80


def test_later_blocks_go_to_open_users_only(spark, monkeypatch):
    """In each round only users that can still improve are dealt again."""
    seen = []
    plain = recommend._round
    monkeypatch.setattr(recommend, "_round", lambda users, n, blocks, *a: seen.append((n, blocks.count())) or plain(users, n, blocks, *a))
    items = [(i, [1000.0 - i if i < 20 else 1.0, 1.0]) for i in range(400)]
    users = [(u, [1.0, 0.0]) for u in range(50)] + [(90, [0.0, 1.0])]  # the last one sees all items alike
    found = search(spark, users, items, {(0, 5)}, 3, 6, 20)
    assert found[3]["best"] == [0, 1, 2] and found[0]["best"] == [0, 1, 2] and found[90]["best"] == [0, 1, 2]
    assert [n for n, _ in seen] == [51, 1, 1, 1, 1] and [b for _, b in seen] == [1, 2, 4, 8, 5]


def test_no_items_or_users(spark):
    some = factors(spark, "item_id", [(1, [1.0])]), factors(spark, "user_id", [(1, [1.0])])
    rated = spark.createDataFrame([], "user_id long, item_id long")
    assert recommend.best_items(some[0].limit(0), some[1], rated).collect() == []
    assert recommend.best_items(some[0], some[1].limit(0), rated).collect() == []
    assert recommend.best_items(*some, rated).select("best", "met").collect() == [([1], 1)]
    assert recommend.best_items(*some, rated.union(spark.createDataFrame([(1, 1)], rated.schema))).select("best").collect() == [([],)]


def test_blocks_fall_in_length(spark):
    items = factors(spark, "item_id", [(i, [float(i % 7), 1.0]) for i in range(50)])
    rows = recommend.item_blocks(items, 8).orderBy("block").collect()
    assert [len(r["ids"]) for r in rows] == [8] * 6 + [2] and all(len(r["numbers"]) == 2 * len(r["ids"]) for r in rows)
    assert all(a["shortest"] >= b["longest"] for a, b in zip(rows, rows[1:]))
    assert items.count() == sum(len(r["ids"]) for r in rows)
    assert recommend.item_blocks(items, 8).where(F.size("ids") == 0).count() == 0
