"""The recommendation job works its ratings out once."""

from pyspark.sql import functions as F

from tabulon.plans import jobs


def test_ratings_are_worked_out_once(spark):
    rows = [(u, i, float((u + i) % 5 + 1)) for u in range(20) for i in range(12)]
    seen = spark.sparkContext.accumulator(0)

    def noted(x):
        seen.add(1)
        return x

    numbered = F.udf(noted, "long")
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double").withColumn("item_id", numbered("item_id"))
    items = spark.createDataFrame([(i, f"t{i}") for i in range(12)], "item_id long, title string")
    fresh = spark.createDataFrame([(-1, 0, 5.0), (-1, 1, 1.0)], "user_id long, item_id long, rating double")
    found = jobs.recommend(ratings, items, fresh, users=[-1], k=3, min_count=20, rank=2, iterations=2).collect()
    assert len(found) == 3 and not {r["item_id"] for r in found} & {0, 1} and {r["n_ratings"] for r in found} == {20}
    assert seen.value == len(rows)
