"""Lists made in blocks of users, against plain joins."""

import random

import pytest

from recsift.operators import recommend


def _tables(spark):
    draw = random.Random(7)
    # User 1 has a third of all rows; a NULL user, NULL items and ratings, repeated rows.
    rows = [(1 if i % 3 == 0 else draw.choice([None, *range(2, 30)]), draw.choice([None, *range(60)]),
             draw.choice([None, 1.0, 3.5, 4.0, 5.0])) for i in range(900)]
    ratings = spark.createDataFrame(rows + rows[:40], "user_id long, item_id long, rating double")
    near = []
    for seed in range(50):  # items 50 to 59 have no neighbours; many equal similarities
        others = draw.sample([i for i in range(60) if i != seed], 8)
        sims = sorted((draw.choice([0.25, 0.5, 0.75]) for _ in others), reverse=True)
        near += [(seed, o, s, r + 1) for r, (o, s) in enumerate(zip(others, sims))]
    similar = spark.createDataFrame(near, "seed_id long, item_id long, similarity double, rank int")
    ratings.createOrReplaceTempView("ub_ratings")
    similar.createOrReplaceTempView("ub_similar")
    return ratings, similar


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("heavy", [1 << 18, 40])
def test_liked_lists_equal_plain_joins(spark, heavy):
    ratings, similar = _tables(spark)
    want = spark.sql("""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, item_id) AS rank FROM (
            SELECT r.user_id, s.item_id, max(s.similarity) AS similarity FROM ub_ratings r JOIN ub_similar s ON r.item_id = s.seed_id
            WHERE r.rating >= 4 AND s.rank <= 5 GROUP BY r.user_id, s.item_id) c
            WHERE NOT EXISTS (SELECT 1 FROM ub_ratings x WHERE x.user_id = c.user_id AND x.item_id = c.item_id))
        WHERE rank <= 5""")
    got = recommend.content_recs_liked(ratings, similar, n=5, heavy=heavy)
    assert got.columns == want.columns and _rows(got) == _rows(want) and got.count() > 50
    assert "LeftAnti" not in got._jdf.queryExecution().executedPlan().toString()  # no row per candidate is shuffled


def test_nothing_rated(spark):
    ratings, similar = _tables(spark)
    none = ratings.limit(0)
    assert recommend.content_recs_liked(none, similar).count() == 0
