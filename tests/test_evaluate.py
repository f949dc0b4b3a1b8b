"""Metrics on hand-made lists (`cold` fixture cases included)."""

import math

from recsift.operators import evaluate, recommend


def _df(spark, rows, schema="user_id long, item_id long"):
    return spark.createDataFrame(rows, schema)


def test_precision_divides_by_list_length(spark):
    recs = _df(spark, [(1, 10), (1, 11)])           # short list of 2, one hit
    rel = _df(spark, [(1, 10), (1, 12), (1, 13)])
    m = evaluate.ranking_metrics(recs, rel).first()
    assert m.precision == 0.5 and abs(m.recall - 1 / 3) < 1e-12
    assert abs(m.f1 - 2 * 0.5 * (1 / 3) / (0.5 + 1 / 3)) < 1e-12


def test_users_without_relevant_or_recs_are_skipped(spark):
    recs = _df(spark, [(1, 10), (2, 20)])
    rel = _df(spark, [(1, 99), (3, 30)])            # user 2: nothing relevant; user 3: no list
    m = evaluate.ranking_metrics(recs, rel).first()
    assert m.n_users == 1 and m.precision == 0.0 and m.f1 == 0.0


def test_jaccard_symmetric_and_bounded(spark):
    a = _df(spark, [(1, 1), (1, 2), (2, 5)])
    b = _df(spark, [(1, 2), (1, 3), (3, 7)])
    ab = {r.user_id: r.jaccard for r in evaluate.jaccard_lists(a, b).collect()}
    ba = {r.user_id: r.jaccard for r in evaluate.jaccard_lists(b, a).collect()}
    assert ab == ba and abs(ab[1] - 1 / 3) < 1e-12 and ab[2] == 0.0 and ab[3] == 0.0
    assert all(0.0 <= v <= 1.0 for v in ab.values())


def test_diversity_matches_pairwise(spark):
    vec = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "b", 1.0)],
                                "item_id long, term string, weight double")
    recs = _df(spark, [(1, 1), (1, 2), (1, 3), (1, 4)])   # item 4 has no vector
    d = evaluate.diversity(recs, vec).first()
    pair = (0.6 + 0.0 + 0.8) * 2  # ordered pairs among 1,2,3; 4 is zero
    assert abs(d.diversity - (1 - pair / (4 * 3))) < 1e-12


def test_regression_metrics(spark):
    p = spark.createDataFrame([(1, 1, 3.0, 2.0), (1, 2, 5.0, 5.0)],
                              "user_id long, item_id long, rating double, prediction double")
    m = evaluate.regression_metrics(p).first()
    assert abs(m.rmse - math.sqrt(0.5)) < 1e-12 and m.mae == 0.5 and abs(m.r2 - (1 - 1 / 2)) < 1e-12


def test_coverage_and_novelty(spark):
    recs = _df(spark, [(1, 1), (2, 1), (2, 2)])
    items = _df(spark, [(1,), (2,), (3,), (4,)], "item_id long")
    c = evaluate.coverage(recs, items).first()
    assert c.coverage == 0.5
    ratings = spark.createDataFrame([(1, 1, 4.0), (2, 1, 3.0), (3, 2, 5.0)], "user_id long, item_id long, rating double")
    n = evaluate.novelty(recs, ratings).first()
    i1, i2 = -math.log2(2 / 3), -math.log2(1 / 3)
    assert n.n_users == 2 and abs(n.novelty - (i1 + (i1 + i2) / 2) / 2) < 1e-12
    s = evaluate.novelty(recs, ratings, smoothing=True).first()
    i1, i2 = -math.log2(3 / 4), -math.log2(2 / 4)
    assert abs(s.novelty - (i1 + (i1 + i2) / 2) / 2) < 1e-12


def test_novelty_leaves_unrated_items_out(spark):
    recs = _df(spark, [(1, 1), (1, 9), (2, 9)])
    ratings = spark.createDataFrame([(1, 1, 4.0), (2, 2, 3.0)], "user_id long, item_id long, rating double")
    n = evaluate.novelty(recs, ratings).first()
    assert n.n_users == 1 and abs(n.novelty - 1.0) < 1e-12


def test_jaccard_over_given_users(spark):
    a, b = _df(spark, [(1, 1), (1, 2)]), _df(spark, [(1, 2), (3, 7)])
    users = _df(spark, [(1,), (2,), (2,)], "user_id long")
    assert {r.user_id: r.jaccard for r in evaluate.jaccard_lists(a, b, users).collect()} == {1: 0.5, 2: 0.0}


def test_compare_algorithms_holds_both_lists(spark):
    a = _df(spark, [(1, 5, 2), (1, 9, 1)], "user_id long, item_id long, rank int")
    c = _df(spark, [(1, 5, 1)], "user_id long, item_id long, rank int")
    users = _df(spark, [(1,), (2,)], "user_id long")
    got = sorted(tuple(r) for r in recommend.compare_algorithms(a, c, users).collect())
    assert got == [(1, [9, 5], [5], 2, 1, 0.5), (2, [], [], 0, 0, 0.0)]
