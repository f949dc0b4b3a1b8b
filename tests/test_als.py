"""ALS on the `low_rank` fixture: recovery, factor consistency, persistence."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.operators import als


@pytest.fixture(scope="module")
def low_rank(spark):
    rng = np.random.default_rng(3)
    U = rng.random((40, 2)) + 0.2
    V = rng.random((30, 2)) + 0.2
    R = U @ V.T
    rows = [(u, i, float(R[u, i]), bool(rng.random() < 0.8)) for u in range(40) for i in range(30)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, observed boolean")
    return df.where("observed").drop("observed"), df.where("NOT observed").drop("observed")


def test_recovers_low_rank(low_rank):
    train, test = low_rank
    model = als.fit_als(train, rank=2, max_iter=15, reg_param=0.001)
    pred = als.predict(model, test)
    rmse = pred.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    assert rmse < 0.1
    gap = als.factor_check(model, test).first()
    assert gap.max_gap < 1e-5


def test_recommendations_and_seen(low_rank):
    train, _ = low_rank
    model = als.fit_als(train, rank=2, max_iter=5)
    allr = als.recommend_all(model, n=5)
    assert allr.groupBy("user_id").count().where("count > 5").count() == 0
    users = train.select("user_id").distinct().limit(3)
    recs = als.recommend_for(model, users, n=5, seen=train)
    assert recs.join(train, ["user_id", "item_id"]).count() == 0
    assert recs.groupBy("user_id").count().where("count != 5").count() == 0


def test_ids_out_of_range_raise_and_negative_ones_stay(spark):
    schema = "user_id long, item_id long, rating double"
    df = spark.createDataFrame([(1, 2, 3.0), (-5, 2, 3.0), (None, 1, 1.0), (7, 2, None)], schema)
    assert {r.user_id for r in als.to_als_ids(df).collect()} == {1, -5}
    assert {r.user_id for r in als.to_als_pairs(df.drop("rating")).collect()} == {1, -5, 7}
    with pytest.raises(Exception, match="does not fit"):
        als.to_als_ids(spark.createDataFrame([(3 * 10**9, 2, 3.0)], schema)).collect()


def test_predict_needs_no_rating(low_rank):
    train, test = low_rank
    model = als.fit_als(train, rank=2, max_iter=3)
    want = {(r.user_id, r.item_id): r.prediction for r in als.predict(model, test).collect()}
    got = {(r.user_id, r.item_id): r.prediction for r in als.predict(model, test.drop("rating")).collect()}
    assert got == want


def test_save_load_round_trip(low_rank, tmp_path):
    train, test = low_rank
    model = als.fit_als(train, rank=2, max_iter=3)
    als.save_model(model, str(tmp_path / "m"))
    back = als.load_model(str(tmp_path / "m"))
    a = {(r.user_id, r.item_id): r.prediction for r in als.predict(model, test).collect()}
    b = {(r.user_id, r.item_id): r.prediction for r in als.predict(back, test).collect()}
    assert a == b and back.rank == 2


def test_cross_validation_report(low_rank):
    train, _ = low_rank
    best, report = als.cross_validate(train, {"rank": [2], "maxIter": [3], "regParam": [0.01, 0.1]}, folds=2)
    rows = report.collect()
    assert len(rows) == 2 and sum(r.is_best for r in rows) == 1
    assert best.rank == 2


def test_exclude_seen_is_exact_for_heavy_users(spark, low_rank):
    train, _ = low_rank
    model = als.fit_als(train, rank=2, max_iter=5)
    users = train.select("user_id").distinct()
    fast = als.recommend_for(model, users, n=3, seen=train, first_k=4)     # forces extra rounds
    full = als.recommend_for(model, users, n=3, seen=train, first_k=10_000)  # one round, all items
    a = sorted((r.user_id, r.item_id, r.rank) for r in fast.collect())
    b = sorted((r.user_id, r.item_id, r.rank) for r in full.collect())
    assert a == b
    unseen = {r.user_id: 30 - r["count"] for r in train.groupBy("user_id").count().collect()}
    per_user = {}
    for u, _, _ in a:
        per_user[u] = per_user.get(u, 0) + 1
    assert per_user == {u: min(3, k) for u, k in unseen.items() if k > 0}


def test_train_with_cross_validation(low_rank):
    train, test = low_rank
    best, report, metrics = als.train_with_cross_validation(
        train.unionByName(test), {"rank": [2], "maxIter": [5], "regParam": [0.01]}, folds=2)
    m = metrics.first()
    assert report.count() == 1 and m.n > 0 and m.rmse < 0.5


BIG = {0: 3 * 10**9, 1: -5, 2: 2**60, 3: -(2**62)}


def test_ids_beyond_int_train_predict_recommend_and_survive_saving(spark, low_rank, tmp_path):
    train, test = low_rank
    user = F.create_map(*[F.lit(x) for kv in BIG.items() for x in kv])

    def big(df):
        return df.withColumn("user_id", F.coalesce(user[F.col("user_id")], F.col("user_id"))).withColumn(
            "item_id", F.when(F.col("item_id") < 5, F.col("item_id") - 2**61).otherwise(F.col("item_id")))

    model = als.fit_als(big(train), rank=2, max_iter=15, reg_param=0.001)
    assert model.users.count() == 40 and model.users.agg(F.max("user_idx")).first()[0] == 39
    pred = als.predict(model, big(test))
    assert pred.count() == test.count()  # every pair is scored
    assert pred.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0] < 0.1
    users = spark.createDataFrame([(v,) for v in BIG.values()], "user_id long")
    recs = als.recommend_for(model, users, n=3, seen=big(train))
    assert {r.user_id for r in recs.collect()} == set(BIG.values())
    assert recs.join(big(train), ["user_id", "item_id"]).count() == 0
    assert als.factor_check(model, big(test)).first().max_gap < 1e-5
    als.save_model(model, str(tmp_path / "big"))
    back = als.load_model(str(tmp_path / "big"))
    assert sorted(als.predict(back, big(test)).collect()) == sorted(pred.collect())
    # Saved over by a model without mapping tables: they are no longer used.
    als.save_model(als.fit_als(train, rank=2, max_iter=2), str(tmp_path / "big"))
    assert als.load_model(str(tmp_path / "big")).users is None


def test_too_many_ids_raise(spark, monkeypatch):
    from recsift.operators import numbering

    monkeypatch.setattr(numbering, "MAX_DENSE", 3)
    train = spark.createDataFrame([(2**40 + i, i % 2, 1.0) for i in range(4)], "user_id long, item_id long, rating double")
    with pytest.raises(ValueError, match="more than INT"):
        als.fit_als(train, rank=1, max_iter=1)


def test_lists_equal_spark_ml_and_skip_bands(spark, low_rank):
    train, _ = low_rank
    model = als.fit_als(train, rank=2, max_iter=5)
    want = {(r.user_id, x.item_idx): x.rating for r in model.model.recommendForAllUsers(4).withColumnRenamed(
        "user_idx", "user_id").collect() for x in r.recommendations}
    for chapter in (3, 7, 65536):
        got = {(r.user_id, r.item_id): r.score for r in als.recommend_for(
            model, train.select("user_id"), n=4, first_k=chapter).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-5 for k in got)


def test_norm_bands_against_brute_force(spark):
    from recsift.operators import retrieval

    rng = np.random.default_rng(5)
    scale = 10.0 ** -rng.integers(0, 6, 400)  # norms fall fast: most items are never scored
    items = (rng.integers(-3, 4, (400, 4)) * scale[:, None]).astype(np.float32)
    queries = np.vstack([rng.integers(-3, 4, (70, 4)), np.zeros((2, 4))]).astype(np.float32)
    seen = {(0, i) for i in range(398)} | {(q, int(i)) for q in range(1, 72) for i in rng.choice(400, 30)}
    want = set()
    for q in range(72):
        scores = [(-round(float(s), 9) + 0.0, i) for i, s in enumerate(items.astype(float) @ queries[q].astype(float)) if (q, i) not in seen]
        want |= {(q, i, k + 1) for k, (_, i) in enumerate(sorted(scores)[:5])}
    df = lambda m, name: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{name} long, vec array<float>")
    pairs = spark.createDataFrame([*seen, (0, 3), (900, 1), (5, 900)], "query_id long, item_id long")  # repeats and unknown ids
    for chapter in (50, 65536):
        got = retrieval.top_n(df(queries, "query_id"), df(items, "item_id"), 5, seen=pairs, chapter=chapter).collect()
        assert {(r.query_id, r.item_id, r["rank"]) for r in got} == want
    norms = np.linalg.norm(items, axis=1)
    by = np.lexsort((np.arange(400), -norms))
    scored = [0]
    monkey, retrieval.BAND = retrieval.BAND, 16
    try:
        retrieval.search_tile(queries[:70].astype(float), np.linalg.norm(queries[:70], axis=1), items[by].astype(float), norms[by], by,
                              (np.empty(0, int), np.empty(0, int)), (np.empty(0, int), np.empty(0, int), np.empty(0)), 5, scored)
    finally:
        retrieval.BAND = monkey
    assert scored[0] < 0.6 * 70 * 400
    assert retrieval.top_n(df(queries[:0], "query_id"), df(items, "item_id"), 5).count() == 0
    assert retrieval.top_n(df(queries, "query_id"), df(items[:0], "item_id"), 5).count() == 0


def test_grid_experiment_resumes(spark, low_rank, tmp_path):
    train, _ = low_rank
    grid = {"rank": [1, 2], "maxIter": [2], "regParam": [0.1]}
    path, fits = str(tmp_path / "grid"), []
    first = als.grid_experiment(train, grid, folds=2, path=path, on_fit=fits.append).collect()
    assert len(fits) == 4 and len(first) == 2
    # Two results are lost: only those are fitted again, and the report is the same.
    spark.createDataFrame([], als.FOLD_SCHEMA).write.mode("overwrite").parquet(f"{path}/rank_1-maxIter_2-regParam_0.1-fold_0")
    spark.createDataFrame([], als.FOLD_SCHEMA).write.mode("overwrite").parquet(f"{path}/rank_2-maxIter_2-regParam_0.1-fold_1")
    again = als.grid_experiment(train, grid, folds=2, path=path, parallelism=2, on_fit=fits.append).collect()
    assert sorted(fits[4:]) == [(1, 2, 0.1, 0), (2, 2, 0.1, 1)]
    assert [(r["rank"], round(r.avg_rmse, 5), r.is_best) for r in again] == [(r["rank"], round(r.avg_rmse, 5), r.is_best) for r in first]
    # Every rating is in exactly one fold.
    assert sum(als._finished(spark, path)[(2, 2, 0.1, f)][0] for f in range(2)) <= train.count()


def test_reach_bounds_and_unusable_vectors(spark):
    from recsift.operators import retrieval

    # Long items that point away from all queries: norms alone would score every one of them.
    rng = np.random.default_rng(6)
    queries = np.column_stack([10 + rng.random(40), rng.random((40, 2)) / 10])
    items = np.vstack([np.column_stack([5 + rng.random(200), rng.random((200, 2))]),
                       np.column_stack([rng.random(400), 50 + rng.random((400, 2))])])
    along = queries.mean(axis=0) / np.linalg.norm(queries.mean(axis=0))

    def split(m):
        return m @ along, np.linalg.norm(m - np.outer(m @ along, along), axis=1)

    bounds = retrieval.reaches(*split(queries), retrieval._support(*split(items), 1))
    scores = queries @ items.T
    assert (bounds >= scores).all()
    fifth = np.sort(scores, axis=1)[:, -5]
    assert (bounds >= fifth[:, None]).mean() < 0.2
    # A vector that holds NaN or NULL hides no other item of its band, and no query.
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(items)] + [(1000 + i, [float("nan")] * 3) for i in range(7)]
    rows += [(2000, [1.0, None, 1.0]), (2001, None)]
    top = int(np.argmax(scores[0]))
    rows[top] = (None, rows[top][1])  # an item without an id counts like any other
    got = retrieval.top_n(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)],
                                                "query_id long, vec array<double>"),
                          spark.createDataFrame(rows, "item_id long, vec array<double>"), 5, chapter=100)
    single = queries.astype(np.float32).astype(float) @ items.astype(np.float32).astype(float).T
    want = {(q, int(i), k + 1) for q in range(40) for k, i in enumerate(np.lexsort((np.arange(600), -np.round(single[q], 9)))[:5])}
    assert {(r.query_id, top if r.item_id is None else r.item_id, r["rank"]) for r in got.collect()} == want
