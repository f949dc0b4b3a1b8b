"""Edge cases of SURVEY section 5.4 and the persistence round trips."""

from pyspark.sql import functions as F

from recsift.operators import clean, content, evaluate, lookup, recommend, similarity, stats

R = "user_id long, item_id long, rating double"


def test_empty_input(spark):
    empty = spark.createDataFrame([], R)
    s = stats.rating_stats(empty).first()
    assert s["count"] == 0 and s["mean"] is None
    assert stats.item_stats(empty).count() == 0
    m = evaluate.ranking_metrics(empty.select("user_id", "item_id"), empty.select("user_id", "item_id")).first()
    assert m.n_users == 0 and m.precision == 0.0 and m.f1 == 0.0


def test_one_rating_item_has_null_stddev(spark):
    df = spark.createDataFrame([(1, 1, 4.0), (2, 2, 3.0), (3, 2, 5.0)], R)
    got = {r.item_id: r.rating_stddev for r in stats.item_stats(df).collect()}
    assert got[1] is None and abs(got[2] - 2 ** 0.5) < 1e-12


def test_user_without_liked_items_gets_no_list(spark):
    sim = spark.createDataFrame([(1, 2, 0.9, 1), (2, 1, 0.9, 1)],
                                "seed_id long, item_id long, similarity double, rank int")
    ratings = spark.createDataFrame([(1, 1, 5.0), (2, 1, 2.0)], R)   # user 2 likes nothing
    recs = recommend.content_recs_liked(ratings, sim)
    assert [(r.user_id, r.item_id) for r in recs.collect()] == [(1, 2)]


def test_unknown_item_title_default(spark):
    items = spark.createDataFrame([(1, "A", ["x"])], "item_id long, title string, genres array<string>")
    ids = spark.createDataFrame([(1,), (99,)], "item_id long")
    got = {r.item_id: r.title for r in lookup.with_titles(ids, items).collect()}
    assert got == {1: "A", 99: "Movie 99"}


def test_preview_is_ordered(spark):
    df = spark.range(100).selectExpr("id AS user_id", "99 - id AS item_id")
    assert [r.item_id for r in clean.preview(df, ["item_id"]).collect()] == [0, 1, 2, 3, 4]


def test_content_model_round_trip(spark, tmp_path):
    items = spark.createDataFrame([(1, "red ring", ["toy"]), (2, "blue ring", ["toy"])],
                                  "item_id long, title string, genres array<string>")
    m = content.ContentModel.fit(items)
    m.save(str(tmp_path / "cm"))
    back = content.ContentModel.load(spark, str(tmp_path / "cm"))
    a = sorted(tuple(r) for r in m.vectors.collect())
    b = sorted(tuple(r) for r in back.vectors.select(*m.vectors.columns).collect())
    assert a == b and back.vocab.count() == m.vocab.count()
    s = similarity.similar_items(back.vectors, n=1, num_blocks=1).collect()
    assert {(r.seed_id, r.item_id) for r in s} == {(1, 2), (2, 1)}


def test_seeded_neighbours_only(spark):
    vec = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (3, "a", 1.0)], "item_id long, term string, weight double")
    got = similarity.similar_items_for(vec, spark.createDataFrame([(2,)], "item_id long"), n=5, num_blocks=2)
    assert sorted((r.seed_id, r.item_id, r.rank) for r in got.collect()) == [(2, 1, 1), (2, 3, 2)]
    assert got.where(F.col("seed_id") != 2).count() == 0


def test_recommend_content_for_one_user_equals_batch(spark):
    from tests.conftest import SF_SMALL
    from recsift.sources.tables import Tables

    t = Tables(spark, SF_SMALL)
    m = content.ContentModel.fit(t.items(), t.tags(), t.tag_scores(), t.tag_names())
    ratings = t.interactions()
    user = ratings.select("user_id").orderBy("user_id").limit(1)
    one = recommend.recommend_content_for(ratings, t.items(), m.vectors, user, n=5)
    sim = similarity.similar_items(m.vectors, n=5, n_items=m.n_items)
    batch = recommend.recommend_content(ratings, t.items(), sim, n=5).join(user, "user_id", "left_semi")
    cols = ["user_id", "item_id", "rank", "similarity"]
    assert sorted(tuple(r) for r in one.select(cols).collect()) == sorted(tuple(r) for r in batch.select(cols).collect())
    assert one.count() == 5


def test_fit_falls_back_to_simple_model(spark, tmp_path):
    items = spark.createDataFrame([(1, "red ring", ["toy"]), (2, "blue ring", ["toy"])],
                                  "item_id long, title string, genres array<string>")
    raw = spark.createDataFrame([(1, "x", "fun")], "user_id long, item_key string, tag string")
    broken_tags = raw.select("user_id", F.col("item_key").cast("bigint").alias("item_id"), "tag")  # ANSI: fails at run
    m = content.ContentModel.fit_or_simple(items, broken_tags)
    assert {r.term for r in m.vocab.collect()} == {"red", "blue", "ring", "toy"}


def test_candidates_per_seed(spark):
    sim = spark.createDataFrame([(1, 2, 0.9, 1), (1, 3, 0.8, 2), (1, 4, 0.7, 3)],
                                "seed_id long, item_id long, similarity double, rank int")
    ratings = spark.createDataFrame([(7, 1, 5.0), (7, 2, 1.0)], R)
    one = [r.item_id for r in recommend.content_recs_liked(ratings, sim, n=2, candidates_per_seed=1).collect()]
    three = sorted(r.item_id for r in recommend.content_recs_liked(ratings, sim, n=2, candidates_per_seed=3).collect())
    assert one == [] and three == [3, 4]   # the only candidate (2) was already rated
