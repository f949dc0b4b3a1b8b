"""Profiling, imputation, splits on the `gaps` fixture (FIXTURES.md section 3)."""

import math

from recsift.operators import clean

GAPS = [
    (1, 10, 4.0, 3, None),
    (1, 10, 4.0, 3, None),          # exact duplicate
    (2, 11, None, None, None),      # NULL measure
    (3, 12, float("nan"), 5, None),  # NaN measure
    (None, 13, 2.0, 4, None),       # NULL key
]
SCHEMA = "user_id long, item_id long, rating double, n int, empty double"


def test_missing_counts_one_aggregate(spark):
    df = spark.createDataFrame(GAPS, SCHEMA)
    out = {r.column: r.missing for r in clean.missing_counts(df).collect()}
    assert out == {"user_id": 1, "item_id": 0, "rating": 2, "n": 1, "empty": 5}
    plan = clean.missing_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # partial + final of ONE aggregate


def test_duplicates(spark):
    df = spark.createDataFrame(GAPS, SCHEMA)
    r = clean.duplicate_counts(df, "gaps").first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (5, 4, 1)


def test_impute_mean_measures_only(spark):
    df = spark.createDataFrame(GAPS, SCHEMA)
    out = clean.impute_mean(df).collect()
    mean_rating = (4.0 + 4.0 + 2.0) / 3
    ratings = [r.rating for r in out]
    assert all(not math.isnan(x) for x in ratings)
    assert abs(ratings[2] - mean_rating) < 1e-12 and abs(ratings[3] - mean_rating) < 1e-12
    assert [r.n for r in out][2] == 3.75  # an int column widens: the mean is not cut
    assert [r.user_id for r in out][4] is None  # keys are never imputed
    assert all(r.empty is None for r in out)  # an all-missing column stays missing
    assert dict(clean.impute_mean(df).dtypes)["n"] == "double"


def test_impute_mean_keeps_present_values_exactly(spark):
    df = spark.sql("""SELECT * FROM VALUES (9007199254740993L, 12345678901234567.89BD, 1), (NULL, NULL, 2), (1L, 0.11BD, NULL)
                      AS t(big, dec, n)""")
    out = clean.impute_mean(df).collect()
    assert {r.big for r in out} >= {9007199254740993, 1} and all(r.big is not None for r in out)
    assert str(out[0].dec) == "12345678901234567.89" and out[1].dec is not None
    assert sorted(r.n for r in out) == [1.0, 1.5, 2.0]
    assert dict(clean.impute_mean(df).dtypes)["big"] == "bigint"


def test_drop_null_keys(spark):
    df = spark.createDataFrame(GAPS, SCHEMA)
    assert clean.drop_null_keys(df, ["user_id", "item_id"]).count() == 4


def test_hash_split_is_partition_of_rows(spark):
    from recsift.sources.tables import split_hash

    df = spark.range(0, 2000).selectExpr("id % 97 AS user_id", "id AS item_id", "1.0 AS rating")
    s = split_hash(df)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and 0.7 < counts["train"] / 2000 < 0.9
    rep = {r.split: r for r in clean.split_report(s).collect()}
    assert abs(rep["train"].pct + rep["test"].pct - 100.0) < 1e-9


def test_random_split_disjoint_and_complete(spark):
    df = spark.range(0, 500).selectExpr("id AS user_id", "id AS item_id", "1.0 AS rating")
    s = clean.split_random(df)
    assert s.count() == 500 and s.select("user_id").distinct().count() == 500


def test_feature_vector_keeps_nan(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "a int, b double, c double")
    out = clean.vector_columns(clean.feature_vector(df), "features", ["fa", "fb", "fc"]).first()
    assert out.fa == 1.0 and out.fb == 2.0 and math.isnan(out.fc)


def test_hashes_of_negative_and_large_ids(spark):
    from pyspark.sql import functions as F

    ids = [-i for i in range(1, 1001)] + [2**60 + i for i in range(500)] + [-(2**62) + i for i in range(500)]
    df = spark.createDataFrame([(u, u % 17 - 8) for u in ids], "user_id long, item_id long")
    for sample in (clean.sample_hash(df, 0.2), clean.sample_hash(df, 0.2, portable=True)):
        assert abs(sample.count() / len(ids) - 0.2) < 0.03
    assert abs(clean.sample_hash(df.where("user_id < 0"), 0.2).count() / 1500 - 0.2) < 0.02
    shares = clean.split_hash(df).groupBy("split").count().collect()
    assert {r.split for r in shares} == {"train", "test"}
    assert abs(next(r["count"] for r in shares if r.split == "train") / len(ids) - 0.8) < 0.02
    assert clean.sample_hash(df, 1.0).count() == len(ids) and clean.sample_hash(df, 0.0).count() == 0
    buckets = df.select(clean.hash_bucket("user_id", "item_id").alias("b")).agg(F.min("b"), F.max("b")).first()
    assert 0 <= buckets[0] and buckets[1] < 1000003


def test_split_per_user_is_exact_for_every_user(spark):
    rows = [(1, i, float(i % 5)) for i in range(3000)] + [(u, i, 1.0) for u in range(2, 40) for i in range(u % 9 + 1)]
    rows += [(None, 1, 2.0), (None, 2, 2.0), (-7, 3, 1.0), (-7, 3, 1.0), (-7, 3, 1.0)]  # repeated pairs, NULL user
    df = spark.createDataFrame(rows, "user_id long, item_id long, place double")
    for user_rows in (16, 100_000):
        out = clean.split_per_user(df, 0.8, user_rows=user_rows)
        assert out.columns == ["user_id", "item_id", "place", "split"]
        n = {}
        for r in out.collect():
            k = n.setdefault(r.user_id, [0, 0])
            k[0] += 1
            k[1] += r.split == "train"
        assert sum(a for a, _ in n.values()) == len(rows)
        assert all(b == int(0.8 * a + 0.5) for a, b in n.values()), n
    sides = [{tuple(r) for r in clean.split_per_user(df.repartition(p)).where("user_id = 1").collect()} for p in (2, 7)]
    assert sides[0] == sides[1]
    assert clean.split_per_user(df.limit(0)).count() == 0


def test_duplicates_by_digest_are_exact(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), ("a", None, float("nan")), ("a", None, float("nan")),
            *[("x", "y", 1.0)] * 50, *[(str(i), "z", float(i)) for i in range(100)]]
    df = spark.createDataFrame(rows, "p string, q string, v double")
    r = clean.duplicate_counts(df, "t").first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (155, df.distinct().count(), 155 - df.distinct().count())
    # Digests that collide change nothing.
    monkeypatch.setattr(clean, "_digest", lambda d: F.struct(F.lit(1).cast("long").alias("a"), F.length("q").cast("long").alias("b")))
    assert tuple(clean.duplicate_counts(df, "t").first()) == tuple(r)
    empty = clean.duplicate_counts(df.limit(0), "t").first()
    assert (empty.n_rows, empty.n_distinct, empty.n_duplicates) == (0, 0, 0)


def test_random_split_sorts_nothing_and_keeps_every_row(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS user_id", "id AS item_id")
    out = clean.split_random(df, (0.8, 0.2), seed=1)
    assert "Sort" not in out._jdf.queryExecution().toString()
    for _ in range(2):  # the sides are fixed, for each reader
        train, test = (out.where(f"split = '{s}'").select("item_id") for s in ("train", "test"))
        assert train.intersect(test).count() == 0 and train.union(test).distinct().count() == 20_000
    assert 0.78 < train.count() / 20_000 < 0.82
    assert clean.split_random(df, (0.8, 0.2), seed=1).exceptAll(out).count() == 0
