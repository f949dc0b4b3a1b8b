"""Regression and ranking metrics shared by both recommenders.

Inputs are generic tables: ``predictions(user_id, item_id, rating,
prediction)``, recommendation lists ``recs(user_id, item_id, ...)`` and
``relevant(user_id, item_id)``.  Each metric is one aggregate (or a couple of
joins on (user, item) followed by aggregates); nothing loops over users on
the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.functions.metrics import harmonic_mean, safe_ratio
from recsift.operators.lookup import ACTIVE_MIN, LIKED_MIN
from recsift.session import cut_lineage


# ---------------------------------------------------------------- regression

def item_mean_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Baseline predictor: the item's mean train rating; unseen items dropped."""
    means = train.groupBy("item_id").agg(F.avg("rating").alias("prediction"))
    return test.select("user_id", "item_id", "rating").join(means, "item_id")


def regression_metrics(pred: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """N, RMSE, MAE, R² (1 - SSE/SST) in one aggregate."""
    err = F.col(label) - F.col(prediction)
    agg = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
                   F.sum(err * err).alias("sse"), F.var_pop(label).alias("vp"))
    return agg.select("n", F.sqrt("mse").alias("rmse"), "mae",
                      (F.lit(1.0) - safe_ratio(F.col("sse"), F.col("vp") * F.col("n"), default=float("nan")))
                      .alias("r2"))


def content_predictions(train: DataFrame, test: DataFrame, similar: DataFrame) -> DataFrame:
    """Similarity-weighted mean of the user's train ratings of the test
    item's neighbours (item-based kNN over the content neighbour table).

    test (u, i) x neighbours of i -> the user's train rating of each
    neighbour j -> sum(sim * r) / sum(sim).  Rows per test pair are bounded by
    the neighbour count; pairs without a rated neighbour get no prediction.
    """
    nb = similar.select(F.col("seed_id").alias("item_id"), F.col("item_id").alias("nb_id"), "similarity")
    tr = train.select("user_id", F.col("item_id").alias("nb_id"), F.col("rating").alias("nb_rating"))
    joined = test.select("user_id", "item_id", "rating").join(nb, "item_id").join(tr, ["user_id", "nb_id"])
    return (joined.groupBy("user_id", "item_id", "rating")
            .agg((F.sum(F.col("similarity") * F.col("nb_rating")) / F.sum("similarity")).alias("prediction")))


def residual_histogram(pred: DataFrame, bins: int = 50, digits: int = 9) -> DataFrame:
    """Residual (rating - prediction) counts in ``bins`` equal bins, min..max.

    The range is fitted first (one small aggregate to the driver); the last
    bin is closed on the right, as in the usual histogram convention.
    """
    res = F.round(F.col("rating") - F.col("prediction"), digits)
    r = pred.select(res.alias("res"))
    lo, hi = r.agg(F.min("res"), F.max("res")).first()
    if lo is None:
        return r.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("res") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = r.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "n")


def prediction_grid(pred: DataFrame, step: float = 0.5) -> DataFrame:
    """(rating, prediction bin lower edge) -> count, the data of a scatter plot."""
    pbin = F.floor(F.col("prediction") / F.lit(step)) * F.lit(step)
    return pred.groupBy("rating", pbin.alias("prediction_bin")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- ranking

def ranking_metrics(recs: DataFrame, relevant: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Macro precision (hits / list length), recall (hits / relevant),
    and F1 of the two averages, over users with a non-empty list and at least
    one relevant item (and in ``users`` when given).

    One full outer join of the two (user, item) sets and one per-user
    aggregate give list length, relevant count and hits together.
    """
    r = recs.select("user_id", "item_id").distinct().withColumn("__rec", F.lit(1))
    rel = relevant.select("user_id", "item_id").distinct().withColumn("__rel", F.lit(1))
    both = r.join(rel, ["user_id", "item_id"], "full")
    per_user = both.groupBy("user_id").agg(
        F.count_if(F.col("__rec").isNotNull()).alias("n_rec"),
        F.count_if(F.col("__rel").isNotNull()).alias("n_rel"),
        F.count_if(F.col("__rec").isNotNull() & F.col("__rel").isNotNull()).alias("hits"))
    per_user = per_user.where((F.col("n_rec") > 0) & (F.col("n_rel") > 0))
    if users is not None:
        per_user = per_user.join(users.select("user_id"), "user_id", "left_semi")
    per_user = per_user.select("user_id", (F.col("hits") / F.col("n_rec")).alias("p"),
                               (F.col("hits") / F.col("n_rel")).alias("r"))
    m = per_user.agg(F.count(F.lit(1)).alias("n_users"), F.coalesce(F.avg("p"), F.lit(0.0)).alias("precision"),
                     F.coalesce(F.avg("r"), F.lit(0.0)).alias("recall"))
    return m.select("n_users", "precision", "recall", harmonic_mean(F.col("precision"), F.col("recall")).alias("f1"))


def eligible_from_split(split: DataFrame, min_ratings: int = ACTIVE_MIN) -> DataFrame:
    """F6/F9 in one pass over a split table: users with >= min_ratings ratings,
    at least one train and at least one test rating."""
    per_user = split.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"))
    return per_user.where((F.col("n") >= min_ratings) & (F.col("n_train") > 0) & (F.col("n_test") > 0)).select(
        "user_id")


def relevant_items(test: DataFrame, threshold: float = LIKED_MIN) -> DataFrame:
    return test.where(F.col("rating") >= threshold).select("user_id", "item_id")


def jaccard_lists(a: DataFrame, b: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Per user |A ∩ B| / |A ∪ B| of two lists.

    A full outer join on (user, item) instead of collected sets, so no user's
    list is gathered into one array.  With ``users`` (``user_id``) exactly these
    users are returned, 0.0 for one whose lists are both empty; without it, the
    users with a list.
    """
    x = a.select("user_id", "item_id").distinct().withColumn("__a", F.lit(1))
    y = b.select("user_id", "item_id").distinct().withColumn("__b", F.lit(1))
    both = x.join(y, ["user_id", "item_id"], "full")
    out = both.groupBy("user_id").agg(
        safe_ratio(F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()), F.count(F.lit(1)))
        .alias("jaccard"))
    if users is None:
        return out
    return users.select("user_id").distinct().join(out, "user_id", "left").select(
        "user_id", F.coalesce("jaccard", F.lit(0.0)).alias("jaccard"))


def coverage(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct recommended items / catalogue size."""
    rec = recs.agg(F.count_distinct("item_id").alias("n_recommended"))
    cat = items.agg(F.count_distinct("item_id").alias("n_catalogue"))
    return rec.unionByName(cat, allowMissingColumns=True).agg(
        F.max("n_recommended").alias("n_recommended"), F.max("n_catalogue").alias("n_catalogue")).select(
        "n_recommended", "n_catalogue", safe_ratio(F.col("n_recommended"), F.col("n_catalogue")).alias("coverage"))


def diversity(recs: DataFrame, vectors: DataFrame) -> DataFrame:
    """1 - mean pairwise cosine within a list, averaged over users (lists of >= 2).

    With unit vectors, the sum of cosines over ordered pairs i != j equals
    ||sum v||^2 - sum ||v||^2, so the per-list mean needs one sum per
    (user, term) and no pair rows.  Items without a vector count as zero
    vectors (cosine 0 with everything).
    """
    lists = recs.select("user_id", "item_id").distinct()
    k = lists.groupBy("user_id").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= 2)
    v = lists.join(vectors.select("item_id", "term", "weight"), "item_id")
    sum_vec = v.groupBy("user_id", "term").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") ** 2).alias("q"))
    per_user = sum_vec.groupBy("user_id").agg((F.sum(F.col("s") ** 2) - F.sum("q")).alias("pair_sum"))
    d = (k.join(per_user, "user_id", "left")
         .select("user_id", (F.lit(1.0) - F.coalesce("pair_sum", F.lit(0.0)) / (F.col("k") * (F.col("k") - 1)))
                 .alias("diversity")))
    return d.agg(F.count(F.lit(1)).alias("n_users"), F.avg("diversity").alias("diversity"))


def novelty(recs: DataFrame, ratings: DataFrame, smoothing: bool = False) -> DataFrame:
    """Mean over users of the mean self-information -log2(popularity) of
    their recommended items; popularity = raters / users.

    An item that nobody rated has no popularity and is left out of the user's
    mean; a user with such items only is left out of ``n_users``.  ``smoothing``
    takes (raters + 1) / (users + 1) instead, which counts every item.
    """
    raters = ratings.groupBy("item_id").agg(F.count_distinct("user_id").alias("raters"))
    n_users = ratings.agg(F.count_distinct("user_id").alias("u")).first()["u"]
    r = recs.select("user_id", "item_id").join(raters, "item_id", "left")
    if smoothing:
        info = -F.log2((F.coalesce("raters", F.lit(0)) + F.lit(1.0)) / F.lit(float(n_users + 1)))
    else:
        info = -F.log2(F.col("raters") / F.lit(float(n_users)))
    per_user = r.groupBy("user_id").agg(F.avg(info).alias("nov"))
    return per_user.agg(F.count("nov").alias("n_users"), F.avg("nov").alias("novelty"))


def metrics_long(algorithm: str, wide: DataFrame, names: list[str]) -> DataFrame:
    """One-row metric frame -> metrics(algorithm, metric, value)."""
    cols = [F.col(n).cast("double").alias(n) for n in names]
    return (wide.select(*cols).unpivot([], names, "metric", "value")
            .select(F.lit(algorithm).alias("algorithm"), "metric", "value"))


def metric_report(algorithm: str, recs: DataFrame, predictions: DataFrame, test: DataFrame, users: DataFrame,
                  items: DataFrame, vectors: DataFrame, ratings: DataFrame) -> DataFrame:
    """The eight metrics of one recommender as (algorithm, metric, value).

    ``recs`` are the lists of ``users`` from the train side, ``predictions`` those of the
    ``test`` ratings.  Four metrics read the lists, so they are written once.
    """
    recs = cut_lineage(recs.select("user_id", "item_id"))
    parts = [(regression_metrics(predictions), ["rmse", "mae"]),
             (ranking_metrics(recs, relevant_items(test), users), ["precision", "recall", "f1"]),
             (coverage(recs, items), ["coverage"]), (diversity(recs, vectors), ["diversity"]),
             (novelty(recs, ratings), ["novelty"])]
    return reduce(DataFrame.unionByName, [metrics_long(algorithm, df, names) for df, names in parts])


def evaluate_content(ratings: DataFrame, similar: DataFrame, n: int = 10, split: DataFrame | None = None,
                     users: DataFrame | None = None) -> DataFrame:
    """E4-E6 for the content recommender in one call, for all eligible users.

    ``split`` is (user_id, item_id, rating, split) with 'train'/'test'
    (default: the portable per-(user, item) hash split).  Lists come from the
    user's train ratings (liked seeds, rated items removed); relevant items are
    the user's test ratings >= 4.  ``users`` optionally restricts the users.
    """
    from recsift.operators.recommend import content_recs_liked
    from recsift.sources.tables import split_hash

    s = split if split is not None else split_hash(ratings.select("user_id", "item_id", "rating"))
    train = s.where(F.col("split") == "train").select("user_id", "item_id", "rating")
    test = s.where(F.col("split") == "test").select("user_id", "item_id", "rating")
    elig = eligible_from_split(s)
    if users is not None:
        elig = elig.join(users.select("user_id"), "user_id", "left_semi")
    recs = content_recs_liked(train, similar, n=n)
    return ranking_metrics(recs, relevant_items(test), elig)
