"""Filters, lookups and per-user reports.

The reference answers one user or one title per call with driver-side
dictionaries and pandas; here each operator answers *all* users in one plan.
Lookups are left joins (Catalyst/AQE chooses broadcast when the dimension is
small at run time); nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.functions.text import contains_ci

# Fixed values from the reference: "liked" means rating >= 4.0, genome tags
# are relevant when relevance > 0.5, active users have >= 5 ratings, missing
# titles read "Movie <id>".
LIKED_MIN = 4.0
RELEVANCE_MIN = 0.5
ACTIVE_MIN = 5
TITLE_PREFIX = "Movie "


def relevant_tags(tag_scores: DataFrame, threshold: float = RELEVANCE_MIN) -> DataFrame:
    """genome scores with relevance strictly above the threshold."""
    return tag_scores.where(F.col("relevance") > threshold)


def liked_items(ratings: DataFrame, threshold: float = LIKED_MIN) -> DataFrame:
    """(user, item, rating) with rating >= threshold, for all users."""
    return ratings.where(F.col("rating") >= threshold).select("user_id", "item_id", "rating")


def active_users(ratings: DataFrame, min_ratings: int = ACTIVE_MIN) -> DataFrame:
    """users with at least ``min_ratings`` ratings."""
    return (ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ratings"))
            .where(F.col("n_ratings") >= min_ratings))


def search_titles(items: DataFrame, text: str, limit: int | None = 10, regex: bool = False) -> DataFrame:
    """Titles containing ``text`` (case-insensitive), first ``limit`` by id.

    Literal by default (the reference passed user text to a regex engine);
    ``regex=True`` keeps that behaviour.  NULL titles never match.
    """
    hits = items.where(F.col("title").isNotNull() & contains_ci(F.col("title"), text, regex))
    hits = hits.orderBy("item_id")
    return hits.limit(limit) if limit is not None else hits


def tag_lookup(tag_scores: DataFrame, tag_names: DataFrame, threshold: float = RELEVANCE_MIN) -> DataFrame:
    """Relevant genome tags with their names; unknown ids get ''.

    A left join replaces the reference's collected dictionary + Python UDF.
    """
    rel = relevant_tags(tag_scores, threshold)
    return (rel.join(tag_names, "tag_id", "left")
            .select("item_id", "tag_id", F.coalesce(F.col("tag"), F.lit("")).alias("tag")))


def with_titles(df: DataFrame, items: DataFrame, prefix: str = TITLE_PREFIX) -> DataFrame:
    """Add ``title``; a missing title reads ``prefix + id``."""
    t = items.select("item_id", F.col("title").alias("__title"))
    out = df.join(t, "item_id", "left")
    title = F.coalesce(F.col("__title"), F.concat(F.lit(prefix), F.col("item_id").cast("string")))
    return out.withColumn("title", title).drop("__title")


def with_own_rating(recs: DataFrame, ratings: DataFrame, fill: float | None = None) -> DataFrame:
    """Add the user's own rating of each recommended item (NULL if unrated)."""
    r = ratings.select("user_id", "item_id", F.col("rating").alias("user_rating"))
    out = recs.join(r, ["user_id", "item_id"], "left")
    if fill is not None:
        out = out.withColumn("user_rating", F.coalesce("user_rating", F.lit(float(fill))))
    return out


def drop_seen(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    """Remove items the user has already rated (left anti join)."""
    return candidates.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def user_top_item(ratings: DataFrame) -> DataFrame:
    """K5: each user's highest-rated item, ties to the smallest item id.

    A grouped ``max`` over a (rating, -item) struct: partial aggregation keeps
    a heavy user's rows on the map side, unlike a window that sorts them all
    in one task.
    """
    best = ratings.groupBy("user_id").agg(
        F.max(F.struct(F.col("rating"), (-F.col("item_id")).alias("neg_item"))).alias("b"))
    return best.select("user_id", (-F.col("b.neg_item")).alias("item_id"), F.col("b.rating").alias("rating"))


def user_history(ratings: DataFrame, items: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """U4 (F5 + J6 + K6): every rating with its title, by user, best first.

    ``users`` (a frame with ``user_id``) restricts the report by semi join.
    The global sort is range-partitioned on (user, rating, item), so a heavy
    user is spread over several tasks.
    """
    r = ratings if users is None else ratings.join(users.select("user_id"), "user_id", "left_semi")
    out = with_titles(r.select("user_id", "item_id", "rating", "ts"), items)
    return out.select("user_id", "item_id", "title", "rating", "ts").orderBy(
        "user_id", F.desc("rating"), "item_id")
