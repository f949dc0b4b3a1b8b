"""Descriptive statistics over ratings, items, users and genres.

All are single grouped aggregates (map-side partial aggregation, one shuffle
on the grouping key).  Genres are exploded on the small item side *before*
the join, and ratings are pre-aggregated per item first, so the join with
ratings carries one row per (item, genre) instead of one per rating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.functions.metrics import percent, two_digits


def rating_stats(ratings: DataFrame) -> DataFrame:
    """A1: count, mean, sample stddev, min, max of all ratings."""
    return ratings.agg(F.count("rating").alias("count"), F.avg("rating").alias("mean"),
                       F.stddev("rating").alias("stddev"), F.min("rating").alias("min"),
                       F.max("rating").alias("max"))


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """A2: rating value -> number of ratings, ascending by value."""
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count")).orderBy("rating")


def rating_distribution_text(ratings: DataFrame) -> DataFrame:
    """A2 for readers (X11): (rating, n_ratings, share), the first and last as text with two digits.

    One aggregate by rating; the shares are a window over its few rows (rating values).
    """
    counts = ratings.where(F.col("rating").isNotNull()).groupBy("rating").agg(F.count(F.lit(1)).alias("n_ratings"))
    total = F.sum("n_ratings").over(Window.partitionBy(F.lit(1)))
    return counts.select(two_digits(F.col("rating")).alias("rating"), "n_ratings", percent(F.col("n_ratings"), total).alias("share"))


def _per_key(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.count("rating").alias("rating_count"),
                                    F.avg("rating").alias("rating_mean"),
                                    F.stddev("rating").alias("rating_stddev"))


def item_stats(ratings: DataFrame) -> DataFrame:
    """A3: per item count, mean, stddev (stddev of one rating is NULL)."""
    return _per_key(ratings, "item_id")


def user_stats(ratings: DataFrame) -> DataFrame:
    """A4: per user count, mean, stddev."""
    return _per_key(ratings, "user_id")


def genre_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """A5: rating_count, avg_rating, item_count per genre, most rated first.

    ``item_count`` counts distinct rated items of the genre (the reference's
    ``movie_count`` repeated the rating count).  Ratings are summed per item
    first; the average is recombined from sums, so it is exact.
    """
    per_item = ratings.groupBy("item_id").agg(F.count("rating").alias("n"), F.sum("rating").alias("s"))
    genres = items.select("item_id", F.explode("genres").alias("genre"))
    return (genres.join(per_item, "item_id")
            .groupBy("genre")
            .agg(F.sum("n").alias("rating_count"),
                 (F.sum("s") / F.sum("n")).alias("avg_rating"),
                 F.count_distinct("item_id").alias("item_count"))
            .orderBy(F.desc("rating_count"), "genre"))


def popular_genres(ratings: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most rated genres (a top-k report: the limit is the feature)."""
    return genre_stats(ratings, items).limit(n)


def top_rated_items(ratings: DataFrame, items: DataFrame, n: int | None = 10,
                    min_ratings: int = 100, order: str = "count") -> DataFrame:
    """A7 (order="count") / A8 (order="mean", n=None).

    count/avg/stddev per item, HAVING count >= min_ratings, joined to items,
    ordered by (count desc, avg desc) or (avg desc); item_id breaks ties.
    The HAVING filter runs before the join, so only qualifying items meet the
    item table.
    """
    stats = (ratings.groupBy("item_id")
             .agg(F.count("rating").alias("rating_count"), F.avg("rating").alias("avg_rating"),
                  F.stddev("rating").alias("rating_stddev"))
             .where(F.col("rating_count") >= min_ratings))
    out = stats.join(items, "item_id").select("item_id", "title", "genres", "rating_count",
                                              "avg_rating", "rating_stddev")
    if order == "count":
        out = out.orderBy(F.desc("rating_count"), F.desc("avg_rating"), "item_id")
    elif order == "mean":
        out = out.orderBy(F.desc("avg_rating"), "item_id")
    else:
        raise ValueError(f"unknown order {order!r}")
    return out.limit(n) if n is not None else out


def item_tag_text(tags: DataFrame) -> DataFrame:
    """All tags of an item joined by blanks (duplicates kept).

    Tags are counted per (item, tag) first, so the per-item collect holds one
    entry per distinct tag, not one per tag row; each tag is then repeated by
    its count.  Sorted for a deterministic text (order is irrelevant to the
    bag-of-words model).
    """
    counted = (tags.where(F.col("tag").isNotNull())
               .groupBy("item_id", "tag").agg(F.count(F.lit(1)).alias("n")))
    per_item = counted.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("tag", "n"))).alias("ts"))
    text = F.array_join(F.flatten(F.transform("ts", lambda s: F.array_repeat(s["tag"], s["n"].cast("int")))), " ")
    return per_item.select("item_id", text.alias("tag_text"))


def dataset_summary(ratings: DataFrame) -> DataFrame:
    """A10: total ratings, distinct users, distinct items (exact)."""
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                       F.count_distinct("user_id").alias("n_users"),
                       F.count_distinct("item_id").alias("n_items"))


SKETCH_BITS = 12  # 2^12 registers: a standard error of 1.6 %, at most about 4 KB


def distinct_sketches(ratings: DataFrame, keys: tuple[str, ...] = (), columns: tuple[str, ...] = ("user_id", "item_id"),
                      bits: int = SKETCH_BITS) -> DataFrame:
    """A10 as mergeable sketches: (keys..., n_rows, one sketch per column) of one batch.

    Store one such table per batch; ``merge_sketches`` unites them, so distinct counts of any
    set of batches need no second look at the rows.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.hll_sketch_agg(c, bits).alias(c) for c in columns]]
    return ratings.groupBy(*keys).agg(*aggs) if keys else ratings.agg(*aggs)


def merge_sketches(sketches: DataFrame, keys: tuple[str, ...] = (),
                   columns: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    """Sketches of several batches united per key (or over all keys, with fewer ``keys``)."""
    aggs = [F.sum("n_rows").alias("n_rows"), *[F.hll_union_agg(c).alias(c) for c in columns]]
    return sketches.groupBy(*keys).agg(*aggs) if keys else sketches.agg(*aggs)


def sketch_counts(sketches: DataFrame, columns: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    """The estimated distinct counts of sketches, under the names ``n_<column>``."""
    rest = [c for c in sketches.columns if c not in columns]
    return sketches.select(*rest, *[F.hll_sketch_estimate(c).alias(f"n_{c}") for c in columns])


def sample_users(ratings: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` distinct users by id (a sample report)."""
    return ratings.select("user_id").distinct().orderBy("user_id").limit(n)

