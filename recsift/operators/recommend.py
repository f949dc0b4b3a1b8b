"""Recommendation lists for all users in one job.

Lists are long tables ``(user_id, item_id, similarity|score, rank)``; a
per-user top n is a ``row_number`` window, which Spark plans with a partial
group limit before the shuffle, so a heavy user's candidates are cut on the
map side; what comes from liked items is cut in blocks of users before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.operators import userblocks
from recsift.operators.lookup import LIKED_MIN, user_top_item


def top_n_per(df: DataFrame, key: str, score: str, n: int, tie: str = "item_id") -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def content_recs_liked(ratings: DataFrame, similar: DataFrame, n: int = 10,
                       liked_min: float = LIKED_MIN, candidates_per_seed: int | None = None,
                       heavy: int = userblocks.HEAVY) -> DataFrame:
    """Items similar to what each user liked, minus what they rated, top n.

    liked (rating >= 4) x the seed's neighbours, as lists -> in blocks of users
    (``userblocks``) the best similarity per item that the user has not rated, n of
    them -> top n per user, also where a heavy user's items came in parts.
    As in the reference, each seed contributes its n neighbours *before*
    rated items are removed, so a list may hold fewer than n items;
    ``candidates_per_seed`` (<= the neighbour table's depth) changes how many
    neighbours each seed contributes.
    """
    per_seed = candidates_per_seed if candidates_per_seed is not None else n
    liked = ratings.where(F.col("rating") >= liked_min).select("user_id", F.col("item_id").alias("seed_id"))
    nb = userblocks.neighbour_lists(similar.where(F.col("rank") <= per_seed))
    lists = liked.join(nb, "seed_id").select("user_id", "ids", "sims")
    user = ratings.schema["user_id"].dataType.simpleString()
    found = userblocks.meet(lists, ratings.select("user_id", "item_id"), userblocks.best_unseen(n),
                            f"user_id {user}, item_id long, similarity double", heavy)
    return top_n_per(found, "user_id", "similarity", n)


def content_recs_top_item(ratings: DataFrame, similar: DataFrame, n: int = 10) -> DataFrame:
    """The n items most similar to each user's top-rated item (rated items kept)."""
    top = user_top_item(ratings).select("user_id", F.col("item_id").alias("seed_id"))
    return (top.join(similar.where(F.col("rank") <= n), "seed_id")
            .select("user_id", "seed_id", "item_id", "similarity", "rank"))


def recommend_content(ratings: DataFrame, items: DataFrame, similar: DataFrame, n: int = 10,
                      own_rating_fill: float | None = None) -> DataFrame:
    """U1 (content): top-item neighbours with title and the user's own rating.

    The own rating is NULL when the user has not rated the item (the
    reference meant to show it but always sent 0); ``own_rating_fill=0``
    reproduces the 0 default.
    """
    from recsift.operators.lookup import with_own_rating, with_titles

    recs = content_recs_top_item(ratings, similar, n).select("user_id", "item_id", "similarity", "rank")
    recs = with_own_rating(recs, ratings, own_rating_fill)
    return with_titles(recs, items).select("user_id", "item_id", "title", "similarity", "rank", "user_rating")


def recommend_als(model, ratings: DataFrame, items: DataFrame, n: int = 10,
                  users: DataFrame | None = None) -> DataFrame:
    """U1 (ALS): ALS top n (rated items not removed, as served) with titles and own rating."""
    from recsift.operators.als import recommend_all, recommend_for
    from recsift.operators.lookup import with_own_rating, with_titles

    recs = recommend_all(model, n) if users is None else recommend_for(model, users, n)
    recs = with_own_rating(recs, ratings)
    return with_titles(recs, items).select("user_id", "item_id", "title", "score", "rank", "user_rating")


def recommend(algorithm: str, **kw) -> DataFrame:
    """U1 dispatcher; the name must be 'als' or 'content_based' (others raise)."""
    if algorithm == "als":
        return recommend_als(**kw)
    if algorithm in ("content_based", "content-based"):
        return recommend_content(**kw)
    raise ValueError(f"unknown algorithm {algorithm!r}; expected 'als' or 'content_based'")


def compare_algorithms(als_recs: DataFrame, content_recs: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Per user, both lists in rank order, their sizes and their Jaccard similarity.

    A user's arrays hold as many items as the lists' n.  ``users``: see ``jaccard_lists``.
    """
    from recsift.operators.evaluate import jaccard_lists

    def ranked(recs: DataFrame, name: str) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct("rank", "item_id")))
        return recs.groupBy("user_id").agg(F.transform(rows, lambda x: x["item_id"]).alias(name))

    none = F.array().cast("array<bigint>")
    out = jaccard_lists(als_recs, content_recs, users)
    for recs, name in ((als_recs, "als_items"), (content_recs, "content_items")):
        out = out.join(ranked(recs, name), "user_id", "left").withColumn(name, F.coalesce(name, none))
    return out.select("user_id", "als_items", "content_items", F.size("als_items").alias("n_als"),
                      F.size("content_items").alias("n_content"), "jaccard")


def recommend_content_for(ratings: DataFrame, items: DataFrame, vectors: DataFrame, users: DataFrame,
                          n: int = 10, own_rating_fill: float | None = None) -> DataFrame:
    """U1 (content) for chosen users, as the reference serves one user per call.

    Only the chosen users' top items are scored (seeded similarity), so the
    job costs |users| x catalogue, not a catalogue self-similarity.
    """
    from recsift.operators.lookup import with_own_rating, with_titles
    from recsift.operators.similarity import similar_items_for

    r = ratings.join(users.select("user_id").distinct(), "user_id", "left_semi")
    top = user_top_item(r).select("user_id", F.col("item_id").alias("seed_id"))
    sim = similar_items_for(vectors, top.select(F.col("seed_id").alias("item_id")), n)
    recs = top.join(sim, "seed_id").select("user_id", "item_id", "similarity", "rank")
    recs = with_own_rating(recs, ratings, own_rating_fill)
    return with_titles(recs, items).select("user_id", "item_id", "title", "similarity", "rank", "user_rating")
