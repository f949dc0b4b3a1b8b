"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the driver's tables (through ``sources.tables``) in full.
Doubles are rounded to 6 digits (similarities to 9) in both the Spark plan
and the SQL text; arrays are flattened to text so both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.functions.metrics import r6
from recsift.operators import stats
from recsift.plans.oracle import with_tables
from recsift.session import cut_lineage
from recsift.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
CHECK: dict[str, str] = {}  # name -> "V" value check, "R" rows only


def query(name: str, sql: str | None = None, reuse: bool = False):
    """Register ``fn(Tables) -> DataFrame``; ``reuse`` materialises the
    interactions table once for jobs that read it several times."""
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir, reuse=reuse))
        QUERIES[name].__name__ = name
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[name] = sql
        CHECK[name] = "V" if sql is not None else "R"
        return fn
    return deco


# ---------------------------------------------------------------- sources

@query("load_interactions", with_tables("SELECT user_id, item_id, rating, ts FROM interactions", "interactions"))
def _load_interactions(t: Tables) -> DataFrame:
    return t.interactions()


@query("load_items", with_tables(
    "SELECT item_id, title, array_to_string(genres, '|') AS genres, CAST(len(genres) AS INTEGER) AS n_genres, "
    "year FROM items",
    "items"))
def _load_items(t: Tables) -> DataFrame:
    i = t.items()
    return i.select("item_id", "title", F.array_join("genres", "|").alias("genres"),
                    F.size("genres").alias("n_genres"), "year")


@query("load_tags", with_tables("SELECT user_id, item_id, tag, ts FROM tags", "tags"))
def _load_tags(t: Tables) -> DataFrame:
    return t.tags()


@query("load_tag_scores", with_tables("SELECT item_id, tag_id, relevance FROM tag_scores", "tag_scores"))
def _load_tag_scores(t: Tables) -> DataFrame:
    return t.tag_scores()


@query("load_tag_names", with_tables("SELECT tag_id, tag FROM tag_names", "tag_names"))
def _load_tag_names(t: Tables) -> DataFrame:
    return t.tag_names()


# ---------------------------------------------------------------- statistics

@query("rating_stats", with_tables("""
    SELECT count(rating) AS count, round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS stddev,
           min(rating) AS min, max(rating) AS max FROM interactions""", "interactions"))
def _rating_stats(t: Tables) -> DataFrame:
    s = stats.rating_stats(t.interactions())
    return s.select("count", r6(F.col("mean")).alias("mean"), r6(F.col("stddev")).alias("stddev"), "min", "max")


@query("rating_distribution", with_tables(
    "SELECT rating, count(*) AS count FROM interactions GROUP BY rating ORDER BY rating", "interactions"))
def _rating_distribution(t: Tables) -> DataFrame:
    return stats.rating_distribution(t.interactions())


def _key_stats_sql(key: str) -> str:
    return with_tables(f"""
        SELECT {key}, count(rating) AS rating_count, round(avg(rating), 6) AS rating_mean,
               round(stddev_samp(rating), 6) AS rating_stddev
        FROM interactions GROUP BY {key}""", "interactions")


def _round_stats(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "rating_count", r6(F.col("rating_mean")).alias("rating_mean"),
                     r6(F.col("rating_stddev")).alias("rating_stddev"))


@query("item_stats", _key_stats_sql("item_id"))
def _item_stats(t: Tables) -> DataFrame:
    return _round_stats(stats.item_stats(t.interactions()), "item_id")


@query("user_stats", _key_stats_sql("user_id"))
def _user_stats(t: Tables) -> DataFrame:
    return _round_stats(stats.user_stats(t.interactions()), "user_id")


_GENRE_SQL = """
    SELECT genre, count(r.rating) AS rating_count, round(avg(r.rating), 6) AS avg_rating,
           count(DISTINCT g.item_id) AS item_count
    FROM (SELECT item_id, unnest(genres) AS genre FROM items) g JOIN interactions r ON g.item_id = r.item_id
    GROUP BY genre"""


def _round_genres(df: DataFrame) -> DataFrame:
    return df.select("genre", "rating_count", r6(F.col("avg_rating")).alias("avg_rating"), "item_count")


@query("genre_stats", with_tables(_GENRE_SQL, "items", "interactions"))
def _genre_stats(t: Tables) -> DataFrame:
    return _round_genres(stats.genre_stats(t.interactions(), t.items()))


@query("popular_genres", with_tables(
    f"SELECT * FROM ({_GENRE_SQL}) ORDER BY rating_count DESC, genre LIMIT 10", "items", "interactions"))
def _popular_genres(t: Tables) -> DataFrame:
    return _round_genres(stats.popular_genres(t.interactions(), t.items(), n=10))


# Fixed query parameters: min_ratings 30 (the reference default 100 matches no
# item at these scales, see FIXTURES.md), top 10.
MIN_RATINGS = 30
TOP_N = 10

_TOP_RATED_BASE = f"""
    SELECT s.item_id, i.title, array_to_string(i.genres, '|') AS genres, s.rating_count,
           round(s.avg_rating, 6) AS avg_rating, round(s.rating_stddev, 6) AS rating_stddev
    FROM (SELECT item_id, count(rating) AS rating_count, avg(rating) AS avg_rating,
                 stddev_samp(rating) AS rating_stddev
          FROM interactions GROUP BY item_id HAVING count(rating) >= {MIN_RATINGS}) s
    JOIN items i ON s.item_id = i.item_id"""


def _flat_top(df: DataFrame) -> DataFrame:
    return df.select("item_id", "title", F.array_join("genres", "|").alias("genres"), "rating_count",
                     r6(F.col("avg_rating")).alias("avg_rating"), r6(F.col("rating_stddev")).alias("rating_stddev"))


@query("top_rated_items", with_tables(
    _TOP_RATED_BASE + f" ORDER BY s.rating_count DESC, s.avg_rating DESC, s.item_id LIMIT {TOP_N}",
    "items", "interactions"))
def top_rated_items_query(t: Tables) -> DataFrame:
    """Flagship (A7): most rated items with at least MIN_RATINGS ratings."""
    return _flat_top(stats.top_rated_items(t.interactions(), t.items(), n=TOP_N, min_ratings=MIN_RATINGS))


@query("best_rated_items", with_tables(
    _TOP_RATED_BASE + " ORDER BY s.avg_rating DESC, s.item_id", "items", "interactions"))
def _best_rated_items(t: Tables) -> DataFrame:
    return _flat_top(stats.top_rated_items(t.interactions(), t.items(), n=None, min_ratings=MIN_RATINGS,
                                           order="mean"))


@query("item_tag_text", with_tables("""
    SELECT item_id, string_agg(tag, ' ' ORDER BY tag) AS tag_text FROM tags
    WHERE tag IS NOT NULL GROUP BY item_id""", "tags"))
def _item_tag_text(t: Tables) -> DataFrame:
    return stats.item_tag_text(t.tags())


@query("dataset_summary", with_tables("""
    SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items
    FROM interactions""", "interactions"))
def _dataset_summary(t: Tables) -> DataFrame:
    return stats.dataset_summary(t.interactions())


@query("sample_users", with_tables(
    "SELECT DISTINCT user_id FROM interactions ORDER BY user_id LIMIT 20", "interactions"))
def _sample_users(t: Tables) -> DataFrame:
    return stats.sample_users(t.interactions(), n=20)


# ---------------------------------------------------------------- profiling, cleaning

from recsift.operators import clean, lookup  # noqa: E402

_CANONICAL = ("interactions", "items", "tags", "tag_scores", "tag_names")


def _canonical(t: Tables) -> list[tuple[str, DataFrame]]:
    return [("interactions", t.interactions()), ("items", t.items()), ("tags", t.tags()),
            ("tag_scores", t.tag_scores()), ("tag_names", t.tag_names())]


_NCOLS = {"interactions": 4, "items": 4, "tags": 4, "tag_scores": 3, "tag_names": 2}


@query("profile_table", with_tables(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS n_rows, CAST({_NCOLS[n]} AS BIGINT) AS n_cols FROM {n}"
    for n in _CANONICAL), *_CANONICAL))
def _profile_table(t: Tables) -> DataFrame:
    frames = [clean.shape(df, n) for n, df in _canonical(t)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("profile_missing", with_tables("""
    SELECT 'user_id' AS "column", CAST(count_if(user_id IS NULL) AS BIGINT) AS missing FROM gappy
    UNION ALL SELECT 'item_id', CAST(count_if(item_id IS NULL) AS BIGINT) FROM gappy
    UNION ALL SELECT 'rating', CAST(count_if(rating IS NULL OR isnan(rating)) AS BIGINT) FROM gappy
    UNION ALL SELECT 'ts', CAST(count_if(ts IS NULL) AS BIGINT) FROM gappy""", "gappy"))
def _profile_missing(t: Tables) -> DataFrame:
    return clean.missing_counts(t.gappy())


@query("profile_duplicates", with_tables(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", (SELECT count(*) FROM {n}) AS n_rows, "
    f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {n})) AS n_distinct, "
    f"(SELECT count(*) FROM {n}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {n})) AS n_duplicates"
    for n in _CANONICAL), *_CANONICAL))
def _profile_duplicates(t: Tables) -> DataFrame:
    return clean.duplicate_report(_canonical(t))


@query("impute_mean", with_tables("""
    SELECT user_id, item_id, round(coalesce(rating, avg(rating) OVER ()), 6) AS rating, ts FROM gappy""", "gappy"))
def _impute_mean(t: Tables) -> DataFrame:
    out = clean.impute_mean(t.gappy())
    return out.select("user_id", "item_id", r6(F.col("rating")).alias("rating"), "ts")


_HASH = "((user_id * 7919 + item_id * 104729) % 1000003)"


@query("sample_random")
def _sample_random(t: Tables) -> DataFrame:
    return clean.sample_random(t.interactions(), 0.2, seed=42)


@query("sample_hash", with_tables(
    f"SELECT user_id, item_id, rating, ts FROM interactions WHERE {_HASH} % 1000 < 200", "interactions"))
def _sample_hash(t: Tables) -> DataFrame:
    return clean.sample_hash(t.interactions(), 0.2, portable=True)


@query("split_random")
def _split_random(t: Tables) -> DataFrame:
    return clean.split_random(t.interactions().select("user_id", "item_id", "rating"), (0.8, 0.2), seed=42)


@query("split_hash", with_tables("SELECT user_id, item_id, rating, split FROM split", "split"))
def _split_hash(t: Tables) -> DataFrame:
    return t.split().select("user_id", "item_id", "rating", "split")


@query("split_per_user", with_tables("""
    SELECT user_id, count(*) AS n_rows, CAST(round(0.8 * count(*)) AS BIGINT) AS n_train FROM interactions
    GROUP BY user_id""", "interactions"), reuse=True)
def _split_per_user(t: Tables) -> DataFrame:
    """Rows and train rows of every user's own 80/20 split."""
    return clean.split_per_user(t.interactions()).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("split") == "train").alias("n_train"))


@query("split_report", with_tables("""
    SELECT split, count(*) AS n_rows, round(100.0 * count(*) / (SELECT count(*) FROM split), 6) AS pct
    FROM split GROUP BY split""", "split"))
def _split_report(t: Tables) -> DataFrame:
    return clean.split_report(t.split()).select("split", "n_rows", r6(F.col("pct")).alias("pct"))


@query("feature_vector", with_tables("""
    SELECT item_id, CAST(count(rating) AS DOUBLE) AS f_count, round(avg(rating), 6) AS f_mean,
           round(coalesce(stddev_samp(rating), 'NaN'::DOUBLE), 6) AS f_stddev
    FROM interactions GROUP BY item_id""", "interactions"))
def _feature_vector(t: Tables) -> DataFrame:
    st = stats.item_stats(t.interactions())
    vec = clean.feature_vector(st, ["rating_count", "rating_mean", "rating_stddev"])
    flat = clean.vector_columns(vec.select("item_id", "features"), "features", ["f_count", "f_mean", "f_stddev"])
    return flat.select("item_id", "f_count", r6(F.col("f_mean")).alias("f_mean"),
                       r6(F.col("f_stddev")).alias("f_stddev"))


# ---------------------------------------------------------------- scalar functions

@query("split_genres", with_tables("""
    SELECT item_id, CAST(pos AS INTEGER) AS pos, genres[pos] AS genre
    FROM (SELECT item_id, genres, unnest(range(1, len(genres) + 1)) AS pos FROM items)""", "items"))
def _split_genres(t: Tables) -> DataFrame:
    i = t.items()
    return i.select("item_id", F.posexplode("genres").alias("pos", "genre")).select(
        "item_id", (F.col("pos") + 1).alias("pos"), "genre")


@query("item_year", with_tables("SELECT item_id, title, year FROM items", "items"))
def _item_year(t: Tables) -> DataFrame:
    return t.items().select("item_id", "title", "year")


# ---------------------------------------------------------------- filters, lookups

@query("relevant_tags", with_tables(
    "SELECT item_id, tag_id, relevance FROM tag_scores WHERE relevance > 0.5", "tag_scores"))
def _relevant_tags(t: Tables) -> DataFrame:
    return lookup.relevant_tags(t.tag_scores())


@query("liked_items", with_tables(
    "SELECT user_id, item_id, rating FROM interactions WHERE rating >= 4.0", "interactions"))
def _liked_items(t: Tables) -> DataFrame:
    return lookup.liked_items(t.interactions())


@query("active_users", with_tables(
    "SELECT user_id, count(*) AS n_ratings FROM interactions GROUP BY user_id HAVING count(*) >= 5",
    "interactions"))
def _active_users(t: Tables) -> DataFrame:
    return lookup.active_users(t.interactions())


# Fixed search parameters for the registered queries.
SEARCH_TEXT = "red"
SEARCH_REGEX = "(ring|bolt) \\(19[89]"


@query("search_titles", with_tables(f"""
    SELECT item_id, title, array_to_string(genres, '|') AS genres FROM items
    WHERE title IS NOT NULL AND contains(lower(title), '{SEARCH_TEXT}') ORDER BY item_id LIMIT 10""", "items"))
def _search_titles(t: Tables) -> DataFrame:
    s = lookup.search_titles(t.items(), SEARCH_TEXT, limit=10)
    return s.select("item_id", "title", F.array_join("genres", "|").alias("genres"))


@query("search_titles_indexed", with_tables(f"""
    SELECT item_id, title, array_to_string(genres, '|') AS genres FROM items
    WHERE title IS NOT NULL AND contains(lower(title), '{SEARCH_TEXT}')""", "items"))
def _search_titles_indexed(t: Tables) -> DataFrame:
    """F8/U3 through the trigram table: every hit, not only the first ten."""
    from recsift.operators.search import TitleIndex

    s = TitleIndex.build(t.items()).search(SEARCH_TEXT, limit=None)
    return s.select("item_id", "title", F.array_join("genres", "|").alias("genres"))


@query("search_titles_regex", with_tables(f"""
    SELECT item_id, title FROM items
    WHERE title IS NOT NULL AND regexp_matches(lower(title), '{SEARCH_REGEX}') ORDER BY item_id""", "items"))
def _search_titles_regex(t: Tables) -> DataFrame:
    return lookup.search_titles(t.items(), SEARCH_REGEX, limit=None, regex=True).select("item_id", "title")


@query("tag_lookup", with_tables("""
    SELECT s.item_id, s.tag_id, coalesce(n.tag, '') AS tag
    FROM tag_scores s LEFT JOIN tag_names n ON s.tag_id = n.tag_id WHERE s.relevance > 0.5""",
    "tag_scores", "tag_names"))
def _tag_lookup(t: Tables) -> DataFrame:
    return lookup.tag_lookup(t.tag_scores(), t.tag_names())


@query("title_lookup", with_tables("""
    SELECT r.item_id, coalesce(i.title, 'Movie ' || CAST(r.item_id AS VARCHAR)) AS title
    FROM (SELECT DISTINCT item_id FROM interactions UNION SELECT DISTINCT item_id FROM tag_scores) r
    LEFT JOIN items i ON r.item_id = i.item_id""", "interactions", "tag_scores", "items"))
def _title_lookup(t: Tables) -> DataFrame:
    ids = t.interactions().select("item_id").union(t.tag_scores().select("item_id")).distinct()
    return lookup.with_titles(ids, t.items()).select("item_id", "title")


@query("user_top_item", with_tables("""
    SELECT user_id, item_id, rating FROM (
        SELECT user_id, item_id, rating,
               row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn
        FROM interactions) WHERE rn = 1""", "interactions"))
def _user_top_item(t: Tables) -> DataFrame:
    return lookup.user_top_item(t.interactions())


@query("user_history", with_tables("""
    SELECT r.user_id, r.item_id, coalesce(i.title, 'Movie ' || CAST(r.item_id AS VARCHAR)) AS title,
           r.rating, r.ts
    FROM interactions r LEFT JOIN items i ON r.item_id = i.item_id
    ORDER BY r.user_id, r.rating DESC, r.item_id""", "interactions", "items"))
def _user_history(t: Tables) -> DataFrame:
    return lookup.user_history(t.interactions(), t.items())


# ---------------------------------------------------------------- content model

from recsift.operators import content, recommend, similarity  # noqa: E402

N_SIMILAR = 10


def _content_model(t: Tables, simple: bool = False) -> content.ContentModel:
    if simple:
        return content.ContentModel.fit(t.items(), simple=True)
    return content.ContentModel.fit(t.items(), t.tags(), t.tag_scores(), t.tag_names())


def _similar(t: Tables) -> DataFrame:
    m = _content_model(t)
    return similarity.similar_items(m.vectors, n=N_SIMILAR, n_items=m.n_items)


def _similar_to_top(t: Tables) -> DataFrame:
    """Neighbours of the users' top items only: |distinct top items| x catalogue."""
    m = _content_model(t)
    seeds = lookup.user_top_item(t.interactions()).select("item_id")
    return similarity.similar_items_for(m.vectors, seeds, n=N_SIMILAR, n_items=m.n_items)


@query("item_document", with_tables("SELECT item_id, document FROM doc", "doc"))
def _item_document(t: Tables) -> DataFrame:
    return content.item_document(t.items(), t.tags(), t.tag_scores(), t.tag_names())


# Small chunks, so that documents have several.
DOC_CHUNK = 64


@query("item_document_chunks", with_tables(f"""
    SELECT item_id, CAST(begins // {DOC_CHUNK} AS BIGINT) AS chunk, string_agg(part, ' ' ORDER BY section, part) AS text FROM (
        SELECT item_id, section, part, coalesce(sum(length(part) + 1) OVER (
                   PARTITION BY item_id ORDER BY section, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
        FROM (SELECT item_id, 0 AS section, title AS part FROM items WHERE title IS NOT NULL
              UNION ALL SELECT item_id, 1, array_to_string(genres, ' ') FROM items
              UNION ALL SELECT i.item_id, 2, coalesce(t.tag, '') FROM items i
                        LEFT JOIN (SELECT * FROM tags WHERE tag IS NOT NULL) t ON i.item_id = t.item_id
              UNION ALL SELECT i.item_id, 3, coalesce(g.tag, '') FROM items i
                        LEFT JOIN (SELECT s.item_id, coalesce(n.tag, '') AS tag FROM tag_scores s
                                   LEFT JOIN tag_names n ON s.tag_id = n.tag_id WHERE s.relevance > 0.5) g
                        ON i.item_id = g.item_id))
    GROUP BY item_id, begins // {DOC_CHUNK}""", "items", "tags", "tag_scores", "tag_names"))
def _item_document_chunks(t: Tables) -> DataFrame:
    """A9, J3, J4, T1 in bounded pieces."""
    return content.item_document_chunks(t.items(), t.tags(), t.tag_scores(), t.tag_names(), chunk_chars=DOC_CHUNK)


@query("item_document_simple", with_tables("SELECT item_id, document FROM doc_simple", "doc_simple"))
def _item_document_simple(t: Tables) -> DataFrame:
    return content.item_document_simple(t.items())


@query("item_tokens", with_tables("SELECT item_id, term, tf FROM toks", "toks"))
def _item_tokens(t: Tables) -> DataFrame:
    return content.item_terms(t.items(), t.tags(), t.tag_scores(), t.tag_names())


@query("vocabulary", with_tables(
    "SELECT term, df, tf_total, round(idf, 9) AS idf FROM vocab", "vocab"))
def _vocabulary(t: Tables) -> DataFrame:
    v = _content_model(t).vocab
    return v.select("term", "df", "tf_total", F.round("idf", 9).alias("idf"))


@query("vocabulary_simple", with_tables(
    "SELECT term, df, tf_total, round(idf, 9) AS idf FROM vocab_simple", "vocab_simple"))
def _vocabulary_simple(t: Tables) -> DataFrame:
    v = _content_model(t, simple=True).vocab
    return v.select("term", "df", "tf_total", F.round("idf", 9).alias("idf"))


@query("tfidf_vectors", with_tables(
    "SELECT item_id, term, tf, round(weight, 9) AS weight FROM vec", "vec"))
def _tfidf_vectors(t: Tables) -> DataFrame:
    v = _content_model(t).vectors
    return v.select("item_id", "term", "tf", F.round("weight", 9).alias("weight"))


@query("similar_items", with_tables("SELECT seed_id, item_id, similarity, rank FROM neighbours", "neighbours"))
def _similar_items(t: Tables) -> DataFrame:
    return _similar(t)


_LIKED_RECS_SQL = """
    SELECT user_id, item_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, item_id) AS rank FROM (
            SELECT c.user_id, c.item_id, max(c.similarity) AS similarity
            FROM (SELECT l.user_id, s.item_id, s.similarity
                  FROM {ratings} l JOIN neighbours s ON l.item_id = s.seed_id WHERE l.rating >= 4.0) c
            WHERE NOT EXISTS (SELECT 1 FROM {ratings} r WHERE r.user_id = c.user_id AND r.item_id = c.item_id)
            GROUP BY c.user_id, c.item_id))
    WHERE rank <= 10"""


@query("content_recs_liked", with_tables(_LIKED_RECS_SQL.format(ratings="interactions"), "neighbours", "interactions"), reuse=True)
def _content_recs_liked(t: Tables) -> DataFrame:
    return recommend.content_recs_liked(t.interactions(), _similar(t), n=N_SIMILAR)


@query("content_recs_top_item", with_tables("""
    SELECT u.user_id, u.item_id AS seed_id, s.item_id, s.similarity, s.rank
    FROM user_top u JOIN neighbours s ON u.item_id = s.seed_id""", "user_top", "neighbours"), reuse=True)
def _content_recs_top_item(t: Tables) -> DataFrame:
    return recommend.content_recs_top_item(t.interactions(), _similar_to_top(t), n=N_SIMILAR)


@query("unseen_candidates", with_tables("""
    SELECT u.user_id, s.item_id, s.similarity
    FROM user_top u JOIN neighbours s ON u.item_id = s.seed_id
    WHERE NOT EXISTS (SELECT 1 FROM interactions r WHERE r.user_id = u.user_id AND r.item_id = s.item_id)""",
    "user_top", "neighbours", "interactions"), reuse=True)
def _unseen_candidates(t: Tables) -> DataFrame:
    recs = recommend.content_recs_top_item(t.interactions(), _similar_to_top(t), n=N_SIMILAR)
    return lookup.drop_seen(recs, t.interactions()).select("user_id", "item_id", "similarity")


# ---------------------------------------------------------------- evaluation

from recsift.operators import evaluate  # noqa: E402

_BASE_PRED = """
    SELECT t.user_id, t.item_id, t.rating, m.prediction
    FROM test t JOIN (SELECT item_id, avg(rating) AS prediction FROM train GROUP BY item_id) m
    ON t.item_id = m.item_id"""

_REG_SQL = """
    SELECT count(*) AS n, round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
           round(avg(abs(rating - prediction)), 6) AS mae,
           round(1 - sum((rating - prediction) * (rating - prediction)) / (var_pop(rating) * count(*)), 6) AS r2
    FROM pred"""


def _train_test(t: Tables) -> tuple[DataFrame, DataFrame]:
    s = t.split().select("user_id", "item_id", "rating", "split")
    return (s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split"))


def _round_cols(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _baseline_pred(t: Tables) -> DataFrame:
    train, test = _train_test(t)
    return evaluate.item_mean_predictions(train, test)


@query("baseline_rmse_mae_r2", with_tables(_REG_SQL, "train", "test", extra=[("pred", _BASE_PRED)]),
       reuse=True)
def _baseline_metrics(t: Tables) -> DataFrame:
    return _round_cols(evaluate.regression_metrics(_baseline_pred(t)), ["rmse", "mae", "r2"])


@query("residual_histogram", with_tables("""
    SELECT CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi,
           count(*) AS n
    FROM (SELECT least(floor((res - lo) / w), 49) AS bin, lo, w FROM (
            SELECT round(rating - prediction, 9) AS res FROM pred) r,
          (SELECT min(round(rating - prediction, 9)) AS lo,
                  (max(round(rating - prediction, 9)) - min(round(rating - prediction, 9))) / 50 AS w FROM pred) m)
    GROUP BY bin, lo, w""", "train", "test", extra=[("pred", _BASE_PRED)]), reuse=True)
def _residual_histogram(t: Tables) -> DataFrame:
    return _round_cols(evaluate.residual_histogram(_baseline_pred(t)), ["bin_lo", "bin_hi"])


@query("prediction_grid", with_tables("""
    SELECT rating, floor(prediction / 0.5) * 0.5 AS prediction_bin, count(*) AS n FROM pred GROUP BY 1, 2""",
    "train", "test", extra=[("pred", _BASE_PRED)]), reuse=True)
def _prediction_grid(t: Tables) -> DataFrame:
    return evaluate.prediction_grid(_baseline_pred(t)).select(
        "rating", F.col("prediction_bin").cast("double").alias("prediction_bin"), "n")


_CONTENT_PRED = """
    SELECT t.user_id, t.item_id, t.rating, sum(s.similarity * r.rating) / sum(s.similarity) AS prediction
    FROM test t JOIN neighbours s ON s.seed_id = t.item_id
    JOIN train r ON r.user_id = t.user_id AND r.item_id = s.item_id
    GROUP BY t.user_id, t.item_id, t.rating"""


def _content_pred(t: Tables) -> DataFrame:
    train, test = _train_test(t)
    return evaluate.content_predictions(train, test, _similar(t))


@query("content_predictions", with_tables(
    "SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM pred",
    "train", "test", "neighbours", extra=[("pred", _CONTENT_PRED)]), reuse=True)
def _content_predictions(t: Tables) -> DataFrame:
    return _round_cols(_content_pred(t), ["prediction"])


@query("content_rating_eval", with_tables(_REG_SQL, "train", "test", "neighbours",
                                          extra=[("pred", _CONTENT_PRED)]), reuse=True)
def _content_rating_eval(t: Tables) -> DataFrame:
    return _round_cols(evaluate.regression_metrics(_content_pred(t)), ["rmse", "mae", "r2"])


_RANKING_SQL = """
    SELECT n_users, round(p, 6) AS precision, round(r, 6) AS recall,
           round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1
    FROM (SELECT count(*) AS n_users, coalesce(avg(hits / n_rec), 0.0) AS p, coalesce(avg(hits / n_rel), 0.0) AS r
          FROM (SELECT a.user_id, a.n_rec, b.n_rel, coalesce(h.hits, 0) AS hits
                FROM (SELECT user_id, count(*) AS n_rec FROM recs GROUP BY user_id) a
                JOIN (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id) b ON a.user_id = b.user_id
                LEFT JOIN (SELECT x.user_id, count(*) AS hits FROM recs x JOIN rel y
                           ON x.user_id = y.user_id AND x.item_id = y.item_id GROUP BY x.user_id) h
                  ON h.user_id = a.user_id
                WHERE a.user_id IN (SELECT user_id FROM elig)))"""

_ELIG = """
    SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) >= 5
    INTERSECT SELECT user_id FROM train INTERSECT SELECT user_id FROM test"""


@query("content_eval", with_tables(
    _RANKING_SQL, "interactions", "train", "test", "neighbours",
    extra=[("recs", _LIKED_RECS_SQL.format(ratings="train")),
           ("rel", "SELECT user_id, item_id FROM test WHERE rating >= 4.0"), ("elig", _ELIG)]), reuse=True)
def _content_eval(t: Tables) -> DataFrame:
    m = evaluate.evaluate_content(t.interactions(), _similar(t), n=N_SIMILAR, split=t.split())
    return _round_cols(m, ["precision", "recall", "f1"])


_TOP_ITEM_RECS = "SELECT u.user_id, s.item_id FROM user_top u JOIN neighbours s ON u.item_id = s.seed_id"


@query("jaccard_lists", with_tables("""
    SELECT coalesce(a.user_id, b.user_id) AS user_id,
           round(count(*) FILTER (WHERE a.item_id IS NOT NULL AND b.item_id IS NOT NULL) / count(*), 6) AS jaccard
    FROM (SELECT DISTINCT user_id, item_id FROM recs) a
    FULL JOIN (SELECT DISTINCT user_id, item_id FROM top_recs) b ON a.user_id = b.user_id AND a.item_id = b.item_id
    GROUP BY coalesce(a.user_id, b.user_id)""", "interactions", "user_top", "neighbours",
    extra=[("recs", _LIKED_RECS_SQL.format(ratings="interactions")), ("top_recs", _TOP_ITEM_RECS)]), reuse=True)
def _jaccard_lists(t: Tables) -> DataFrame:
    sim = _similar(t)
    a = recommend.content_recs_liked(t.interactions(), sim, n=N_SIMILAR)
    b = recommend.content_recs_top_item(t.interactions(), sim, n=N_SIMILAR)
    return _round_cols(evaluate.jaccard_lists(a, b), ["jaccard"])


_COVERAGE_SQL = """
    SELECT count(DISTINCT r.item_id) AS n_recommended, (SELECT count(DISTINCT item_id) FROM items) AS n_catalogue,
           round(count(DISTINCT r.item_id) / (SELECT count(DISTINCT item_id) FROM items), 6) AS coverage
    FROM recs r"""


@query("coverage", with_tables(_COVERAGE_SQL, "interactions", "items", "neighbours",
    extra=[("recs", _LIKED_RECS_SQL.format(ratings="interactions"))]), reuse=True)
def _coverage(t: Tables) -> DataFrame:
    recs = recommend.content_recs_liked(t.interactions(), _similar(t), n=N_SIMILAR)
    return _round_cols(evaluate.coverage(recs, t.items()), ["coverage"])


_DIVERSITY_SQL = """
    SELECT count(*) AS n_users, round(avg(1 - coalesce(p.s, 0) / (k.k * (k.k - 1))), 6) AS diversity
    FROM (SELECT user_id, count(*) AS k FROM lists GROUP BY user_id HAVING count(*) >= 2) k
    LEFT JOIN (SELECT a.user_id, sum(va.weight * vb.weight) AS s
               FROM lists a JOIN lists b ON a.user_id = b.user_id AND a.item_id <> b.item_id
               JOIN vec va ON va.item_id = a.item_id
               JOIN vec vb ON vb.item_id = b.item_id AND va.term = vb.term
               GROUP BY a.user_id) p ON k.user_id = p.user_id"""


@query("diversity", with_tables(_DIVERSITY_SQL, "interactions", "neighbours", "vec",
    extra=[("recs", _LIKED_RECS_SQL.format(ratings="interactions")),
           ("lists", "SELECT DISTINCT user_id, item_id FROM recs")]), reuse=True)
def _diversity(t: Tables) -> DataFrame:
    m = _content_model(t)
    sim = similarity.similar_items(m.vectors, n=N_SIMILAR, n_items=m.n_items)
    recs = recommend.content_recs_liked(t.interactions(), sim, n=N_SIMILAR)
    return _round_cols(evaluate.diversity(recs, m.vectors), ["diversity"])


_NOVELTY_SQL = """
    SELECT count(nov) AS n_users, round(avg(nov), 6) AS novelty FROM (
        SELECT r.user_id, avg(-log2(x.raters / nu.u)) AS nov
        FROM recs r LEFT JOIN (SELECT item_id, count(DISTINCT user_id) AS raters FROM interactions GROUP BY item_id) x
          ON r.item_id = x.item_id
        CROSS JOIN (SELECT count(DISTINCT user_id) AS u FROM interactions) nu
        GROUP BY r.user_id)"""


@query("novelty", with_tables(_NOVELTY_SQL, "interactions", "neighbours",
    extra=[("recs", _LIKED_RECS_SQL.format(ratings="interactions"))]), reuse=True)
def _novelty(t: Tables) -> DataFrame:
    recs = recommend.content_recs_liked(t.interactions(), _similar(t), n=N_SIMILAR)
    return _round_cols(evaluate.novelty(recs, t.interactions()), ["novelty"])


# ---------------------------------------------------------------- reports

@query("recommend_content", with_tables("""
    SELECT u.user_id, s.item_id, coalesce(i.title, 'Movie ' || CAST(s.item_id AS VARCHAR)) AS title,
           s.similarity, s.rank, r.rating AS user_rating
    FROM user_top u JOIN neighbours s ON u.item_id = s.seed_id
    LEFT JOIN interactions r ON r.user_id = u.user_id AND r.item_id = s.item_id
    LEFT JOIN items i ON i.item_id = s.item_id""", "user_top", "neighbours", "interactions", "items"), reuse=True)
def _recommend_content(t: Tables) -> DataFrame:
    return recommend.recommend_content(t.interactions(), t.items(), _similar_to_top(t), n=N_SIMILAR)


# ---------------------------------------------------------------- collaborative model

from recsift.operators import als  # noqa: E402

# Fixed query parameters: rank 10, 10 iterations; the grid search runs the whole
# grid (12 combinations x 3 folds, and the best one again on all ratings).
ALS_PARAMS = {"rank": 10, "max_iter": 10, "reg_param": 0.1}
CV_FITS_AT_ONCE = 4


def _als_model(t: Tables):
    train, _ = _train_test(t)
    return als.fit_als(train, **ALS_PARAMS)


@query("als_predictions", reuse=True)
def _als_predictions(t: Tables) -> DataFrame:
    train, test = _train_test(t)
    return als.predict(als.fit_als(train, **ALS_PARAMS), test)


@query("als_cv_grid")
def _als_cv_grid(t: Tables) -> DataFrame:
    train, _ = _train_test(t)
    _, report = als.cross_validate(cut_lineage(train), als.FULL_GRID, folds=3, parallelism=CV_FITS_AT_ONCE)
    return report


@query("als_scored_pairs", with_tables("""
    SELECT user_id, item_id, rating, true AS from_factors FROM test
    WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""", "train", "test"), reuse=True)
def _als_scored_pairs(t: Tables) -> DataFrame:
    """M4/M8: exactly the test pairs whose user and item the training side knows are scored, each with the
    inner product of its two factor rows."""
    train, test = _train_test(t)
    model = als.fit_als(train, **ALS_PARAMS)
    dot = F.aggregate(F.zip_with("uf", "if", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return (als.predict(model, test).join(model.userFactors.withColumnRenamed("features", "uf"), "user_id", "left")
            .join(model.itemFactors.withColumnRenamed("features", "if"), "item_id", "left")
            .select("user_id", "item_id", "rating",
                    F.coalesce(F.abs(dot - F.col("prediction")) < 1e-4, F.lit(False)).alias("from_factors")))


@query("als_unseen_lists", with_tables("""
    SELECT u.user_id, least(10, (SELECT count(DISTINCT item_id) FROM train) - u.n) AS n_items, 0 AS n_seen, true AS ranked
    FROM (SELECT user_id, count(DISTINCT item_id) AS n FROM train GROUP BY user_id) u
    WHERE u.n < (SELECT count(DISTINCT item_id) FROM train)""", "train"), reuse=True)
def _als_unseen_lists(t: Tables) -> DataFrame:
    """M5-M7 with rated items left out: every user's list is full, holds nothing rated, and scores fall."""
    train, _ = _train_test(t)
    recs = als.recommend_all(als.fit_als(train, **ALS_PARAMS), n=TOP_N, seen=train)
    seen = train.select("user_id", "item_id", F.lit(1).alias("seen"))
    per_user = recs.join(seen, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count_distinct("item_id").alias("n_items"), F.count("seen").alias("n_seen"),
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("l"))
    falls = F.forall(F.sequence(F.lit(1), F.size("l")), lambda i: (F.element_at("l", i)["rank"] == i) & (
        F.element_at("l", i)["score"] <= F.element_at("l", F.greatest(i - 1, F.lit(1)))["score"]))
    return per_user.select("user_id", "n_items", F.col("n_seen").cast("int").alias("n_seen"), falls.alias("ranked"))


# Whole numbers, so both engines have the same sums: what a user rates and how an item is rated.
_USER_VEC = ("count(*)", "CAST(sum(2 * rating) AS BIGINT)", "CAST(max(2 * rating) AS BIGINT)")
_ITEM_VEC = ("CAST(sum(2 * rating) AS BIGINT)", "CAST(min(2 * rating) AS BIGINT)", "count(*)")


@query("factor_top_items", with_tables(f"""
    SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, CAST(score AS DOUBLE) AS score FROM (
        SELECT u.user_id, i.item_id, u.a * i.a + u.b * i.b + u.c * i.c AS score,
               row_number() OVER (PARTITION BY u.user_id ORDER BY u.a * i.a + u.b * i.b + u.c * i.c DESC, i.item_id) AS rank
        FROM (SELECT user_id, {_USER_VEC[0]} AS a, {_USER_VEC[1]} AS b, {_USER_VEC[2]} AS c FROM interactions GROUP BY user_id) u,
             (SELECT item_id, {_ITEM_VEC[0]} AS a, {_ITEM_VEC[1]} AS b, {_ITEM_VEC[2]} AS c FROM interactions GROUP BY item_id) i
        WHERE NOT EXISTS (SELECT 1 FROM interactions r WHERE r.user_id = u.user_id AND r.item_id = i.item_id))
    WHERE rank <= 10""", "interactions"), reuse=True)
def _factor_top_items(t: Tables) -> DataFrame:
    """M5/M7's search over factor tables that SQL can state: the unseen items with the highest inner products."""
    from recsift.operators import retrieval

    def vectors(key: str, name: str, parts: tuple[str, ...]) -> DataFrame:
        sums = t.interactions().groupBy(F.col(key).alias(name)).agg(*[F.expr(p).alias(f"v{i}") for i, p in enumerate(parts)])
        return sums.select(name, F.array("v0", "v1", "v2").alias("vec"))

    recs = retrieval.top_n(vectors("user_id", "query_id", _USER_VEC), vectors("item_id", "item_id", _ITEM_VEC), TOP_N,
                           seen=t.interactions().select("user_id", "item_id"))
    return recs.withColumnRenamed("query_id", "user_id")


@query("als_recs_subset", reuse=True)
def _als_recs_subset(t: Tables) -> DataFrame:
    return als.recommend_for(_als_model(t), lookup.active_users(t.interactions()), n=TOP_N)


@query("als_recs_all")
def _als_recs_all(t: Tables) -> DataFrame:
    return als.recommend_all(_als_model(t), n=TOP_N)


@query("als_factor_check", reuse=True)
def _als_factor_check(t: Tables) -> DataFrame:
    _, test = _train_test(t)
    return als.factor_check(_als_model(t), test)


@query("als_residual_histogram", reuse=True)
def _als_residual_histogram(t: Tables) -> DataFrame:
    train, test = _train_test(t)
    return evaluate.residual_histogram(als.predict(als.fit_als(train, **ALS_PARAMS), test))


def _als_metrics(t: Tables, vectors: DataFrame) -> DataFrame:
    train, test = _train_test(t)
    model = als.fit_als(train, **ALS_PARAMS)
    users = evaluate.eligible_from_split(t.split())
    recs = als.recommend_for(model, users, n=TOP_N, seen=train)
    return evaluate.metric_report("als", recs, als.predict(model, test), test, users, t.items(), vectors, t.interactions())


@query("als_eval", reuse=True)
def _als_eval(t: Tables) -> DataFrame:
    return _als_metrics(t, _content_model(t).vectors)


@query("recommend_als", reuse=True)
def _recommend_als(t: Tables) -> DataFrame:
    return recommend.recommend_als(_als_model(t), t.interactions(), t.items(), n=TOP_N)


@query("compare_algorithms", reuse=True)
def _compare_algorithms(t: Tables) -> DataFrame:
    a = als.recommend_all(_als_model(t), n=TOP_N)
    c = recommend.content_recs_top_item(t.interactions(), _similar_to_top(t), n=TOP_N)
    both = recommend.compare_algorithms(a, c, t.interactions().select("user_id"))
    return both.withColumns({name: F.array_join(F.transform(name, lambda i: i.cast("string")), "|")
                             for name in ("als_items", "content_items")})


def _content_metrics(t: Tables, m: content.ContentModel) -> DataFrame:
    train, test = _train_test(t)
    sim = cut_lineage(similarity.similar_items(m.vectors, n=N_SIMILAR, n_items=m.n_items))
    recs = recommend.content_recs_liked(train, sim, n=N_SIMILAR)
    return evaluate.metric_report("content_based", recs, evaluate.content_predictions(train, test, sim), test,
                                  evaluate.eligible_from_split(t.split()), t.items(), m.vectors, t.interactions())


@query("content_metric_report", with_tables("""
    SELECT 'content_based' AS algorithm, metric, CAST(value AS DOUBLE) AS value FROM (
        SELECT 'rmse' AS metric, rmse AS value FROM reg UNION ALL SELECT 'mae', mae FROM reg
        UNION ALL SELECT 'precision', precision FROM rk UNION ALL SELECT 'recall', recall FROM rk
        UNION ALL SELECT 'f1', f1 FROM rk UNION ALL SELECT 'coverage', coverage FROM cov
        UNION ALL SELECT 'diversity', diversity FROM div UNION ALL SELECT 'novelty', novelty FROM nov)""",
    "interactions", "items", "train", "test", "neighbours", "vec", extra=[
        ("pred", _CONTENT_PRED), ("recs", _LIKED_RECS_SQL.format(ratings="train")),
        ("rel", "SELECT user_id, item_id FROM test WHERE rating >= 4.0"), ("elig", _ELIG),
        ("lists", "SELECT DISTINCT user_id, item_id FROM recs"), ("reg", _REG_SQL), ("rk", _RANKING_SQL),
        ("cov", _COVERAGE_SQL), ("div", _DIVERSITY_SQL), ("nov", _NOVELTY_SQL)]), reuse=True)
def _content_metric_report(t: Tables) -> DataFrame:
    """E14's rows of the content recommender, by value."""
    return _round_cols(_content_metrics(t, _content_model(t)), ["value"])


@query("algorithm_comparison", reuse=True)
def _algorithm_comparison(t: Tables) -> DataFrame:
    """metrics(algorithm, metric, value) for both recommenders, all computed."""
    m = _content_model(t)
    return _als_metrics(t, m.vectors).unionByName(_content_metrics(t, m))


@query("compare_content_lists", with_tables("""
    SELECT u.user_id, coalesce(a.l, '') AS liked_items, coalesce(b.l, '') AS top_item_items,
           CAST(coalesce(a.n, 0) AS INTEGER) AS n_liked, CAST(coalesce(b.n, 0) AS INTEGER) AS n_top_item,
           round(CASE WHEN coalesce(a.n, 0) + coalesce(b.n, 0) = 0 THEN 0.0
                      ELSE coalesce(c.n, 0) / (coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(c.n, 0)) END, 6) AS jaccard
    FROM (SELECT DISTINCT user_id FROM interactions) u
    LEFT JOIN (SELECT user_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), '|' ORDER BY rank) AS l FROM recs GROUP BY user_id) a
      ON a.user_id = u.user_id
    LEFT JOIN (SELECT user_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), '|' ORDER BY rank) AS l FROM top_recs GROUP BY user_id) b
      ON b.user_id = u.user_id
    LEFT JOIN (SELECT x.user_id, count(*) AS n FROM recs x JOIN top_recs y ON x.user_id = y.user_id AND x.item_id = y.item_id
               GROUP BY x.user_id) c ON c.user_id = u.user_id""", "interactions", "user_top", "neighbours",
    extra=[("recs", _LIKED_RECS_SQL.format(ratings="interactions")),
           ("top_recs", "SELECT u.user_id, s.item_id, s.rank FROM user_top u JOIN neighbours s ON u.item_id = s.seed_id")]), reuse=True)
def _compare_content_lists(t: Tables) -> DataFrame:
    """U2's report by value, on the two content lists of every user."""
    sim = cut_lineage(_similar(t))
    a = recommend.content_recs_liked(t.interactions(), sim, n=N_SIMILAR)
    b = recommend.content_recs_top_item(t.interactions(), sim, n=N_SIMILAR)
    both = recommend.compare_algorithms(a, b, t.interactions().select("user_id"))
    joined = {name: F.array_join(F.transform(old, lambda i: i.cast("string")), "|")
              for name, old in (("liked_items", "als_items"), ("top_item_items", "content_items"))}
    return both.withColumns(joined).select("user_id", *joined, F.col("n_als").alias("n_liked"), F.col("n_content").alias("n_top_item"),
                                           F.round("jaccard", 6).alias("jaccard"))


# ---------------------------------------------------------------- second corpus: documents

_DOC_TOKS = r"""
    SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)
    WHERE term NOT IN (SELECT term FROM stop_words) GROUP BY doc_id, term"""


def _document_terms(t: Tables) -> DataFrame:
    from recsift.sources.tables import raw

    from recsift.session import spread

    docs = spread(raw(t.spark, t.sf_dir, "documents").select("doc_id", "text"))
    return content.document_terms(docs, id_col="doc_id", text_col="text")


@query("document_terms", with_tables("SELECT doc_id, term, tf FROM doc_toks", "stop_words",
                                     extra=[("doc_toks", _DOC_TOKS)]))
def _document_terms_q(t: Tables) -> DataFrame:
    return _document_terms(t)


@query("document_vocabulary", with_tables("""
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf_total,
           round(ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1, 9) AS idf
    FROM doc_toks GROUP BY term""", "stop_words",
    extra=[("doc_toks", _DOC_TOKS)]))
def _document_vocabulary(t: Tables) -> DataFrame:
    from recsift.sources.tables import raw

    n_docs = content.count_docs(raw(t.spark, t.sf_dir, "documents"))
    terms = _document_terms(t).withColumnRenamed("doc_id", "item_id")
    v = content.vocabulary(terms, n_docs, None)
    return v.select("term", "df", "tf_total", F.round("idf", 9).alias("idf"))


DOC_SEARCH_TEXT = "license"


@query("search_documents", with_tables(f"""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE text IS NOT NULL AND contains(lower(text), '{DOC_SEARCH_TEXT}') ORDER BY doc_id LIMIT 10"""))
def _search_documents(t: Tables) -> DataFrame:
    """F8/U3 on the second corpus: whole texts searched case-insensitively, first 10 by id."""
    from recsift.sources.tables import raw

    docs = raw(t.spark, t.sf_dir, "documents").withColumnRenamed("doc_id", "item_id").withColumnRenamed("text", "title")
    hits = lookup.search_titles(docs.select("item_id", "title", "lang", "n_chars"), DOC_SEARCH_TEXT, limit=10)
    return hits.select(F.col("item_id").alias("doc_id"), "lang", "n_chars")


@query("similar_items_padded", with_tables("""
    SELECT seed_id, item_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
        SELECT a.item_id AS seed_id, b.item_id, coalesce(s.similarity, 0.0) AS similarity,
               row_number() OVER (PARTITION BY a.item_id
                                  ORDER BY coalesce(s.similarity, 0.0) DESC, b.item_id) AS rank
        FROM items a JOIN items b ON a.item_id <> b.item_id
        LEFT JOIN (SELECT seed_id, item_id, similarity FROM neighbours) s
          ON s.seed_id = a.item_id AND s.item_id = b.item_id)
    WHERE rank <= 10""", "items", "neighbours"))
def _similar_items_padded(t: Tables) -> DataFrame:
    """T6 as the reference ranks it: the whole catalogue, zero similarity padding short lists."""
    return similarity.pad_with_zero(cut_lineage(_similar(t)), t.items(), n=N_SIMILAR)


# ---------------------------------------------------------------- files, saved models and stored lists

from recsift.session import new_path  # noqa: E402
from recsift.sources import csv as files  # noqa: E402
from recsift.sources import store  # noqa: E402


def _as_files(t: Tables, *names: str) -> str:
    """The named canonical tables, whole, as CSV files in a new folder."""
    folder = new_path(t.spark)
    files.write_folder({n: df for n, df in _canonical(t) if n in names}, folder)
    return folder


@query("serving_sample", with_tables(f"SELECT user_id, item_id, rating, ts FROM interactions WHERE {_HASH} % 1000 < 200",
                                     "interactions"))
def _serving_sample(t: Tables) -> DataFrame:
    """The ratings file as it is read for serving, with a reproducible fifth of its rows."""
    ratings = files.read_ratings(t.spark, f"{_as_files(t, 'interactions')}/rating.csv")
    return clean.sample_hash(ratings, 0.2, portable=True).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("csv_items", with_tables(
    "SELECT item_id, title, array_to_string(genres, '|') AS genres, CAST(len(genres) AS INTEGER) AS n_genres, year FROM items",
    "items"))
def _csv_items(t: Tables) -> DataFrame:
    """S2 and the writer: the catalogue through its CSV file."""
    i = files.read_movies(t.spark, f"{_as_files(t, 'items')}/movie.csv")
    return i.select("item_id", "title", F.array_join("genres", "|").alias("genres"), F.size("genres").alias("n_genres"), "year")


@query("csv_tags", with_tables("SELECT user_id, item_id, tag, ts FROM tags", "tags"))
def _csv_tags(t: Tables) -> DataFrame:
    """S3 and the writer: the tags through their CSV file."""
    return files.read_tags(t.spark, f"{_as_files(t, 'tags')}/tag.csv").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("csv_folder_duplicates", ORACLE["profile_duplicates"])
def _csv_folder_duplicates(t: Tables) -> DataFrame:
    """S1-S5 together: all five files of a folder, read back and profiled."""
    return clean.duplicate_report(list(files.read_folder(t.spark, _as_files(t, *_CANONICAL)).items()))


@query("ingest_counts", with_tables("""
    SELECT 'ok' AS reason, count(rating) AS n_rows FROM gappy
    UNION ALL SELECT 'no rating', count(*) - count(rating) FROM gappy""", "gappy"))
def _ingest_counts(t: Tables) -> DataFrame:
    """S1 with quarantine: a ratings file with gaps, every line kept or put aside with its reason."""
    folder = new_path(t.spark)
    files.write_folder({"interactions": t.gappy()}, folder)
    return files.ingest(t.spark, "ratings", f"{folder}/rating.csv", f"{folder}/ingested").counts


@query("preview_interactions", with_tables(
    "SELECT user_id, item_id, rating, ts FROM interactions ORDER BY user_id, item_id LIMIT 5", "interactions"))
def _preview_interactions(t: Tables) -> DataFrame:
    """The first five rows in a fixed order (the limit is the feature)."""
    return clean.preview(t.interactions(), ["user_id", "item_id"])


@query("rating_distribution_text", with_tables("""
    SELECT printf('%.2f', rating) AS rating, count(*) AS n_ratings,
           printf('%.2f', round(100.0 * count(*) / (SELECT count(rating) FROM interactions), 2)) || ' %' AS share
    FROM interactions WHERE rating IS NOT NULL GROUP BY interactions.rating""", "interactions"))
def _rating_distribution_text(t: Tables) -> DataFrame:
    return stats.rating_distribution_text(t.interactions())


@query("saved_content_model", with_tables("SELECT seed_id, item_id, similarity, rank FROM neighbours", "neighbours"))
def _saved_content_model(t: Tables) -> DataFrame:
    """Neighbours from a content model that was saved and loaded."""
    path = new_path(t.spark)
    _content_model(t).save(path)
    return similarity.similar_items(content.ContentModel.load(t.spark, path).vectors, n=N_SIMILAR)


@query("saved_als_model", with_tables("""
    SELECT user_id, item_id, rating, true AS same FROM test
    WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""", "train", "test"), reuse=True)
def _saved_als_model(t: Tables) -> DataFrame:
    """A saved and loaded model scores the same pairs, each with the same number, as the fitted one."""
    train, test = _train_test(t)
    model, path = als.fit_als(train, **ALS_PARAMS), new_path(t.spark)
    als.save_model(model, path)
    fitted = als.predict(model, test).select("user_id", "item_id", F.col("prediction").alias("fitted"))
    loaded = als.predict(als.load_model(path), test)
    return loaded.join(fitted, ["user_id", "item_id"], "full").select(
        "user_id", "item_id", "rating", F.coalesce(F.col("fitted") == F.col("prediction"), F.lit(False)).alias("same"))


@query("stored_lists", with_tables("""
    SELECT 'liked' AS algorithm, user_id, item_id, rank, similarity AS score FROM liked_recs
    UNION ALL SELECT 'top item', u.user_id, s.item_id, s.rank, s.similarity
    FROM user_top u JOIN neighbours s ON u.item_id = s.seed_id""", "interactions", "user_top", "neighbours",
    extra=[("liked_recs", _LIKED_RECS_SQL.format(ratings="interactions"))]), reuse=True)
def _stored_lists(t: Tables) -> DataFrame:
    """Two algorithms' lists in one store; writing one of them again leaves the other as it is."""
    sim, path = cut_lineage(_similar(t)), new_path(t.spark)
    top = recommend.content_recs_top_item(t.interactions(), sim, n=N_SIMILAR)
    liked = recommend.content_recs_liked(t.interactions(), sim, n=N_SIMILAR)
    for name, recs in (("liked", top), ("top item", top), ("liked", liked)):  # the last replaces the first
        store.write_recs(recs.select("user_id", "item_id", "rank", F.col("similarity").alias("score")), path, name)
    return store.read_recs(t.spark, path).select("algorithm", "user_id", "item_id", "rank", "score")
