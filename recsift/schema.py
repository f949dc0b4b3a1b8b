"""Canonical table schemas and column names.

Ids are BIGINT in tables; they are narrowed to INT only at the ALS boundary.
"""

from pyspark.sql import types as T

USER, ITEM, RATING, TS = "user_id", "item_id", "rating", "ts"
TITLE, GENRES, YEAR = "title", "genres", "year"
TAG, TAG_ID, RELEVANCE = "tag", "tag_id", "relevance"
SCORE, RANK, ALGORITHM = "score", "rank", "algorithm"

INTERACTIONS = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(ITEM, T.LongType()),
    T.StructField(RATING, T.DoubleType()),
    T.StructField(TS, T.TimestampType()),
])

ITEMS = T.StructType([
    T.StructField(ITEM, T.LongType()),
    T.StructField(TITLE, T.StringType()),
    T.StructField(GENRES, T.ArrayType(T.StringType())),
    T.StructField(YEAR, T.IntegerType()),
])

TAGS = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(ITEM, T.LongType()),
    T.StructField(TAG, T.StringType()),
    T.StructField(TS, T.TimestampType()),
])

TAG_SCORES = T.StructType([
    T.StructField(ITEM, T.LongType()),
    T.StructField(TAG_ID, T.LongType()),
    T.StructField(RELEVANCE, T.DoubleType()),
])

TAG_NAMES = T.StructType([
    T.StructField(TAG_ID, T.LongType()),
    T.StructField(TAG, T.StringType()),
])

RECS = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(ITEM, T.LongType()),
    T.StructField(RANK, T.IntegerType()),
    T.StructField(SCORE, T.DoubleType()),
    T.StructField(ALGORITHM, T.StringType()),
])

# Raw CSV layouts (header names as written in the files).
RATINGS_CSV = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])
MOVIES_CSV = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])
TAGS_CSV = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
GENOME_SCORES_CSV = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("tagId", T.LongType()),
    T.StructField("relevance", T.DoubleType()),
])
GENOME_TAGS_CSV = T.StructType([
    T.StructField("tagId", T.LongType()),
    T.StructField("tag", T.StringType()),
])
