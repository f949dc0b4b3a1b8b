"""CSV readers and writer for the MovieLens-style files.

Explicit schemas (inference would read malformed rows and widen types), the
reference's read modes (``DROPMALFORMED`` for ratings and movies, permissive
for the rest), renaming to canonical columns, and ``try_cast`` for text
fields so that ANSI mode does not abort a whole job on one bad value.

With ``DROPMALFORMED`` Spark's CSV column pruning lets ``count()`` see rows
that ``collect()`` drops; the readers turn pruning off for their own reads
(option ``columnPruning``) so the two agree.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsift import schema as S
from recsift.functions.text import GENRE_SEPARATOR, split_genres, year_from_title


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything on the file system that Spark would read it from."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(path)
    return bool(found.getFileSystem(conf).globStatus(found))


def _missing(spark: SparkSession, path: str, empty_schema, on_missing: str) -> DataFrame | None:
    if _exists(spark, path):
        return None
    if on_missing == "empty":
        return spark.createDataFrame([], empty_schema)
    raise FileNotFoundError(path)


def _reader(spark: SparkSession, csv_schema, mode: str):
    return (spark.read.schema(csv_schema).option("header", "true").option("mode", mode)
            .option("columnPruning", "false"))


def _timestamp(c) -> F.Column:
    """Text timestamps or epoch seconds, both accepted; bad text -> NULL."""
    epoch = F.when(c.rlike(r"^\s*-?\d+\s*$"), F.timestamp_seconds(F.trim(c).try_cast("bigint")))
    return F.coalesce(epoch, F.try_to_timestamp(c))


def _canonical(kind: str) -> list:
    """The canonical columns of a file's own columns."""
    user, item = F.col("userId").alias(S.USER), F.col("movieId").alias(S.ITEM)
    ts = _timestamp(F.col("timestamp")).alias(S.TS)
    return {
        "ratings": [user, item, F.col("rating").cast("double").alias(S.RATING), ts],
        "movies": [item, F.col("title").alias(S.TITLE), split_genres(F.col("genres")).alias(S.GENRES),
                   year_from_title(F.col("title")).alias(S.YEAR)],
        "tags": [user, item, F.col("tag").alias(S.TAG), ts],
        "genome_scores": [item, F.col("tagId").alias(S.TAG_ID), F.col("relevance").alias(S.RELEVANCE)],
        "genome_tags": [F.col("tagId").alias(S.TAG_ID), F.col("tag").alias(S.TAG)],
    }[kind]


def _read(spark: SparkSession, kind: str, path: str, empty_schema, mode: str, on_missing: str) -> DataFrame:
    empty = _missing(spark, path, empty_schema, on_missing)
    if empty is not None:
        return empty
    return _reader(spark, _LAYOUTS[kind][0], mode).csv(path).select(*_canonical(kind))


def read_ratings(spark: SparkSession, path: str, on_missing: str = "raise") -> DataFrame:
    return _read(spark, "ratings", path, S.INTERACTIONS, "DROPMALFORMED", on_missing)


def read_movies(spark: SparkSession, path: str, on_missing: str = "raise") -> DataFrame:
    return _read(spark, "movies", path, S.ITEMS, "DROPMALFORMED", on_missing)


def read_tags(spark: SparkSession, path: str, on_missing: str = "raise") -> DataFrame:
    return _read(spark, "tags", path, S.TAGS, "PERMISSIVE", on_missing)


def read_genome_scores(spark: SparkSession, path: str, on_missing: str = "raise") -> DataFrame:
    return _read(spark, "genome_scores", path, S.TAG_SCORES, "PERMISSIVE", on_missing)


def read_genome_tags(spark: SparkSession, path: str, on_missing: str = "raise") -> DataFrame:
    return _read(spark, "genome_tags", path, S.TAG_NAMES, "PERMISSIVE", on_missing)


@dataclass(frozen=True)
class Ingested:
    """``kept``: canonical rows; ``quarantine``: (record, reason) of the lines that were not kept;
    ``counts``: (reason, n_rows), with "ok" for the kept ones."""

    kept: DataFrame
    quarantine: DataFrame
    counts: DataFrame


def ingest(spark: SparkSession, kind: str, path: str, out: str) -> Ingested:
    """S1-S5 without losing a line: every data line of the file is kept or quarantined with a reason.

    One scan of the file writes both sides as one Parquet table under ``out``,
    partitioned by reason, so that reading one side doesn't touch the other.
    Reasons: ``malformed`` (wrong number of fields, or a field of another type),
    ``no id``, and what the kind's own check finds.  A malformed record is the
    line as it stands in the file, another one its fields as JSON.  Empty lines
    are no records.  An existing table under ``out`` is replaced.
    """
    layout, keys, checks = _LAYOUTS[kind]
    marked = T.StructType([*layout.fields, T.StructField(CORRUPT, T.StringType())])
    df = (_reader(spark, marked, "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed")
    for key in keys:
        reason = reason.when(F.col(key).isNull(), "no id")
    for name, check in checks().items():
        reason = reason.when(check, name)
    reason = reason.otherwise(KEPT)
    fields = F.to_json(F.struct(*[f.name for f in layout.fields]))
    rows = df.withColumn("reason", reason).select(
        *_canonical(kind), F.when(F.col("reason") != KEPT, F.coalesce(F.col(CORRUPT), fields)).alias("record"), "reason")
    rows.write.mode("overwrite").partitionBy("reason").parquet(out)
    back = spark.read.schema(rows.schema).parquet(out)
    kept = back.where(F.col("reason") == KEPT).drop("record", "reason")
    return Ingested(kept, back.where(F.col("reason") != KEPT).select("record", "reason"),
                    back.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


CORRUPT, KEPT = "_corrupt_record", "ok"
# kind -> (layout of the file, ids that a row must have, further checks)
_LAYOUTS = {
    "ratings": (S.RATINGS_CSV, ("userId", "movieId"), lambda: {
        "no rating": F.col("rating").isNull() | F.isnan("rating"),
        "bad timestamp": F.col("timestamp").isNotNull() & _timestamp(F.col("timestamp")).isNull()}),
    "movies": (S.MOVIES_CSV, ("movieId",), lambda: {"no title": F.col("title").isNull()}),
    "tags": (S.TAGS_CSV, ("userId", "movieId"), lambda: {"no tag": F.col("tag").isNull()}),
    "genome_scores": (S.GENOME_SCORES_CSV, ("movieId", "tagId"), lambda: {"no relevance": F.col("relevance").isNull()}),
    "genome_tags": (S.GENOME_TAGS_CSV, ("tagId",), lambda: {"no tag": F.col("tag").isNull()}),
}


def read_folder(spark: SparkSession, folder: str, on_missing: str = "raise") -> dict[str, DataFrame]:
    """The five files of a MovieLens-style folder as canonical tables."""
    j = lambda n: os.path.join(folder, n)
    return {
        "interactions": read_ratings(spark, j("rating.csv"), on_missing),
        "items": read_movies(spark, j("movie.csv"), on_missing),
        "tags": read_tags(spark, j("tag.csv"), on_missing),
        "tag_scores": read_genome_scores(spark, j("genome_scores.csv"), on_missing),
        "tag_names": read_genome_tags(spark, j("genome_tags.csv"), on_missing),
    }


def _layout_columns(kind: str) -> list:
    """A file's own columns from the canonical ones."""
    def line(name: str):
        return F.regexp_replace(name, r"[\r\n]+", " ")

    user, item = F.col(S.USER).alias("userId"), F.col(S.ITEM).alias("movieId")
    ts = F.date_format(S.TS, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    return {
        "ratings": [user, item, F.col(S.RATING).alias("rating"), ts],
        "movies": [item, line(S.TITLE).alias("title"), line(F.array_join(S.GENRES, GENRE_SEPARATOR)).alias("genres")],
        "tags": [user, item, line(S.TAG).alias("tag"), ts],
        "genome_scores": [item, F.col(S.TAG_ID).alias("tagId"), F.col(S.RELEVANCE).alias("relevance")],
        "genome_tags": [F.col(S.TAG_ID).alias("tagId"), line(S.TAG).alias("tag")],
    }[kind]


# Canonical table -> (kind of its file, name of the file in a folder).
FILES = {"interactions": ("ratings", "rating.csv"), "items": ("movies", "movie.csv"), "tags": ("tags", "tag.csv"),
         "tag_scores": ("genome_scores", "genome_scores.csv"), "tag_names": ("genome_tags", "genome_tags.csv")}


def write_folder(tables: dict[str, DataFrame], folder: str) -> None:
    """Canonical tables in the files' layout, so that ``read_folder`` gives the same rows back.

    Every table is written by its own tasks, as a folder of part files with a header
    each under the file's name; the readers take such a folder for a file.  What the
    layout can't hold: a line break in a text becomes a blank (a record is a line), an
    empty text comes back as NULL, and so does an empty list of genres.  Blanks at the
    ends, quotes, commas and backslashes of a text come back.
    """
    for name, df in tables.items():
        kind, file = FILES[name]
        (df.select(*_layout_columns(kind)).write.mode("overwrite").option("header", "true")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(os.path.join(folder, file)))
