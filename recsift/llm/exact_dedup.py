"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table ``(digest, keep_id)`` bucketed and sorted by the
SHA-256 digest of the normalised text, at a path that outlives the session.
A batch is reduced to one row per digest (partial aggregation before the
shuffle, so a text that fills a third of the batch costs one row per task),
anti-joined with the index by sort-merge (the index side is read in its
buckets, without a shuffle), and the digests that are new are appended.

Defined results
  * NULL text counts as the empty text; letters A-Z are lower-cased, nothing else.
  * Of equal texts the row with the largest ``doc_id`` stays; a text that the
    index already holds stays with the document indexed first.
  * A NULL ``doc_id`` loses to any other; in a group of NULL ids only, all rows
    share the decision.  Rows that repeat both ``doc_id`` and text are one
    document: ``resolve`` returns each with the same decision,
    ``deduplicate`` returns it once.
  * Running a batch again (after a failure) gives the same result: its digests
    are found in the index with their own ``doc_id``.
  * An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.llm.common import materialise, new_path, text_or_empty, unused
from recsift.sources.csv import _exists

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_digest(name: str = "text") -> Column:
    """Lower-case hex SHA-256 of the normalised text (UTF-8)."""
    return F.sha2(F.translate(text_or_empty(name), UPPER, UPPER.lower()), 256)


class DigestIndex:
    """A digest index at ``path``.

    The number of buckets is stored with a new index (64 unless given) and read
    from an old one; asking for another number than the stored one raises.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        note = f"{path}/_buckets"  # Spark's scans of the table pass over it
        if _exists(spark, note):
            self.buckets = spark.read.parquet(note).first()[0]
            if buckets is not None and buckets != self.buckets:
                raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        else:
            self.buckets = buckets or 64
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(note)
        self.name = "recsift_digests_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        """Add ``(digest, keep_id)`` rows, one sorted file per bucket."""
        (fresh.select("digest", "keep_id").repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.name))


def resolve(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256).

    ``group_size`` counts the rows of this batch that have the text.
    """
    rows = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   text_digest().alias("text_sha256")), "digests")
    groups = materialise(rows.groupBy(F.unhex("text_sha256").alias("digest"))
                         .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    index.append(groups.hint("merge").join(index.table(), "digest", "left_anti"))
    keepers = groups.drop("keep_id").hint("merge").join(index.table(), "digest").select(
        F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "group_size")
    # Both sides are shuffled for this join alone, so AQE may split a hot text.
    return rows.join(keepers, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The kept (id, digest) pairs are joined back by one key; rows that repeat
    it are combined before the shuffle, and the same shuffle serves both.
    """
    name = unused(docs, "dedup_key")

    def key(digest: Column) -> Column:
        return F.concat_ws(":", digest, F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))

    kept = resolve(docs, index).where("kept").select(key(F.col("text_sha256")).alias(name)).distinct()
    return (docs.withColumn(name, key(text_digest())).dropDuplicates([name])
            .hint("merge").join(kept, name, "left_semi").select(*docs.columns))


def temporary_index(spark: SparkSession) -> DigestIndex:
    """A new, empty index in the shared folder."""
    return DigestIndex(spark, new_path(spark, "index"))
