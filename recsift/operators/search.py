"""Literal title search through a trigram table.

Every title is listed under its different trigrams (three characters of the
lower-cased text).  A title that holds the searched text holds all of its
trigrams, so the rarest of them name few candidates, and every candidate's
title is checked.  The table is range-partitioned and sorted by (trigram, id): a
lookup reads the row groups whose statistics admit the trigram, and a trigram that
a third of all titles hold spans as many files as it needs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.functions.text import contains_ci
from recsift.session import cut_lineage, new_path

GRAM = 3
#: Trigrams whose candidates are intersected before titles are read.
PROBES = 3
#: Titles whose trigrams a task holds while the table is built.
TITLES_PER_TASK = 50_000


@dataclass(frozen=True)
class TitleIndex:
    """``grams`` (gram, item_id), ``sizes`` (gram, n) and ``titles`` (the items' columns) as Parquet under ``path``."""

    spark: SparkSession
    path: str

    @classmethod
    def build(cls, items: DataFrame, path: str | None = None) -> "TitleIndex":
        """``items`` has item_id and title; further columns come back with the hits.  NULL titles are never found."""
        spark = items.sparkSession
        index = cls(spark, path or new_path(spark))
        known = items.where(F.col("title").isNotNull() & F.col("item_id").isNotNull())
        (known.repartitionByRange("item_id").sortWithinPartitions("item_id").write.parquet(f"{index.path}/titles"))
        # Spread before the trigrams are made: a scan of few large splits would hold those of millions of titles in a task.
        known = index._table("titles").select("item_id", "title")
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(known.count() / TITLES_PER_TASK))
        known = known.repartition(tasks, "item_id")
        chars = F.regexp_extract_all(F.lower("title"), F.lit("(?s)."), F.lit(0))  # one pass, whole characters
        grams = F.when(F.size("c") >= GRAM, F.transform(F.sequence(F.lit(0), F.size("c") - GRAM), lambda i: F.concat(
            *[F.get(F.col("c"), i + k) for k in range(GRAM)])))
        rows = known.select("item_id", chars.alias("c")).select("item_id", F.explode(F.array_distinct(grams)).alias("gram"))
        rows = cut_lineage(rows.select("gram", "item_id").distinct())  # the range partitioning reads them twice
        (rows.repartitionByRange(tasks, "gram", "item_id").sortWithinPartitions("gram", "item_id")
         .write.parquet(f"{index.path}/grams"))
        sizes = spark.read.parquet(f"{index.path}/grams").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        sizes.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{index.path}/sizes")
        return index

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def search(self, text: str, limit: int | None = 10) -> DataFrame:
        """The rows whose title holds ``text``, case-insensitively, first ``limit`` by id; the same as
        ``lookup.search_titles``.  Texts shorter than a trigram are searched in all titles."""
        needle = text.lower()
        titles = self._table("titles")
        grams = sorted({needle[i:i + GRAM] for i in range(len(needle) - GRAM + 1)})
        if grams:
            sizes = {r.gram: r.n for r in self._table("sizes").where(F.col("gram").isin(grams)).collect()}  # a row per trigram
            ids = None
            for gram in sorted(grams, key=lambda g: (sizes.get(g, 0), g))[:PROBES]:
                one = self._table("grams").where(F.col("gram") == gram).select("item_id")
                ids = one if ids is None else ids.join(one, "item_id", "left_semi")
            titles = titles.join(ids, "item_id", "left_semi")
        hits = titles.where(contains_ci(F.col("title"), text)).orderBy("item_id")
        return hits.limit(limit) if limit is not None else hits
