"""Canonical tables derived from the driver's Parquet tables.

Each adapter is a lazy DataFrame plan over ``spark.read.parquet`` so that
column pruning and filters reach the scan.  The derivations are fixed by
FIXTURES.md; the SQL oracle uses the same definitions (``plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.functions.text import split_genres, year_from_title


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem")
    od = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"])


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, item); ratings 0.5 .. 5.0 in half steps."""
    return (
        _order_lines(spark, sf_dir)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg((F.ceil(F.avg("l_quantity") / F.lit(5.0)) / F.lit(2.0)).cast("double").alias("rating"),
             F.max("o_orderdate").alias("ts"))
    )


def items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title, genres) with genres still a ``|``-joined string."""
    p = raw(spark, sf_dir, "part")
    title = F.when(p["p_partkey"] % 7 == 0, p["p_name"]).otherwise(
        F.concat(p["p_name"], F.lit(" ("), (F.lit(1970) + p["p_size"]).cast("string"), F.lit(")")))
    genres = F.concat(p["p_type"], F.lit("|"), F.regexp_replace(p["p_brand"], "#", ""))
    return p.select(p["p_partkey"].alias("item_id"), title.alias("title"), genres.alias("genres"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical items: genres split to an array, year taken from the title."""
    r = items_raw(spark, sf_dir)
    return r.select("item_id", "title", split_genres(F.col("genres")).alias("genres"),
                    year_from_title(F.col("title")).alias("year"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ol = _order_lines(spark, sf_dir).where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    return ol.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                     F.lower("o_orderpriority").alias("tag"), F.col("o_orderdate").alias("ts"))


def tag_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("tag_id"))
            .agg(F.round(F.avg("l_discount") * 10, 6).alias("relevance")))


def tag_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = raw(spark, sf_dir, "supplier")
    return s.select(s["s_suppkey"].alias("tag_id"), F.regexp_replace("s_name", "#", "").alias("tag"))


def split_hash(inter: DataFrame, train_share: int = 8) -> DataFrame:
    """Portable 80/20 split by a fixed hash of (user, item); no shuffle."""
    from recsift.operators.clean import hash_bucket

    h = hash_bucket("user_id", "item_id") % 10
    return inter.withColumn("split", F.when(h < train_share, "train").otherwise("test"))


def interactions_gappy(inter: DataFrame) -> DataFrame:
    """About a tenth of the ratings set to NULL (profiling / imputation input)."""
    gap = (F.pmod(F.col("user_id"), F.lit(10)) + F.pmod(F.col("item_id"), F.lit(10))) % 10 == 0
    return inter.select("user_id", "item_id",
                        F.when(~gap, F.col("rating")).alias("rating"), "ts")


class Tables:
    """Lazily built canonical tables for one data folder.

    With ``reuse=True`` the interactions table, which multi-step jobs read
    several times with different projections (so Spark cannot share the
    exchanges), is written once to the shared checkpoint folder and read back
    by every later use in the job.  It is bucketed and sorted by (user, item), so
    that anti joins with seen pairs and joins of predictions with ratings need no
    exchange of the ratings; no pair holds many rows, so buckets are even however
    heavy a user is.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, reuse: bool = False):
        self.spark, self.sf_dir, self.reuse = spark, sf_dir, reuse
        self._interactions: DataFrame | None = None

    def interactions(self) -> DataFrame:
        if not self.reuse:
            return interactions(self.spark, self.sf_dir)
        if self._interactions is None:
            from recsift.session import cut_bucketed

            self._interactions = cut_bucketed(interactions(self.spark, self.sf_dir), ["user_id", "item_id"])
        return self._interactions

    def items(self) -> DataFrame:
        return items(self.spark, self.sf_dir)

    def items_raw(self) -> DataFrame:
        return items_raw(self.spark, self.sf_dir)

    def tags(self) -> DataFrame:
        return tags(self.spark, self.sf_dir)

    def tag_scores(self) -> DataFrame:
        return tag_scores(self.spark, self.sf_dir)

    def tag_names(self) -> DataFrame:
        return tag_names(self.spark, self.sf_dir)

    def split(self) -> DataFrame:
        return split_hash(self.interactions())

    def gappy(self) -> DataFrame:
        return interactions_gappy(self.interactions())


def materialize(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Write the canonical tables once as Parquet (a shared folder on a cluster)."""
    t = Tables(spark, sf_dir)
    out = {}
    for name, df in [("interactions", t.interactions()), ("items", t.items()), ("tags", t.tags()),
                     ("tag_scores", t.tag_scores()), ("tag_names", t.tag_names())]:
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = path
    return out
