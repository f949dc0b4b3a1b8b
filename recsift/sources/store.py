"""Persisting models and recommendation lists.

ALS models use Spark ML's own writer (``operators.als.save_model``); the
content model is two Parquet tables (``operators.content.ContentModel``);
recommendation lists are written partitioned by algorithm so that one
algorithm's lists can be read (or replaced) without touching the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_recs(recs: DataFrame, path: str, algorithm: str | None = None, fmt: str = "parquet") -> None:
    """Write (user_id, item_id, rank, score, algorithm) lists."""
    out = recs if algorithm is None else recs.withColumn("algorithm", F.lit(algorithm))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("algorithm").format(fmt).save(path))


def read_recs(spark: SparkSession, path: str, algorithm: str | None = None, fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).load(path)
    return df.where(F.col("algorithm") == algorithm) if algorithm else df
