"""Running rating statistics over a stream of rating files.

The reference has no streaming; this is the batch item/user statistics (A3/A4)
kept up to date as new rating files land in a folder: a Structured Streaming
aggregation whose state is the per-key (count, sum, sum of squares), so mean
and sample stddev are exact at every trigger.  Checkpoints go to the folder
given by the caller (the cluster's shared checkpoint location).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift import schema as S


def read_rating_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(S.INTERACTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def running_stats(ratings: DataFrame, key: str = "item_id") -> DataFrame:
    """Per key: rating_count, rating_mean, rating_stddev (NULL for one rating)."""
    agg = ratings.where(F.col("rating").isNotNull()).groupBy(key).agg(
        F.count("rating").alias("rating_count"), F.sum("rating").alias("s"),
        F.sum(F.col("rating") * F.col("rating")).alias("q"))
    n = F.col("rating_count")
    var = (F.col("q") - F.col("s") * F.col("s") / n) / (n - 1)
    return agg.select(key, "rating_count", (F.col("s") / n).alias("rating_mean"),
                      F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("rating_stddev"))


def start_running_stats(spark: SparkSession, folder: str, checkpoint: str, query_name: str,
                        key: str = "item_id", sink: str = "memory", trigger_once: bool = False):
    """Start the streaming query (``update`` mode; ``complete`` for the memory sink)."""
    stats = running_stats(read_rating_stream(spark, folder), key)
    w = stats.writeStream.queryName(query_name).option("checkpointLocation", checkpoint)
    w = w.outputMode("complete" if sink == "memory" else "update").format(sink)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
