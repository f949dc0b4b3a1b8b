"""What a job leaves on the executors' disks while the session goes on."""

import re

from pyspark.sql import functions as F

from recsift.operators import als
from recsift.session import FREE_SHUFFLES, cut_bucketed, cut_lineage


def shuffles(spark) -> set[str]:
    """The ids of the shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {m[1] for n in names if (m := re.match(r"shuffle_(\d+)_.*\.data", n))}


def test_written_tables_leave_no_shuffles(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 97).alias("g"))
    before, conf = shuffles(spark), spark.conf.get(FREE_SHUFFLES)
    kept = cut_lineage(rows.groupBy("g").agg(F.sum("id").alias("s")).repartition(3, "s"))
    bucketed = cut_bucketed(rows, ["id", "g"], 4)
    assert not shuffles(spark) - before
    assert spark.conf.get(FREE_SHUFFLES) == conf
    assert kept.agg(F.sum("s")).first()[0] == bucketed.agg(F.sum("id")).first()[0] == 20_000 * 19_999 // 2


def test_fit_holds_the_shuffles_of_one_iteration(spark):
    rows = cut_lineage(spark.range(3000).select(
        (F.col("id") % 60).alias("user_id"), (F.xxhash64("id") % 40).alias("item_id"), (F.col("id") % 5 + 1.0).alias("rating")))
    before = shuffles(spark)
    model = als.fit_als(rows, rank=3, max_iter=10)
    assert len(shuffles(spark) - before) <= 8  # blocks, the last iteration; 22 and more with all of them
    apart = als.fit_als(rows, rank=3, max_iter=10, checkpoint_interval=10)
    assert {r.user_id: r.features for r in model.userFactors.collect()} == {r.user_id: r.features for r in apart.userFactors.collect()}
