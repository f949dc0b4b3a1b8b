"""Running statistics over a stream of rating files equal the batch statistics."""

import datetime as dt
import tempfile

from recsift.operators import stats
from recsift.streaming import ratings as R


def test_running_stats_match_batch(spark):
    folder = tempfile.mkdtemp(prefix="recsift-stream-in-")
    ckpt = tempfile.mkdtemp(prefix="recsift-stream-ckpt-")
    ts = dt.datetime(2020, 1, 1)
    rows = [(u, u % 3, float(1 + (u * 7) % 9) / 2, ts) for u in range(30)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts timestamp")
    df.limit(15).write.mode("append").parquet(folder)
    q = R.start_running_stats(spark, folder, ckpt, "running_item_stats")
    try:
        q.processAllAvailable()
        df.subtract(df.limit(15)).write.mode("append").parquet(folder)
        q.processAllAvailable()
        got = {r.item_id: r for r in spark.table("running_item_stats").collect()}
    finally:
        q.stop()
    want = {r.item_id: r for r in stats.item_stats(spark.read.parquet(folder)).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        assert got[k].rating_count == w.rating_count
        assert abs(got[k].rating_mean - w.rating_mean) < 1e-9
        assert abs(got[k].rating_stddev - w.rating_stddev) < 1e-9


def test_running_user_stats(spark):
    folder = tempfile.mkdtemp(prefix="recsift-stream-in-")
    ckpt = tempfile.mkdtemp(prefix="recsift-stream-ckpt-")
    ts = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([(1, 1, 4.0, ts), (1, 2, 2.0, ts), (2, 1, 5.0, ts)],
                               "user_id long, item_id long, rating double, ts timestamp")
    df.write.mode("append").parquet(folder)
    q = R.start_running_stats(spark, folder, ckpt, "running_user_stats", key="user_id")
    try:
        q.processAllAvailable()
        got = {r.user_id: (r.rating_count, r.rating_mean, r.rating_stddev)
               for r in spark.table("running_user_stats").collect()}
    finally:
        q.stop()
    assert got[1][0] == 2 and got[1][1] == 3.0 and abs(got[1][2] - 2 ** 0.5) < 1e-12
    assert got[2] == (1, 5.0, None)
