"""Spark session defaults and the checkpoint folder.

Library functions never create a session; they take one.  ``get_session`` is a
convenience for scripts and tests.  On a cluster the session is built by the
platform and only ``ensure_checkpoint_dir`` is used: it reads
``spark.checkpoint.dir`` from the session and sets a folder of its own only for
local masters (tests, the bench), never a machine-local folder on a cluster.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "recsift",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if _is_local(spark):
        folder = tempfile.mkdtemp(prefix="recsift-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir()
    return None


_RUN: ContextVar[tuple[str, list[str]] | None] = ContextVar("recsift_run", default=None)


def current_run() -> str | None:
    """The folder of the run that is open, None outside a ``run_folder``."""
    run = _RUN.get()
    return run[0] if run else None


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own, in the shared checkpoint folder, for all intermediate tables written inside.

    It is deleted at the end, also after a failure, so write or collect results
    before that: frames that were returned lazily read from it.  Runs may be nested.
    """
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{folder.rstrip('/')}/recsift-run-{uuid.uuid4().hex}"
    tables: list[str] = []
    token = _RUN.set((path, tables))
    try:
        yield path
    finally:
        _RUN.reset(token)
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Later reads keep column pruning and pushdown, and a lost executor costs a
    re-read.  A cluster that names no folder raises: going on would recompute
    the frame for every reader.
    """
    spark = df.sparkSession
    path = new_path(spark)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The jobs inside delete their shuffle files when they end, not when the driver's JVM next collects garbage.

    For writes whose result is read back from files: nobody reads their shuffles again.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    if before == "true":  # also where another thread's write is open
        yield
        return
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def new_path(spark: SparkSession) -> str:
    """A path for an intermediate table: in the open run's folder, else in the shared one."""
    folder = current_run() or ensure_checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{folder}/recsift-{uuid.uuid4().hex}"


def cut_bucketed(df, keys: list[str], buckets: int | None = None):
    """Like ``cut_lineage``, as a table bucketed and sorted by ``keys``.

    A join or grouping on exactly these keys needs no exchange on this side.
    Choose keys of which none holds many rows (such as user and item together):
    a bucket is one task.  ``buckets``: the session's shuffle partitions unless given.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark)
    name = "recsift_" + uuid.uuid4().hex
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {n} BUCKETS "
              f"LOCATION '{path}'")
    if _RUN.get():
        _RUN.get()[1].append(name)
    with shuffles_freed(spark):
        df.repartition(n, *keys).sortWithinPartitions(*keys).write.insertInto(name)
    return spark.table(name)


def spread(df):
    """Round-robin a scan over the cores when it arrives in fewer partitions
    than there are cores (e.g. one large row group) and the next step is
    CPU-heavy per row (tokenising whole texts).  A no-op for tables that
    already scan in many splits, as they do at cluster scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
