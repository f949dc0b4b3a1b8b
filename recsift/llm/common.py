"""Helpers shared by the operators: the shared folder, materialised tables, column hygiene."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.session import current_run

#: Words as the contracts define them: runs of bytes other than blank and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


@functools.lru_cache(maxsize=None)
def _test_folder() -> str:
    path = tempfile.mkdtemp(prefix="recsift-llm-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a temporary folder serves for a single-JVM ``local``
    master (tests); any other master must name one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if sc.master == "local" or sc.master.startswith("local["):
        return _test_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def new_path(spark: SparkSession, tag: str) -> str:
    """A new path in the open run's folder (``session.run_folder`` deletes it at the end), else in the shared one."""
    return f"{current_run() or shared_folder(spark)}/recsift-{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts lineage so that an executor lost later costs a re-read, not a
    recomputation, and the next steps read only the columns they need.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(name: str = "text") -> Column:
    """Number of words of a whole text as LONG (NULL: 0)."""
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
