"""The registry loads without a JVM, also when PySpark comes from pyspark.zip."""

import glob
import os
import subprocess
import sys

import pyspark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import pyspark
import __spark_entry__ as e
assert pyspark.__file__.count("pyspark.zip") == {zipped}, pyspark.__file__
from pyspark import SparkContext
q, o = e.queries(), e.oracle_sql()
assert SparkContext._active_spark_context is None
assert len(q) >= 70 and set(o) <= set(q)
print("NAMES", len(q), len(o))
"""


def _run(path: list[str], zipped: int) -> None:
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([*path, REPO]))
    out = subprocess.run([sys.executable, "-c", CODE.format(zipped=zipped)], env=env, cwd="/", capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 0 and "NAMES" in out.stdout, out.stderr[-2000:]


def test_registry_without_session():
    _run([], 0)


def test_registry_from_zip():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = glob.glob(lib + "/pyspark.zip") + glob.glob(lib + "/py4j-*.zip")
    assert len(zips) == 2
    _run(zips, 1)


def test_stop_words_equal_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    from recsift.functions.stopwords import ENGLISH

    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")
