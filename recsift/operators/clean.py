"""Profiling, imputation, sampling and splitting.

Profiling runs as *one* aggregate per table (the reference ran one job per
column); imputation fits all means in one pass and applies them in one
projection.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsift.operators.numbering import unused
from recsift.session import cut_lineage

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FRACTIONAL = (T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def shape(df: DataFrame, name: str) -> DataFrame:
    """(table, n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def _is_missing(df: DataFrame, name: str):
    c = F.col(name)
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing) for every column, NaN counted for float/double.

    One aggregate over the table, then unpivoted on the one-row result.
    """
    counts = df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "missing")


def _digest(df: DataFrame):
    """128 bits of a row.  Equal rows have equal digests (-0.0 counts as 0.0); NULLs are told apart by place."""
    cols = [F.col(f.name) + F.lit(0).cast(f.dataType) if isinstance(f.dataType, FRACTIONAL) else F.col(f.name)
            for f in df.schema.fields]
    nulls = [F.col(c).isNull() for c in df.columns]
    return F.struct(F.xxhash64(*cols, *nulls).alias("a"), F.xxhash64(F.lit(1), *nulls, *reversed(cols)).alias("b"))


def duplicate_counts(df: DataFrame, name: str) -> DataFrame:
    """(table, n_rows, n_distinct, n_duplicates) with exact full-row distinct.

    Rows are counted by a 128-bit digest first (16 bytes a row are shuffled, not
    the row).  Rows whose digest occurs once are different from all others; only
    rows whose digest repeats are compared in full, so the count is exact
    whatever the digests do.
    """
    counted = df.groupBy(_digest(df).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted.select("d.a", "d.b", "n"))
    # Three numbers per table.
    n_rows, single, repeats = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") == 1),
                                          F.count_if(F.col("n") > 1)).first()
    distinct = F.lit(single)
    one = df.sparkSession.range(1)
    if repeats:
        repeated = counted.where("n > 1").select(F.struct("a", "b").alias("d"))
        one = (df.select(F.struct(*df.columns).alias("r"), _digest(df).alias("d")).join(repeated, "d", "left_semi")
               .groupBy("r").agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).alias("k")))
        distinct = distinct + F.col("k")
    return one.select(F.lit(name).alias("table"), F.lit(n_rows).alias("n_rows"), distinct.alias("n_distinct"),
                      (F.lit(n_rows) - distinct).alias("n_duplicates")).select(
        "table", *[F.col(c).cast("long").alias(c) for c in ("n_rows", "n_distinct", "n_duplicates")])


def duplicate_report(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """C3 for several (name, table) pairs, their jobs side by side; one row per table."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(tables), 8))) as pool:
        jobs = [pool.submit(copy_context().run, duplicate_counts, df, name) for name, df in tables]
        return reduce(DataFrame.unionByName, [j.result() for j in jobs])


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL key cannot be imputed meaningfully; they are dropped."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond) if cond is not None else df


def _nan_to_null(c):
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def _imputed(df: DataFrame, name: str, mean: float | None):
    """Present values keep their exact value.  BYTE, SHORT and INT widen to DOUBLE
    (which holds them exactly) so that the mean is not cut; BIGINT and DECIMAL keep
    their type and the mean is rounded to it."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        kind = T.DoubleType()
    fill = F.lit(mean).cast("double")
    if isinstance(kind, T.LongType):
        fill = F.round(fill)
    return F.when(_is_missing(df, name), fill.cast(kind)).otherwise(F.col(name).cast(kind)).alias(name)


def impute_mean(df: DataFrame, measures: list[str] | None = None,
                keys: tuple[str, ...] = ("user_id", "item_id", "tag_id")) -> DataFrame:
    """C4: replace NULL and NaN in measure columns by the column mean.

    Keys are never imputed (a NULL id given the mean id is meaningless); by
    default every numeric non-key column is a measure.  Means ignore NULL and
    NaN (the reference's mean of a column holding NaN was NaN).  All means are
    fitted in one aggregate (one small row to the driver, like any estimator
    fit) and applied in one projection; only missing values change (see
    ``_imputed`` for the types).  A column that is entirely missing stays missing.
    """
    cols = measures if measures is not None else numeric_columns(df, exclude=keys)
    if not cols:
        return df
    row = df.agg(*[F.avg(_nan_to_null(F.col(c))).alias(c) for c in cols]).first()
    means = row.asDict() if row is not None else {}
    return df.select(*[_imputed(df, c, means.get(c)) if c in cols else F.col(c) for c in df.columns])


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First n rows in a fixed order."""
    return df.orderBy(*order_by).limit(n)


def hash_bucket(*cols: str, modulus: int = 1000003):
    """Portable bucket 0..modulus-1 from integer keys (same text in SQL for keys from 0 on).

    Keys are reduced before they are weighed, so that negative and very large ids
    neither leave the range nor overflow.
    """
    weights = (7919, 104729, 1299709)
    expr = None
    for c, w in zip(cols, weights):
        term = F.pmod(F.col(c).cast("long"), F.lit(modulus)) * w
        expr = term if expr is None else expr + term
    return expr % modulus


def _unit(seed: int, keys: tuple[str, ...]):
    """Seeded position of a row's keys: 63 bits, the same on every cluster."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 1)


def _below(share: float) -> int:
    return min(2**63 - 1, round(share * 2**63))


def sample_random(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample (Spark's seeded sampler; depends on partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_hash(df: DataFrame, fraction: float, keys: tuple[str, ...] = ("user_id", "item_id"), seed: int = 42,
                portable: bool = False) -> DataFrame:
    """C8 reproducible: keep rows whose keys' 64-bit hash falls below ``fraction``, whatever the ids are.

    ``portable=True`` uses ``hash_bucket`` (per mille), which plain SQL can state.
    """
    if portable:
        return df.where(hash_bucket(*keys) % 1000 < int(round(fraction * 1000)))
    return df.where(_unit(seed, keys) < F.lit(_below(fraction)))


def split_hash(df: DataFrame, train_share: float = 0.8, keys: tuple[str, ...] = ("user_id", "item_id"),
               seed: int = 42) -> DataFrame:
    """C9 reproducible: a ``split`` label by the keys' 64-bit hash; no shuffle."""
    return df.withColumn("split", F.when(_unit(seed, keys) < F.lit(_below(train_share)), "train").otherwise("test"))


#: Rows of one user that are ranked in one task by ``split_per_user``.
USER_ROWS = 100_000


def split_per_user(df: DataFrame, train_share: float = 0.8, user: str = "user_id", item: str = "item_id",
                   seed: int = 42, user_rows: int = USER_ROWS) -> DataFrame:
    """Every user's own split: ``round(train_share * n)`` of a user's n rows are 'train'.

    Rows come in seeded hash order.  A user's hash range is cut into buckets of
    about ``user_rows`` rows; running counts of the buckets say which are all on
    one side, and only the bucket in which the user's cut falls is ranked.  So a
    user with most of the rows is spread like any other rows.  Rows that repeat
    a (user, item) pair have the same place; ties are broken by the other columns' hash.
    """
    names = [unused(df, n) for n in ("place", "bucket", "n_before", "n_goal", "n_rank", "tie", "cut")]
    place, bucket, before, goal, rank, tie, cut = names
    rows = df.withColumn(place, _unit(seed, (user, item))).withColumn(tie, F.xxhash64(*df.columns))
    most = df.groupBy(user).agg(F.count(F.lit(1)).alias(goal)).agg(F.max(goal)).first()[0] or 1
    bits = max(0, (most // user_rows).bit_length())
    rows = rows.withColumn(bucket, F.shiftrightunsigned(place, 63 - bits) if bits else F.lit(0).cast("long"))
    per = rows.groupBy(user, bucket).agg(F.count(F.lit(1)).alias(rank))
    of_user = Window.partitionBy(user)  # at most 2^bits rows a user
    earlier = of_user.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn(goal, F.round(F.sum(rank).over(of_user) * F.lit(train_share)).cast("long"))
           .withColumn(before, F.coalesce(F.sum(rank).over(earlier), F.lit(0).cast("long")))
           .where((F.col(before) <= F.col(goal)) & (F.col(goal) < F.col(before) + F.col(rank)))
           .select(F.col(user).alias(cut), F.col(bucket).alias(rank), F.col(goal) - F.col(before)))
    per = per.toDF(cut, rank, goal)
    # A user without a cut bucket has all rows on the train side (a share of 1, or one row).
    rows = rows.join(per, rows[user].eqNullSafe(per[cut]), "left")
    side = F.when(F.col(rank).isNull() | (F.col(bucket) < F.col(rank)), "train").otherwise("test")
    clear = rows.where(F.col(rank).isNull() | (F.col(bucket) != F.col(rank))).withColumn("split", side)
    nth = F.row_number().over(Window.partitionBy(user).orderBy(place, tie))
    at_cut = rows.where(F.col(bucket) == F.col(rank)).withColumn(
        "split", F.when(nth <= F.col(goal), "train").otherwise("test"))
    return clear.unionByName(at_cut).select(*df.columns, "split")


def split_random(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> DataFrame:
    """A seeded random ``split`` label ('train' / 'test') for every row.

    ``randomSplit`` sorts every partition by all columns once for each side, so that both sides see the
    same order.  Here a row gets its label in one pass, and the labelled rows are written once to the
    shared folder: no sort, and every reader sees the same sides.  As with any seeded sampler, the rows of a
    side depend on partitioning and on the order of the rows.
    """
    share = weights[0] / sum(weights)
    return cut_lineage(df.withColumn("split", F.when(F.rand(seed) < share, "train").otherwise("test")))


def split_report(split: DataFrame, labels: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """C11: rows and percent of rows per split side, from one aggregate."""
    counts = split.agg(F.count(F.lit(1)).alias("__total"),
                       *[F.count_if(F.col("split") == s).alias(s) for s in labels])
    long = counts.unpivot(["__total"], list(labels), "split", "n_rows")
    return long.select("split", "n_rows", (100.0 * F.col("n_rows") / F.col("__total")).alias("pct"))


def feature_vector(df: DataFrame, cols: list[str] | None = None, out: str = "features",
                   handle_invalid: str = "keep") -> DataFrame:
    """Numeric columns assembled into an ML vector (NULL -> NaN with 'keep')."""
    cols = cols if cols is not None else numeric_columns(df)
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def vector_columns(df: DataFrame, vec: str, names: list[str]) -> DataFrame:
    arr = vector_to_array(F.col(vec))
    return df.select(*[c for c in df.columns if c != vec], *[arr[i].alias(n) for i, n in enumerate(names)])
