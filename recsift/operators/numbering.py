"""Distributed numbering: the rank of every row in a global order, without a window over all rows.

Rows are range-partitioned and sorted, so partition p holds the p-th run of the
order.  Numbers are the place inside the partition plus the rows of the
partitions before it; only one count per partition is summed on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.session import cut_lineage

ROW_BITS = 33  # monotonically_increasing_id: the partition above, the row in the partition below
MAX_DENSE = 2**31 - 1


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores where the frame has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... in the given order (give an order without ties for stable numbers).

    The rows are written to the shared folder before (the range partitioning reads
    its order columns twice, to sample and to sort) and after they are placed, so the
    numbers don't change when an executor is lost later.  The offsets table has one
    row per partition.
    """
    at, part, shift = unused(df, "at"), unused(df, "part"), unused(df, "shift")
    df = cut_lineage(df)
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn(at, F.monotonically_increasing_id()))
    place = F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    counts = placed.groupBy(F.shiftright(at, ROW_BITS).alias(part)).agg(F.count(F.lit(1)).alias(shift))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(shift).over(before), F.lit(0)).alias(shift))
    return (placed.withColumn(part, F.shiftright(at, ROW_BITS)).join(F.broadcast(offsets), part)
            .withColumn(name, F.col(shift) + place).select(*df.columns, name))


def dense_ids(ids: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): every different id that isn't NULL, with its INT rank by id.

    Raises where there are more ids than INT can number.
    """
    out = cut_lineage(numbered(ids.select(F.col(column).cast("long").alias(column)).where(F.col(column).isNotNull())
                               .distinct(), column, name=name))
    n = out.count()
    if n > MAX_DENSE:
        raise ValueError(f"{n} different values of {column}: more than INT ids can number")
    return out.withColumn(name, F.col(name).cast("int"))


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same keys that come before in ``order``.

    Rows are range-partitioned by keys and order, so a key that holds most rows
    spans many partitions.  Sums run inside each partition, and each (key,
    partition) gets the key's sum over the partitions before it: one row each.
    """
    at, part, base = unused(df, "at"), unused(df, "part"), unused(df, "base")
    by = [*keys, *order]
    df = cut_lineage(df)
    placed = cut_lineage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(at, F.monotonically_increasing_id())
                         .withColumn(part, F.shiftright(at, ROW_BITS)))
    zero = F.lit(0).cast("long")
    inside = Window.partitionBy(part, *keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*keys, part).agg(F.sum(value).alias(base))
    offsets = sums.withColumn(base, F.coalesce(F.sum(base).over(earlier), zero))
    return (placed.withColumn(name, F.coalesce(F.sum(value).over(inside), zero)).join(offsets, [*keys, part])
            .withColumn(name, (F.col(name) + F.col(base)).cast("long")).select(*df.columns, name))
