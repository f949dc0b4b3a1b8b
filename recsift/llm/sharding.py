"""Sharding by vector bin packing over bytes, tokens and rows.

Items are groups of equal texts.  Each has a vector (bytes, tokens, rows), each
shard a residual capacity in the same three resources; items are placed largest
first where the dot product of the item's vector with the residual capacity is
highest.  Bytes weigh ``WEIGHTS[0]`` times as much, for they are what must come out even.

The greedy order is sequential, so the number of items is bounded by
parameters, not by the data: groups that hold more than ``1 / (shards * FINE)``
of a resource are items of their own (there can't be more than
``3 * shards * FINE``).  All other groups are whole inside one of ``TILES`` hash
tiles, and a tile is an item.  Only a group too large for balance, over
``SPLIT / (shards * FINE)`` of a resource, is cut into items of that size, so
that a text which fills a third of the table spreads evenly.  Sums for groups
and tiles are aggregated before the shuffle.  Only these sums reach the driver.

Slots are numbered inside tiles and slices of ``1 / (shards * FINE)`` of the
table and shifted by the rows placed before them, so no task orders a whole
shard or a hot group.

Defined results
  * NULL text has no bytes, no tokens; its rows form a group of their own.
  * size is UTF-8 bytes + 1.  Rows that repeat everything are separate rows.
  * Long texts are measured whole; one that is larger than a shard's share stays one row.
  * Ties: of items of equal share the first by name (tile or text digest), of shards that
    fit equally well the one with the smaller number.
  * Other columns, whatever their names, are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise, text_or_empty, word_count

SHARDS = 8
TILES = 4096
FINE = 64
SPLIT = 16
WEIGHTS = (4, 1, 1)
RESOURCES = ("size", "tokens", "n_rows")


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item; ``items``: one row of non-negative resources per item."""
    total = items.sum(axis=0)
    share = items / np.where(total > 0, total / shards, 1)  # in units of a shard's capacity
    residual = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        out[i] = s = int(np.argmax(residual @ (share[i] * WEIGHTS)))
        residual[s] -= share[i]
    return out


def shard(docs: DataFrame, shards: int = SHARDS, tiles: int = TILES, fine: int = FINE) -> DataFrame:
    """One row per document: (doc_id, size, tokens, text_crc32, shard, slot)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
                       word_count().alias("tokens"), F.lit(1).cast("long").alias("n_rows"),
                       F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
                       F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("key"))
    rows = materialise(rows.withColumn("tile", F.pmod(F.xxhash64("key"), F.lit(tiles)).cast("int")), "rows")
    sums = [F.sum(c).alias(c) for c in RESOURCES]
    total = rows.agg(*sums).first()
    if not total["n_rows"]:
        return rows.select("doc_id", "size", "tokens", "text_crc32", F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    share = F.greatest(*[F.col(c) / F.lit(max(1, total[c])) for c in RESOURCES])
    groups = rows.groupBy("key").agg(*sums).withColumn("slices", F.ceil(share * shards * fine).cast("int"))
    # At most 3 * shards * fine groups have a second slice: the bound of this broadcast.
    large = materialise(groups.where("slices > 1").select("key", "slices"), "large")
    slice_of = F.pmod(F.xxhash64("doc_id"), F.col("slices"))
    rows = rows.join(F.broadcast(large), "key", "left").withColumn(
        "part", F.when(F.col("slices").isNull(), F.col("tile").cast("string")).otherwise(
            F.concat_ws(":", "key", slice_of)))
    # At most tiles + 6 * shards * fine parts.
    parts = rows.groupBy("part").agg(*sums).toPandas().sort_values("part", ignore_index=True)
    name = parts["part"].str.split(":", expand=True).reindex(columns=[0, 1]).fillna("0")
    of_group = parts.groupby(name[0])["part"].transform("size") > SPLIT
    parts["item"] = name[0] + (":" + (name[1].astype(int) // SPLIT).astype(str)).where(of_group, "")
    items = parts.groupby("item")[list(RESOURCES)].sum()
    parts["shard"] = parts["item"].map(dict(zip(items.index, place(items.to_numpy(float), shards))))
    parts["first"] = parts.groupby("shard")["n_rows"].cumsum() - parts["n_rows"]
    placed = spark.createDataFrame(parts[["part", "shard", "first"]], "part string, shard int, first long")
    order = Window.partitionBy("part").orderBy("key", "doc_id")
    return rows.join(F.broadcast(placed), "part").select(
        "doc_id", "size", "tokens", "text_crc32", "shard",
        (F.col("first") + F.row_number().over(order) - 1).alias("slot"))
