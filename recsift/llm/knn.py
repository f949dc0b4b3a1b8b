"""Exact top-k search by inner product: a Voronoi kNN join.

The largest inner product becomes a nearest neighbour: with one more coordinate
every data vector gets the same norm M, queries get 0 there, and
``d(q, x)^2 = |q|^2 + M^2 - 2 q.x``.  Pivots drawn from the data cut the space
into cells.  Summaries of the cells (the smallest distances to the pivot) bound
each query's k-th distance from above, and the queries of a group bound, per data
cell, the distances to the pivot that a needed vector can have.  A vector is
replicated only to the groups whose bounds it meets; every group is solved
locally in blocks of at most ``QUERY_BLOCK`` queries by about ``DATA_BLOCK``
vectors, so no group, however hot, is gathered in one task.  The blocks' best are
merged last.

In many dimensions the bounds exclude little, and no exact method does better;
the number of groups therefore follows the number of queries, and the work is
queries times vectors in matrix products.

Defined results
  * Components are ``floor(256 * x)`` as LONG.  Vectors that are NULL, lack a
    vec_id, or hold NULL or non-finite components take no part.
  * Vectors of unequal lengths: missing components count as 0.
  * Candidates are all rows with another vec_id than the query's; equal scores
    go to the smaller vec_id; a repeated row is a candidate each time, and a
    repeated query id is answered once per distinct vector.
  * Products beyond 2^53 are computed in exact integers and clipped to LONG.
  * Fewer candidates than k: all of them.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise

K = 5
SCALE = 256
QUERIES_PER_GROUP = 512
MIN_PIVOTS, MAX_PIVOTS = 4, 256
QUERY_BLOCK = 4096
DATA_BLOCK = 16384
_TILE = 128  # queries whose scores are ranked at once


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components as LONG, rows that take part only."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, shorter ones filled up with 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), np.int64)
    if len(flat):
        out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    points = np.c_[x.astype(float), lift]
    square = (points ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def top_scores(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """The k best of one block for each query, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    exact = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1] < 2 ** 53
    data = x.astype(float).T if exact else x.astype(object).T
    for i in range(0, len(q), _TILE):
        part, part_ids = q[i:i + _TILE], query_ids[i:i + _TILE]
        if exact:
            scores = part.astype(float) @ data
        else:
            scores = np.clip(part.astype(object) @ data, -2 ** 63, 2 ** 63 - 1).astype(np.int64)
        own = ids[None, :] == part_ids[:, None]
        if exact:
            scores[own] = -np.inf
            limit = np.partition(scores, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
            row, col = np.nonzero((scores >= limit[:, None]) & ~own)
            value = scores[row, col].astype(np.int64)
        else:
            row, col = np.nonzero(~own)
            value = scores[row, col]
        best = np.lexsort((col, -value if exact else np.invert(value), row))  # ids are in order
        row, col, value = row[best], col[best], value[best]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        keep = nth < k
        yield pd.DataFrame({"query_id": part_ids[row[keep]], "query": row[keep] + i, "vec_id": ids[col[keep]],
                            "score": value[keep]})


def top_k(vectors: DataFrame, is_query: Column, k: int = K, data_block: int = DATA_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores over all other rows.

    ``vectors``: (vec_id, embedding); ``is_query``: a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors).withColumn("q", F.coalesce(is_query, F.lit(False))), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, n_queries, dim, longest = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max(F.size("v")), F.max(norm)).first()
    if not n or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, longest = max(dim, 1), longest or 0.0
    n_pivots = min(max(MIN_PIVOTS, ceil(n_queries / QUERIES_PER_GROUP)), MAX_PIVOTS)
    # Pivots are different vectors, however often one is repeated: at most MAX_PIVOTS hashes, then their vectors.
    lowest = [r[0] for r in rows.select(F.xxhash64("v").alias("h")).distinct().orderBy("h").limit(n_pivots).collect()]
    chosen = rows.withColumn("h", F.xxhash64("v")).where(F.col("h").isin(lowest)).dropDuplicates(["h"]).orderBy("h").select("v").collect()
    points = np.zeros((len(chosen), dim + 1))
    for i, r in enumerate(chosen):
        points[i, :len(r["v"])] = r["v"]
    points[:, dim] = np.sqrt(np.maximum(longest - (points ** 2).sum(1), 0))
    slack = 1e-6 * (1 + sqrt(longest)) * dim  # rounding of distances

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            d = _distances(x, np.sqrt(np.maximum(longest - (x.astype(float) ** 2).sum(1), 0)), points)
            as_query = _distances(x, np.zeros(len(x)), points)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(d.argmin(1), pa.int32()), pa.array(d.min(1)),
                 pa.array(as_query.argmin(1), pa.int32())], ["vec_id", "v", "q", "cell", "dist", "grp"])

    placed = materialise(rows.select("vec_id", "v", "q").mapInArrow(
        assign, "vec_id long, v array<long>, q boolean, cell int, dist double, grp int").withColumn(
        "row", F.monotonically_increasing_id()), "placed")
    # Of the k + 1 nearest ids of a cell at most one is a query's own, so k others bound its k-th distance.
    ids = placed.groupBy("cell", "vec_id").agg(F.min("dist").alias("dist"))
    nearest = ids.select("cell", "vec_id", "dist", F.row_number().over(
        Window.partitionBy("cell").orderBy("dist", "vec_id")).alias("nth")).where(
        F.col("nth") <= k + 1).collect()  # at most MAX_PIVOTS * (k + 1)
    cells, dists, near_ids = (np.array([r[c] for r in nearest]) for c in ("cell", "dist", "vec_id"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), dim)
            group = batch.column(1).to_numpy()
            d = _distances(x, np.zeros(len(x)), points)
            above = d[:, cells] + dists
            above[near_ids[None, :] == batch.column(2).to_numpy()[:, None]] = np.inf  # its own rows are no answers
            reach = np.partition(above, k - 1, axis=1)[:, k - 1] if above.shape[1] >= k else np.full(len(x), np.inf)
            for g in np.unique(group):
                own = group == g
                low, high = (d[own] - reach[own, None]).min(0), (d[own] + reach[own, None]).max(0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(points), g), pa.int32()), pa.array(
                    np.arange(len(points)), pa.int32()), pa.array(low), pa.array(high), pa.array(
                    np.full(len(points), own.sum()), pa.int64())], ["grp", "cell", "low", "high", "n"])

    bounds = placed.where("q").select("v", "grp", "vec_id").mapInArrow(bound, "grp int, cell int, low double, high double, n long")
    bounds = bounds.groupBy("grp", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    # At most MAX_PIVOTS ** 2 rows: the bound of this broadcast.
    bounds = spark.createDataFrame(bounds.withColumn("q_blocks", F.ceil(F.col("n") / query_block).cast("int")).drop("n")
                                   .toPandas(), "grp int, cell int, low double, high double, q_blocks int")
    d_blocks = ceil(n / data_block)
    needed = placed.drop("grp").join(F.broadcast(bounds), "cell").where(
        F.col("dist").between(F.col("low") - slack, F.col("high") + slack))
    data = needed.select("grp", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"),
                         F.pmod(F.xxhash64("row"), F.lit(d_blocks)).cast("int").alias("db"), "vec_id", "v")
    groups = bounds.select("grp", "q_blocks").distinct()
    asked = placed.where("q").select(F.col("grp").alias("g"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
    asked = asked.distinct().join(F.broadcast(groups), F.col("g") == F.col("grp")).select(
        "g", F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(d_blocks - 1))).alias("db"), "query_id", "qv")

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vector": [], "vec_id": [], "score": []})
        x, q = (_matrix(pa.array(v, pa.list_(pa.int64())), dim) for v in (left["v"], right["qv"]))
        found = pd.concat(top_scores(left["vec_id"].to_numpy(), x, right["query_id"].to_numpy(), q, k))
        marks = np.array([zlib.crc32(row.tobytes()) for row in q], np.int64)
        return found.assign(vector=marks[found["query"].to_numpy()])[["query_id", "vector", "vec_id", "score"]]

    best = data.groupBy("grp", "qb", "db").cogroup(asked.groupBy("g", "qb", "db")).applyInPandas(
        solve, "query_id long, vector long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
