"""Harmonic packing of token sequences.

Lengths are put into reciprocal-capacity classes: class k holds pieces that fit
k times into a sequence but not k + 1 times, and each of its bins takes exactly
k pieces.  Filling needs no look at other classes or other workers: a task
fills the bins of each class on its own and holds back only bins that it can't
fill.  Those are numbered per class over all tasks (from counts per class and
task) and filled again with k pieces each; what is left then, fewer than k
pieces of each class, is a fixed number of pieces whatever the input, and is
placed first-fit decreasing.

Documents may be cut, which harmonic classes reward: a length just above
capacity / (k + 1) wastes most.  Whole sequences are cut off first.  The rest is
cut into the fewest pieces whose class bins waste at most ``capacity //
WASTE`` tokens each, by a table over all lengths computed from that rule.

Defined results
  * NULL and empty texts have the end id only: one piece of length 1.
  * Every id of a document lies in exactly one piece; ``offset`` is gapless from
    0 in every sequence; rows that repeat an id or text are separate documents.
  * An empty table gives an empty result.
  * Task failures: a piece's bin depends on its task's rows in order, and the
    pieces are written out before anything is derived from them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise
from recsift.llm.tokens import encode_texts, slices, tokenizer_path, worker_encoder

CAPACITY = 2048
END_ID = 1
WASTE = 64

_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, class int, nth int, task int")


def cut_table(capacity: int = CAPACITY, waste: int = WASTE) -> list[list[int]]:
    """For each length below ``capacity`` the pieces it is cut into, largest first."""
    lengths = np.arange(capacity)
    lengths[0] = 1
    good = np.flatnonzero(capacity - capacity // lengths * lengths <= capacity // waste)
    good = np.union1d(good[good > 0], [1])
    fewest = np.zeros(capacity, np.int64)
    table: list[list[int]] = [[]]
    for n in range(1, capacity):
        options = good[good <= n][::-1]
        first = int(options[np.argmin(fewest[n - options])])
        fewest[n] = fewest[n - first] + 1
        table.append(sorted([first, *table[n - first]], reverse=True))
    return table


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Documents as pieces, those of bins that a task could fill with sequence and offset."""
    path = path or tokenizer_path()
    cuts = cut_table(capacity)
    names = [f.split()[0] for f in _PIECE.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64()] * 7 + [pa.int32()] * 3 + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, filled = worker_encoder(path), TaskContext.get().partitionId(), 0
        open_bins: dict[int, list[list]] = {}
        ready: list[list] = []
        most = 256 if with_ids else 4096  # rows held back before they are sent on

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in slices(batch.column(1)):
                for i, ids in enumerate(encode_texts(encoder, texts), first):
                    raw, total = np.append(ids, end_id).astype("<u4").tobytes(), len(ids) + 1
                    start = 0
                    for length in [capacity] * (total // capacity) + cuts[total % capacity]:
                        part = raw[4 * start:4 * (start + length)]
                        k = capacity // length
                        bin_ = open_bins.setdefault(k, [])
                        bin_.append([doc_ids[i], start, length, zlib.crc32(part), total, None, None, k, len(bin_),
                                     task, *[part] * with_ids])
                        start += length
                        if len(bin_) == k:
                            offset = 0
                            for row in open_bins.pop(k):
                                row[5], row[6] = (task << 32) + filled, offset
                                offset += row[2]
                                ready.append(row)
                            filled += 1
                    if len(ready) >= most:
                        yield batch_of(ready)
                        ready = []
        yield batch_of(ready + [row for rows in open_bins.values() for row in rows])
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, _PIECE + ", ids binary" * with_ids)


def _first_fit(capacity: int, base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rest = pa.Table.from_batches(got).sort_by(
            [("length", "descending"), ("class", "ascending"), ("at", "ascending")])
        used = np.zeros(0, np.int64)
        where, offsets = [], []
        for n in rest["length"].to_pylist():
            fits = np.flatnonzero(used + n <= capacity)
            b = int(fits[0]) if len(fits) else len(used)
            if b == len(used):
                used = np.append(used, 0)
            where.append(base + b)
            offsets.append(int(used[b]))
            used[b] += n
        for name, values in (("sequence_id", where), ("offset", offsets)):
            rest = rest.set_column(rest.column_names.index(name), name, pa.array(values, pa.int64()))
        yield from rest.to_batches()
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``ids`` (little-endian unsigned 32-bit) on request.
    """
    every = materialise(pieces(docs, capacity, end_id, path, with_ids), "pieces")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    held = every.where("sequence_id IS NULL")
    counts = held.groupBy("class", "task").agg(F.count(F.lit(1)).alias("n"))
    in_class = Window.partitionBy("class")
    counts = counts.withColumns({
        "before": F.sum("n").over(in_class.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
        "total": F.sum("n").over(in_class)})
    held = held.join(counts.drop("n"), ["class", "task"]).withColumn(
        "at", F.coalesce("before", F.lit(0)) + F.col("nth")).drop("before")
    held = materialise(held, "held")
    full = F.col("at") < F.col("total") - F.col("total") % F.col("class")
    bin_ = F.lit(1 << 62) + F.col("class") * F.lit(1 << 40) + F.floor(F.col("at") / F.col("class"))
    so_far = Window.partitionBy("sequence_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    again = held.where(full).withColumn("sequence_id", bin_.cast("long")).withColumn(
        "offset", F.coalesce(F.sum("length").over(so_far), F.lit(0)).cast("long"))
    # Fewer than k pieces of each class k: a bound that the capacity sets.
    rest = held.where(~full).withColumn("one", F.lit(0))
    rest = rest.repartition(1, "one").mapInArrow(_first_fit(capacity, (1 << 62) + (1 << 61)), rest.schema)
    done = every.where("sequence_id IS NOT NULL")
    return done.select(*out).unionByName(again.select(*out)).unionByName(rest.select(*out))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, pieces, ids): the packed sequences themselves, from ``pack(..., with_ids=True)``.

    A group is one sequence, so its size has the capacity as its bound.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length",
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"),
                                                p["length"].alias("length"))).alias("pieces"),
        F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("ids_hex")).withColumn(
        "ids", F.unhex("ids_hex")).drop("ids_hex")
