"""SimHash near-dedup by multi-index hashing.

Fingerprints.  Words of the whole text (A-Z lower-cased), shingles of ``shingle``
words, XXH64 with seed 42 of each shingle; a bit of the 64-bit fingerprint is 1
if it is set in over half of the hashes.

Links.  Two fingerprints link if at most ``max_bits`` bits differ.  The 64 bits
are cut into segments; by the pigeonhole principle a link has a segment in
which no more than that segment's radius differs, the radii adding up to
``max_bits - segments + 1``.  Each fingerprint is stored once per segment under
the segment's value; as a probe it enumerates the small Hamming ball around its
own segment value (one mask of each complementary pair), fetches the matches
from the table, and the complete distance is verified.

Buckets.  Work runs on distinct fingerprints, so exact copies cost one row.  A
bucket with more than ``bucket_limit`` different fingerprints is not expanded:
everything that probes or fills it is linked through shared centres instead.
Two fingerprints are within ``max_bits`` exactly if a value lies within half of
that from either; every fingerprint emits the ball of that radius, and all that
emit a value link to the smallest of them.  A value has no more members than
the ball has, so no group can be hot, and no link is lost.

Defined results
  * NULL text counts as empty.  No words: fingerprint 0, linked like any other.
  * Fewer words than a shingle: the whole sequence is the one shingle.
  * Rows without doc_id are linked by their fingerprints like any other; a
    component without any doc_id has NULL as component_id.
  * Rows that repeat a doc_id count by their own texts.  Rows that repeat both
    are one document: ``drop_near_duplicates`` returns it at most once.
  * Long texts are read whole.  Other columns, whatever their names, are kept
    and take no part.
  * An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import materialise, unused
from recsift.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 2
BUCKET_LIMIT = 512
_BLOCK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text, as an unsigned number."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.frombuffer(b"".join(map(xxh64_digest, grams, repeat(SEED))), ">u8").astype("<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        part = hashes[i:i + _BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, fp): fp is the fingerprint's bits as LONG, mark a hash of the text itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], ["doc_id", "mark", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(text).alias("mark"), text.alias("text")).mapInArrow(
        run, "doc_id long, mark long, fp long")


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _masks(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _literals(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(v)).cast("long") for v in values])


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(fp, node) with distinct fp -> (u, v): edges between nodes whose
    connected components are those of all links.

    Buckets within ``bucket_limit`` give every link; larger ones give a star
    for each centre.
    """
    if max_bits < 1:
        return fps.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    width = [64 * (i + 1) // segments - 64 * i // segments for i in range(segments)]
    spare = max_bits - segments + 1
    radius = [spare // segments + (i < spare % segments) if spare >= 0 else (0 if i <= max_bits else -1)
              for i in range(segments)]
    used = [(i, 64 * i // segments, w, r) for i, (w, r) in enumerate(zip(width, radius)) if r >= 0]
    value = lambda off, w: F.shiftrightunsigned(F.col("fp"), off).bitwiseAND(F.lit(_signed((1 << w) - 1)))
    stored = fps.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("s"), value(off, w).alias("v")) for i, off, w, _ in used])).alias("k")).select(
        "k.s", "k.v", F.col("fp").alias("fp_b"), F.col("node").alias("node_b"))
    probed = None
    for i, off, w, r in used:
        own = fps.withColumn("__v", value(off, w))
        # Of the two ends of a link only the one whose lowest differing bit is 0 probes.
        mask = F.explode(F.filter(_literals(_masks(w, r)), lambda m: (m == 0) | (
            F.col("__v").bitwiseAND(m.bitwiseAND(-m)) == 0)))
        part = own.withColumn("m", mask).select(F.lit(i).alias("s"), F.col("__v").bitwiseXOR(F.col("m")).alias("v"),
                                                "fp", "node", "m")
        probed = part if probed is None else probed.unionByName(part)
    large = materialise(stored.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_limit)
                        .select("s", "v"), "large")
    some_large = not large.isEmpty()  # saves the joins with an empty table; results are the same
    table = stored.join(large, ["s", "v"], "left_anti") if some_large else stored
    near = ((F.col("fp") < F.col("fp_b")) | (F.col("m") != 0)) & (_distance("fp", "fp_b") <= max_bits)
    pairs = probed.join(table, ["s", "v"]).where(near).select(F.col("node").alias("u"), F.col("node_b").alias("v"))
    if not some_large:
        return pairs
    crowd = probed.join(large, ["s", "v"], "left_semi").select("fp", "node").union(
        stored.join(large, ["s", "v"], "left_semi").select("fp_b", "node_b")).distinct()
    return pairs.union(_centre_links(crowd, max_bits))


def _centre_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links through shared centres: values within half of ``max_bits`` of both ends."""
    small, big = max_bits // 2, (max_bits + 1) // 2
    near = fps.withColumn("m", F.explode(_literals(_masks(64, big)))).select(
        F.col("fp").bitwiseXOR(F.col("m")).alias("c"), "node",
        (F.bit_count(F.col("m")) <= small).alias("inner"))
    low = near.where("inner").groupBy("c").agg(F.min("node").alias("v"))
    return near.join(low, "c").where("node <> v").select(F.col("node").alias("u"), "v").distinct()


def _components(docs: DataFrame, shingle: int, max_bits: int, segments: int, bucket_limit: int) -> tuple[DataFrame, DataFrame]:
    """((doc_id, mark, fp), (fp, component)): a component is named by its smallest fingerprint."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    fps = materialise(rows.select("fp", F.col("fp").alias("node")).distinct(), "fps")
    comps = connected_components(materialise(links(fps, max_bits, segments, bucket_limit), "links"))
    return rows, materialise(fps.join(comps, "node", "left").select("fp", F.coalesce("component", "fp").alias("component")), "labels")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per document: (doc_id, fp, component_id).

    ``component_id`` is the smallest doc_id reachable over links.
    """
    rows, labels = _components(docs, shingle, max_bits, segments, bucket_limit)
    low = rows.groupBy("fp").agg(F.min("doc_id").alias("low")).join(labels, "fp")
    ids = low.groupBy("component").agg(F.min("low").alias("component_id"))
    named = labels.join(ids, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest doc_id (NULL last).

    Every row is decided by its own doc_id and text.
    """
    rows, labels = _components(docs, shingle, max_bits, SEGMENTS, BUCKET_LIMIT)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    # One row per fingerprint, then one per component: both with partial sums before the shuffle.
    stays = rows.groupBy("fp").agg(first).join(labels, "fp").groupBy("component").agg(F.min("first").alias("first"))
    name = unused(docs, "document")

    def key(doc_id: Column, mark: Column) -> Column:
        return F.concat_ws(":", mark.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("-")))

    kept = stays.select(key(F.col("first.doc_id"), F.col("first.mark")).alias(name))
    return (docs.withColumn(name, key(F.col("doc_id").cast("long"), _mark(F.col("text").cast("string")))).dropDuplicates([name])
            .hint("merge").join(kept, name, "left_semi").select(*docs.columns))
