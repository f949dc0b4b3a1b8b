"""Merkle manifest of a dataset, with checkpoint-and-recompute proofs.

Each row is a leaf, the SHA-256 of its five fields.  Per ``lang`` the leaves
ascend by ``doc_id``; every 8 consecutive nodes become their parent until one
node, the subroot, remains.  The subroots, ordered by ``lang``, make the root in
the same way.

Only every second level is kept (``STRIDE``): the stored levels hold 1/64 of the
one below.  A proof takes, for each stored level, the aligned subtree of at most
64 nodes that ends in one node of the next stored level.  Its missing interior
level is hashed again from the stored nodes, the siblings of both levels are
emitted, and the interior nodes are dropped.

On Spark:
  * Texts are read once; only digests move on.
  * Positions come from a range partitioning by (lang, doc_id, digest): counts
    per partition and lang, their running sum, and the place inside the partition.
    A lang that holds most rows spans as many partitions as it needs, and rows
    that are equal in all of it are dealt out by a salt.
  * An aligned subtree is a group of at most 64 digests; every level is one
    grouping of evenly sized groups, whatever the langs' sizes.
  * A proof's upper part is made once per stored node, from the root downwards,
    and joined to the 64 nodes below it.
  * Every stored level is a Parquet table under the manifest's path; an executor
    that is lost costs a reread.  The driver sees one number per level, the size
    of the largest tree.

Defined results
  * A NULL field is ``-``; an empty text is ``0:``.  NULL ``lang`` is a tree of
    its own, the first one.
  * Rows that repeat a ``doc_id`` stand next to each other by leaf digest (NULL
    ids first), so that the manifest doesn't depend on the order of the input;
    rows that are equal in all five fields have equal leaves and come one after
    another, each with its own proof.
  * A lang of one row has its leaf as subroot; a single lang has its subroot as
    root; an empty table has no manifest row.
  * Long texts are hashed whole.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import new_path
from recsift.llm.exact_dedup import UPPER

FANOUT = 8
STRIDE = 2  # the code below regenerates one missing level
SPAN = FANOUT ** STRIDE
#: Rows (one for each partition and lang) up to which the table of offsets is broadcast.
BROADCAST_ROWS = 500_000
STEP = "array<struct<l:string,r:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a row; ``text`` stands in for its text."""
    text = F.col("text") if text is None else text
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)), 256)


def _key(lang: Column) -> Column:
    """Tree key: NULL first, then the langs in bytewise order."""
    return F.coalesce(F.concat(F.lit("+"), lang.cast("string")), F.lit(""))


@dataclass
class Manifest:
    """Stored levels of the trees below the subroots and of the tree above them.

    ``leaves``: (key, pos, n, h, carried columns); ``levels[s]``: (key, pos, n, h)
    with ``n`` nodes in the tree's level; ``subroots``: (key, h); ``top``: the
    levels above, of one tree with key ''.
    """

    path: str
    leaves: DataFrame | None = None
    levels: list[DataFrame] = field(default_factory=list)
    subroots: DataFrame | None = None
    top: list[DataFrame] = field(default_factory=list)
    root: DataFrame | None = None

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.path}/{name}")


def _numbered(m: Manifest, df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Adds ``pos`` (from 0 within ``key``, in the order of ``by``) and ``n`` (nodes of the key)."""
    cols = [c for c in df.columns if c != "salt"]
    order = [F.col("key").asc(), *[F.col(c).asc_nulls_first() for c in by], F.col("salt").asc()]
    placed = m.write(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *cols, F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part")), name + "-placed")
    runs = placed.groupBy("key", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = m.write(runs.select("key", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                               F.sum("c").over(whole).alias("n")), name + "-runs")
    if runs.count() <= BROADCAST_ROWS:
        runs = F.broadcast(runs)
    return placed.join(runs, ["key", "part"]).select(*cols, (F.col("at") + F.col("shift")).alias("pos"), "n")


def _runs_of(hashes: Column, count: Column) -> Column:
    """The digests' parents: one for each run of FANOUT of the ``count`` digests."""
    starts = F.sequence(F.lit(0), F.ceil(count / F.lit(FANOUT)).cast("int") - 1)
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(hashes, i * FANOUT + 1, F.lit(FANOUT)), ""), 256))


def _subtrees(level: DataFrame, *carry: str) -> DataFrame:
    """(key, up, n, nodes, inner): the aligned subtrees of trees that have more than one node here.

    ``nodes`` are at most 64, in order; ``inner`` is the level above them, made
    again each time and never stored.
    """
    pairs = F.sort_array(F.collect_list(F.struct("pos", "h", *carry)))
    g = level.where("n > 1").groupBy("key", F.floor(F.col("pos") / SPAN).alias("up")).agg(
        F.first("n").alias("n"), pairs.alias("nodes"))
    return g.withColumn("inner", _runs_of(F.col("nodes.h"), F.size("nodes")))


def _above(sub: DataFrame) -> DataFrame:
    """The next stored level: of a tree with at most 8 nodes the parent, of others the parents' parent."""
    deep = F.col("n") > FANOUT
    return sub.select("key", F.col("up").alias("pos"), F.when(deep, F.ceil(F.col("n") / SPAN)).otherwise(1).alias("n"),
                      F.when(deep, F.sha2(F.array_join("inner", ""), 256)).otherwise(F.get("inner", F.lit(0))).alias("h"))


def _grow(m: Manifest, leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(stored levels, (key, h) of the trees' last nodes)."""
    levels, level = [leaves], leaves.select("key", "pos", "n", "h")
    done = level.where("n = 1")
    while (level.agg(F.max("n")).first()[0] or 0) > 1:
        level = m.write(_above(_subtrees(level)), f"{name}-{STRIDE * len(levels)}")
        levels.append(level)
        done = done.unionByName(level.where("n = 1"))
    return levels, m.write(done.select("key", "h"), name + "-last")


def build(docs: DataFrame, path: str | None = None, *carry: Column) -> Manifest:
    """The manifest of (doc_id, source, lang, n_chars, text) rows, written under ``path``."""
    m = Manifest(path or new_path(docs.sparkSession, "manifest"))
    h = F.col("h")
    rows = m.write(docs.select(_key(F.col("lang")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                               leaf_digest().alias("h"), *carry)
                   .withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "rows")
    m.leaves = m.write(_numbered(m, rows, ["doc_id", "h"], "leaves"), "leaves")
    m.levels, m.subroots = _grow(m, m.leaves, "level")
    subroots = m.subroots.select(F.lit("").alias("key"), F.col("key").alias("tree"), h, F.lit(0).alias("salt"))
    m.top, root = _grow(m, m.write(_numbered(m, subroots, ["tree"], "top"), "top-0"), "top")
    m.root = root.select("h")
    return m


def _others(hashes: Column, i: Column) -> Column:
    """Step of a proof: the digests left and right of number ``i`` (from 0) in its run."""
    start = F.floor(i / F.lit(FANOUT)).cast("int") * FANOUT
    return F.struct(F.array_join(F.slice(hashes, start + 1, i - start), "").alias("l"),
                    F.array_join(F.slice(hashes, i + 2, F.lit(FANOUT) - 1 - (i - start)), "").alias("r"))


def _down(level: DataFrame, above: DataFrame, *carry: str) -> DataFrame:
    """(key, pos, h, carry..., last, steps) of the level's nodes in trees that go on; ``above`` is the
    same of the next stored level.  Both sides are joined as subtrees, before they are unfolded."""
    i = F.col("i")
    own = F.when(F.col("n") > FANOUT, F.array(_others(F.col("nodes.h"), i), _others(
        F.col("inner"), F.floor(i / F.lit(FANOUT)).cast("int")))).otherwise(F.array(_others(F.col("nodes.h"), i)))
    up = above.select("key", F.col("pos").alias("up"), "last", "steps")
    each = _subtrees(level, *carry).join(up, ["key", "up"]).select("*", F.posexplode("nodes").alias("i", "e"))
    return each.select("key", "e.*", "last", F.concat(own, "steps").alias("steps"))


def _paths(m: Manifest, levels: list[DataFrame], beyond: DataFrame, name: str, *carry: str) -> DataFrame:
    """(key, pos, h, carry..., last, steps) of the lowest level's nodes: the digest of their tree's last
    node, and the steps there and on; ``beyond``: (key, steps) from the trees' last nodes."""
    above = None
    for s in range(len(levels) - 1, -1, -1):
        cols = carry if s == 0 else ()
        out = levels[s].where("n = 1").join(beyond, "key").select("key", "pos", "h", *cols, F.col("h").alias("last"), "steps")
        if above is not None:
            out = _down(levels[s], above, *cols).unionByName(out)
        above = out if s == 0 else m.write(out, f"{name}-steps-{STRIDE * s}")
    return above


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def siblings(steps: Column) -> Column:
    """The proof as text: the siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["l"], s["r"])), "")


def prove(m: Manifest, *carry: str) -> DataFrame:
    """One row per leaf: (key, pos, h, carried columns, last, steps): its digest, its tree's subroot
    and the steps from the leaf to the root."""
    spark = m.subroots.sparkSession
    tops = m.write(_paths(m, m.top, spark.createDataFrame([("", [])], f"key string, steps {STEP}"), "top", "tree"),
                   "top-steps-0")
    return _paths(m, m.levels, tops.select(F.col("tree").alias("key"), "steps"), "level", *carry)


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``folded_root`` is recomputed from the siblings and the row's leaf, which is
    that of the text with A-Z lower-cased where 3 divides crc32 of the doc_id.
    """
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(changed, leaf_digest(F.translate(F.col("text"), UPPER, UPPER.lower())))
    m = build(docs, path, tampered.alias("tampered"))
    first = m.root.first()  # one digest
    root = F.lit(first[0] if first else None).cast("string")
    out = prove(m, "doc_id", "tampered").select(
        "doc_id", F.col("h").alias("leaf"), F.col("last").alias("subroot"), root.alias("root"),
        F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "h"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
