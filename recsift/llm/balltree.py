"""Ranked lexical search by exact inner products over ball trees of sparse vectors.

A document is the sparse vector of its integer term contributions: the term's
weight times its saturated frequency.  An item is the vector of its terms'
counts.  The score is their inner product, so the ten best documents are an exact
maximum inner product search.

  1. The items' terms are the vocabulary (a term that no item has adds to no
     score).  One pass over the documents counts terms and writes each document's
     sparse vector over the vocabulary; N, L and df come from that table.
  2. The vectors are range-partitioned by their heaviest terms, so that like
     documents and all copies come together, and cut into blocks of bounded size.
     Each block becomes one row with a ball tree: documents in leaf order, and for
     every node its centroid and its radii.
  3. A radius is kept for each of ``GROUPS`` groups of terms (terms of similar
     frequency), and Cauchy-Schwarz is applied group by group: no document of a
     node scores more than  q·c + sum over groups of |q_g| r_g.  The sum is made
     in doubles and rounded up by more than any rounding error, so a subtree is
     left out only if none of its documents can reach the score to beat.
  4. For each item the block with the highest bound is searched first; its k-th
     score is a lower limit for the item.  Then every block is searched best-first
     for the items whose bound reaches their limits.  At the leaves the scores
     are 64-bit integer sums.
  5. What the blocks return, at most k documents per item each, is ranked.

No document's vector is sent to more than one task, nothing grows with the number
of documents in a task or on the driver, and the vocabulary goes to the tasks in
passes of about ``PASS_ROWS`` item terms.

Defined results
  * Terms, weights and scores as the contract of the query says; NULL text has no
    terms.  N counts only documents with a term.
  * Equal scores rank by ascending doc_id, NULL ids last; copies are ranked one
    by one.  Rows that repeat a doc_id are documents of their own.
  * Every item row is an item of its own, also with a repeated or NULL item_id.
    An item without terms, or whose terms no document has, gets no row.
  * Long texts are read whole.  Other columns, whatever their names, are not read.
  * Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise

#: Terms, as bytes of a text whose letters A-Z are lower case.
TERM = rb"[0-9a-z\x80-\xff]+"
K = 10
PASS_ROWS = 1_000_000
BLOCK_DOCS = 2048
BLOCK_ENTRIES = 1_000_000
LEAF_DOCS = 16
GROUPS = 1024
NO_ID = 2**63 - 1

VECTORS = "doc_id long, n long, cols array<int>, tfs array<int>"
WEIGHED = "k1 int, k2 int, k3 int, salt long, doc_id long, no_id boolean, cols array<int>, vals array<long>"
BLOCKS = ("cols array<int>, doc_ids array<long>, no_ids array<boolean>, ptr array<int>, entry_cols array<int>, "
          "entry_vals array<long>, node_lo array<int>, node_hi array<int>, node_child array<int>, node_ptr array<int>, "
          "node_cols array<int>, node_vals array<double>, radius_ptr array<int>, radius_group array<int>, "
          "radius array<double>")
FOUND = "qid long, doc_id long, no_id boolean, score long"


def terms_of(text: str | None) -> list[bytes]:
    # bytes.lower() changes A-Z only; in UTF-8 all other characters are bytes from 0x80.
    return re.findall(TERM, text.encode().lower()) if text else []


class Tree:
    """A ball tree over sparse non-negative rows (CSR over local columns)."""

    def __init__(self, ptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, groups: np.ndarray, n_cols: int,
                 n_groups: int, leaf_docs: int = LEAF_DOCS):
        self.ptr, self.cols, self.vals = ptr, cols, vals.astype(np.float64)
        self.groups, self.n_cols, self.n_groups = groups, n_cols, n_groups
        self.order: list[np.ndarray] = []
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.child: list[int] = []  # first of two children that follow each other; -1 for a leaf
        self.centroids: list[tuple[np.ndarray, np.ndarray]] = []
        self.radii: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [(self._add(), np.arange(len(ptr) - 1), 0)]
        while waiting:
            node, rows, at = waiting.pop()
            self.lo[node], self.hi[node] = at, at + len(rows)
            side = self._measure(node, rows, len(rows) > leaf_docs)
            if side is None:
                self.order.append((at, rows))
                continue
            left, right = rows[side[:len(rows) // 2]], rows[side[len(rows) // 2:]]
            self.child[node] = self._add()
            self._add()
            waiting += [(self.child[node], left, at), (self.child[node] + 1, right, at + len(left))]
        self.rows = np.concatenate([r for _, r in sorted(self.order, key=lambda x: x[0])])

    def _add(self) -> int:
        for x in (self.lo, self.hi, self.child):
            x.append(-1)
        self.centroids.append(None)
        self.radii.append(None)
        return len(self.lo) - 1

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of every entry of the rows, the row's number for each)."""
        n = self.ptr[rows + 1] - self.ptr[rows]
        of = np.repeat(np.arange(len(rows)), n)
        return np.repeat(self.ptr[rows] - np.cumsum(n) + n, n) + np.arange(n.sum()), of

    def _measure(self, node: int, rows: np.ndarray, split: bool) -> np.ndarray | None:
        """Stores centroid and radii; returns the rows in the order of the split, None for a leaf."""
        at, of = self._entries(rows)
        c, y = self.cols[at], self.vals[at]
        centre = np.bincount(c, weights=y, minlength=self.n_cols) / len(rows)
        held = np.flatnonzero(centre)
        self.centroids[node] = held, centre[held]
        base = np.bincount(self.groups[held], weights=centre[held] ** 2, minlength=self.n_groups)
        # |y - c|^2 in a group: all of c^2, and where the row has an entry (y - c)^2 instead of c^2.
        change = np.bincount(of * self.n_groups + self.groups[c], weights=y * (y - 2 * centre[c]),
                             minlength=len(rows) * self.n_groups).reshape(len(rows), self.n_groups)
        most = np.maximum(change.max(axis=0) + base, 0)
        # The subtraction may cancel; 1e-12 of what was added is far more than its error.
        radius = np.sqrt(most + 1e-12 * (base + np.abs(change).max(axis=0))) * (1 + 1e-9)
        used = np.flatnonzero(radius)
        self.radii[node] = used, radius[used]
        if not split:
            return None
        # From the row farthest from the centroid to the row farthest from that one.
        norm = np.bincount(of, weights=y * y, minlength=len(rows))
        far = int(np.argmax(change.sum(axis=1)))
        a = self._dense(rows[far])
        along_a = np.bincount(of, weights=y * a[c], minlength=len(rows))
        b = self._dense(rows[int(np.argmax(norm - 2 * along_a))])
        return np.argsort(np.bincount(of, weights=y * b[c], minlength=len(rows)) - along_a, kind="stable")

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.n_cols)
        out[self.cols[self.ptr[row]:self.ptr[row + 1]]] = self.vals[self.ptr[row]:self.ptr[row + 1]]
        return out


def _csr(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ptr = np.concatenate(([0], np.cumsum([len(a) for a, _ in parts]))).astype(np.int32)
    return ptr, np.concatenate([a for a, _ in parts]).astype(np.int32), np.concatenate([b for _, b in parts])


def pack_block(doc_ids: np.ndarray, no_ids: np.ndarray, lengths: np.ndarray, cols: np.ndarray, vals: np.ndarray,
               groups: np.ndarray, n_groups: int) -> dict:
    """One row of BLOCKS; ``groups`` holds the group of each vocabulary term."""
    known, local = np.unique(cols, return_inverse=True)
    ptr = np.concatenate(([0], np.cumsum(lengths)))
    tree = Tree(ptr, local, vals, groups[known], len(known), n_groups)
    at, _ = tree._entries(tree.rows)
    node_ptr, node_cols, node_vals = _csr(tree.centroids)
    radius_ptr, radius_group, radius = _csr(tree.radii)
    return {"cols": known.astype(np.int32), "doc_ids": doc_ids[tree.rows], "no_ids": no_ids[tree.rows],
            "ptr": np.concatenate(([0], np.cumsum(lengths[tree.rows]))).astype(np.int32),
            "entry_cols": local[at].astype(np.int32), "entry_vals": vals[at],
            "node_lo": np.array(tree.lo, np.int32), "node_hi": np.array(tree.hi, np.int32),
            "node_child": np.array(tree.child, np.int32), "node_ptr": node_ptr, "node_cols": node_cols,
            "node_vals": node_vals, "radius_ptr": radius_ptr, "radius_group": radius_group, "radius": radius}


class Items:
    """The items' vectors as they travel to the tasks: CSR by item, and the norm of each item in each group."""

    def __init__(self, qids: np.ndarray, ptr: np.ndarray, cols: np.ndarray, counts: np.ndarray, groups: np.ndarray):
        self.qids, self.ptr, self.cols, self.counts, self.groups = qids, ptr, cols, counts, groups
        self.n_groups = int(groups.max()) + 1 if len(groups) else 1

    def part(self, chosen: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms of ``known`` x chosen items: counts, groups x chosen items: norms)."""
        q = np.zeros((len(known), len(chosen)), np.int64)
        norms = np.zeros((self.n_groups, len(chosen)))
        for j, i in enumerate(chosen):
            cols, counts = self.cols[self.ptr[i]:self.ptr[i + 1]], self.counts[self.ptr[i]:self.ptr[i + 1]]
            place = np.minimum(np.searchsorted(known, cols), len(known) - 1)
            here = known[place] == cols
            q[place[here], j] = counts[here]
            np.add.at(norms[:, j], self.groups[cols[here]], counts[here].astype(np.float64) ** 2)
        return q, np.sqrt(norms)


def bounds(block: dict, q: np.ndarray, norms: np.ndarray, nodes: int, width: int = 8192) -> np.ndarray:
    """nodes x items: no document of the node has a higher score, rounded up."""
    out = np.zeros((nodes, q.shape[1]))
    ptr, cols, vals = block["node_ptr"], block["node_cols"], block["node_vals"]
    of = np.repeat(np.arange(nodes), np.diff(ptr[:nodes + 1]))
    cols, vals = cols[:len(of)], vals[:len(of)]
    for a in range(0, len(q), width):  # a slice of the terms at a time
        here = (cols >= a) & (cols < a + width)
        dense = np.zeros((nodes, min(width, len(q) - a)))
        dense[of[here], cols[here] - a] = vals[here]
        out += dense @ q[a:a + width].astype(np.float64)
    ptr = block["radius_ptr"]
    of = np.repeat(np.arange(nodes), np.diff(ptr[:nodes + 1]))
    dense = np.zeros((nodes, len(norms)))
    dense[of, block["radius_group"][:len(of)]] = block["radius"][:len(of)]
    return (out + dense @ norms) * (1 + 1e-9) + 1


def search_block(block: dict, items: Items, chosen: np.ndarray, limits: np.ndarray, k: int, stats: list[int] | None = None,
                 ) -> Iterator[tuple[int, int, bool, int]]:
    """(item number, doc_id, no_id, score): the block's k best documents of each chosen item that
    reach the item's limit; ties at the end are decided by doc_id."""
    step = max(1, min(256, 4_000_000 // max(1, len(block["cols"]))))
    for a in range(0, len(chosen), step):
        part = chosen[a:a + step]
        q, norms = items.part(part, block["cols"])
        root = bounds(block, q, norms, 1)[0]
        live = np.flatnonzero(root >= limits[part])
        if not len(live):
            continue
        q, norms = np.ascontiguousarray(q[:, live].T), norms[:, live]
        upper = bounds(block, q.T, norms, len(block["node_lo"]))
        for j, i in enumerate(part[live]):
            for found in _best_first(block, q[j], upper[:, j], int(limits[i]), k, stats):
                yield (int(i), *found)


def _best_first(block: dict, q: np.ndarray, upper: np.ndarray, limit: int, k: int,
                stats: list[int] | None) -> list[tuple[int, bool, int]]:
    best: list[tuple] = []  # a heap; its first entry is the one to beat
    ptr, child, lo, hi = block["ptr"], block["node_child"], block["node_lo"], block["node_hi"]
    waiting = [(-upper[0], 0)]
    while waiting:
        bound, node = heapq.heappop(waiting)
        if -bound < max(limit, best[0][0] if len(best) == k else 1):
            break  # the best of what waits can't reach it
        if child[node] >= 0:
            for c in (int(child[node]), int(child[node]) + 1):
                heapq.heappush(waiting, (-upper[c], c))
            continue
        a, b = lo[node], hi[node]
        if stats is not None:
            stats[0] += int(b - a)
        first, last = ptr[a], ptr[b]
        scores = np.add.reduceat(block["entry_vals"][first:last] * q[block["entry_cols"][first:last]], ptr[a:b] - first)
        least = max(limit, best[0][0] if len(best) == k else 1)
        for d in np.flatnonzero(scores >= least):
            entry = (int(scores[d]), -int(block["no_ids"][a + d]), -int(block["doc_ids"][a + d]))
            if len(best) < k:
                heapq.heappush(best, entry)
            else:
                heapq.heappushpop(best, entry)
    return [(-d, bool(-x), s) for s, x, d in best]


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, cols, tfs) of every document that has a term; ``cols`` may be empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in (b.slice(a, 512) for b in batches for a in range(0, len(b), 512)):
            ids, ns, cols, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                counts = Counter(terms)
                here = sorted((known[t], c) for t, c in counts.items() if t in known)
                ids.append(doc_id.as_py())
                ns.append(len(terms))
                cols.append([c for c, _ in here])
                tfs.append([t for _, t in here])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(cols, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "cols", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, VECTORS)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a list column."""
    column = batch.column(name)
    ends = column.offsets.to_numpy()
    return np.diff(ends), column.flatten().to_numpy(zero_copy_only=False)


def _list_array(values: np.ndarray, lengths: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values, kind))


def _weigh(vectors: DataFrame, weights, n_docs: int, n_terms: int) -> DataFrame:
    """Contributions and range keys of the documents that have a weighed term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            lengths, cols = _lists(batch, "cols")
            _, tfs = _lists(batch, "tfs")
            m = 25 + (75 * batch.column("n").to_numpy() * n_docs) // n_terms
            tf = tfs.astype(np.int64)
            vals = w[cols] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, lengths)))
            of = np.repeat(np.arange(len(lengths)), lengths)
            keep = vals > 0
            cols, vals, of = cols[keep], vals[keep], of[keep]
            lengths = np.bincount(of, minlength=len(m))
            # The three heaviest terms of each document.
            by = np.lexsort((cols, -vals, of))
            place = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            keys = np.full((3, len(m)), -1, np.int32)
            for i in range(3):
                there = by[place == i]
                keys[i, of[there]] = cols[there]
            some = pa.array(lengths > 0)
            doc_id = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x) for x in keys), pa.array(np.zeros(len(m), np.int64)), doc_id.fill_null(NO_ID),
                 doc_id.is_null(), _list_array(cols, lengths, pa.int32()), _list_array(vals, lengths, pa.int64())],
                ["k1", "k2", "k3", "salt", "doc_id", "no_id", "cols", "vals"]).filter(some)

    return vectors.mapInArrow(run, WEIGHED).withColumn("salt", F.xxhash64("doc_id", F.monotonically_increasing_id()))


def _build(weighed: DataFrame, groups, n_groups: int) -> DataFrame:
    """One row per block of at most BLOCK_DOCS like documents."""
    order = ["k1", "k2", "k3", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        held: list[tuple] = []
        docs = entries = 0

        def flush() -> pa.RecordBatch:
            lengths, cols, vals, ids, nulls = (np.concatenate(x) for x in zip(*held))
            block = pack_block(ids, nulls, lengths, cols, vals, groups.value, n_groups)
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in block.values()],
                list(block))

        for batch in batches:
            lengths, cols = _lists(batch, "cols")
            _, vals = _lists(batch, "vals")
            ends = np.concatenate(([0], np.cumsum(lengths)))
            ids = batch.column("doc_id").to_numpy()
            nulls = batch.column("no_id").to_numpy(zero_copy_only=False)
            a = 0
            while a < len(ids):
                room = np.searchsorted(ends, ends[a] + BLOCK_ENTRIES - entries, side="right") - 1
                b = min(len(ids), a + BLOCK_DOCS - docs, max(room, a))
                if b == a and docs == 0:
                    b = a + 1  # one document alone is more than a block's entries
                if b > a:
                    held.append((lengths[a:b], cols[ends[a]:ends[b]], vals[ends[a]:ends[b]], ids[a:b], nulls[a:b]))
                    docs, entries, a = docs + b - a, entries + int(ends[b] - ends[a]), b
                if a < len(ids):
                    yield flush()
                    held, docs, entries = [], 0, 0
        if held:
            yield flush()

    return (weighed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order).mapInArrow(run, BLOCKS)
            .withColumn("block", F.monotonically_increasing_id()))


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    for batch in batches:
        for i in range(len(batch)):
            row = {}
            for name in batch.schema.names:
                value = batch.column(name)[i]
                row[name] = value.values.to_numpy(zero_copy_only=False) if hasattr(value, "values") else value.as_py()
            yield row.pop("block"), row


def _search(blocks: DataFrame, sent, limits, k: int, only=None) -> DataFrame:
    """FOUND rows of all blocks; ``only``: block -> item numbers to search for in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        everything = np.arange(len(items.qids))
        for block_id, block in _blocks_of(batches):
            chosen = everything if only is None else only.value.get(block_id)
            if chosen is None:
                continue
            rows = list(search_block(block, items, chosen, limits.value, k))
            if rows:
                i, ids, nulls, scores = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items.qids[list(i)]), pa.array(ids, pa.int64()), pa.array(nulls, pa.bool_()),
                     pa.array(scores, pa.int64())], ["qid", "doc_id", "no_id", "score"])

    return blocks.mapInArrow(run, FOUND)


def _best_block(blocks: DataFrame, sent) -> dict[int, list[int]]:
    """block -> numbers of the items for which its bound is the highest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        n = len(items.qids)
        best, where = np.zeros(n), np.full(n, -1, np.int64)
        for block_id, block in _blocks_of(batches):
            step = max(1, min(256, 4_000_000 // max(1, len(block["cols"]))))
            for a in range(0, n, step):
                part = np.arange(a, min(n, a + step))
                bound = bounds(block, *items.part(part, block["cols"]), 1)[0]
                more = bound > best[part]
                best[part[more]], where[part[more]] = bound[more], block_id
        some = np.flatnonzero(where >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(where[some]), pa.array(best[some])],
                                         ["i", "block", "bound"])

    # The root's centroid and radii are the first of each array; the documents' entries are not read.
    used = ["block", "cols", "node_ptr", "node_cols", "node_vals", "radius_ptr", "radius_group", "radius"]
    top = blocks.select(*used).mapInArrow(run, "i long, block long, bound double").groupBy("i").agg(
        F.max_by("block", F.struct("bound", "block")).alias("block"))
    out: dict[int, list[int]] = {}
    for r in top.collect():  # a row for each item of the pass
        out.setdefault(r["block"], []).append(r["i"])
    return out


def _pass(docs: DataFrame, entries: list, k: int) -> DataFrame:
    """FOUND rows (the k best of every block that may matter) for the items in ``entries``: (qid, term, count)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    vocabulary = sorted({e[1].encode() for e in entries})
    number = {t: i for i, t in enumerate(vocabulary)}
    vectors = materialise(_vectors(docs, sc.broadcast(vocabulary)), "vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return spark.createDataFrame([], FOUND)
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("cols").alias("c")).groupBy("c").count().collect():  # a row for each term
        df[r[0]] = r[1]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    # Groups of terms of similar frequency, each with about as many entries.
    by = np.argsort(-df, kind="stable")
    share = np.cumsum(df[by]) - df[by]
    groups = np.zeros(len(df), np.int64)
    groups[by] = np.minimum(share * GROUPS // max(1, int(df.sum())), GROUPS - 1)
    weighed = _weigh(vectors, sc.broadcast(weights), n_docs, n_terms)
    blocks = materialise(_build(weighed, sc.broadcast(groups), GROUPS), "blocks")

    entries = sorted((q, number[t.encode()], c) for q, t, c in entries)
    qids, first = np.unique(np.array([e[0] for e in entries], np.int64), return_index=True)
    items = Items(qids, np.append(first, len(entries)), np.array([e[1] for e in entries], np.int64),
                  np.array([e[2] for e in entries], np.int64), groups)
    items.n_groups = GROUPS
    sent = sc.broadcast(items)
    first_look = {b: np.array(sorted(i)) for b, i in _best_block(blocks, sent).items()}
    limits = np.ones(len(qids), np.int64)
    some = blocks.where(F.col("block").isin(list(first_look))) if len(first_look) <= 1000 else blocks
    low = (_search(some, sent, sc.broadcast(limits), k, sc.broadcast(first_look)).groupBy("qid")
           .agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k))
    for r in low.collect():  # a row for each item of the pass
        limits[np.searchsorted(qids, r["qid"])] = r["low"]
    return _search(blocks, sent, sc.broadcast(limits), k)


def search(docs: DataFrame, items: DataFrame, k: int = K, pass_rows: int = PASS_ROWS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item with a score above 0."""
    items = materialise(items.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text"))
                        .withColumn("qid", F.monotonically_increasing_id()), "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = Counter(terms_of(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([qid] * len(counts), pa.int64()), pa.array([t.decode() for t in counts], pa.string()),
                     pa.array(list(counts.values()), pa.int64())], ["qid", "term", "count"])

    entries = materialise(items.select("qid", "text").mapInArrow(run, "qid long, term string, count long"), "item-terms")
    passes = max(1, -(-entries.count() // pass_rows))
    found = None
    for p in range(passes):
        part = entries.where(F.pmod(F.xxhash64("qid"), F.lit(passes)) == p).collect()  # about pass_rows rows
        got = _pass(docs, [tuple(r) for r in part], k)
        found = got if found is None else found.unionByName(got)
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "no_id", "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(items.select("qid", "item_id"), "qid").select(
        "item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
