"""Exact cosine top-n neighbours of every item.

Why not a term self-join: joining the posting lists on ``term`` emits one row
per pair of items sharing a term, i.e. all pairs within a term group; a term
held by a third of the catalogue makes that quadratic in rows and shuffle.

Instead every item's sparse vector is packed into one row, and items with the same
vector are one class: its vector, its smallest id and its ``n + 1`` smallest ids, which
are all that any list can take from it.  The classes are hashed into ``B`` blocks, and
the similarity matrix is cut into the ``B (B + 1) / 2`` block pairs on or above the
diagonal.  A packed vector is sent to the ``B`` pairs its block is part of (an
equi-grouping on the pair key, no cross join); with blocks of up to 65,536 classes that
is 153 copies at 10^7 of them.  One task per pair sorts each block by the heaviest
terms (so that like vectors are neighbours) and goes through it tile by tile:

  * Floors: the classes, sorted by their heaviest terms, are first compared within ranges
    of this order.  A class's ``n + 1``-th similarity there can only rise.
  * Upper bounds: a vector's similarity with anything in a tile is at most the sum
    of its weights times the tile's largest weight of each term.  A row meets the tiles
    (of 64 rows) where this bound reaches its floor, each tile with all such rows at once.
  * These products are made in single precision: frequent terms through one matrix
    product, the others through the tile's inverted lists.  Entries that come within the
    rounding error of a row's n-th similarity are summed again in double precision,
    term by term, and only those are ranked.

Rows leaving a task are bounded by ``2 (n + 1)`` per class and pair; windows over one
class's candidates pick its best items, which its members share (each without itself).
Task memory is bounded by the packed blocks, their bounds for 256 tiles and one product, whatever
the term distribution.  Where bounds rule out nothing, the work remains two products per pair of classes.

Catalogues of more than one block are not cut into all block pairs.  A class with floor ``f``
can only be reached by vectors that share one of its first terms, those without which
the rest of its vector is shorter than ``f`` (rare terms come first).  So it asks for
the groups of these terms alone: a frequent term's group holds the classes with that
term, rare terms share groups.  Groups are cut into blocks as above, a query block and
a candidate block a task.  A class whose first terms hold more than the catalogue asks for all
of it; where the groups would take more rows than all block pairs (long vectors, low floors), these are searched.

Ranking: similarity rounded to 9 digits, descending, ties to the smaller id;
only positive similarities (items sharing no kept term are not padded), and an
item is never its own neighbour (excluded by id, so exact duplicates rank 1).
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.operators.retrieval import keep_best
from recsift.session import cut_lineage

# The block kernel travels to the Python workers by value (it needs only numpy
# and pandas there), so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIM_DIGITS = 9
OUT_SCHEMA = "seed_id long, item_id long, similarity double"


#: Rows of a tile, at most, and their entries (a single row may have more).
TILE, TILE_ENTRIES = 64, 1 << 16
MAX_BLOCK = 65_536
#: The terms by which rows are sorted, their heaviest ones; rows of this order that give each other a floor.
LEAD, NEAR_ROWS = 3, 1 << 15
#: Tiles that give a row its first floor, where it has none.
FIRST = 4
#: Rows and weights of a matrix made at a time, tiles whose bounds are made at a time, and entries that are summed.
STRIPE, CELLS, ROUND, ENTRIES = 4096, 1 << 22, 256, 1 << 18
#: Multiplications of a matrix product that cost as much as one met entry.
PRODUCTS = 500
UNIT = 2.0**-24  # rounding of single precision
SLACK = 1e-9  # half a unit of the last digit kept, and the rounding of a bound
TINY = np.finfo(np.float32).tiny
SHARED = 16  # a term of more rows than this part of a block has a group of its own
EVERYTHING = -1  # the group of all classes
NO_ID = -(2**63)  # stands for a NULL id, which may name itself


class _Rows:
    """Rows of a block in tiles: ids, CSR of term codes and weights (by row, then code), n best entries of each row.

    ``nth``: a row's n-th similarity so far, never below its ``floor``; tile j is the rows from ``cuts[j]`` on."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray, weights: np.ndarray, n_codes: int,
                 floor: np.ndarray, n: int, tile: int):
        self.ids, self.sizes, self.codes, self.weights, self.n_codes, self.n = ids, sizes, codes, weights, n_codes, n
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.rows = np.repeat(np.arange(len(ids)), sizes)
        self.keys = self.rows * n_codes + codes  # ascending
        self.longest = math.sqrt(np.bincount(self.rows, weights=weights**2, minlength=1).max(initial=0.0))
        self.nth = floor
        self.clear()
        cuts = [0]
        while cuts[-1] < len(ids):
            a = cuts[-1]
            full = int(np.searchsorted(self.ends, self.starts[a] + TILE_ENTRIES, side="right"))
            cuts.append(min(len(ids), a + tile, max(a + 1, full)))
        self.cuts = np.array(cuts)

    def clear(self) -> None:
        """Forget the entries; their n-th similarity stays as the rows' floor."""
        self.floor = self.nth.copy()
        self.best_ids = np.zeros((len(self.ids), self.n), np.int64)
        self.best = np.full((len(self.ids), self.n), -np.inf)

    def tile(self, j: int) -> np.ndarray:
        return np.arange(self.cuts[j], self.cuts[j + 1])

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, place among all entries) of the entries of some rows."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        return (np.repeat(np.arange(len(rows)), sizes),
                np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - ends + sizes, sizes))

    def most(self, a: int, b: int) -> np.ndarray:
        """By tile from a to b and by code, the largest weight."""
        out = np.zeros((b - a, self.n_codes), np.float32)
        lo, hi = self.cuts[a], self.cuts[b]
        at = slice(self.starts[lo], self.ends[hi - 1])
        tiles = np.searchsorted(self.cuts, self.rows[at], side="right") - 1 - a
        np.maximum.at(out, (tiles, self.codes[at]), self.weights[at].astype(np.float32))
        return out

    def reaches(self, i: int, most: np.ndarray) -> np.ndarray:
        """Upper bounds of the similarities of tile i's rows with the rows of tiles, given their largest weights."""
        place, at = self.entries(self.tile(i))
        known, column = np.unique(self.codes[at], return_inverse=True)
        mine = np.zeros((self.cuts[i + 1] - self.cuts[i], len(known)), np.float32)
        mine[place, column] = self.weights[at]
        # All weights are positive, so rounding is relative to the sum.
        return (mine @ most[:, known].T) * np.float32(1 + 4 * (self.sizes[self.tile(i)].max() + 4) * UNIT) + np.float32(SLACK)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge entries into the n best of their rows."""
        counts = (scores > 0) & (scores >= self.nth[rows])
        rows, ids, scores = rows[counts], ids[counts], scores[counts]
        changed = np.unique(rows)
        old = self.best[changed] > 0
        rows, ids, scores = keep_best(np.concatenate((np.repeat(changed, old.sum(axis=1)), rows)),
                                      np.concatenate((self.best_ids[changed][old], ids)),
                                      np.concatenate((self.best[changed][old], scores)), self.n)
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        self.best_ids[rows, place], self.best[rows, place] = ids, scores
        self.nth[changed] = np.maximum(self.floor[changed], self.best[changed, -1])

    def frame(self) -> pd.DataFrame:
        row, place = np.nonzero(self.best > 0)
        return pd.DataFrame({"seed_id": self.ids[row], "item_id": self.best_ids[row, place], "similarity": self.best[row, place]})


def _search(A: _Rows, B: _Rows, own: bool = False) -> None:
    """Offer the similarities with the rows of B to the rows of A.  ``own``: a row may be its own neighbour.

    A row meets the tiles that its bounds do not rule out, which are few once it has a floor."""
    if not len(A.ids) or not len(B.ids):
        return
    step = max(1, min(ROUND, CELLS // max(1, B.n_codes)))
    n_tiles = len(B.cuts) - 1
    found = _Found(A, B, own)
    new = [i for i in range(len(A.cuts) - 1) if np.isneginf(A.nth[A.tile(i)]).any()]
    if new:
        # A floor from the nearest tiles; their entries are met again below.
        near: dict[int, list] = {i: [] for i in new}
        for a in range(0, n_tiles, step):
            most = B.most(a, min(a + step, n_tiles))
            for i in new:
                reach = A.reaches(i, most).sum(axis=0)
                near[i] = sorted(near[i] + [(float(reach[j]), a + int(j)) for j in np.argsort(-reach, kind="stable")[:FIRST]],
                                 key=lambda x: (-x[0], x[1]))[:FIRST]
        for i in new:
            found.add(A.tile(i), np.concatenate([B.tile(j) for _, j in near[i]]))
        found.flush()
        A.clear()
    for a in range(0, n_tiles, step):
        b = min(a + step, n_tiles)
        most = B.most(a, b)
        meets = np.concatenate([A.reaches(i, most) >= A.nth[A.tile(i), None] for i in range(len(A.cuts) - 1)]).T
        for j in range(a, b):
            rows = np.flatnonzero(meets[j - a])
            if len(rows):
                found.add(rows, B.tile(j))
        found.flush()


class _Found:
    """Pairs of rows that may count, found in single precision and summed again in double precision."""

    def __init__(self, A: _Rows, B: _Rows, own: bool):
        self.A, self.B, self.own, self.waiting, self.pairs = A, B, own, 0, []
        # A sum of k products in single precision is off by less than (k + 4) UNIT, all norms being 1.
        self.off = SLACK + (4 + max(A.sizes.max(), B.sizes.max())) * UNIT * max(1.0, A.longest * B.longest)

    def add(self, rows: np.ndarray, others: np.ndarray) -> None:
        A, B = self.A, self.B
        stripe = int(np.clip(CELLS // max(1, B.sizes[others].sum()), 16, STRIPE))
        for a in range(0, len(rows), stripe):
            part = rows[a:a + stripe]
            S = _dot((A, part), (B, others))
            if not self.own:
                _, r, c = np.intersect1d(A.ids[part], B.ids[others], return_indices=True)
                S[r, c] = 0.0  # never its own neighbour
            r, c = np.divmod(np.flatnonzero(S >= _least(S, A.nth[part], A.n, self.off)[:, None]), S.shape[1])
            self.pairs.append((part[r], others[c]))
            self.waiting += len(r)
            if self.waiting > ENTRIES:
                self.flush()

    def flush(self) -> None:
        if self.waiting:
            r, c = (np.concatenate(x) for x in zip(*self.pairs))
            self.A.offer(r, self.B.ids[c], _exact(self.A, self.B, r, c))
        self.waiting, self.pairs = 0, []


def _least(S: np.ndarray, nth: np.ndarray, n: int, off: float) -> np.ndarray:
    """By row, the single-precision entry from which on it may be among the n best; only positive
    entries, as zero means no term in common.  The rounding here is within ``off``'s margin."""
    least = nth - off
    new = np.flatnonzero(np.isneginf(nth))
    if len(new):
        k = min(n, S.shape[1])
        least[new] = np.partition(S[new], S.shape[1] - k, axis=1)[:, S.shape[1] - k] - 2 * off
    return np.maximum(least, TINY).astype(np.float32)


def _dot(a: tuple[_Rows, np.ndarray], b: tuple[_Rows, np.ndarray]) -> np.ndarray:
    """Similarities in single precision of some rows of both sides: frequent terms through one matrix
    product, each entry of the others meets the entries of its term on the other side."""
    shape = len(a[1]), len(b[1])
    their_row, at = b[0].entries(b[1])
    known, theirs = np.unique(b[0].codes[at], return_inverse=True)
    order = np.argsort(theirs, kind="stable")
    their_row, theirs, their_weight = their_row[order], theirs[order], b[0].weights[at[order]].astype(np.float32)
    place = np.full(b[0].n_codes, -1)
    place[known] = np.arange(len(known))
    row, at = a[0].entries(a[1])
    mine = place[a[0].codes[at]]
    same = mine >= 0
    row, mine, weight = row[same], mine[same], a[0].weights[at[same]].astype(np.float32)
    held = np.bincount(theirs, minlength=len(known))
    often = np.bincount(mine, minlength=len(known)) * held * PRODUCTS >= shape[0] * shape[1]
    hot = np.cumsum(often) - 1
    few, many = np.zeros((shape[0], int(often.sum())), np.float32), np.zeros((int(often.sum()), shape[1]), np.float32)
    use = often[theirs]
    many[hot[theirs[use]], their_row[use]] = their_weight[use]
    use = often[mine]
    few[row[use], hot[mine[use]]] = weight[use]
    S = few @ many
    row, mine, weight = row[~use], mine[~use], weight[~use]
    n = held[mine]
    at = np.arange(n.sum()) + np.repeat((np.cumsum(held) - held)[mine] - (np.cumsum(n) - n), n)
    np.add.at(S.reshape(-1), np.repeat(row * shape[1], n) + their_row[at], np.repeat(weight, n) * their_weight[at])
    return S


def _exact(A: _Rows, B: _Rows, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The similarities of row r of A and row c of B in double precision, summed in the order of the terms."""
    out = np.empty(len(r))
    ends = np.cumsum(B.sizes[c])
    a = 0
    while a < len(r):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 4 * ENTRIES, side="right")))
        pair, at = B.entries(c[a:b])
        want = r[a:b][pair] * A.n_codes + B.codes[at]
        place = np.minimum(np.searchsorted(A.keys, want), len(A.keys) - 1)
        same = A.keys[place] == want
        out[a:b] = np.bincount(pair[same], weights=A.weights[place[same]] * B.weights[at[same]], minlength=b - a)
        a = b
    return np.round(out, SIM_DIGITS)


def _split(pdf: pd.DataFrame, first: np.ndarray, n: int, tile: int) -> tuple[_Rows, _Rows]:
    """The rows where ``first`` holds and the others, each sorted by its heaviest terms and id."""
    items, terms = pdf["item_id"].to_numpy(np.int64), pdf["terms"].to_list()
    floor = pdf["floor"].to_numpy(np.float64, na_value=-np.inf) if "floor" in pdf else np.full(len(pdf), -np.inf)
    floor = np.where(np.isnan(floor), -np.inf, floor)
    sizes = np.fromiter(map(len, terms), np.int64, len(terms))
    # Sorted codes, so the sums are made in the same order whatever order rows arrive in.
    codes, known = pd.factorize(np.concatenate(terms), sort=True)
    weights = np.concatenate(pdf["weights"].to_list())
    rows, starts = np.repeat(np.arange(len(items)), sizes), np.cumsum(sizes) - sizes
    heavy = np.lexsort((codes, -weights, rows))
    lead = np.full((LEAD, len(items)), -1)
    for k in range(LEAD):
        lead[k, sizes > k] = codes[heavy[starts[sizes > k] + k]]
    order = np.lexsort((items, *lead[::-1], ~first))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    entries = np.lexsort((codes, place[rows]))
    items, sizes, floor, codes, weights = items[order], sizes[order], floor[order], codes[entries], weights[entries]
    ends, cut = np.concatenate(([0], np.cumsum(sizes))), int(first.sum())
    return tuple(_Rows(items[a:b], sizes[a:b], codes[ends[a]:ends[b]], weights[ends[a]:ends[b]], len(known), floor[a:b], n, tile)
                 for a, b in ((0, cut), (cut, len(items))))


def _block_pair_kernel(n: int, tile: int = TILE, own: bool = False):
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
        A, B = _split(pdf, pdf["blk"].to_numpy() == lo, n, tile)
        if lo == hi:
            _search(A, A, own)
            return A.frame()
        _search(A, B, own)
        _search(B, A, own)
        return pd.concat([A.frame(), B.frame()])
    return kernel


def _seeded_kernel(n: int, tile: int = TILE, own: bool = False):
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        seeds, others = _split(pdf, pdf["role"].to_numpy() == 0, n, tile)
        _search(seeds, others, own)
        return seeds.frame()
    return kernel


def _floor_kernel(n: int, near: int = NEAR_ROWS, tile: int = TILE):
    """Of sorted rows: the n-th similarity of each among the rows around it, at most some ``2 near``, its own included."""
    def floors(pdf: pd.DataFrame) -> pd.DataFrame:
        A, _ = _split(pdf, np.ones(len(pdf), bool), n, tile)
        _search(A, A, True)
        return pd.DataFrame({"item_id": A.ids, "floor": A.nth})[A.nth > 0]

    def kernel(batches):
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= 2 * near:
                yield floors(pd.concat(held))
                held = []
        if sum(map(len, held)):
            yield floors(pd.concat(held))
    return kernel


def packed(vectors: DataFrame) -> DataFrame:
    """(item_id, terms, weights, lead): one row per item, terms in order, and the heaviest of them.

    An array is as long as the item's kept terms, at most ``max_features`` of a fitted model.
    """
    entry = F.sort_array(F.collect_list(F.struct(_term(vectors), F.col("weight").cast("double").alias("weight"))))
    heavy = F.sort_array(F.transform("v", lambda x: F.struct(x["weight"], x["term"])), asc=False)
    return vectors.groupBy("item_id").agg(entry.alias("v")).select(
        "item_id", F.col("v.term").alias("terms"), F.col("v.weight").alias("weights"),
        F.slice(F.transform(heavy, lambda x: x["term"]), 1, LEAD).alias("lead"))


def _term(vectors: DataFrame):
    """The term key shipped to the kernel: the vocabulary's integer index when
    the model has one (4 bytes instead of the text), else the term itself."""
    return F.col("term_idx").alias("term") if "term_idx" in vectors.columns else F.col("term")


def _no_floor() -> Column:
    return F.lit(None).cast("double")


class _Classes:
    """The items with a vector, by vector.

    ``members`` (cls, item_id); ``rows`` (item_id = cls, terms, weights, lead); ``first`` (cls, item_id) with
    the ``n + 1`` smallest ids of a class.  ``cls`` is the smallest id.  Weights of equal documents differ in their last
    bits (sums over partitions), so they are the same from the 12th digit on; the class has its smallest item's.
    """

    def __init__(self, vectors: DataFrame, n: int):
        same = F.struct("terms", F.transform("weights", lambda w: F.round(w, 12)))
        known = packed(vectors).withColumn("item_id", F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)))
        rows = cut_lineage(known.withColumn("a", F.xxhash64(same)).withColumn("b", F.xxhash64(F.lit(1), same)))
        ids = rows.groupBy("a", "b").agg(F.min("item_id").alias("cls"))
        self.members = cut_lineage(rows.select("a", "b", "item_id").join(ids, ["a", "b"]).select("cls", "item_id"))
        own = self.members.where("cls = item_id").select("item_id")
        self.rows = rows.select("item_id", "terms", "weights", "lead").join(own, "item_id", "left_semi")
        place = F.row_number().over(Window.partitionBy("cls").orderBy("item_id"))
        self.first = self.members.withColumn("place", place).where(F.col("place") <= n + 1).select("cls", "item_id")
        self.n, self.count = n, own.count()

    def floors(self) -> DataFrame:
        """(item_id, floor): the n + 1-th similarity of a class among those whose heaviest terms are next to its own.

        Sorted by these terms, the classes come in ranges of ``NEAR_ROWS`` at most; a class with fewer neighbours has no row.
        """
        cores = self.rows.sparkSession.sparkContext.defaultParallelism
        parts = max(1, math.ceil(self.count / NEAR_ROWS), min(2 * cores, self.count // 1024))
        near = self.rows.repartitionByRange(parts, "lead", "item_id")
        rows = near.sortWithinPartitions("lead", "item_id").select("item_id", "terms", "weights")
        return cut_lineage(rows.mapInPandas(_floor_kernel(self.n + 1), "item_id long, floor double"))

    def lists(self, found: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
        """The items' lists (``seeds``: of these items) from those of the classes, (seed_id, item_id, similarity).

        The n + 1 best items of a class are among those of its n + 1 best classes; each member leaves itself out.
        """
        best = Window.partitionBy("seed_id").orderBy(F.desc("similarity"), "item_id")

        def top(df: DataFrame) -> DataFrame:
            return df.withColumn("place", F.row_number().over(best)).where(F.col("place") <= self.n + 1)

        classes = top(found).select("seed_id", F.col("item_id").alias("cls"), "similarity")
        items = top(classes.join(self.first, "cls").select("seed_id", "item_id", "similarity"))
        entry = F.struct("place", "item_id", "similarity")
        per_class = items.groupBy(F.col("seed_id").alias("cls")).agg(F.sort_array(F.collect_list(entry)).alias("l"))
        members = self.members if seeds is None else self.members.join(seeds, "item_id", "left_semi")

        def other(x: Column) -> Column:
            return (x["item_id"] != F.col("seed_id")) | (F.col("seed_id") == NO_ID)

        each = members.withColumnRenamed("item_id", "seed_id").join(per_class, "cls").select(
            "seed_id", F.posexplode(F.slice(F.filter("l", other), 1, self.n)).alias("at", "x"))
        return each.select("seed_id", F.col("x.item_id").alias("item_id"), F.col("x.similarity").alias("similarity"),
                           (F.col("at") + 1).alias("rank"))


def num_blocks_for(vectors: DataFrame, block_size: int = MAX_BLOCK, n_items: int | None = None) -> int:
    """Blocks so that a block holds <= block_size items and the pairs keep all cores busy."""
    spark = vectors.sparkSession
    if n_items is None:
        n_items = vectors.select("item_id").distinct().count()
    by_size = math.ceil(n_items / block_size) if n_items else 1
    cores = spark.sparkContext.defaultParallelism
    by_cores = math.ceil((math.sqrt(1 + 32 * cores) - 1) / 2)  # B(B+1)/2 >= 4 * cores
    return max(1, by_size, min(by_cores, max(1, n_items // 256)))


def _groups_kernel(frequent: dict, bundles: int, rare: int, count: int, longest: float):
    """Adds ``ask``, the groups where a row's best can be, and ``hold``, the groups that it is in.

    ``frequent``: (group, rows) of the terms that have a group of their own; the others share ``bundles`` groups,
    of about ``rare`` entries."""
    def groups(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["terms"].map(len).to_numpy(np.int64)
        codes, known = pd.factorize(np.concatenate(pdf["terms"].to_list()))
        weights = np.concatenate(pdf["weights"].to_list())
        row = np.repeat(np.arange(len(pdf)), sizes)
        own = [frequent.get(t) for t in known.tolist()]
        shared = pd.util.hash_array(np.asarray(known)) % np.uint64(bundles)
        group = np.array([int(b) if g is None else g[0] for g, b in zip(own, shared)])
        held = np.array([0 if g is None else g[1] for g in own])
        order = np.lexsort((codes, -weights, held[codes], row))
        codes, weights = codes[order], weights[order]  # by row: rare terms, heavy ones first, then by rows
        rest = np.cumsum((weights**2)[::-1])[::-1]  # from an entry to the last of its row
        ends = np.cumsum(sizes)
        rest = rest - np.repeat(np.append(rest, 0.0)[ends], sizes)
        floor = pdf["floor"].to_numpy(np.float64, na_value=-np.inf)
        floor = np.where(np.isnan(floor), -np.inf, floor)
        needed = np.sqrt(rest.clip(0)) * longest * (1 + SLACK) + 10 * SLACK >= floor[row]
        cost = np.bincount(row[needed], weights=np.maximum(held[codes[needed]], rare), minlength=len(pdf))
        wide = cost > count
        pdf["ask"] = _distinct(np.append(row[needed & ~wide[row]], np.flatnonzero(wide)),
                               np.append(group[codes[needed & ~wide[row]]], np.full(wide.sum(), EVERYTHING)), len(pdf))
        pdf["hold"] = _distinct(row, group[codes], len(pdf))
        return pdf

    def kernel(batches):
        for pdf in batches:
            if len(pdf):
                yield groups(pdf.reset_index(drop=True))
    return kernel


def _distinct(row: np.ndarray, values: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """By row, its different values."""
    pairs = np.unique(np.column_stack((row, values)), axis=0)
    return np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, n_rows)))


def _by_terms(rows: DataFrame, count: int, n: int, block_size: int, most: int, own: DataFrame | None = None) -> DataFrame | None:
    """Entries (``OUT_SCHEMA``) of the ``n`` best of every class (of ``own``), found in the groups of its first
    terms; None where the groups would take ``most`` rows or more.  ``rows`` is (item_id, terms, weights, floor).

    The driver sees the terms that have a group of their own and two counts per group: about a group for each
    4,096 entries of all rows, with blocks of 65,536.
    """
    spark = rows.sparkSession
    rows = cut_lineage(rows)
    rare = max(1, block_size // SHARED)
    counts = cut_lineage(rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    bundles = max(1, math.ceil((counts.where(F.col("n") <= rare).agg(F.sum("n")).first()[0] or 0) / rare))
    frequent = {r.term: (bundles + i, r.n) for i, r in enumerate(counts.where(F.col("n") > rare).orderBy("term").collect())}
    square = F.aggregate("weights", F.lit(0.0), lambda s, w: s + w * w)
    longest = math.sqrt(rows.agg(F.max(square)).first()[0] or 0.0)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = cut_lineage(rows.mapInPandas(_groups_kernel(frequent, bundles, rare, count, longest),
                                         f"{schema}, ask array<bigint>, hold array<bigint>"))
    queries = dealt if own is None else cut_lineage(dealt.join(own, "item_id", "left_semi"))
    asks = {r.grp: r.n for r in queries.select(F.explode("ask").alias("grp")).groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    if EVERYTHING in asks:
        dealt = dealt.withColumn("hold", F.array_append("hold", F.lit(EVERYTHING).cast("long")))
    holds = {r.grp: r.n for r in dealt.select(F.explode("hold").alias("grp")).groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    cut = [(g, math.ceil(k / block_size), math.ceil(holds[g] / block_size)) for g, k in sorted(asks.items())]
    if not cut:
        return spark.createDataFrame([], OUT_SCHEMA)
    total = sum(asks[g] * c + holds[g] * q for g, q, c in cut)
    if total >= most:
        return None
    sizes = F.broadcast(spark.createDataFrame(cut, "grp long, qs long, cs long"))
    vector, zero = ["item_id", "terms", "weights", "floor"], F.lit(0).cast("long")

    def side(df: DataFrame, groups: str, mine: str, theirs: str, role: int) -> DataFrame:
        dealt = df.select(*vector, F.explode(groups).alias("grp")).join(sizes, "grp")
        return dealt.withColumn(mine[0], F.pmod(F.xxhash64("item_id"), F.col(mine))).withColumn(
            theirs[0], F.explode(F.sequence(zero, F.col(theirs) - 1))).select(*vector, "grp", "q", "c", F.lit(role).alias("role"))

    both = side(queries, "ask", "qs", "cs", 0).unionByName(side(dealt, "hold", "cs", "qs", 1))
    tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil(total / block_size))
    by = ["grp", "q", "c"]
    out = cut_lineage(both.repartition(tasks, *by).groupBy(*by).applyInPandas(_seeded_kernel(n, own=True), OUT_SCHEMA))
    # A pair that shares several terms may be found in several groups, with the same similarity.
    return out.repartition("seed_id").groupBy("seed_id", "item_id").agg(F.max("similarity").alias("similarity"))


def similar_items(vectors: DataFrame, n: int = 10, num_blocks: int | None = None,
                  block_size: int = MAX_BLOCK, n_items: int | None = None) -> DataFrame:
    """(seed_id, item_id, similarity, rank) — the n nearest items of every item.

    ``vectors`` is (item_id, term, weight) with L2-normalised weights; ``n_items`` is not needed.
    """
    classes = _Classes(vectors, n)
    B = num_blocks or num_blocks_for(vectors, block_size, classes.count)
    rows = classes.rows.join(classes.floors(), "item_id", "left") if B > 1 else classes.rows.withColumn("floor", _no_floor())
    if num_blocks is None and classes.count > block_size:
        found = _by_terms(rows.select("item_id", "terms", "weights", "floor"), classes.count, n + 1, block_size,
                          classes.count * B)
        if found is not None:
            return classes.lists(found)
    v = rows.withColumn("blk", F.pmod(F.xxhash64("item_id"), F.lit(B)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(B - 1))).alias("other")
    pairs = v.select("*", other).select("item_id", "terms", "weights", "floor", "blk",
                                        F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"))
    # One shuffle, sized to the number of block pairs: an explicit partition
    # count is not coalesced by AQE, so the pairs spread over all cores
    # instead of being packed into a few tasks because the input is small.
    n_pairs = B * (B + 1) // 2
    pairs = pairs.repartition(2 * n_pairs, "lo", "hi")
    return classes.lists(cut_lineage(pairs.groupBy("lo", "hi").applyInPandas(_block_pair_kernel(n + 1, own=True), OUT_SCHEMA)))


def similar_items_for(vectors: DataFrame, seeds: DataFrame, n: int = 10, num_blocks: int | None = None,
                      block_size: int = MAX_BLOCK, n_items: int | None = None) -> DataFrame:
    """T6 for chosen seeds (``seeds`` has ``item_id``), e.g. one film or the
    users' top items: same ranking as ``similar_items``, restricted to seeds.

    The seeds' classes are cut into ``Bs`` blocks and all classes into ``B`` blocks; a
    task scores one seed block against one candidate block; many seeds ask for the groups
    of their first terms, as in ``similar_items``.  Work is at most |seeds| x catalogue (not catalogue squared) and a task never holds more than one
    block of each side, however many seeds there are.
    """
    classes = _Classes(vectors, n)
    B = num_blocks or num_blocks_for(vectors, block_size, classes.count)
    seed_ids = cut_lineage(seeds.select("item_id").distinct())
    own = cut_lineage(classes.members.join(seed_ids, "item_id", "left_semi").select(F.col("cls").alias("item_id")).distinct())
    n_seeds = own.count()
    if n_seeds == 0:
        return vectors.sparkSession.createDataFrame([], OUT_SCHEMA + ", rank int")
    Bs = max(1, math.ceil(n_seeds / block_size))
    own_rows = classes.rows.join(own, "item_id", "left_semi")
    many = B > 1 and n_seeds >= NEAR_ROWS  # few seeds are cheaper to search than floors for the catalogue
    floors = classes.floors() if many else None
    if many and num_blocks is None and classes.count > block_size:
        rows = classes.rows.join(floors, "item_id", "left").select("item_id", "terms", "weights", "floor")
        found = _by_terms(rows, classes.count, n + 1, block_size, n_seeds * B + classes.count * math.ceil(n_seeds / block_size), own)
        if found is not None:
            return classes.lists(found, seed_ids)
    own_rows = own_rows.join(floors, "item_id", "left") if many else own_rows.withColumn("floor", _no_floor())
    seed_vec = own_rows.select(
        "item_id", "terms", "weights", "floor", F.pmod(F.xxhash64("item_id"), F.lit(Bs)).cast("int").alias("sb"),
        F.explode(F.sequence(F.lit(0), F.lit(B - 1))).alias("cb"), F.lit(0).alias("role"))
    cand = classes.rows.select(
        "item_id", "terms", "weights", _no_floor().alias("floor"), F.explode(F.sequence(F.lit(0), F.lit(Bs - 1))).alias("sb"),
        F.pmod(F.xxhash64("item_id"), F.lit(B)).cast("int").alias("cb"), F.lit(1).alias("role"))
    both = seed_vec.unionByName(cand).repartition(2 * B * Bs, "sb", "cb")
    out = both.groupBy("sb", "cb").applyInPandas(_seeded_kernel(n + 1, own=True), OUT_SCHEMA)
    return classes.lists(cut_lineage(out), seed_ids)


def pad_with_zero(similar: DataFrame, catalogue: DataFrame, n: int = 10) -> DataFrame:
    """Fill neighbour lists shorter than n with zero-similarity items, as a
    ranking of the whole catalogue would (ties at 0 in id order, never the
    item itself).  Every catalogue item gets a list, also items without any
    kept term.

    Only the first 2n + 1 catalogue ids can ever be needed (a short list holds
    fewer than n positives, plus the item itself), so they are fitted once as
    a bounded literal and exploded for the short lists only; no join with the
    catalogue per seed.
    """
    ids = catalogue.select("item_id").distinct()
    first = [r["item_id"] for r in ids.orderBy("item_id").limit(2 * n + 1).collect()]
    have = similar.groupBy("seed_id").agg(F.count(F.lit(1)).alias("k"))
    short = (ids.select(F.col("item_id").alias("seed_id"))
             .join(have, "seed_id", "left").fillna(0, ["k"]).where(F.col("k") < n))
    if not first:
        return similar
    pads = (short.select("seed_id", "k", F.explode(F.array(*[F.lit(i).cast("bigint") for i in first])).alias("item_id"))
            .where(F.col("item_id") != F.col("seed_id"))
            .join(similar.select("seed_id", "item_id"), ["seed_id", "item_id"], "left_anti"))
    w = Window.partitionBy("seed_id").orderBy("item_id")
    pads = (pads.withColumn("rank", (F.col("k") + F.row_number().over(w)).cast("int"))
            .where(F.col("rank") <= n)
            .select("seed_id", "item_id", F.lit(0.0).alias("similarity"), "rank"))
    return similar.select("seed_id", "item_id", "similarity", "rank").unionByName(pads)
