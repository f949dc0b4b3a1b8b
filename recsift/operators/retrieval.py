"""Exact top n by inner product for many queries, in bands of falling reach.

With ``d`` the queries' mean direction every vector is split into its part along
``d`` and the length of the rest, ``(x, y)``, and ``u . i <= ux ix + uy iy``: tighter
than the product of the norms wherever queries point one way.  So:

  * The catalogue is numbered by the falling sum of that bound over all queries and
    cut into chapters.  A chapter's reach in a few directions of the (x, y) plane
    bounds every query's scores in it (a support function: between two of the
    directions it is at most their combination).
  * The first chapter meets all queries.  Then rounds of 2, 4, 8 ... chapters meet the
    queries, hashed into blocks, whose n-th score a chapter can still reach (an
    equi-grouping on block and chapter, no cross join of rows).
  * A task holds one block of queries and one chapter, scores them in bands, and
    drops a query from the bands where it can't gain any more.  Scores are made in
    single precision; those within the rounding error of a query's n-th score
    are made again in doubles, and only these count.
  * Excluded pairs of a query are those of the chapter alone, so its list is
    bounded by the chapter however many items the query has seen, and nobody is
    asked for a list as long as the catalogue.
  * Between the rounds a query keeps its n best; every round is written to the
    shared folder.

Scores are sums in doubles, rounded to 9 digits; ties go to the smaller item id.
Vectors that are NULL or hold NULL or NaN take no part.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.operators.numbering import numbered
from recsift.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHAPTER = 65_536   # items that a task holds
BLOCK = 32_768     # queries that a task holds
TILE, BAND = 1024, 2048
ROUND = 64         # chapters that a round may ask for
DIRECTIONS = 32    # steps of the half circle in which a chapter's reach is known
DIGITS = 9
SLACK = 1e-9       # relative rounding of a bound, and half a unit of the last digit kept
UNIT = 2.0**-24    # rounding of single precision
SINGLE_MAX = 1e30  # beyond it products are made in doubles
NO_ID = 2**63 - 1   # stands for a NULL item id, the last among equal scores
PLACED = "vec array<float>, x double, y double"
STATE = f"row long, query_id long, {PLACED}, ids array<long>, scores array<double>"


def keep_best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int):
    """The n best entries of every row: score down, id up; sorted by row."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < n
    return rows[keep], ids[keep], scores[keep]


def nth_score(rows: np.ndarray, scores: np.ndarray, n_rows: int, n: int) -> np.ndarray:
    """Each row's n-th score, -inf where it has fewer; the entries come from ``keep_best``."""
    out = np.full(n_rows, -np.inf)
    last = np.flatnonzero(np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") == n - 1)
    out[rows[last]] = scores[last]
    return out


def reaches(x: np.ndarray, y: np.ndarray, support: np.ndarray) -> np.ndarray:
    """Upper bounds of ``x ix + y iy`` (y >= 0) by row and by row of ``support``, the reaches of groups of items."""
    size, at = np.hypot(x, y), np.arctan2(y, x)
    step = math.pi / DIRECTIONS
    k = np.clip((at / step).astype(np.int64), 0, DIRECTIONS - 1)
    after, before = np.sin((k + 1) * step - at).clip(0) / math.sin(step), np.sin(at - k * step).clip(0) / math.sin(step)
    bound = size[:, None] * (after[:, None] * support[:, k].T + before[:, None] * support[:, k + 1].T)
    # The last column is the longest item's norm: rounding is relative to the product of the norms.
    return np.minimum(bound, size[:, None] * support[:, -1]) + SLACK * (1 + size[:, None] * support[:, -1])


def _directions() -> np.ndarray:
    at = np.arange(DIRECTIONS + 1) * (math.pi / DIRECTIONS)
    return np.stack([np.cos(at), np.sin(at)])


def _support(x: np.ndarray, y: np.ndarray, band: int) -> np.ndarray:
    """A row for each ``band`` items in turn: their reach in every direction, and their largest norm."""
    starts = np.arange(0, len(x), band)
    reach = np.stack([x, y], axis=1) @ _directions()
    return np.column_stack([np.maximum.reduceat(reach, starts, axis=0), np.maximum.reduceat(np.hypot(x, y), starts)])


def search_tile(u: np.ndarray, norms: np.ndarray, items: np.ndarray, item_norms: np.ndarray, item_ids: np.ndarray,
                seen: tuple[np.ndarray, np.ndarray], best: tuple[np.ndarray, np.ndarray, np.ndarray], n: int,
                scored: list[int] | None = None, reach: np.ndarray | None = None, floor: np.ndarray | None = None):
    """``best`` entries after the chapter; ``seen``: (row, place in the chapter), by place.

    ``reach``: upper bounds by row and band, from the norms unless given.  ``floor``: rows take nothing below it."""
    floor = np.full(len(u), -np.inf) if floor is None else floor
    nth = np.maximum(nth_score(best[0], best[2], len(u), n), floor)
    if not len(items):
        return best
    longest = norms.max(initial=0.0) * item_norms.max(initial=0.0)
    kind = np.float32 if longest < SINGLE_MAX else np.float64
    off = 2 * SLACK + (u.shape[1] + 4) * UNIT * longest
    few, many = u.astype(kind), np.ascontiguousarray(items.astype(kind).T)
    for j, a in enumerate(range(0, len(items), BAND)):
        b = min(a + BAND, len(items))
        most = norms * item_norms[a:b].max() * (1 + SLACK) + SLACK if reach is None else reach[:, j]
        live = np.flatnonzero(most >= nth)
        if not len(live):
            continue
        scores = few[live] @ many[:, a:b]
        if scored is not None:
            scored[0] += scores.size
        first, last = np.searchsorted(seen[1], (a, b))
        if last > first:
            row = np.full(len(u), -1)
            row[live] = np.arange(len(live))
            r = row[seen[0][first:last]]
            scores[r[r >= 0], seen[1][first:last][r >= 0] - a] = -np.inf
        least = nth[live] - off
        new = np.flatnonzero(np.isneginf(least))
        if len(new):
            k = min(n, b - a)
            least[new] = np.partition(scores[new], b - a - k, axis=1)[:, b - a - k] - 2 * off
        # Rounding ``least`` is within the margin; -inf marks excluded pairs.
        r, c = np.divmod(np.flatnonzero(scores >= np.maximum(least, np.finfo(kind).min).astype(kind)[:, None]), b - a)
        if not len(r):
            continue
        exact = np.round(np.einsum("ij,ij->i", u[live[r]], items[a + c]), DIGITS) + 0.0
        good = exact >= nth[live[r]]
        best = keep_best(*(np.concatenate(x) for x in zip(best, (live[r][good], item_ids[a + c[good]], exact[good]))), n)
        nth = np.maximum(nth_score(best[0], best[2], len(u), n), floor)
    return best


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each entry, entries) of a column of lists, NULL for none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(len(lists)), sizes), pc.list_flatten(lists).to_numpy()


def _matrix(vecs: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(vecs).to_numpy().astype(np.float64).reshape(len(vecs), -1)


def _lists(rows: np.ndarray, values: np.ndarray, n_rows: int, kind: pa.DataType) -> pa.Array:
    """A list for each row; ``rows`` ascend."""
    ends = np.searchsorted(rows, np.arange(n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind), type=pa.list_(pa.field("element", kind)))


def _whole(batch: pa.RecordBatch) -> pa.Table:
    return pa.Table.from_batches([batch])


def _sums(batches):
    """One row: the sum of the vectors and how many there are."""
    total, n = None, 0
    for batch in map(_whole, batches):
        if batch.num_rows:
            part = _matrix(batch["vec"]).sum(axis=0)
            total, n = part if total is None else total + part, n + batch.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([_lists(np.zeros(len(total), int), total, 1, pa.float64()), pa.array([n])], ["total", "n"])


def _place(along: np.ndarray):
    """Adds x, the part along the direction, and y, the length of the rest."""
    def run(batches):
        for batch in map(_whole, batches):
            if batch.num_rows:
                v = _matrix(batch["vec"])
                x = v @ along
                y = np.linalg.norm(v - x[:, None] * along, axis=1)
                yield from batch.append_column("x", pa.array(x)).append_column("y", pa.array(y)).to_batches()
    return run


def _ask(n: int, support: np.ndarray, first: int, last: int):
    """Adds ``ask``, the chapters first to last - 1 that a query still needs, and ``later``, whether any after them."""
    def run(batches):
        for batch in map(_whole, batches):
            if not batch.num_rows:
                continue
            rows, scores = _flat(batch["scores"])
            nth = nth_score(rows, scores, batch.num_rows, n)[:, None]
            x, y = batch["x"].to_numpy(), batch["y"].to_numpy()
            row, ask = np.nonzero(reaches(x, y, support[first:last]) >= nth)
            rest = support[last:].max(axis=0, keepdims=True) if last < len(support) else np.full((1, support.shape[1]), -np.inf)
            later = (reaches(x, y, rest) >= nth)[:, 0] if last < len(support) else np.zeros(batch.num_rows, bool)
            yield from (batch.append_column("ask", _lists(row, ask + first, batch.num_rows, pa.int64()))
                        .append_column("later", pa.array(later)).to_batches())
    return run


def _kernel(n: int):
    """The n best entries of every query in the chapter that are not below its n-th score so far."""
    def run(queries: pa.Table, chapter: pa.Table) -> pa.Table:
        u, x, y = _matrix(queries["vec"]) if len(queries) else np.empty((0, 1)), queries["x"].to_numpy(), queries["y"].to_numpy()
        floor = queries["least"].to_numpy()
        parts = []
        if len(queries) and len(chapter):
            ix, iy, key = (chapter[c].to_numpy() for c in ("x", "y", "key"))
            order = np.lexsort((chapter["item_id"].to_numpy(), -key))
            items, item_ids = _matrix(chapter["vec"])[order], chapter["item_id"].to_numpy()[order]
            support, item_norms = _support(ix[order], iy[order], BAND), np.linalg.norm(items, axis=1)
            by_id = np.argsort(item_ids)  # to find the places of seen items
            rows, ids = _flat(queries["seen"])
            places = by_id[np.minimum(np.searchsorted(item_ids, ids, sorter=by_id), len(by_id) - 1)]
            known = item_ids[places] == ids
            rows, places = rows[known], places[known]
            norms, nothing = np.linalg.norm(u, axis=1), (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            for a in range(0, len(queries), TILE):
                b = min(a + TILE, len(queries))
                lo, hi = np.searchsorted(rows, (a, b))
                by = lo + np.argsort(places[lo:hi], kind="stable")
                r, i, s = search_tile(u[a:b], norms[a:b], items, item_norms, item_ids, (rows[by] - a, places[by]), nothing, n,
                                      reach=reaches(x[a:b], y[a:b], support), floor=floor[a:b])
                parts.append((r + a, i, s))
        r, i, s = (np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
        return pa.table({**{c: queries[c] for c in ("row", "query_id", "vec", "x", "y")},
                         "ids": _lists(r, i, len(queries), pa.int64()),
                         "scores": _lists(r, s.astype(np.float64), len(queries), pa.float64())})
    return run


def _known(df: DataFrame, name: str) -> DataFrame:
    """(name, vec) without vectors that are NULL or hold NULL or NaN."""
    vec = F.col("vec").cast("array<float>").alias("vec")
    return df.select(F.col(name).cast("long").alias(name), vec).where(
        F.coalesce(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(False)))


def _rounds(chapters: int) -> list[tuple[int, int]]:
    """Chapters by round, (first, after the last): 1, 2, 4 ... of them."""
    out, a, size = [], 0, 1
    while a < chapters:
        out.append((a, min(a + size, chapters)))
        a, size = out[-1][1], min(2 * size, ROUND)
    return out


def top_n(queries: DataFrame, items: DataFrame, n: int = 10, seen: DataFrame | None = None, chapter: int = CHAPTER,
          block: int = BLOCK) -> DataFrame:
    """(query_id, item_id, rank, score): the n items with the highest inner product for every query.

    ``queries`` is (query_id, vec), ``items`` is (item_id, vec) with one row per
    id, vectors of one length; ``seen`` (query_id, item_id) pairs are left out.
    A query that has seen all but k items gets k rows.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    spark = queries.sparkSession
    none = spark.createDataFrame([], "query_id long, item_id long, rank int, score double")
    asked = cut_lineage(_known(queries, "query_id"))
    sums = asked.select("vec").mapInArrow(_sums, "total array<double>, n long").collect()  # a row per partition
    if not sums:
        return none
    along = np.sum([r.total for r in sums], axis=0)
    along = along / np.linalg.norm(along) if np.linalg.norm(along) > 0 else np.eye(len(along))[0]
    state = asked.mapInArrow(_place(along), f"query_id long, {PLACED}")
    x, y = state.agg(F.sum("x"), F.sum("y")).first()
    named = items.withColumn("item_id", F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)))
    catalogue = cut_lineage(_known(named, "item_id").mapInArrow(_place(along), f"item_id long, {PLACED}")
                            .withColumn("key", F.lit(x) * F.col("x") + F.lit(y) * F.col("y")))
    count = catalogue.count()
    if not count:
        return none
    if count <= chapter:  # one chapter needs no numbers; the results are the same
        catalogue = catalogue.withColumn("chapter", F.lit(0).cast("long"))
    else:
        catalogue = cut_lineage(numbered(catalogue, F.desc("key"), F.asc("item_id")).select(
            "item_id", "vec", "x", "y", "key", F.floor(F.col("pos") / chapter).alias("chapter")))
    # One row per chapter: a 65,536th of the catalogue's rows.
    reach = [F.max(F.col("x") * float(c) + F.col("y") * float(s)) for c, s in _directions().T]
    found = catalogue.groupBy("chapter").agg(F.array(*reach, F.max(F.hypot("x", "y"))).alias("h")).collect()
    support = np.array([r.h for r in sorted(found, key=lambda r: r.chapter)])
    rounds = _rounds(len(support))
    if seen is not None:
        pairs = seen.select(F.col("user_id" if "user_id" in seen.columns else "query_id").cast("long").alias("query_id"),
                            F.col("item_id").cast("long").alias("item_id"))
        pairs = pairs.join(catalogue.select("item_id", "chapter"), "item_id")
        if len(support) > 1:  # several rounds read it
            pairs = cut_lineage(pairs)
    cores = spark.sparkContext.defaultParallelism
    done: list[DataFrame] = []
    for i, (first, last) in enumerate(rounds):
        if i == 0:
            rows = sum(r.n for r in sums)
            left = state.withColumn("row", F.monotonically_increasing_id()).withColumn("chapter", F.lit(0).cast("long")).withColumn(
                "least", F.lit(float("-inf")))
        else:
            nth = F.when(F.size("scores") >= n, F.element_at("scores", n)).otherwise(F.lit(float("-inf")))
            left = state.select("row", "query_id", "vec", "x", "y", F.explode("ask").alias("chapter"), nth.alias("least"))
            rows = state.where(F.size("ask") > 0).count()
        blocks = max(math.ceil(cores / (last - first)), math.ceil(rows / block))
        if seen is None:
            left = left.withColumn("seen", F.array().cast("array<long>"))
        else:
            per_query = pairs.where(F.col("chapter").between(first, last - 1)).groupBy("query_id", "chapter").agg(
                F.collect_set("item_id").alias("seen"))
            left = left.join(per_query, ["query_id", "chapter"], "left")
        left = left.withColumn("blk", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        here = catalogue.where(F.col("chapter").between(first, last - 1))
        if i == 0:
            right = here.withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        else:  # the blocks that ask for it: at most ``blocks`` rows a chapter
            asks = left.select(*[(F.col(c) + 0).alias(c) for c in ("blk", "chapter")]).distinct()
            right = here.join(F.broadcast(asks), "chapter")
        by = ["blk", "chapter"]
        tasks = 2 * blocks * (last - first)
        out = left.repartition(tasks, *by).groupBy(*by).cogroup(right.repartition(tasks, *by).groupBy(*by)).applyInArrow(
            _kernel(n), STATE)
        if i:  # the n best of the old and the new entries
            new = out.groupBy("row").agg(F.flatten(F.collect_list(F.arrays_zip("ids", "scores"))).alias("new"))
            entries = F.transform(F.concat(F.arrays_zip("ids", "scores"), F.coalesce("new", F.array())), lambda e: F.struct(
                (-e["scores"]).alias("s"), e["ids"].alias("i")))
            out = state.join(new, "row", "left").withColumn("e", F.slice(F.sort_array(entries), 1, n)).select(
                "row", "query_id", "vec", "x", "y", F.col("e.i").alias("ids"), F.transform("e.s", lambda v: -v).alias("scores"))
        if i + 1 == len(rounds):
            done.append(cut_lineage(out).select("query_id", "ids", "scores"))
            break
        state = cut_lineage(out.mapInArrow(_ask(n, support, *rounds[i + 1]), f"{STATE}, ask array<long>, later boolean"))
        more = (F.size("ask") > 0) | F.col("later")
        done.append(state.where(~more).select("query_id", "ids", "scores"))
        state = state.where(more)
        if state.isEmpty():
            break
    state = done[0]
    for d in done[1:]:
        state = state.unionByName(d)
    lists = state.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("pos", "e"))
    return lists.select("query_id", F.nullif("e.ids", F.lit(NO_ID)).alias("item_id"), (F.col("pos") + 1).alias("rank"),
                        F.col("e.scores").alias("score"))
