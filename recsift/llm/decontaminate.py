"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of 10 consecutive words; an item of fewer words,
but not none, is one window.  A document word inside any occurrence of a window
is hit.

A document holds a window only if it holds all of the window's shingles (5
words; a shorter window is one shingle).  So one shingle per window is a
sufficient prefix, and the rarest is the best:

  1. The distinct windows get a number; a window that a thousand items share is
     one window, its items are joined back at the end.
  2. One scan of all documents counts how often each shingle of a window occurs:
     the order of rarity.
  3. Each window keeps its rarest shingle and the offset at which it stands
     first.  A second scan joins the documents' shingles with these prefixes.  A
     match fixes where the window would begin; it must begin and end within the
     document (positional and length bound), and the words there must equal the
     window's (exact verification, so that hash collisions don't matter).

The texts are cut into words once, into a table that both scans read.  Documents
are never shuffled: the windows are sent to the tasks in blocks of about
``BLOCK_ROWS`` rows and ``BLOCK_CHARS`` characters, one block unless the items
have more.  Only the occurrences that were found are grouped, by document.

Defined results
  * NULL text has no words; such a document is clean, such an item has no window.
  * Rows with the same ``item_id`` are one item.  An item with a NULL id makes
    words hit, but is neither counted nor listed.
  * Every document row gets its own result, also rows that repeat a doc_id or
    have none.  Other columns, whatever their names, are not read.
  * ``items_sha256`` of a clean document is that of the empty string.
  * Long texts are read whole; an occurrence may stand anywhere in them.
  * Equally rare shingles: the one with the smaller hash; that decides only the way.
  * Without items, or without documents, there is nothing to find or to return.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise
from recsift.llm.exact_dedup import UPPER

#: Words of a text whose letters A-Z are lower case already.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 5
#: What is sent to every task at once: shingles or windows, and the windows' characters.
BLOCK_ROWS = 200_000
BLOCK_CHARS = 64_000_000


def _words(name: str) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(name).cast("string"), F.lit("")), UPPER, UPPER.lower()),
                                F.lit(WORDS), F.lit(0))


def _shingle(words: Column, at: Column, length: int) -> Column:
    """Hash of the ``length`` words from position ``at`` (from 0)."""
    return F.xxhash64(F.lit(length), *[F.get(words, at + F.lit(i)) for i in range(length)])


def _windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """((win_id, win): each different window once, (win_id, item_id): the items that have it)."""
    w = items.select(F.col("item_id").alias("item_id"), _words("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(window - 1), F.lit(1)))
    each = materialise(w.select("item_id", F.explode(starts).alias("at"), "w").select(
        "item_id", F.slice("w", F.col("at"), F.lit(window)).alias("win")).distinct(), "windows")
    wins = materialise(each.select("win").distinct().select(
        F.monotonically_increasing_id().alias("win_id"), "win"), "windows")
    return wins, materialise(each.join(wins, "win").select("win_id", "item_id"), "members")


def _blocks(df: DataFrame, key: str, block: int) -> list[DataFrame]:
    """``df`` in parts of about ``block`` rows and as many characters as their share; none where it is empty."""
    chars = F.sum(F.octet_length(F.array_join("win", " "))) if "win" in df.columns else F.lit(0)
    rows, n_chars = df.agg(F.count(F.lit(1)), F.coalesce(chars, F.lit(0))).first()
    parts = max(-(-rows // block), -(-n_chars // BLOCK_CHARS))
    if parts <= 1:
        return [df] if rows else []
    return [df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)]


def _positions(texts: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """(keep..., w, p, token): every shingle of every document that has as many words."""
    at = texts.where(F.size("w") >= lengths[0]).select(
        *keep, "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.lit(lengths[0]))).alias("p"))
    tokens = [_shingle(F.col("w"), F.col("p"), n) for n in lengths]
    return at.select("*", F.explode(F.array(*tokens)).alias("token") if len(tokens) > 1 else tokens[0].alias("token"))


def _prefixes(texts: DataFrame, wins: DataFrame, shingle: int, block: int) -> tuple[DataFrame, list[int]]:
    """((win_id, win, token, offset): each window's rarest shingle, the shingle lengths)."""
    length = F.least(F.size("win"), F.lit(shingle))
    lengths = sorted(r[0] for r in wins.select(length).distinct().collect())  # at most ``shingle`` numbers
    if not lengths:
        return wins.select("win_id", "win", F.lit(None).cast("long").alias("token"), F.lit(0).alias("offset")), []
    at = wins.select("win_id", "win", length.alias("n"),
                     F.explode(F.sequence(F.lit(0), F.size("win") - length)).alias("offset"))
    token = F.coalesce(*[F.when(F.col("n") == n, _shingle(F.col("win"), F.col("offset"), n)) for n in lengths])
    shingles = materialise(at.select("win_id", "offset", token.alias("token")), "shingles")
    tokens = materialise(shingles.select("token").distinct(), "tokens")
    counts = [_positions(texts, lengths).select("token").join(F.broadcast(part), "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("df"))
              for part in _blocks(tokens, "token", block)]
    rarity = materialise(functools.reduce(DataFrame.unionByName, counts), "rarity")
    # A window with a shingle that no document holds can't occur.
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "offset")).alias("m")
    best = shingles.join(rarity, "token", "left").groupBy("win_id").agg(rarest).where("m.df > 0")
    return materialise(best.join(wins, "win_id").select("win_id", "win", "m.token", "m.offset"), "prefixes"), lengths


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                block: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((row, doc_id, n_words): the documents, numbered, (row, win_id, start, length): every
    occurrence of a window, ``start`` counting words from 0, (win_id, item_id))."""
    wins, members = _windows(items, window)
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _words("text").alias("w"))
    texts = materialise(cut.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                   F.size("w").cast("long").alias("n_words"), "w"), "words")
    prefixes, lengths = _prefixes(texts, wins, shingle, block)
    start, size = F.col("p") - F.col("offset"), F.size("win")
    found = [_positions(texts, lengths, "row").join(F.broadcast(part), "token")
             .where((start >= 0) & (start + size <= F.size("w")))
             .where(F.slice("w", start + 1, size) == F.col("win"))
             .select("row", "win_id", start.alias("start"), size.alias("length"))
             for part in _blocks(prefixes, "win_id", block)]
    hits = functools.reduce(DataFrame.unionByName, found) if found else prefixes.select(
        F.col("win_id").alias("row"), "win_id", F.lit(0).alias("start"), F.lit(0).alias("length")).where("false")
    return texts.select("row", "doc_id", "n_words"), materialise(hits, "found"), members


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
           block: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    texts, hits, members = occurrences(docs, items, window, shingle, block)
    # Words covered: each start adds what no earlier occurrence of its document reaches.
    spans = hits.groupBy("row", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest("start", F.least("end", F.coalesce(F.max("end").over(before), F.lit(0))))
    covered = spans.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
    of = (hits.select("row", "win_id").distinct().join(members, "win_id").where("item_id IS NOT NULL")
          .select("row", F.col("item_id").cast("string").alias("item")).distinct()
          .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    out = texts.join(covered, "row", "left").join(of, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
