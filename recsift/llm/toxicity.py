"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters to Latin, and undoes digit and
symbol substitutions inside words that also hold letters.  Lexicon entries are
word beginnings; an entry's weight is its log odds between toxic and other
labelled documents.  Matches inside an exception phrase (an entry's word with
its neighbour, where the pair speaks against toxicity) don't count.  The sum of
weights is normalised by length, and a logistic link fitted on the same
labelled rows turns it into a score.

An entry must be found in several documents and between several different
neighbours: words that documents share because they are copies of each other
have the same neighbours everywhere and don't qualify.

Fitting takes at most ``FIT_ROWS`` labelled rows of the training folds, chosen
by a hash of the id; that number bounds everything that reaches the driver.  Terms
are counted in all of these rows, and only terms with enough support come to the
driver.  Parameters of the model: entries have ``SHORTEST`` to ``LONGEST``
characters (a longer word is matched by its beginning), a lexicon has at most
``MAX_ENTRIES`` entries (the heaviest) and exceptions (those with most evidence),
and words of more than ``NEIGHBOUR`` characters make no exception phrase.  Scoring
covers every document's whole text.

Defined results
  * NULL and empty texts: no match, length 0, the score of a text without matches.
  * Without labels of both classes nothing can be learned: score 0, predicted 0.
  * A document with several labels counts as toxic if one says so; NULL labels
    and labels without document are ignored; a NULL doc_id is not held out.
  * Rows that repeat a doc_id are scored one by one, and each of their texts is
    learned from.  Terms or phrases with equal weight or evidence: by code point.
  * An empty table has no scores.  Long texts are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import materialise

FOLDS = 5
FIT_ROWS = 20_000
MAX_ENTRIES = 20_000
MIN_SUPPORT = 3
MIN_SHARE = 0.005
MIN_LOG_ODDS = 2.5
MIN_LEAN = 0.4
KEEP_SHARE = 0.9
SHORTEST, LONGEST = 3, 16
NEIGHBOUR = 64

# Cyrillic and Greek letters that look like Latin ones.
LOOK_ALIKE = dict(zip("авеѕіјкмнорстухԁһӏ" + "αβεηικνορτυχω",
                      "abesijkmhopctyxdhl" + "abenikvoptuxw"))
# Digits and symbols used in place of letters.
SUBSTITUTED = dict(zip("013457@$!|", "oieastasil"))

_UNDO = str.maketrans(SUBSTITUTED)
_MARKS = re.compile(r"[0-9@$!|]").finditer
# A digit 1 can stand for i or l, so both fold to i.
_FOLD = str.maketrans(LOOK_ALIKE | {"l": "i", "ӏ": "i"} | {c: " " for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¡¿–—"})


def _undo(word: str) -> str:
    core = word.rstrip("!|.,;:?\"')")  # a mark at the end ends the word
    return core.translate(_UNDO) if any(map(str.isalpha, core)) else core


def fold(text: str | None) -> str:
    """Folded words, each with a blank before and after."""
    text = " ".join((text or "").lower().split())
    out, done = [], 0
    for m in _MARKS(text):
        if m.start() >= done:
            a = max(done, text.rfind(" ", done, m.start()) + 1)
            b = text.find(" ", a)
            b = len(text) if b < 0 else b
            out += (text[done:a], _undo(text[a:b]))
            done = b
    out.append(text[done:])
    return " " + " ".join("".join(out).translate(_FOLD).split()) + " "


@dataclass(frozen=True)
class Model:
    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    link: tuple[float, float, float]
    known: bool = True


def _beginnings(folded: str) -> set[str]:
    return {w[:n] for w in set(folded.split()) for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def _in_context(folded: str) -> set[tuple[str, int]]:
    """Beginnings of words with a hash of the word's neighbours."""
    words = folded.split()
    near = zip(["", *words], words, [*words[1:], ""])
    return {(w[:n], zlib.crc32(f"{a} {b}".encode())) for a, w, b in near
            for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


class Matcher:
    """Finds entries at word starts, longest entry per word, outside exception phrases."""

    def __init__(self, entries: dict[str, float], exceptions=()):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for e in entries:
            self.automaton.add_word(" " + e, (e, False))
        for p in exceptions:
            self.automaton.add_word(f" {p} ", (p, True))
        if entries:
            self.automaton.make_automaton()
        self.empty = not entries
        self.entries = entries

    def find(self, folded: str) -> list[tuple[int, str]]:
        """(start of the word, entry) of each matched word."""
        if self.empty:
            return []
        best: dict[int, str] = {}
        excused: list[tuple[int, int]] = []
        for end, (entry, exception) in self.automaton.iter(folded):
            if exception:
                excused.append((end - len(entry) - 1, end))
            else:
                at = end - len(entry) + 1
                if len(entry) > len(best.get(at, "")):
                    best[at] = entry
        return [(at, e) for at, e in best.items() if not any(a < at < b for a, b in excused)]

    def words(self, folded: str) -> list[str]:
        """The matched words."""
        return [folded[at:folded.index(" ", at)] for at, _ in self.find(folded)]

    def features(self, folded: str) -> tuple[float, float]:
        """(weights per length, log of the number of matches)."""
        found = self.find(folded)
        return (100.0 * sum(self.entries[e] for _, e in found) / (folded.count(" ") - 1 + 20), math.log1p(len(found)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents outside the held-out fold."""
    chosen = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("__id"), "__id").limit(rows))
    # The bound on the rows is the bound of this broadcast.
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "__id").select("text", "toxic")


def _count(sample: DataFrame, of_text, having: str = "true") -> dict[str, tuple[int, int]]:
    """Documents of either class (other, toxic) by term, for terms that meet ``having``; ``of_text``: text -> terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                found[toxic].update(of_text(fold(text.as_py())))
        terms = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(
            pa.array([c[t] for t in terms], pa.int64()) for c in found)], ["term", "other", "toxic"])

    rows = (sample.mapInArrow(run, "term string, other long, toxic long").groupBy("term")
            .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).where(having))
    return {r["term"]: (r["other"], r["toxic"]) for r in rows.collect()}


def _contexts(sample: DataFrame, among: frozenset[str]) -> dict[str, int]:
    """Different neighbourhoods of each term of ``among``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0):
                found |= {x for x in _in_context(fold(text.as_py())) if x[0] in among}
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array(
                [c for _, c in found], pa.int64())], ["term", "near"])

    rows = sample.mapInArrow(run, "term string, near long").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return {r["term"]: r["n"] for r in rows.collect()}  # as many as ``among`` has


def _log_odds(toxic: int, other: int, n_toxic: int, n_other: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))


def _evidence(toxic: int, other: int, n_toxic: int, n_other: int) -> float:
    """Log-likelihood ratio statistic of the term's split between the classes."""
    share = n_toxic / (n_toxic + n_other)
    parts = ((toxic, share), (other, 1 - share))
    return 2 * sum(k * math.log(k / ((toxic + other) * q)) for k, q in parts if k)


def _exceptions(sample: DataFrame, matcher: Matcher, n_toxic: int, n_other: int) -> tuple[str, ...]:
    """Matched words with a neighbour that speak against toxicity."""
    def phrases(folded: str) -> set[str]:
        out = set()
        for at, _ in matcher.find(folded):
            end = folded.index(" ", at)
            word = folded[at:end]
            before = folded[folded.rfind(" ", 0, max(0, at - 1)) + 1:max(0, at - 1)]
            after = folded[end + 1:end + NEIGHBOUR + 2].split(" ")[0]
            out |= {f"{before} {word}"} if 0 < len(before) <= NEIGHBOUR else set()
            out |= {f"{word} {after}"} if 0 < len(after) <= NEIGHBOUR else set()
        return out

    pairs = _count(sample, phrases, f"other >= {MIN_SUPPORT} AND toxic * 20 <= other")
    clear = [p for p, (o, t) in pairs.items() if _log_odds(t, o, n_toxic, n_other) <= -1]
    clear.sort(key=lambda p: (-_evidence(pairs[p][1], pairs[p][0], n_toxic, n_other), p))
    return tuple(sorted(clear[:MAX_ENTRIES]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn entries, exceptions and the link from labelled rows."""
    sample = materialise(training_rows(docs, labels, rows), "labelled")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_other, n_toxic = n.get(0, 0), n.get(1, 0)
    if not n_other or not n_toxic:
        return Model((), (), (0.0, 0.0, 0.0), known=False)
    support = max(min(MIN_SUPPORT, n_toxic), MIN_SHARE * n_toxic)
    toxic = {t: c[1] for t, c in _count(sample.where("toxic = 1"), _beginnings, f"toxic >= {support}").items()}
    near = _contexts(sample.where("toxic = 1"), frozenset(toxic))
    toxic = {t: c for t, c in toxic.items() if near.get(t, 0) >= support}
    among = frozenset(toxic)
    other = {t: c[0] for t, c in _count(sample.where("toxic = 0"), lambda f: among & _beginnings(f)).items()}
    weight = {t: _log_odds(c, other.get(t, 0), n_toxic, n_other) for t, c in toxic.items()}
    # Terms that lean to toxic texts may owe their other uses to fixed phrases: those don't count against them.
    unsure = {t: w for t, w in weight.items() if MIN_LEAN <= w < MIN_LOG_ODDS}
    excused = _exceptions(sample, Matcher(unsure), n_toxic, n_other) if unsure else ()
    if excused:
        fixed = Matcher(unsure, excused)
        left = {t: c[0] for t, c in _count(sample.where("toxic = 0"), lambda f: (
            among & _beginnings(" ".join(fixed.words(f))))).items()}
        for t in unsure:
            other[t] = left.get(t, 0)
            weight[t] = _log_odds(toxic[t], other[t], n_toxic, n_other)
    # Of so many candidates some split well by chance; the evidence must exceed that.
    needed = 2 * math.log(max(2, len(toxic)))
    clear = {t for t, c in toxic.items()
             if weight[t] >= MIN_LOG_ODDS and _evidence(c, other.get(t, 0), n_toxic, n_other) >= needed}
    entries: dict[str, float] = {}
    for t in sorted(toxic, key=lambda t: (len(t), t)):
        # Shortest beginnings that tell the classes apart; longer ones say the same.
        if t in clear and not any(t[:i] in entries for i in range(SHORTEST, len(t))):
            entries[t] = weight[t]
    closed = {}
    for t in entries:  # as long as nearly all that hold it hold the longer one
        longer = t
        while more := [x for x in among if len(x) == len(longer) + 1 and x.startswith(longer)
                       and near[x] >= KEEP_SHARE * near[t] and toxic[x] >= KEEP_SHARE * toxic[t]]:
            longer = max(more, key=lambda x: (near[x], x))
        closed[longer] = weight[longer]
    entries = dict(sorted(closed.items(), key=lambda x: (-x[1], x[0]))[:MAX_ENTRIES])
    exceptions = _exceptions(sample, Matcher(entries), n_toxic, n_other)
    matcher_args = (entries, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*matcher_args)
        for batch in batches:
            x = [matcher.features(fold(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in x], pa.float64()), pa.array(
                [b for _, b in x], pa.float64()), batch.column(1).cast(pa.int32())], ["density", "hits", "toxic"])

    seen = sample.mapInArrow(measure, "density double, hits double, toxic int").toPandas()  # at most ``rows`` rows
    return Model(tuple(entries.items()), exceptions, _logistic(seen[["density", "hits"]].to_numpy(), seen["toxic"].to_numpy()))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, float, float]:
    """Newton steps of ridge-regularised logistic regression, classes weighted evenly."""
    order = np.lexsort((x[:, 1], x[:, 0], y))  # sums in one order: reruns agree
    x, y = np.c_[np.ones(len(x)), x][order], y[order]
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    b = np.zeros(3)
    keep = ridge * np.diag([0.01, 1, 1]) / 3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + keep, x.T @ (w * (y - p)) - keep @ b)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, (b0, b1, b2) = Matcher(dict(model.entries), model.exceptions), model.link
        for batch in batches:
            out = []
            for t in batch.column(1):
                density, hits = matcher.features(fold(t.as_py()))
                z = max(-700.0, min(700.0, b0 + b1 * density + b2 * hits))
                out.append(1 / (1 + math.exp(-z)) if model.known else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model marks as toxic; columns as they are."""
    if "text" not in docs.columns:
        raise ValueError("drop_toxic needs a text column")

    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, (b0, b1, b2) = Matcher(dict(model.entries), model.exceptions), model.link
        for batch in batches:
            keep = []
            for t in batch.column(at):
                density, hits = matcher.features(fold(t.as_py()))
                keep.append(not model.known or b0 + b1 * density + b2 * hits < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
