"""Lexical search, Merkle manifest and decontamination against brute force on small fixtures."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.llm import balltree, decontaminate, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, w string, win_id int, key string, row int"
ITEM_SCHEMA = "item_id long, text string, w string, qid int"
rnd = random.Random(11)
WORDS = ["Tree", "Été", "été", "heble", "12", "don't", "a", "Über", "中文", "x@y.z", "tion", "Kn", "nn", "of", "is"]


def _text(n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


PASSAGE = _text(24)
OTHER = _text(14)
LONG = _text(15_000) + " " + PASSAGE + " " + _text(5_000)
TEXTS = [None, "", " .,;\n", "A", "a A a", "one two", LONG, PASSAGE, PASSAGE.upper(), "x " + PASSAGE[len(PASSAGE) // 2:],
         PASSAGE + "-" + PASSAGE + "\n" + OTHER, "a " * 400, *[_text(rnd.randint(1, 60)) for _ in range(60)],
         *["start " + PASSAGE] * 40]
ROWS = [(i, t, [None, "en", "de", "de", "", "ü", "zz"][i * i % 7], None if i % 5 == 0 else "s", None if i % 7 == 0 else i,
         "w", 1, "k", 2) for i, t in enumerate(TEXTS)]
ROWS += [ROWS[7], ROWS[7], (7, "Another text", "en", "s", 1, "", 0, "", 0), (None, PASSAGE, None, None, None, "", 0, "", 0),
         (None, "Upper Case", None, None, None, "", 0, "", 0)]
ITEMS = [(1, PASSAGE, "x", 0), (2, "the " + OTHER + " end", "x", 0), (3, None, "x", 0), (4, "", "x", 0), (5, "One Two", "x", 0),
         (10, PASSAGE, "x", 0), (1, "a " * 12, "x", 0), (None, "heble tion", "x", 0), (6, "nowhere to be found", "x", 0), (7, "A", "x", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, ITEM_SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_items(spark):
    return spark.createDataFrame([], ITEM_SCHEMA)


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t or ""))


def _contamination(rows, items):
    windows = defaultdict(set)
    for r in items:
        w = _words(r[1])
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add(r[0])
    out = Counter()
    for r in rows:
        w, hit, of = _words(r[1]), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    of |= ids
        of = sorted(str(i) for i in of if i is not None)
        out[(r[0], len(w), len(hit), len(of), hashlib.sha256(",".join(of).encode()).hexdigest(), bool(hit))] += 1
    return out


def test_decontamination(spark, docs, items, empty, no_items):
    want = _contamination(ROWS, ITEMS)
    assert Counter(map(tuple, decontaminate.report(docs, items).collect())) == want
    assert any(k[3] > 1 for k in want) and any(not k[5] for k in want)
    # In several blocks, and with shingles of one word, the results are the same.
    assert Counter(map(tuple, decontaminate.report(docs, items, block=7).collect())) == want
    assert Counter(map(tuple, decontaminate.report(docs, items, shingle=1).collect())) == want
    assert decontaminate.report(empty, items).count() == 0
    clean = decontaminate.report(docs, no_items).collect()
    assert len(clean) == len(ROWS) and not any(r.contaminated for r in clean)
    long_items = [r for r in ITEMS if len(_words(r[1])) >= 10]
    got = decontaminate.report(docs, spark.createDataFrame(long_items, ITEM_SCHEMA))
    assert Counter(map(tuple, got.collect())) == _contamination(ROWS, long_items)


def test_decontamination_is_native(spark, docs, items):
    df = decontaminate.report(docs, items)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def _terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(t or ""))


def _ranking(rows, items, k=10):
    docs = [(r[0], Counter(_terms(r[1])), len(_terms(r[1]))) for r in rows]
    docs = [d for d in docs if d[2]]
    big_n, big_l = len(docs), sum(d[2] for d in docs)
    df = Counter(t for d in docs for t in d[1])
    out = Counter()
    for r in items:
        terms, scored = _terms(r[1]), []
        for doc_id, tf, n in docs:
            m = 25 + (75 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in terms if tf[t])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        for i, (s, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]):
            out[(r[0], i + 1, doc_id, -s)] += 1
    return out


def test_lexical_search(spark, docs, items, empty, no_items, monkeypatch):
    want = _ranking(ROWS, ITEMS)
    assert Counter(map(tuple, balltree.search(docs, items).collect())) == want
    # Small blocks and leaves, several passes, few groups of terms: the same ranking.
    monkeypatch.setattr(balltree, "BLOCK_DOCS", 16)
    monkeypatch.setattr(balltree, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(balltree, "GROUPS", 3)
    assert Counter(map(tuple, balltree.search(docs, items, pass_rows=9).collect())) == want
    assert balltree.search(empty, items).count() == 0
    assert balltree.search(docs, no_items).count() == 0


def test_ball_tree_prunes_and_stays_exact():
    """Clusters of documents: most leaves are never scored, and the ten best are the true ones."""
    g = np.random.default_rng(3)
    n, per, clusters = 4000, 6, 100
    cols = np.concatenate([np.sort(g.choice(10, per, replace=False)) + 10 * (i % clusters) for i in range(n)])
    vals = g.integers(1, 10**9, n * per)
    groups = np.arange(10 * clusters) // 10
    block = balltree.pack_block(np.arange(n), np.zeros(n, bool), np.full(n, per), cols, vals, groups, clusters)
    items = balltree.Items(np.arange(5), np.arange(0, 55, 10)[:6], np.arange(50), np.full(50, 2), groups)
    stats, k = [0], 10
    got = sorted(balltree.search_block(block, items, np.arange(5), np.ones(5, np.int64), k, stats))
    scores = np.zeros((5, n), np.int64)
    for j in range(5):
        inside = (cols >= 10 * j) & (cols < 10 * j + 10)
        np.add.at(scores[j], np.repeat(np.arange(n), per)[inside], 2 * vals[inside])
    want = sorted((j, int(d), False, int(scores[j, d])) for j in range(5)
                  for d in sorted(np.flatnonzero(scores[j]), key=lambda d: (-scores[j, d], d))[:k])
    assert got == want
    assert stats[0] < 0.2 * 5 * n
    q, norms = items.part(np.arange(5), block["cols"])
    upper = balltree.bounds(block, q, norms, len(block["node_lo"]))
    for node, (a, b) in enumerate(zip(block["node_lo"], block["node_hi"])):
        assert (upper[node] >= scores[:, block["doc_ids"][a:b]].max(axis=1)).all()


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, text):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def _manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, _leaf(r, r[1]), r))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    low = {k: _tree([x[2] for x in sorted(trees[k], key=lambda x: x[:3])]) for k in order}
    top = _tree([low[k][-1][0] for k in order])
    out = Counter()
    for at, k in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(trees[k], key=lambda x: x[:3])):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            h, proof = _leaf(r, _lower(r[1])) if changed else leaf, ""
            for levels, pos in ((low[k], i), (top, at)):
                for nodes in levels[:-1]:
                    run, own = nodes[pos // 8 * 8:pos // 8 * 8 + 8], pos % 8
                    proof += "".join(run[:own] + run[own + 1:])
                    h = _h(*run[:own], h, *run[own + 1:])
                    pos //= 8
            out[(r[0], leaf, low[k][-1][0], top[-1][0], _h(proof), h, h == top[-1][0])] += 1
    return out


def test_merkle_manifest(spark, docs, empty):
    want = _manifest(ROWS)
    got = Counter(map(tuple, merkle.report(docs).collect()))
    assert got == want
    assert {True, False} == {k[6] for k in got}
    assert merkle.report(empty).count() == 0


def test_merkle_manifest_of_many_langs_and_one(spark):
    for langs, n in ((600, 1300), (1, 520), (1, 512), (9, 9), (1, 1)):
        rows = [(i, f"Text {i % 7}", f"l{i % langs}", "s", i) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        got = Counter(map(tuple, merkle.report(df.repartition(5)).collect()))
        assert got == _manifest(rows)


def test_merkle_proofs_of_a_stored_manifest(spark, docs, tmp_path):
    m = merkle.build(docs, str(tmp_path / "manifest"))
    proofs = merkle.prove(m, "doc_id").withColumn("again", merkle.fold(F.col("h"), F.col("steps")))
    root = m.root.first()[0]
    assert {r.again for r in proofs.collect()} == {root}
    sizes = [level.count() for level in m.levels]
    assert all(b <= a / 8 + 20 for a, b in zip(sizes, sizes[1:]))  # only every second level is stored
