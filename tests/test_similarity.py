"""Blocked exact cosine top-n against a brute-force numpy reference."""

import numpy as np
import pytest

from recsift.operators import content, similarity


def _random_vectors(n_items=120, n_terms=25, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n_items):
        k = rng.integers(1, 6)
        terms = rng.choice(n_terms, size=k, replace=False)
        w = rng.random(k) + 0.1
        w = w / np.sqrt((w * w).sum())
        rows += [(int(i * 3 + 1), f"t{t}", float(x)) for t, x in zip(terms, w)]
    # a hot term held by a third of the items
    return rows


def _brute(rows, n):
    ids = sorted({r[0] for r in rows})
    terms = sorted({r[1] for r in rows})
    M = np.zeros((len(ids), len(terms)))
    for i, t, w in rows:
        M[ids.index(i), terms.index(t)] = w
    S = np.round(M @ M.T, 9)
    out = set()
    for a in range(len(ids)):
        cand = [(-S[a, b], ids[b]) for b in range(len(ids)) if b != a and S[a, b] > 0]
        for rank, (neg, j) in enumerate(sorted(cand)[:n], 1):
            out.add((ids[a], j, round(-neg, 9), rank))
    return out


@pytest.mark.parametrize("blocks", [1, 2, 3, 5])
def test_matches_brute_force(spark, blocks):
    rows = _random_vectors()
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    got = {(r.seed_id, r.item_id, round(r.similarity, 9), r.rank)
           for r in similarity.similar_items(vec, n=5, num_blocks=blocks).collect()}
    assert got == _brute(rows, 5)


def test_duplicates_self_and_ties(spark):
    # dup_docs: items 1 and 2 share a document, 3 differs; no_terms item 4 has no vector
    items = spark.createDataFrame(
        [(1, "red ring", ["toy"]), (2, "red ring", ["toy"]), (3, "blue ring", ["toy"]), (4, "the of", [])],
        "item_id long, title string, genres array<string>")
    m = content.ContentModel.fit(items, max_features=None)
    assert m.vectors.where("item_id = 4").count() == 0
    sim = {(r.seed_id, r.rank): (r.item_id, r.similarity)
           for r in similarity.similar_items(m.vectors, n=3, num_blocks=2).collect()}
    assert sim[(1, 1)] == (2, 1.0)  # the twin, not itself
    assert sim[(2, 1)] == (1, 1.0)
    assert all(seed != item for (seed, _), (item, _) in sim.items())
    assert sim[(3, 1)][0] == 1 and sim[(3, 2)][0] == 2  # equal similarity: smaller id first
    assert all(s <= 1.0 + 1e-12 for _, s in sim.values())


def test_norm_is_one(spark):
    items = spark.createDataFrame([(1, "alpha beta beta", ["g"]), (2, "beta gamma", ["g"])],
                                  "item_id long, title string, genres array<string>")
    m = content.ContentModel.fit(items)
    norms = m.vectors.groupBy("item_id").agg({"weight": "collect_list"}).collect()
    for r in norms:
        assert abs(sum(w * w for w in r[1]) - 1.0) < 1e-12


@pytest.mark.parametrize("blocks", [1, 4])
def test_seeded_matches_all_pairs(spark, blocks):
    rows = _random_vectors(n_items=80, seed=11)
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    seeds = spark.createDataFrame([(1,), (34,), (100,), (999,)], "item_id long")  # 999 unknown: no rows
    got = {tuple(r) for r in similarity.similar_items_for(vec, seeds, n=4, num_blocks=blocks)
           .select("seed_id", "item_id", "similarity", "rank").collect()}
    want = {t for t in _brute(rows, 4) if t[0] in (1, 34, 100)}
    assert {(a, b, round(c, 9), d) for a, b, c, d in got} == want


def test_seeded_with_many_seed_blocks(spark):
    rows = _random_vectors(n_items=60, seed=5)
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    seeds = vec.select("item_id").distinct()  # every item is a seed
    got = {(r.seed_id, r.item_id, round(r.similarity, 9), r.rank)
           for r in similarity.similar_items_for(vec, seeds, n=3, num_blocks=3, block_size=16).collect()}
    assert got == _brute(rows, 3)


def test_pad_with_zero_like_a_full_catalogue_ranking(spark):
    items = spark.createDataFrame(
        [(1, "red ring", ["toy"]), (2, "red bolt", ["car"]), (3, "blue nut", ["car"]), (4, "the of", []), (5, "zz", [])],
        "item_id long, title string, genres array<string>")
    m = content.ContentModel.fit(items, max_features=None)
    sim = similarity.similar_items(m.vectors, n=3, num_blocks=2)
    padded = similarity.pad_with_zero(sim, items, n=3)
    lists = {}
    for r in padded.collect():
        lists.setdefault(r.seed_id, []).append((r.rank, r.item_id, r.similarity))
    lists = {k: [i for _, i, _ in sorted(v)] for k, v in lists.items()}
    assert set(lists) == {1, 2, 3, 4, 5} and all(len(v) == 3 for v in lists.values())
    assert lists[4] == [1, 2, 3]            # no vector: zeros in id order
    assert lists[1][0] == 2 and 1 not in lists[1]
    zeros = [r for r in padded.collect() if r.similarity == 0.0]
    assert all(r.seed_id != r.item_id for r in zeros)


def test_document_chunks_make_the_document(spark):
    from pyspark.sql import functions as F

    items = spark.createDataFrame([(1, "red ring", ["toy", "x"]), (2, None, []), (3, "", None), (4, "long title " * 30, ["g"])],
                                  "item_id long, title string, genres array<string>")
    tags = [(1, "fun")] * 1000 + [(1, "a b")] * 3 + [(2, "é")] * 7 + [(9, "unknown item")] + [(1, None), (1, "")]
    tags += [(1, f"tag{i:05d}") for i in range(300)]
    tags = spark.createDataFrame(tags, "item_id long, tag string")
    scores = spark.createDataFrame([(1, 5, 0.9), (1, 6, 0.8), (4, 7, 0.6), (4, 5, 0.1)], "item_id long, tag_id long, relevance double")
    names = spark.createDataFrame([(5, "space"), (6, "alien")], "tag_id long, tag string")
    for args in ((tags, scores, names), (None, None, None)):
        want = {r.item_id: r.document for r in content.item_document(items, *args).collect()}
        for size in (7, 50, 1 << 16):
            chunks = content.item_document_chunks(items, *args, chunk_chars=size)
            rows = sorted((r.item_id, r.chunk, r.text) for r in chunks.collect())
            got = {}
            for i, _, text in rows:
                got[i] = text if i not in got else got[i] + " " + text
            assert got == want
            # A chunk holds what begins in it: at most its size and the rest of one part.
            longest = 400
            assert all(len(t) <= size + longest for _, _, t in rows)


def test_tiles_that_cannot_count_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(1)
    sizes, tile = 2000, 100
    groups = np.repeat(np.arange(20), sizes // 20)  # items of a group share terms, groups share one weak term
    terms = [np.r_[g * 10 + rng.choice(10, 3, replace=False), 999] for g in groups]
    weights = [np.r_[rng.random(3) + 0.5, 0.01] for _ in groups]
    weights = [w / np.sqrt((w * w).sum()) for w in weights]
    import pandas as pd

    pdf = pd.DataFrame({"item_id": np.arange(sizes), "terms": terms, "weights": weights, "top": groups, "blk": 0, "lo": 0, "hi": 0})
    done = []
    dot = similarity._dot
    monkeypatch.setattr(similarity, "_dot", lambda a, b: done.append(1) or dot(a, b))
    got = similarity._block_pair_kernel(5, tile)(pdf)
    assert len(done) < 0.4 * 20 * 21 / 2
    M = np.zeros((sizes, 1000))
    for i, (t, w) in enumerate(zip(terms, weights)):
        M[i, t] = w
    S = np.round(M @ M.T, 9)
    np.fill_diagonal(S, 0)
    want = {(i, j) for i in range(sizes) for j in sorted(range(sizes), key=lambda j: (-S[i, j], j))[:5]}
    assert set(zip(got["seed_id"], got["item_id"])) == want


def test_copies_are_scored_once_and_share_their_list(spark, monkeypatch):
    rows = _random_vectors(n_items=30, n_terms=12, seed=4)
    copies = [(i + 1000 * k, t, w) for k in range(40) for i, t, w in rows]
    vec = spark.createDataFrame(copies, "item_id long, term string, weight double")
    scored = similarity._Classes(vec, 4).rows.count()
    assert scored <= 30  # 1200 items
    got = {(r.seed_id, r.item_id, round(r.similarity, 9), r.rank) for r in similarity.similar_items(vec, n=4, num_blocks=2).collect()}
    assert got == _brute(copies, 4)
    seeds = spark.createDataFrame([(1,), (1004,), (39001,)], "item_id long")
    some = {(r.seed_id, r.item_id, round(r.similarity, 9), r.rank) for r in similarity.similar_items_for(vec, seeds, n=4, num_blocks=2).collect()}
    assert some == {t for t in got if t[0] in (1, 1004, 39001)}


def test_single_precision_never_decides_a_rank():
    import pandas as pd

    rng = np.random.default_rng(3)
    n_items, n_terms = 700, 60
    M = rng.random((n_items, n_terms)) * (rng.random((n_items, n_terms)) < 0.3)
    M[:, 0] += 1.0
    M[350:] = M[:350] + 1e-8 * rng.random((350, n_terms)) * (M[:350] > 0)  # near copies: apart from the 9th digit on
    M /= np.sqrt((M * M).sum(axis=1, keepdims=True))
    pdf = pd.DataFrame({"item_id": rng.permutation(n_items), "terms": [np.flatnonzero(m) for m in M], "weights": [m[m > 0] for m in M],
                        "top": [int(m.argmax()) for m in M], "blk": np.arange(n_items) % 2, "lo": 0, "hi": 1})
    S = np.round(M @ M.T, 9)
    ids = pdf["item_id"].to_numpy()
    got = similarity._block_pair_kernel(6, 100)(pdf)
    for x in range(n_items):
        others = [y for y in range(n_items) if y % 2 != x % 2]
        want = sorted((-S[x, y], ids[y]) for y in others)[:6]
        mine = got[got["seed_id"] == ids[x]]
        assert np.allclose(sorted(-mine["similarity"]), [w for w, _ in want], atol=1.1e-9)


def _catalogue(n_items):
    """Items of a name, a brand and a year each: (item_id, terms, weights) in unit length."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n_items):
        terms = np.array([rng.integers(8), 10 + rng.integers(10), 30 + rng.integers(20)])
        w = np.array([3.1, 3.3, 4.0])
        rows.append((i, terms, w / np.sqrt((w * w).sum())))
    return rows


def test_floors_leave_few_pairs_and_the_same_lists(monkeypatch):
    import pandas as pd

    pdf = pd.DataFrame(_catalogue(6000), columns=["item_id", "terms", "weights"])
    pdf["blk"], pdf["lo"], pdf["hi"] = np.arange(len(pdf)) % 2, 0, 1
    heavy = pdf.iloc[np.lexsort(np.stack(pdf["terms"].to_list()).T)]
    floors = pd.concat(similarity._floor_kernel(4)(iter([heavy[["item_id", "terms", "weights"]]])))
    made = []
    dot = similarity._dot
    monkeypatch.setattr(similarity, "_dot", lambda a, b: made.append(len(a[1]) * len(b[1])) or dot(a, b))
    got = similarity._block_pair_kernel(4, own=True)(pdf.merge(floors, on="item_id", how="left"))
    assert sum(made) < 0.5 * 3000 * 3000  # every pair of the two blocks was made before
    M = np.zeros((len(pdf), 50))
    for i, t, w in pdf[["item_id", "terms", "weights"]].itertuples(index=False):
        M[i, t] = w
    S = np.round(M @ M.T, 9)
    floor = floors.set_index("item_id")["floor"]
    nth = np.sort(S, axis=1)[:, -4]
    assert (floor.to_numpy() <= nth[floor.index] + 1.1e-9).all()  # never above the n-th of all
    mine = {i: set(zip(g["item_id"], g["similarity"].round(8))) for i, g in got.groupby("seed_id")}
    for i in range(0, len(pdf), 7):
        across = [j for j in range(len(pdf)) if j % 2 != i % 2 and S[i, j] > nth[i] + 2e-9]
        assert {(j, round(S[i, j], 8)) for j in sorted(across, key=lambda j: (-S[i, j], j))[:4]} <= mine.get(i, set())


def test_lists_by_floors_match_brute_force(spark):
    rows = [(i, f"t{t}", float(x)) for i, terms, w in _catalogue(900) for t, x in zip(terms, w)]
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    got = {(r.seed_id, r.item_id, round(r.similarity, 9), r.rank)
           for r in similarity.similar_items(vec, n=5, num_blocks=3).collect()}
    assert got == _brute(rows, 5)
