"""Neighbours of catalogues of more than one block, searched in the groups of a row's first terms."""

import numpy as np
import pandas as pd
import pytest

from recsift.operators import similarity


def _rows(n_items=700, seed=5):
    """Vectors of a few frequent terms, and for two items in three one or two rare terms."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n_items):
        frequent = [f"{kind}{rng.integers(k)}" for kind, k in (("a", 4), ("b", 6), ("c", 9))]
        rare = [f"rare{x}" for x in rng.choice(90, size=rng.integers(0, 3), replace=False)]
        w = np.array([1.0, 1.2, 1.5][:len(frequent)] + [2.5] * len(rare)) * rng.integers(1, 3, len(frequent) + len(rare))
        out += [(2 * i + 1, t, float(x)) for t, x in zip(frequent + rare, w / np.sqrt((w * w).sum()))]
    return out


def _brute(rows, n, seeds=None):
    frame = pd.DataFrame(rows, columns=["item", "term", "w"]).pivot(index="item", columns="term", values="w").fillna(0.0)
    ids, M = frame.index.to_numpy(), frame.to_numpy()
    S = np.round(M @ M.T, 9)
    out = set()
    for a in range(len(ids)):
        best = sorted((-S[a, b], int(ids[b])) for b in range(len(ids)) if b != a and S[a, b] > 0)[:n]
        out |= {(int(ids[a]), j, round(float(-s), 8), k) for k, (s, j) in enumerate(best, 1) if seeds is None or ids[a] in seeds}
    return out


def _got(df):
    return {(r.seed_id, r.item_id, round(r.similarity, 8), r.rank) for r in df.collect()}


@pytest.fixture
def grouped(monkeypatch):
    """Whether each search in groups took place."""
    calls, inner = [], similarity._by_terms
    monkeypatch.setattr(similarity, "_by_terms", lambda *a: calls.append(inner(*a)) or calls[-1])
    return calls


@pytest.mark.parametrize("number", [False, True])
def test_groups_match_brute_force(spark, grouped, number):
    rows = _rows()
    known = sorted({t for _, t, _ in rows})
    table = [(i, known.index(t), t, w) for i, t, w in rows]
    vec = spark.createDataFrame(table, "item_id long, term_idx int, term string, weight double")
    vec = vec if number else vec.drop("term_idx")
    assert _got(similarity.similar_items(vec, n=4, block_size=96)) == _brute(rows, 4)
    assert len(grouped) == 1 and grouped[0] is not None


def test_many_seeds_ask_for_their_groups(spark, grouped, monkeypatch):
    monkeypatch.setattr(similarity, "NEAR_ROWS", 128)
    rows = _rows()
    seeds = sorted({i for i, _, _ in rows})[::3]
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    found = similarity.similar_items_for(vec, spark.createDataFrame([(i,) for i in seeds], "item_id long"), n=4, block_size=96)
    assert _got(found) == _brute(rows, 4, set(seeds))
    assert len(grouped) == 1 and grouped[0] is not None


def test_long_vectors_meet_all_blocks(spark, grouped):
    rng = np.random.default_rng(3)
    w = rng.random((150, 40)) + 0.5
    w /= np.sqrt((w * w).sum(axis=1))[:, None]
    rows = [(i, f"t{t}", float(w[i, t])) for i in range(150) for t in range(40)]
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    assert _got(similarity.similar_items(vec, n=3, block_size=64)) == _brute(rows, 3)
    assert grouped == [None]


def test_a_row_asks_for_its_first_terms_alone():
    terms = [["year", "brand", "rare"], ["year", "brand", "rare"], ["year", "brand", "rare"], ["year", "brand"]]
    weights = [[0.6, 0.4, 0.69], [0.6, 0.4, 0.69], [0.6, 0.4, 0.69], [0.8, 0.6]]
    pdf = pd.DataFrame({"item_id": range(4), "terms": terms, "weights": weights, "floor": [0.9, 0.7, None, 0.7]})
    frequent = {"year": (5, 100), "brand": (6, 200)}
    (out,) = similarity._groups_kernel(frequent, bundles=1, rare=10, count=250, longest=1.0)([pdf])
    # Without the rare term the rest is 0.72 long, without the year 0.4; a third row without a floor asks for all it has.
    assert [list(x) for x in out["ask"]] == [[0], [0, 5], [similarity.EVERYTHING], [5]]
    assert [list(x) for x in out["hold"]] == [[0, 5, 6]] * 3 + [[5, 6]]


def test_groups_and_block_pairs_agree_on_copies_and_null_ids(spark, grouped):
    rows = _rows(500) + [(i + 5000, t, w) for i, t, w in _rows(500) if i < 120] + [(None, t, w) for i, t, w in _rows(500, 6) if i == 9]
    vec = spark.createDataFrame(rows, "item_id long, term string, weight double")
    got, want = (sorted(similarity.similar_items(vec, n=3, **how).collect(), key=str) for how in ({"block_size": 48}, {"num_blocks": 3}))
    assert got == want and len(got) > 1500
    assert len(grouped) == 1 and grouped[0] is not None
