"""Every registered query: value check against DuckDB (V) or rows-only (R)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = E.queries()
ORACLE = E.oracle_sql()
# Queries whose result is a ranking: rows must come in the oracle's order.
ORDERED = {"rating_distribution", "popular_genres", "top_rated_items", "best_rated_items", "user_history",
           "sample_users", "search_titles", "search_titles_regex", "search_documents",
           "preview_interactions"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(v)


def _rows(cols, records, ordered=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    if not ordered:
        rows.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 50


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_value_check(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    scols, srows = _rows(df.columns, [tuple(r) for r in df.collect()], name in ORDERED)
    cur = duck.execute(ORACLE[name])
    dcols, drows = _rows([d[0] for d in cur.description], cur.fetchall(), name in ORDERED)
    assert scols == dcols
    assert len(srows) == len(drows)
    assert srows == drows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows
    if {"user_id", "rank", "score"} <= set(df.columns):  # lists of at most 10, scores falling with the rank
        lists = {}
        for r in rows:
            lists.setdefault(r.user_id, []).append((r["rank"], r.score))
        for ranks in lists.values():
            ranks.sort()
            assert [k for k, _ in ranks] == list(range(1, len(ranks) + 1)) and len(ranks) <= 10
            assert all(x[1] >= y[1] for x, y in zip(ranks, ranks[1:]))
    if name == "algorithm_comparison":
        assert len({(r.algorithm, r.metric) for r in rows}) == 16
    for c in ("prediction", "value", "avg_rmse", "max_gap"):
        if c in df.columns:
            assert all(math.isfinite(r[c]) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["item_id", "title", "genres", "rating_count", "avg_rating", "rating_stddev"]
