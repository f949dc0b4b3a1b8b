"""Trigram search against the scan, sketches against exact counts, run folders, bucketed interactions."""

import os

import pytest
from pyspark.sql import functions as F

from recsift.operators import content, lookup, stats
from recsift.operators.search import TitleIndex
from recsift.session import cut_lineage, run_folder
from recsift.sources.tables import Tables
from tests.conftest import SF_SMALL


def test_trigram_search_equals_the_scan(spark, tmp_path):
    titles = ["Heat (1995)", "HEATHER", "the aea", "Été à la plage", "a%b_c", "line\nbreak", "x", "", None, "😀😀😀 smile", "aaaa",
              "Sie ÄRGERN sich", *[f"the film {i}" for i in range(300)]]
    items = spark.createDataFrame([(i, t, "x") for i, t in enumerate(titles)] + [(None, "Heat", "x"), (3, "heat twice", "x")],
                                  "item_id long, title string, gram string")
    index = TitleIndex.build(items, str(tmp_path / "index"))
    known = items.where("item_id IS NOT NULL")
    for text in ("heat", "HEAT", "the", "film 29", "eat (", "été", "b_c", "%b_", "e\nb", "😀😀", "😀😀😀", "aaa", "aaaaa", "x", "", "ärg",
                 "nothing", "the film 1"):
        for limit in (None, 10):
            want = [tuple(r) for r in lookup.search_titles(known, text, limit).collect()]
            got = [tuple(r) for r in index.search(text, limit).collect()]
            assert sorted(got) == sorted(want) if limit is None else [r[0] for r in got] == [r[0] for r in want], text
    again = TitleIndex(spark, index.path)  # the index outlives the object that built it
    assert again.search("smile").count() == 1
    plan = index.search("film 29")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram," in plan  # the lookup reaches the scan of the trigram table


def test_sketches_merge_over_batches(spark):
    rows = spark.range(0, 60000).select((F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 20000).alias("user_id"),
                                        (F.col("id") % 3000).alias("item_id"))
    batches = [stats.distinct_sketches(rows.where(F.col("user_id") % 3 == i), ("g",)) for i in range(3)]
    store = batches[0].unionByName(batches[1]).unionByName(batches[2])
    for keys in (("g",), ()):
        got = stats.sketch_counts(stats.merge_sketches(store, keys))
        exact = rows.groupBy(*keys).agg(F.count_distinct("user_id").alias("u"), F.count_distinct("item_id").alias("i"),
                                        F.count(F.lit(1)).alias("n"))
        both = got.crossJoin(exact) if not keys else got.join(exact, "g")
        checked = both.collect()
        assert len(checked) == (7 if keys else 1)
        for r in checked:
            assert r.n_rows == r.n
            assert abs(r.n_user_id / r.u - 1) < 0.06 and abs(r.n_item_id / r.i - 1) < 0.06  # about four standard errors
    assert stats.sketch_counts(stats.distinct_sketches(rows.limit(0))).first().n_user_id == 0


def test_run_folder_is_deleted(spark):
    with pytest.raises(ZeroDivisionError):
        with run_folder(spark) as path:
            kept = cut_lineage(spark.range(5))
            with run_folder(spark) as inner:
                cut_lineage(spark.range(3))
            assert kept.count() == 5
            assert not os.path.exists(inner.removeprefix("file:")) and os.path.exists(path.removeprefix("file:"))
            1 / 0
    assert not os.path.exists(path.removeprefix("file:"))
    assert cut_lineage(spark.range(2)).count() == 2


def test_large_vocabulary_stays_a_table(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"w{i % 5} w{i % 11} common x{i}", ["g"]) for i in range(60)],
                                  "item_id long, title string, genres array<string>")
    local = content.ContentModel.fit(items, max_features=12)
    monkeypatch.setattr(content, "LOCAL_VOCABULARY", 3)
    table = content.ContentModel.fit(items, max_features=12)
    rows = lambda df, cols: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert rows(table.vocab, ("term", "df", "tf_total", "idf", "term_idx")) == rows(local.vocab, ("term", "df", "tf_total", "idf", "term_idx"))
    round9 = lambda m: {(r.item_id, r.term): round(r.weight, 9) for r in m.vectors.collect()}
    assert round9(table) == round9(local)
    assert "LocalTableScan" not in table.vocab._jdf.queryExecution().executedPlan().toString()


def test_bucketed_interactions_need_no_exchange(spark):
    t = Tables(spark, SF_SMALL, reuse=True)
    pairs = t.interactions()
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, Tables(spark, SF_SMALL).interactions().collect()))
    cand = spark.range(0, 5000).select((F.col("id") % 150).alias("user_id"), (F.col("id") % 199).alias("item_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        anti = lookup.drop_seen(cand, pairs)
        plan = anti._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan  # the candidates only
        both = cand.join(t.split().where("split = 'train'"), ["user_id", "item_id"])
        assert both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        seen = {(r.user_id, r.item_id) for r in pairs.collect()}
        assert {(r.user_id, r.item_id) for r in anti.collect()} == {(i % 150, i % 199) for i in range(5000)} - seen
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_trigrams_are_made_in_spread_tasks(spark, tmp_path, monkeypatch):
    from recsift.operators import search

    # One split of titles must not be one task of trigrams: the table has a file for each ``TITLES_PER_TASK`` titles.
    monkeypatch.setattr(search, "TITLES_PER_TASK", 20, raising=False)
    rows = [(i, f"title number {i:03d}") for i in range(400)] + [(7, "title number 007"), (8, None)]
    items = spark.createDataFrame(rows, "item_id long, title string").coalesce(1)
    index = search.TitleIndex.build(items, str(tmp_path / "t"))
    assert spark.read.parquet(f"{index.path}/grams").inputFiles().__len__() > 16
    assert [r.item_id for r in index.search("r 007", limit=None).collect()] == [7, 7]
