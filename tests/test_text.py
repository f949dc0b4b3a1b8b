"""Year extraction (`titles` fixture), tokens, stop words, search."""

from pyspark.sql import functions as F

from recsift.functions import text
from recsift.operators import content, lookup

TITLES = [("Toy (1995)", 1995), ("Toy (1995) ", None), ("X", None), ("A (1990) (2001)", 2001), (None, None)]


def test_year_from_title(spark):
    df = spark.createDataFrame([(t,) for t, _ in TITLES], "title string")
    got = [r.y for r in df.select(text.year_from_title(F.col("title")).alias("y")).collect()]
    assert got == [y for _, y in TITLES]


def test_tokens_and_stop_words(spark):
    docs = spark.createDataFrame([(1, "The Matrix: a film, THE film (1999) x"), (2, "the of and")],
                                 "item_id long, document string")
    terms = {(r.item_id, r.term): r.tf for r in content.document_terms(docs).collect()}
    assert terms == {(1, "matrix"): 1, (1, "film"): 2, (1, "1999"): 1}  # 'a', 'x' too short; 'the' stop word
    assert len(text.english_stop_words()) == 181


def test_search_literal_and_regex(spark):
    items = spark.createDataFrame([(1, "Star (1977)", ["A"]), (2, "st.r", ["B"]), (3, None, ["C"])],
                                  "item_id long, title string, genres array<string>")
    lit = [r.item_id for r in lookup.search_titles(items, "st.r").collect()]
    rx = [r.item_id for r in lookup.search_titles(items, "st.r", regex=True).collect()]
    assert lit == [2] and rx == [1, 2]


def test_regex_search_keeps_escapes(spark):
    items = spark.createDataFrame([(1, "Alien 3", ["A"]), (2, "ALIEN X", ["B"])],
                                  "item_id long, title string, genres array<string>")
    got = [r.item_id for r in lookup.search_titles(items, r"alien \D", regex=True).collect()]
    assert got == [2]


def test_terms_are_counted_in_spread_tasks(spark, monkeypatch):
    from recsift.operators import content

    monkeypatch.setattr(content, "CHARS_PER_TASK", 100, raising=False)
    rows = [(i % 300, f"alpha beta gamma{i} beta") for i in range(600)]  # ids repeat
    docs = spark.createDataFrame([*rows, (None, "alpha"), (5, None)], "item_id long, document string").coalesce(1)
    terms = content.document_terms(docs, stop_words=False)
    got = {(r.item_id, r.term): r.tf for r in terms.collect()}
    assert got[(7, "beta")] == 4 and got[(None, "alpha")] == 1 and len(got) == 300 * 4 + 1
    # A shuffle by id before the terms are made, and none after.
    plan = terms.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and plan.index("Generate") < plan.index("Exchange")
