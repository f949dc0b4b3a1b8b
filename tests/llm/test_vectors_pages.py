"""Edge cases and brute force for top-k search and page extraction; the pipeline against brute force."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.llm import exact_dedup, knn, mixing, pages, simhash, toxicity
from recsift.llm.common import table

SF = "/root/testdata/sf0.001"


def _brute(rows, k):
    """rows: (vec_id, ints); queries: ids divisible by 50."""
    dim = max(len(v) for _, v in rows)
    full = [(i, [*v, *[0] * (dim - len(v))]) for i, v in rows]
    out = set()
    for q, a in full:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in full if i != q)[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("blocks", [(16384, 4096), (64, 3)])
def test_top_k(spark, blocks):
    r = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=8) / 2]) for i in range(700)]
    rows += [(i, [0.5] * 8) for i in range(700, 900)] + [(900, []), (901, [1.0]), (902, [0.0] * 8), (903, [9.0] * 10)]
    bad = [(950, None), (951, [1.0, None]), (952, [float("nan")] * 8), (953, [float("inf")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(3)
    got = knn.top_k(df, F.col("vec_id") % 50 == 0, data_block=blocks[0], query_block=blocks[1]).collect()
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    assert {tuple(x) for x in got} == _brute(ints, 5) and len(got) == 5 * 19


def test_top_k_large_components_few_rows_and_none(spark):
    rows = [(0, [1e15, 1.0]), (50, [1e15, 2.0]), (51, [-1e15, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(x) for x in knn.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    top = 2 ** 63 - 1
    assert got == {(0, 1, 50, top), (0, 2, 51, -top - 1), (50, 1, 0, top), (50, 2, 51, -top - 1)}
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert knn.top_k(none, F.col("vec_id") % 50 == 0).count() == 0
    assert knn.top_k(df.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_query_rows(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(i, [i / 10, 1.0]) for i in range(1, 9)]
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert sorted(x["rank"] for x in got.collect()) == [1, 2, 3, 4, 5]


def test_a_query_id_that_fills_pivots_and_cells(spark):
    """One query id, repeated more than k + 1 times, with the largest norm and the first pivot's place."""
    ids = [r[0] for r in spark.range(0, 5000, 50).orderBy(F.xxhash64("id")).limit(1).collect()]
    r = np.random.default_rng(4)
    others = [(int(i), [float(x) for x in r.normal(size=6)]) for i in range(1, 70) if i % 50]
    for copies in (10, 40):
        rows = [(ids[0], [9.0] * 6)] * copies + [(50, [1.0, -2.0, 0.5, 0.0, 0.0, 1.0])] * 7 + others
        rows += [(71, others[0][1])] * 20  # and a candidate that is repeated
        got = knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 50 == 0)
        want = set()
        for q, v in {(a, tuple(b)) for a, b in rows if a % 50 == 0}:
            quant = lambda x: np.floor(256 * np.array(x)).astype(np.int64)
            scores = sorted((-int(quant(v) @ quant(x)), i) for i, x in rows if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)}
        assert {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in got.collect()} == want


def _lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("cells", [1 << 28, 8])
def test_common_is_longest(cells):
    r = random.Random(2)
    for _ in range(400):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 15))] for _ in range(2))
        at = pages.common(a, b, cells)
        assert len(at) == _lcs(a, b) and at == sorted(set(at))
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in at))


def _text(html):
    return "\n\n".join(t for t, r in pages.lines_of(html) if r != pages.DROP)


def test_lines():
    cases = {
        None: "", "": "", "plain &amp; text": "plain & text", "a < b": "a < b", "<p>x<p>y": "x\n\ny",
        "<p>one <b>two</b>\n three<br>four&nbsp;five</p>": "one two three four five",
        "<script>var t='<p>no</p>'</script><p>yes": "yes", "<style>p{}</style>x<!-- <p>no -->y": "xy",
        "<nav><ul><li><a>m</a></li></ul></nav><p>t</p><footer>f": "t",
        "<div class='side-bar ad'>a<div>b</div></div><p>t": "t", "<p class=ad>a<p>t": "t",
        "<ul><li>1<li>2</ul>": "1\n\n2", "<p title='a > b'>t</p>": "t", "<p>cut <a hre": "cut",
        "<div id=comments><p>c</p></div><p>t</p>": "t", "<form><p>f</p></form>t": "t", "<p>x</b></p>y": "x\n\ny",
        "<p>a<span class=ad>b</span>c</p>": "a\n\nc", "<table><tr><td>1<td>2</table>": "1\n\n2",
        "<title>t</title><h1>h</h1>": "h", "<textarea>x</textarea>y": "y", "<script>never closed": "",
    }
    for html, want in cases.items():
        assert _text(html) == want, html
    deep = "<div>" * 20000 + "x" + "</div>" * 20000
    assert _text(deep) == "x"


def test_class_names_and_forms():
    cases = {
        "<div class='content has-sidebar'><p>t": "t", "<div class=no-sidebar><article><p>t</p></article></div>": "t",
        "<div class=search><article><p>t</p></article><p>u</p></div>v": "t\n\nv", "<aside><main>t</main></aside>": "t",
        "<article><div class=article-header><h1>h</h1></div><h2 id=search>s</h2><p class=share-price>9</p></article>": "h\n\ns\n\n9",
        "<article><div class=header><h1>h</h1></div><div id=comments>c</div><p class=notice>n</p>t</article>": "h\n\nt",
        "<div id=comments><article>c</article></div><article class='post comment'>d</article>t": "t",
        "<footer><article>f</article></footer><div hidden><article>h</article></div><p class='hidden-gem'>t": "t",
        "<form id=aspnetForm><nav>n</nav><p>long text</p><label>Name</label><input><button>Go</button></form><p>t": "long text\n\nt",
        "<form><main><p>t</p><form><p>Your name</p></form><p>much more text</p></main></form>": "t\n\nmuch more text",
        "<form class=search><p>find it here</p></form><p>t</p>": "t",
    }
    for html, want in cases.items():
        assert _text(html) == want, html


def test_differencing(spark):
    frame = "<div>Home About</div>{}<div>All rights</div>"
    urls = ["http://H.example/a/1", "http://h.example/a/2?x=1", "http://h.example/b/3", "http://other.example/", None]
    bodies = ["<p>first</p>", "<p>second</p><p>more</p>", "<p>third</p>", "<p>alone</p>", "<p>no url</p>"]
    rows = [(i, u, frame.format(b)) for i, (u, b) in enumerate(zip(urls, bodies))]
    rows += [(10, urls[0], frame.format("<article><p>q</p><aside>s</aside></article>")), (11, "http://h.example/z", None),
             (12, "http://copy.example/1", frame.format("<p>c</p>")), (13, "http://copy.example/1", frame.format("<p>c</p>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.extract(df).collect()}
    assert got[1][0] == "second\n\nmore" and got[2][0] == "third" and got[10][0] == "q"
    assert got[3][0] == "Home About\n\nalone\n\nAll rights" and got[4][0].count("no url") == 1
    assert got[11] == ("", 0) and got[12][0] == got[13][0] and "c" in got[12][0]
    assert all(n == len(t) for t, n in got.values())
    assert pages.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_near_copies_keep_their_text(spark, partitions):
    body = "".join(f"<p>A long paragraph with the number {i} of this page</p>" for i in range(8))
    page = "<div>Home</div>{}<div>All rights</div>"
    urls = [f"http://h.example/a/1?page={i}" for i in range(40)] + ["http://h.example/a/1/print"]
    rows = [(i, u, page.format(body + f"<p>ad {i}</p>")) for i, u in enumerate(urls)]
    rows += [(90, "http://h.example/b/2", page.format("<p>Other text altogether on this one</p>" * 3)), (91, "http://h.example/a/2", "")]
    rows += [(100 + i, f"http://only.example/a?{i}", page.format(body + f"<p>ad {i}</p>")) for i in range(3)]
    want = "\n\n".join(f"A long paragraph with the number {i} of this page" for i in range(8))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["page_id"]: r["text"] for r in pages.extract(
            spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert all(got[i] == f"{want}\n\nad {i}" for i in range(41))
    assert got[90].count("Other text") == 3 and "Home" not in got[90] and got[91] == ""
    assert all(got[100 + i] == f"Home\n\n{want}\n\nad {i}\n\nAll rights" for i in range(3))


def test_differencing_decides_inside_the_article(spark):
    page = "<div>Home</div><p>lead {0}</p><article><p>Subscribe now</p><p>body {0}</p><p>more {0}</p></article>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(3)]
    rows.append((9, "http://i.example/9", "<p>a</p><article class=comment><p>me too</p></article>"))
    # The neighbour has the line as an advert only.
    rows += [(20, "http://j.example/1", "<article><p>quoted</p><p>x</p></article>"),
             (21, "http://j.example/2", "<div class=ad>quoted</div><article><p>y</p></article>")]
    got = {r["page_id"]: r["text"] for r in pages.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"lead {i}\n\nbody {i}\n\nmore {i}" for i in range(3)} | {9: "a", 20: "quoted\n\nx", 21: "y"}


def test_shared_sentences_of_two_articles_stay(spark):
    """Three pages of a host and most of them are needed before a line of the article is template."""
    page = "<div>Home</div><article><p>{}</p><p>Ok</p><p>Yes</p></article>"
    rows = [(i, f"http://two.example/{i}", page.format(t)) for i, t in enumerate(("Poem", "Other"))]
    rows += [(10 + i, f"http://many.example/{i}", f"<article><p>text {i}</p><p>{'Les.' if i < 4 else f'line {i}'}</p></article>")
             for i in range(9)]
    # Forty near copies are one page of their host.
    body = "".join(f"<p>A long paragraph with the number {i} of this page</p>" for i in range(8))
    rows += [(100 + i, f"http://runs.example/a?{i}", f"<article>{body}<p>Yes</p><p>ad {i}</p></article>") for i in range(40)]
    rows.append((150, "http://runs.example/b", "<article><p>Something else</p><p>Yes</p></article>"))
    rows += [(200 + i, f"http://most.example/{i}", f"<article><p>body {i}</p><p>Subscribe now</p></article>") for i in range(5)]
    rows.append((205, "http://most.example/5", "<article><p>body 5</p></article>"))
    got = {r["page_id"]: r["text"] for r in pages.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Poem\n\nOk\n\nYes" and got[1] == "Other\n\nOk\n\nYes"
    assert all(got[10 + i] == f"text {i}\n\n" + ("Les." if i < 4 else f"line {i}") for i in range(9))
    assert got[100].count("Yes") == 1 and got[150] == "Something else\n\nYes"
    assert all(got[200 + i] == f"body {i}" for i in range(6))


def test_rows_differ_by_their_null_fields(spark):
    """Equal values in other fields, NULL elsewhere: different pages, each with its own lines."""
    rows = [(1, "<p>x</p>", None), (1, None, "<p>x</p>"), (None, None, "<p>x</p>"), (None, "<p>x</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert pages._rows_of(df.union(df)).select("uid").distinct().count() == 4
    got = pages.extract(df).collect()
    assert sorted((r["url"] is None, r["text"]) for r in got) == [(False, "")] * 2 + [(True, "x")] * 2


def test_names_by_their_parts():
    dropped = ["cookie-consent-banner", "user-comments", "comments-wrapper", "sidebar-widget", "site-footer__inner",
               "main-sidebar", "newsletter_box"]
    for name in dropped:
        assert _text(f"<div class={name}><p>x</p></div><p>t</p>") == "t", name
        assert _text(f"<div id={name}><p>x</p></div><p>t</p>") == "t", name
    for name in ("has-sidebar", "no-sidebar", "content-sidebar", "article-header", "share-price", "comment-count", "lunch-menu",
                 "page-wrapper", "main-content", "hidden-gem", "post-list"):
        assert _text(f"<div class={name}><p>x</p></div><p>t</p>") == "x\n\nt", name


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_pages_of_the_table(spark, sf):
    """Against the article element cut out by hand."""
    import html as h
    import re

    source = duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall()
    got = {r["page_id"]: r["text"] for r in pages.extract(table(spark, sf, "pages")).collect()}
    assert len(got) == len(source)
    for i, page in source:
        if "<article>" in (page or ""):
            article = re.sub(r"(?s)</article>.*", "", page.split("<article>", 1)[1])
            blocks = re.split(r"</?(?:h1|p|div|li|ul)\b[^>]*>", article)
            want = [" ".join(h.unescape(re.sub(r"<[^>]*>?", lambda m: " " if m[0].startswith("<br") else "", b)).split())
                    for b in blocks]
            assert got[i] == "\n\n".join(b for b in want if b)


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing sources", "packing"]
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    clean = {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    best = {}
    for i in sorted(clean):
        best[rows[i].translate(str.maketrans(exact_dedup.UPPER, exact_dedup.UPPER.lower()))] = i
    fps = {i: simhash.fingerprint(rows[i]) for i in best.values()}
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    left = {i for i in fps if find(i) == i}
    report = mixing.mix_report(docs.where(F.col("doc_id").isin(list(left)))).where("taken > 0").collect()
    # Whole documents: the last one of a source if its target reaches half of it.
    want = {r["doc_id"] for r in report if r["taken"] >= r["size"] or 2 * r["taken"] >= r["size"]}
    got = pipeline.run(spark, SF).toPandas()
    assert set(got["doc_id"]) == want
    assert (got.groupby("sequence_id")["length"].sum() <= 2048).all()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got.itertuples())
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op4_voronoi_topk"])
def test_oracle(spark, name):
    from recsift.llm.registry import ORACLE, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(str, got.values.tolist())) == sorted(map(str, want.values.tolist()))
