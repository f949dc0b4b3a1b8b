"""CSV readers (S1-S5, S7), adapters and stores."""

import pytest
from pyspark.sql import functions as F

from recsift import schema as S
from recsift.functions.metrics import percent, two_digits
from recsift.sources import csv as C
from recsift.sources import store


def test_dropmalformed_count_matches_collect(spark, tmp_path):
    p = tmp_path / "rating.csv"
    p.write_text("userId,movieId,rating,timestamp\n1,10,4.0,2015-03-01 10:00:00\n2,11,3.5,1425204000\n3,12\n")
    df = C.read_ratings(spark, str(p))
    assert df.count() == 2
    assert len(df.collect()) == 2
    assert df.columns == ["user_id", "item_id", "rating", "ts"]
    ts = {r.user_id: r.ts for r in df.collect()}
    assert ts[1] is not None and ts[2] is not None  # text and epoch seconds


def test_movies_split_and_year(spark, tmp_path):
    p = tmp_path / "movie.csv"
    p.write_text('movieId,title,genres\n1,Toy Story (1995),Adventure|Animation\n2,"Heat, The",Action\n')
    rows = {r.item_id: r for r in C.read_movies(spark, str(p)).collect()}
    assert rows[1].genres == ["Adventure", "Animation"] and rows[1].year == 1995
    assert rows[2].genres == ["Action"] and rows[2].year is None


def test_missing_file_raises_or_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        C.read_tags(spark, str(tmp_path / "nope.csv"))
    empty = C.read_genome_scores(spark, str(tmp_path / "nope.csv"), on_missing="empty")
    assert empty.count() == 0 and empty.columns == ["item_id", "tag_id", "relevance"]


def test_read_folder(spark, tmp_path):
    (tmp_path / "rating.csv").write_text("userId,movieId,rating,timestamp\n1,1,5.0,1\n")
    (tmp_path / "movie.csv").write_text("movieId,title,genres\n1,A (2000),X\n")
    (tmp_path / "tag.csv").write_text("userId,movieId,tag,timestamp\n1,1,fun,1\n")
    (tmp_path / "genome_scores.csv").write_text("movieId,tagId,relevance\n1,7,0.9\n")
    (tmp_path / "genome_tags.csv").write_text("tagId,tag\n7,space\n")
    t = C.read_folder(spark, str(tmp_path))
    assert {k: v.count() for k, v in t.items()} == {
        "interactions": 1, "items": 1, "tags": 1, "tag_scores": 1, "tag_names": 1}


def test_recs_store_round_trip(spark, tmp_path):
    recs = spark.createDataFrame([(1, 2, 1, 0.9), (1, 3, 2, 0.5)], "user_id long, item_id long, rank int, score double")
    path = str(tmp_path / "recs")
    store.write_recs(recs, path, "als")
    store.write_recs(recs.withColumn("score", F.lit(0.1)), path, "content_based")
    assert store.read_recs(spark, path, "als").count() == 2
    assert store.read_recs(spark, path).count() == 4


def test_materialize_canonical_tables(spark, tmp_path):
    from recsift.sources.tables import Tables, materialize
    from tests.conftest import SF_SMALL

    paths = materialize(spark, SF_SMALL, str(tmp_path / "canon"))
    t = Tables(spark, SF_SMALL)
    assert spark.read.parquet(paths["interactions"]).count() == t.interactions().count()
    assert spark.read.parquet(paths["items"]).schema.simpleString() == t.items().schema.simpleString()


def test_tags_permissive_keeps_short_rows(spark, tmp_path):
    p = tmp_path / "tag.csv"
    p.write_text("userId,movieId,tag,timestamp\n1,10,funny,1\n2,11\n")
    rows = C.read_tags(spark, str(p)).orderBy("user_id").collect()
    assert len(rows) == 2 and rows[1].tag is None and rows[1].item_id == 11


@pytest.mark.parametrize("parts", [1, 3])
def test_ingest_keeps_or_quarantines_every_line(spark, tmp_path, parts):
    good = [f"{i},{i % 7},{i % 5 + 0.5},2015-03-01 10:00:0{i % 10}" for i in range(200)]
    bad = {"1,2": "malformed", "a,1,2.0,1": "malformed", "1,2,3.0,4,5": "malformed", ",3,4.0,1": "no id", "4,,4.0,1": "no id",
           "5,6,,1": "no rating", "5,6,NaN,1": "no rating", "7,8,4.0,yesterday": "bad timestamp", "9,9,x,1": "malformed"}
    lines = [x for pair in zip(good, [*bad, *[None] * len(good)]) for x in pair if x is not None]
    folder = tmp_path / "in"
    folder.mkdir()
    for p in range(parts):
        (folder / f"rating{p}.csv").write_text("userId,movieId,rating,timestamp\n" + "\n".join(lines[p::parts]) + "\n\n")
    got = C.ingest(spark, "ratings", str(folder), str(tmp_path / "out"))
    counts = {r.reason: r.n_rows for r in got.counts.collect()}
    want = {"ok": len(good)}
    for reason in bad.values():
        want[reason] = want.get(reason, 0) + 1
    assert counts == want and sum(counts.values()) == len(lines)
    assert got.kept.columns == ["user_id", "item_id", "rating", "ts"] and got.kept.where("ts IS NULL").count() == 0
    assert sorted((r.user_id, r.item_id) for r in got.kept.collect()) == sorted((i, i % 7) for i in range(200))
    records = {r.record: r.reason for r in got.quarantine.collect()}
    assert all(records[line] == "malformed" for line, reason in bad.items() if reason == "malformed")
    assert any('"yesterday"' in r for r, reason in records.items() if reason == "bad timestamp")
    again = C.ingest(spark, "ratings", str(folder), str(tmp_path / "out"))  # replaces, doesn't add
    assert again.kept.count() == len(good)


def test_ingest_of_the_other_files(spark, tmp_path):
    files = {
        "movies": ('movieId,title,genres\n1,"Heat, The (1995)",Action\n2,,X\nx,T,G\n', {"ok": 1, "no title": 1, "malformed": 1}),
        "tags": ("userId,movieId,tag,timestamp\n1,1,fun,1\n1,2,,1\n2,11\n", {"ok": 1, "no tag": 1, "malformed": 1}),
        "genome_scores": ("movieId,tagId,relevance\n1,7,0.9\n1,8,\n,8,0.5\n", {"ok": 1, "no relevance": 1, "no id": 1}),
        "genome_tags": ("tagId,tag\n7,space\n8,\n", {"ok": 1, "no tag": 1}),
    }
    for kind, (text, want) in files.items():
        (tmp_path / f"{kind}.csv").write_text(text)
        got = C.ingest(spark, kind, str(tmp_path / f"{kind}.csv"), str(tmp_path / f"{kind}-out"))
        assert {r.reason: r.n_rows for r in got.counts.collect()} == want, kind


def test_files_give_the_same_rows_back(spark, tmp_path):
    odd = ["plain", "", None, " blanks ", 'says "so", twice', "back\\slash", "ends\\", 'quote"\\', "a|b, c", "été 東京", "two\nlines"]
    items = spark.createDataFrame([(i, x, ["A", "B C"], None) for i, x in enumerate(odd)], S.ITEMS)
    tags = spark.createDataFrame([(1, i, x, None) for i, x in enumerate(odd)], S.TAGS).withColumn(
        "ts", F.timestamp_micros(F.lit(1425204000123456)))
    C.write_folder({"items": items, "tags": tags}, str(tmp_path / "f"))
    back = C.read_folder(spark, str(tmp_path / "f"), on_missing="empty")
    want = [x.replace("\n", " ") if x else None for x in odd]
    assert [r.title for r in back["items"].orderBy("item_id").collect()] == want
    assert [r.tag for r in back["tags"].orderBy("item_id").collect()] == want
    assert {tuple(r.genres) for r in back["items"].collect()} == {("A", "B C")}
    C.write_folder({"items": items.withColumn("genres", F.array().cast("array<string>"))}, str(tmp_path / "g"))
    assert C.read_movies(spark, str(tmp_path / "g" / "movie.csv")).where("genres IS NOT NULL").count() == 0
    assert back["tags"].select("ts").distinct().collect() == tags.select("ts").distinct().collect()
    assert back["interactions"].count() == 0
    C.write_folder({"tags": tags.limit(0)}, str(tmp_path / "f"))  # replaced by an empty table
    assert C.read_tags(spark, str(tmp_path / "f" / "tag.csv")).count() == 0


def test_percent_and_digits(spark):
    df = spark.createDataFrame([(1, 3), (0, 4), (2, 0), (None, 5)], "a long, b long")
    got = df.select(percent(F.col("a"), F.col("b")).alias("p"), two_digits(F.col("a") / F.lit(8)).alias("d")).collect()
    assert [r.p for r in got] == ["33.33 %", "0.00 %", None, None] and [r.d for r in got] == ["0.13", "0.00", "0.25", None]
