"""Edge cases and brute force for the operators on documents."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.llm import exact_dedup, mixing, packing, pii, sharding, simhash, tokens, toxicity
from recsift.llm.components import connected_components
from recsift.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, key int, __x string"
rnd = random.Random(7)
WORDS = ["tree", "Été", "heble", "12", "don't", "a", "Über", "中文", "x@y.z", "tion"]
LONG = " ".join(rnd.choice(WORDS) for _ in range(30_000))
TEXTS = [None, "", " \t\n", "A b C", "a B c", "a b  c", "one", "two words", LONG, LONG + " end", "A b C",
         "mail joe.doe@mail.example.com or +1 (555) 123-4567, 10.0.0.300 10.0.0.1", "4111 1111 1111 1111 4111111111111112",
         "joe [at] mail [dot] com", *[" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 60))) for _ in range(40)],
         *["hot copy text"] * 30]
ROWS = [(i, t, "en", [None, "b", "a", "ä", "hot", "hot"][i % 6], None, "s", 1, "x") for i, t in enumerate(TEXTS)]
ROWS += [ROWS[3], ROWS[3], (None, "null id", None, None, None, None, None, None), (None, "A b C", None, "z", 1, "", 2, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_exact_dedup(spark, docs, empty):
    got = exact_dedup.resolve(docs, exact_dedup.temporary_index(spark)).collect()
    groups = defaultdict(list)
    for r in ROWS:
        groups[_lower(r[1])].append(r[0])
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, got)) == want
    kept = exact_dedup.deduplicate(docs, exact_dedup.temporary_index(spark))
    assert kept.columns == docs.columns
    assert sorted(_lower(r["text"]) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.resolve(empty, exact_dedup.temporary_index(spark)).count() == 0


def test_exact_dedup_keeps_an_index(spark, docs):
    index = exact_dedup.temporary_index(spark)
    first, second = docs.where("doc_id < 20"), docs.where("doc_id >= 20 AND doc_id IS NOT NULL")
    exact_dedup.resolve(first, index).collect()
    again = exact_dedup.DigestIndex(spark, index.path)
    known = {r["digest"] for r in again.table().collect()}
    kept = exact_dedup.deduplicate(second, again)
    assert all(hashlib.sha256(_lower(r["text"]).encode()).digest() not in known for r in kept.collect())
    rerun = exact_dedup.resolve(first, again).where("kept").select("text_sha256").distinct().count()
    assert rerun == len(known)
    assert again.table().groupBy("digest").count().where("count > 1").count() == 0


def _water(sizes, weights):
    total, capped, target = sum(sizes.values()), {}, {}
    while True:
        free = {s: w for s, w in weights.items() if s not in capped}
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(free.values())
        over = {s: 3 * sizes[s] for s in free if level * free[s] >= 3 * sizes[s]}
        if not over:
            return capped | {s: level * w for s, w in free.items()}
        capped |= over


def test_mixing(spark, docs, empty):
    got = mixing.mix_report(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = _water(sizes, {s: i % 3 + 1 for i, s in enumerate(names)})
    taken = defaultdict(int)
    assert len(got) == len(ROWS)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]], abs_tol=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_report(docs.repartition(5)).collect()))
    whole = mixing.mix(docs)
    assert whole.columns == docs.columns
    words = Counter()
    for r in whole.collect():
        words[r["source"]] += size(r["text"])
    longest = defaultdict(int)
    for r in ROWS:
        longest[r[3]] = max(longest[r[3]], size(r[1]))
    assert all(abs(words[s] - target[s]) <= longest[s] / 2 + 1 for s in sizes)
    assert {tuple(r) for r in whole.collect()} <= set(ROWS)  # whole rows, nothing overwritten
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_keeps_columns_with_working_names(spark):
    rows = [(i, f"w{i} " * (i + 1), "s", "own", 7, 8, 9) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __src string, __size int, __h int, __doc int")
    got = mixing.mix(df)
    assert got.columns == df.columns and {tuple(r) for r in got.collect()} <= set(rows)


def test_near_duplicates_are_decided_by_their_own_text(spark):
    base = " ".join(f"word{i}" for i in range(300))
    near = base.replace("word150", "other")
    assert (simhash.fingerprint(base) ^ simhash.fingerprint(near)).bit_count() <= 6
    bits = (simhash.fingerprint(base) ^ simhash.fingerprint(near)).bit_count()
    rows = [(1, base, "x"), (2, near, "x"), (2, "a clean unique text with other words", "x"), (None, "same null text here", "x"),
            (None, "same null text here", "x"), (None, near, "y"), (9, base, "y"), (9, base, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __gone string")
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.drop_near_duplicates(df, max_bits=max(2, bits)).collect())
    assert kept == [(0, "same null text here"), (1, base), (2, "a clean unique text with other words")]
    named = df.withColumnRenamed("__gone", "document")
    assert simhash.drop_near_duplicates(named, max_bits=max(2, bits)).columns == named.columns


def test_index_remembers_its_buckets(spark):
    index = exact_dedup.DigestIndex(spark, exact_dedup.new_path(spark, "index"), 8)
    docs = spark.createDataFrame([(i, f"t{i}", "x") for i in range(100)], "doc_id long, text string, dedup_key string")
    assert exact_dedup.deduplicate(docs, index).count() == 100
    again = exact_dedup.DigestIndex(spark, index.path)
    assert again.buckets == 8
    exact_dedup.resolve(docs, again).collect()
    assert again.table().count() == 100
    with pytest.raises(ValueError, match="8 buckets"):
        exact_dedup.DigestIndex(spark, index.path, 16)


def test_mixing_small_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    totals = mixing.mix_report(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) <= 1 for r in totals)


def test_water_fill_against_iteration(spark):
    for seed in range(20):
        r = random.Random(seed)
        sizes = {f"s{i}": r.choice([0, 1, 5, 100, 10_000, 1_000_000]) for i in range(r.randint(1, 9))}
        weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
        if not sum(sizes.values()):
            continue
        got = mixing.water_fill(spark.createDataFrame(list(sizes.items()), "__src string, source_size long")).collect()
        want = _water(sizes, weights)
        assert all(math.isclose(x["target"], want[x["__src"]], rel_tol=1e-9, abs_tol=1e-6) for x in got)


def test_water_fill_over_many_sources(spark):
    """Ranks and sums that span range partitions; the NULL source is the last."""
    r = random.Random(7)
    sizes = {f"s{i:05}": r.choice([0, 1, 5, 5, 100, 10_000]) for i in range(4000)} | {"s99999": 10**7, "n": 300}
    order = [*sorted(s for s in sizes if s != "n"), "n"]
    rows = spark.createDataFrame(list(sizes.items()), "__src string, source_size long").repartition(6)
    got = {x["__src"]: x["target"] for x in mixing.water_fill(rows).collect()}
    want = _water(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    assert got.keys() == sizes.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in sizes)


def test_packing_round_trip(spark, docs, empty):
    encoder = tokens.TextEncoder(tokens.tokenizer_path())
    want = {i: np.append(encoder.whole(t or ""), 1).astype("<u4").tobytes() for i, t in enumerate(TEXTS)}
    got = packing.pack(docs, with_ids=True).toPandas()
    assert (got["length"].groupby(got["sequence_id"]).sum() <= 2048).all()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]]
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got.itertuples())
    once = got[got["doc_id"].notna() & (got["doc_id"] != 3)].sort_values("start").groupby("doc_id")
    assert all(b"".join(g["ids"]) == want[int(i)] for i, g in once)
    assert len(got[got["doc_id"] == 3]) == 3 and len(got[got["doc_id"].isna()]) == 2
    joined = packing.sequences(packing.pack(docs, with_ids=True)).toPandas()
    assert all(len(r.ids) == 4 * r.length for r in joined.itertuples())
    assert packing.pack(empty).count() == 0


def test_cut_table_covers_every_length():
    for capacity in (64, 100, 2048):
        for n, parts in enumerate(packing.cut_table(capacity)):
            assert sum(parts) == n
            assert all(capacity - capacity // p * p <= max(capacity // packing.WASTE, 0) or p == 1 for p in parts)


def test_packing_wastes_little(spark):
    texts = [(i, " ".join(["tree house"] * (1 + i * 37 % 1500))) for i in range(3000)]
    got = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(8))
    n = got.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert n[0] / (2048 * n[1]) > 0.985


def test_token_counts(spark, docs, empty):
    encoder = tokens.TextEncoder(tokens.tokenizer_path())
    odd = ["a\x1cb", "x\u0085y​z", "<|endoftext|> a<|startoftext|>b", "ÀÉ.. é İı Σς", "it's 'S don't", "﻿q", "A" * 3000]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = tokens.count_tokens(docs.select("doc_id", "text").union(more)).collect()
    texts = dict(enumerate(TEXTS)) | {1000 + i: t for i, t in enumerate(odd)}
    assert len(got) == len(ROWS) + len(odd)
    for r in got:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]] or ""
            n = len(encoder.full.encode(t, add_special_tokens=False).ids)
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 2048)
    assert tokens.count_tokens(empty).count() == 0


def test_encoder_with_a_full_cache():
    import pyarrow as pa

    small = tokens.TextEncoder(tokens.tokenizer_path(), cache_rows=4)
    texts = [t or "" for t in TEXTS]
    assert [x.tolist() for x in tokens.encode_texts(small, pa.array(texts))] == [small.whole(t).tolist() for t in texts]


def _components(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("limit", [512, 2])
@pytest.mark.parametrize("bits,segments", [(2, 2), (1, 2), (3, 2), (4, 4), (3, 4)])
def test_links_lose_nothing(spark, limit, bits, segments):
    r = random.Random(bits * 10 + segments)
    fps = set()
    for _ in range(12):
        base = r.getrandbits(64)
        for _ in range(10):
            fps.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))))
    fps |= {0, 1, (1 << 64) - 1, 1 << 63, 3 << 62}
    nodes = {fp: i for i, fp in enumerate(sorted(fps))}
    signed = [(fp - (1 << 64) if fp >> 63 else fp, i) for fp, i in nodes.items()]
    edges = simhash.links(spark.createDataFrame(signed, "fp long, node long"), bits, segments, limit)
    want = _components([(i, j) for a, i in nodes.items() for b, j in nodes.items() if (a ^ b).bit_count() <= bits and i < j],
                       nodes.values())
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert {i: got.get(i, i) for i in nodes.values()} == want


def test_simhash(spark, docs, empty):
    got = simhash.near_duplicates(docs).collect()
    fps = {i: simhash.fingerprint(t) for i, t in enumerate(TEXTS)}
    want = _components([(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2], list(fps))
    assert len(got) == len(ROWS)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["fp"] % (1 << 64), r["component_id"]) == (fps[r["doc_id"]], want[r["doc_id"]])
    import xxhash

    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in (b"a b c", b"b c d")) for b in range(64)]
    assert simhash.fingerprint("A b\tc d") == sum(1 << b for b in range(64) if ones[b] == 2)
    assert simhash.fingerprint("a b") == xxhash.xxh64_intdigest(b"a b", 42) and simhash.fingerprint(None) == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == set(want.values())
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_long_path(spark):
    n = 300
    ids = rnd.sample(range(1000), n)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "u long, v long")
    assert {r["component"] for r in connected_components(edges).collect()} == {min(ids)}


def test_shards(spark, docs, empty):
    got = sharding.shard(docs).toPandas()
    assert len(got) == len(ROWS) and got["shard"].between(0, 7).all()
    for _, s in got.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    for r in got[got["doc_id"].notna()].itertuples():
        t = (TEXTS[int(r.doc_id)] or "").encode()
        assert (r.size, r.text_crc32) == (len(t) + 1, zlib.crc32(t))
    assert sharding.shard(empty).count() == 0


def test_shards_are_even_with_a_hot_group(spark):
    rows = [(i, "copy of one text" if i % 3 == 0 else f"text {i} " + "w " * (i % 40)) for i in range(6000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() / sums.min() < 1.01
    counts = got.groupby("shard").size()
    assert counts.max() / counts.min() < 1.05


def test_toxicity_fold():
    assert toxicity.fold("You ІD10T, с1own! 42 2020") == " you idiot ciown 42 2020 " == toxicity.fold("you IDIOT, CLOWN 42 2020")
    assert toxicity.fold(None) == toxicity.fold(" \n") == "  "


def test_toxicity_exceptions_and_held_out(spark, empty):
    r = random.Random(3)
    plain = [f"w{r.choice('abcdefgh')}{r.choice('klmnop')}x" for _ in range(60)]
    rows, labels = [], []
    for i in range(600):
        words = [r.choice(plain) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            words.insert(r.randint(0, 20), r.choice(["grumpf", "grumpfer", "sch1eck"]))
        elif i % 4 == 1:
            words.insert(r.randint(0, 20), "grumpf fish")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (10 ** 9, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    got = toxicity.score(docs, model).toPandas().set_index("doc_id")
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(got.index[got["held_out"]]) == held
    assert np.mean([got["predicted"][i] == int(i % 4 == 0) for i in held]) > 0.95
    assert got["score"].between(0, 1).all()
    kept = toxicity.drop_toxic(docs, model)
    assert {x["doc_id"] for x in kept.collect()} == set(got.index[got["predicted"] == 0])
    assert toxicity.score(empty, model).count() == 0 and toxicity.drop_toxic(empty, model).columns == empty.columns
    none = toxicity.fit(docs, lab.where("toxic = 0"))
    assert toxicity.score(docs, none).agg(F.max("score")).first()[0] == 0.0


def test_toxicity_nulls(spark, docs):
    model = toxicity.Model((("tree", 5.0),), ("tree a",), (-3.0, 1.0, 1.0))
    got = toxicity.score(docs, model)
    assert got.count() == len(ROWS) and got.where("score IS NULL OR held_out IS NULL").count() == 0


def _brute_spans(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, t):
        d = re.sub("[^0-9]", "", t)
        if kind == "ip":
            return all(int(x) <= 255 for x in t.split("."))
        if kind == "card":
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            return 13 <= len(d) <= 19 and luhn % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items()
                    for m in re.finditer(p, text or "") if ok(k, m[0]))


def test_personal_data(spark, docs, empty):
    r = random.Random(5)
    alphabet = "ab1.29@-+ ()%é中"
    noise = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    noise += ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "a" * 20000, "9" * 20000, "1 " * 20000, "x@" + "a." * 5000 + "b"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    got = pii.report(docs.select("doc_id", "text").union(more)).collect()
    texts = dict(enumerate(TEXTS)) | {1000 + i: t for i, t in enumerate(noise)}
    assert len(got) == len(ROWS) + len(noise)
    for x in got:
        if x["doc_id"] is None:
            continue
        base = _brute_spans(texts[x["doc_id"]])
        assert x["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(x["spans"].split(","))
        assert [x[f"n_{k}"] for k in pii.KINDS] == [base.count(k + ":") for k in pii.KINDS]
    assert pii.report(empty).count() == 0


def test_trees_select_proposed_spans(spark):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    r = random.Random(3)
    runs = ["".join(r.choice("123456789") for _ in range(16)) for _ in range(4000)]
    bad, good = [x for x in runs if not luhn(x)][:900], [x for x in runs if luhn(x)][:90]
    texts = [f"it was {x} then" for x in bad] + [f"it was {' '.join((x[:4], x[4:8], x[8:12], x[12:]))} then" for x in good]
    texts += [f"please mail ann.bo{r.randint(10, 99)}@host{r.randint(10, 99)}.de today" for _ in range(120)]
    texts += ["you can have a look at example dot com today"] * 60
    hidden = len(texts)
    texts += ["it was 4111.1111.1111.1111 then", "please mail ann.bo42 (at) host57 (dot) de today"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["spans"] for x in pii.report(docs).collect()}
    assert got[hidden] == "card:7:26" and got[hidden + 1] == "email:12:41"
    assert got[hidden - 1] == "" and got[0] == "" and got[len(bad)] == "card:7:26"


def test_redact(spark):
    docs = spark.createDataFrame([(1, "é write a@b.de now"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}[1] == "é write [email] now"


def test_queries_are_registered(spark):
    from recsift.llm.registry import ORACLE, QUERIES

    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert table(spark, "/root/testdata/sf0.001", "documents").count() == 200
