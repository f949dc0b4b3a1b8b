"""Personal data, toxicity and shards: precision, held-out quality and balance."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.llm import pii, sharding, toxicity
from recsift.llm.common import table

SF = "/root/testdata/sf0.1"


def test_a_texts_test_never_hides_a_match(spark):
    r = random.Random(8)
    bits = ["a@b.de", "joe [at] mail [dot] com", "JOE (AT) mail.com", "x at y dot zz", "1.2.3.4", "10 [.] 0 [dot] 0 (.) 1", "4111.1111.1111.1111",
            "371449635398431", "3714 496353 98431", "+49 170 1234567", "0049 30 1234567", "(030) 123 4567", "555-123-4567", " at ", " dot ", "é", "7",
            "12", ".", " ", "@", "[", pii.MARK]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", "", "x"]) for _ in range(r.randint(0, 5))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    for prefix, patterns in (("s", pii.STRICT), ("w", pii.WIDE)):
        for kind, regex in patterns.items():
            found = F.regexp_extract_all("text", F.lit(regex), F.lit(0))
            hidden = df.where((F.size(found) > 0) & ~F.col("text").rlike(pii.NEEDS[f"{prefix}_{kind}"]))
            assert hidden.count() == 0, (prefix, kind)
            cut = df.select(found.alias("m"), F.split("text", regex, -1).alias("g"), pii._pieces(regex).alias("p"))
            odd = cut.where((F.filter("p", lambda x, i: i % 2 == 1) != F.col("m")) | (F.filter("p", lambda x, i: i % 2 == 0) != F.col("g")))
            assert odd.count() == 0, (prefix, kind)


def test_redact_decides_every_row_by_its_own_text(spark):
    rows = [(1, "write to a@b.de now", 5), (1, "longer prefix, then c@d.org", 5), (None, "me@x.fr", 5), (None, None, 5), (2, "", 5), (2, "", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid int").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in pii.redact(df).collect()), key=str)
    assert got == sorted([(1, "write to [email] now"), (1, "longer prefix, then [email]"), (None, "[email]"), (None, None), (2, ""), (2, "")],
                         key=str)


def test_precision_of_added_spans(spark):
    """Hidden addresses and cards among look-alikes: what is added is right nearly always, and most is found."""
    r = random.Random(21)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def card(good):
        while True:
            d = "4" + "".join(r.choice("0123456789") for _ in range(15))
            if luhn(d) == good:
                return " ".join((d[:4], d[4:8], d[8:12], d[12:]))

    name = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(5, 9)))
    texts, planted = [], {}
    for _ in range(300):
        texts.append(f"Please mail {name()}.{name()}{r.randint(10, 99)}@{name()}.de or pay by card {card(True)} today")
        texts.append(f"The serial {card(False)} was read, see {name()} at {name()} dot {name()} in the text")
    for i in range(120):
        kind = ("email", "card")[i % 2]
        span = f"{name()}.{name()}{r.randint(10, 99)} (at) {name()} (dot) de" if kind == "email" else card(True).replace(" ", ".")
        head = "Please mail " if kind == "email" else "or pay by card "
        planted[len(texts)] = f"{kind}:{len(head)}:{len(head) + len(span)}"
        texts.append(f"{head}{span} today")
    got = {x["doc_id"]: x["spans"] for x in pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    added = {(i, s) for i, spans in got.items() for s in filter(None, spans.split(","))
             if i in planted or i % 2 == 1}
    right = {(i, s) for i, s in planted.items()}
    assert len(added & right) >= 0.9 * len(added) and len(added & right) >= 0.7 * len(right), (len(added), len(added & right), len(right))


def test_toxicity_of_the_held_out_fold(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels)
    held = toxicity.score(docs, model).where("held_out").join(
        labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").toPandas()
    toxic = held["toxic"] == 1
    assert toxic.sum() > 50
    assert (held["predicted"][toxic] == 1).mean() > 0.85
    assert (held["predicted"][~toxic] == 1).mean() < 0.01
    order = held["score"].rank()
    auc = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.9


def test_exceptions_with_most_evidence_are_kept(spark, monkeypatch):
    rows = [("zorn at you", 1)] * 40
    for phrase, n in (("grey zorn", 60), ("beta zorn", 8), ("gamma zorn", 30)):
        rows += [(f"{phrase} {i}", 0) for i in range(n)]
    rows.append(("zorn " + "x" * 200, 0))
    sample = spark.createDataFrame(rows, "text string, toxic long")
    matcher = toxicity.Matcher({"zorn": 3.0})
    every = toxicity._exceptions(sample, matcher, 40, 98)
    assert {"grey zorn", "beta zorn", "gamma zorn"} <= set(every) and not any("x" * 60 in e for e in every)
    monkeypatch.setattr(toxicity, "MAX_ENTRIES", 2)
    assert set(toxicity._exceptions(sample, matcher, 40, 98)) == {"grey zorn", "gamma zorn"}


def test_place_against_brute_force():
    r = np.random.default_rng(6)
    for _ in range(30):
        items = r.integers(0, 100, (r.integers(1, 40), 3)).astype(float)
        shards = int(r.integers(1, 6))
        total = items.sum(axis=0)
        cap = [t / shards if t > 0 else 1.0 for t in total]
        share = [[x / c for x, c in zip(item, cap)] for item in items]
        left, want = [[1.0] * 3 for _ in range(shards)], [0] * len(items)
        for i in sorted(range(len(items)), key=lambda i: -max(share[i])):
            dots = [sum(w * a * b for w, a, b in zip(sharding.WEIGHTS, share[i], left[s])) for s in range(shards)]
            want[i] = min(s for s in range(shards) if dots[s] >= max(dots) - 1e-12)
            left[want[i]] = [a - b for a, b in zip(left[want[i]], share[i])]
        got = sharding.place(items, shards)
        assert [int(x) for x in got] == want


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", SF])
def test_shards_balance_bytes_tokens_and_rows(spark, sf):
    got = sharding.shard(table(spark, sf, "documents")).groupBy("shard").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")).toPandas()
    assert len(got) == 8
    for c in ("size", "tokens", "n_rows"):
        assert got[c].max() / got[c].mean() < (1.01 if sf == SF else 1.1), (c, got[c].tolist())


def test_personal_data_model_learns_from_every_span(spark, monkeypatch):
    texts = [" ".join(f"mail a{i}x{j}@site{j}.org ip 1{j % 90}.2.3.{i} build 999.{j}.1.{i}00" for j in range(40)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    fit = pii.GBTClassifier.fit
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, df: seen.append(df.where("label = 1").count()) or fit(self, df))
    found = pii.candidates(pii._rows(docs))
    pii.fit(found)
    left_out = found.where(F.pmod(F.xxhash64("uid"), F.lit(4)) == 0).count()
    assert seen == [(200 - left_out) * 2 * 40]  # an address and an ip in each of 40 places
