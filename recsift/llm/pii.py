"""Personal data by candidate gradient boosting, in DataFrame operations only.

Generators.  For each kind a strict pattern with its validity rule gives the
base spans; wider patterns (obfuscated addresses, numbers inside digit runs that
the strict pattern swallowed or refused, other separators, national and 00
prefixes) propose more, overlapping spans.

Model.  Boosted trees (Spark ML) score every proposed span by its format
(length, digits, separators, groups, repeated digits, checksum) and context
(neighbouring characters, words such as "phone" or "mail" or "token" before it).
They are fitted on the labelled spans of all texts but a quarter (by hash) that the thresholds
are taken from.  The spans of a kind and label together weigh at most as much as
``GROUP_WEIGHT`` spans, so that no frequent kind drowns the others.  Base spans are
positive.  Spans that overlap no base span are negative if they fail their
kind's rule, and all of them for e-mail, which has no rule; the other proposals
that pass a rule are unlabelled and stay out of the fit.  Format is that of the
plain spelling, so that a wide pattern's separators alone tell nothing.  The rule
and what equals it are not features.  A kind's threshold is the score that
``RECALL`` of its base spans left out of the fit reach: a span is added if it
looks as much like personal data as they do.  A kind with fewer than ``ENOUGH``
such spans gets the threshold ``STRICTEST``.

Selection.  Base spans always stay.  A proposed span is added if its score
reaches its kind's threshold, it passes the kind's digit rule, and it overlaps
neither a base span nor an added span with a higher score.

Positions are code points.  One scan per pattern sets marks around the matches, and
the pieces between marks give matches and positions.  A text is scanned for a pattern
only if it has what every match of it needs (``NEEDS``).

Defined results
  * NULL text counts as empty; an empty text or table gives no spans.
  * Strict matches that fail their rule are dropped without another try.
  * Without both kinds of spans to learn from, nothing is added.
  * Repeated rows are separate documents, also in ``redact``, which returns a row
    for every row; so are rows without doc_id.
  * Two proposals with equal scores: the one of the first kind, then the first.
  * Long texts are read whole.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import materialise, text_or_empty

KINDS = ("email", "ip", "card", "phone")
GROUP_WEIGHT = 2500
TREES = 10
RECALL = 0.98
ENOUGH = 10
STRICTEST = 0.9
CONTEXT = 32

# The strict patterns.  Possessive loops and "a run's start or the
# previous match's end" change no match, they keep long runs linear.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider patterns.  Each needs a mark of its kind, so plain numbers in prose are not proposed.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}(?:\x20?(?:\(at\)|\[at\]|\{at\})\x20?[a-z0-9-]{1,63}"
             r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)[a-z0-9-]{2,63}){1,4}"
             r"|\x20at\x20[a-z0-9-]{1,63}(?:\x20dot\x20[a-z0-9-]{2,63}){1,4}"
             r"|\x20?@\x20?[a-z0-9-]{1,63}(?:\.[a-z0-9-]{2,63}){1,4})(?![a-z0-9@])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.)\x20?[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20./_-][0-9]{4}){3}|3[47][0-9]{2}[\x20./_-][0-9]{6}[\x20./_-][0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}"
             r"|00[1-9][0-9]{0,2}[\x20./-][0-9]{2,4}[\x20./-][0-9]{3,4}(?:[\x20./-]?[0-9]{2,4})?"
             r"|\(0?[0-9]{3,4}\)\x20?[0-9]{3,4}[\x20.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9]|[.-][0-9])",
}
# What every match of a pattern needs, as a cheap test of the whole text.
NEEDS = {
    "s_email": "@", "w_email": r"(?i)@|[(\[{]at[)\]}]|\x20at\x20[a-z0-9-]{1,63}\x20dot\x20",
    "s_ip": r"[0-9]\.[0-9]", "w_ip": r"[0-9]\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.)\x20?[0-9]",
    "s_card": r"[0-9][\x20-]?[0-9]", "w_card": "[0-9]{4}",
    "s_phone": r"\+[0-9]", "w_phone": "[0-9]{3}",
}
MARK = "\ufdd0"  # a code point that is no character; texts that hold it are cut in another way
# Words before a span that speak for its kind or against personal data.
WORDS = {
    "email": "mail|email|e-mail|contact|courriel|correo|write to",
    "ip": "ip|host|server|address|login from|adresse",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|handy|portable|tel[eé]fono",
}
AGAINST = "token|key|secret|password|hash|sha|md5|id|isbn|version|order|no|nr"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def valid(kind: str, text: Column) -> Column:
    """The validity rule of a kind."""
    n = F.length(_digits(text))
    if kind == "ip":
        return F.regexp_replace(text, r"[^0-9.]", "").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(text))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _found(kind: str, wide: bool) -> Column:
    """All matches as array<struct<kind, start, stop, text, before, after, base>>, from columns m and p."""
    name = f"{'w' if wide else 's'}_{kind}"
    matches, gaps = F.col(f"m_{name}"), F.col(f"p_{name}")
    items = F.zip_with(F.transform(matches, lambda m, i: F.struct(m.alias("m"), i.alias("i"))),
                       F.slice(gaps, 1, F.size(matches)),
                       lambda m, g: F.struct(m["m"].alias("m"), m["i"].alias("i"), g.alias("g")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,stop:int,text:string,before:string,after:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        stop = start + F.length(x["m"])
        span = F.struct(start.alias("start"), stop.alias("stop"), x["m"].alias("text"),
                        F.right(x["g"], F.lit(CONTEXT)).alias("before"),
                        F.left(F.element_at(gaps, x["i"] + 2), F.lit(4)).alias("after"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    spans = F.aggregate(items, empty, add, lambda acc: acc["out"])
    full = F.transform(spans, lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["text"].alias("text"),
        s["before"].alias("before"), s["after"].alias("after"), valid(kind, s["text"]).alias("ok"),
        F.lit(not wide).alias("strict")))
    return full


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty().alias("text"))


def _pieces(regex: str) -> Column:
    """A text cut at the ends of its matches: gap, match, gap, match ... gap."""
    text = F.col("text")
    both = F.zip_with(F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), F.lit(0)), lambda gap, m: F.array(gap, m))
    held = F.filter(F.flatten(both), lambda x: x.isNotNull())
    return F.when(text.contains(MARK), held).otherwise(
        F.split(F.regexp_replace(text, F.lit(regex), F.lit(f"{MARK}$0{MARK}")), MARK, -1))


def candidates(rows: DataFrame) -> DataFrame:
    """(uid, doc_id, strict, wide): every proposed span of every whole text of (uid, doc_id, text)."""
    pieces, cols = {}, {}
    for prefix, patterns in (("s", STRICT), ("w", WIDE)):
        for kind, regex in patterns.items():
            name = f"{prefix}_{kind}"
            pieces[f"c_{name}"] = F.when(F.col("text").rlike(NEEDS[name]), _pieces(regex)).otherwise(F.array().cast("array<string>"))
            cols[f"m_{name}"] = F.filter(f"c_{name}", lambda x, i: i % 2 == 1)
            cols[f"p_{name}"] = F.filter(f"c_{name}", lambda x, i: i % 2 == 0)
    rows = rows.withColumns(pieces).drop("text").withColumns(cols)
    return materialise(rows.select("uid", "doc_id", F.concat(*[_found(k, False) for k in KINDS]).alias("strict"),
                                   F.concat(*[_found(k, True) for k in KINDS]).alias("wide")), "candidates")


def _plain(kind: Column, text: Column) -> Column:
    """The spelling without the wide patterns' disguises."""
    out = F.regexp_replace(text, r"(?i)\x20?(?:\(at\)|\[at\]|\{at\}|@)\x20?|\x20at\x20", "@")
    out = F.regexp_replace(out, r"(?i)\x20?(?:\((?:dot|\.)\)|\[(?:dot|\.)\]|\{dot\})\x20?|\x20dot\x20", ".")
    return F.when(kind == KINDS.index("card"), F.regexp_replace(out, "[-./_]", " ")).when(
        kind == KINDS.index("phone"), F.regexp_replace(F.regexp_replace(out, "^00", "+"), "[./]", "-")).otherwise(out)


def _features(spans: DataFrame) -> DataFrame:
    """One vector per span: format and context."""
    t, before = _plain(F.col("kind"), F.col("text")), F.lower("before")
    digits = _digits(t)
    context = reduce(lambda a, k: F.when(F.col("kind") == KINDS.index(k), before.rlike(
        rf"(?:^|[^a-z])(?:{WORDS[k]})[^a-z]{{0,4}}$").cast("double")).otherwise(a), KINDS, F.lit(0.0))
    values = {
        "kind_": F.col("kind").cast("double"), "chars": F.length(t).cast("double"), "digits": F.length(digits).cast("double"),
        "separators": F.length(F.regexp_replace(t, r"[^\x20()./_-]", "")).cast("double"),
        "groups": F.size(F.split(t, r"[^0-9A-Za-z]+")).cast("double"),
        "plus": t.startswith("+").cast("double"), "letters": F.length(F.regexp_replace(t, "[^A-Za-z]", "")).cast("double"),
        "different": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "largest_part": F.coalesce(F.array_max(F.transform(F.split(t, r"[^0-9]+"), lambda p: F.length(p))), F.lit(0)).cast("double"),
        "first": F.coalesce(F.left(digits, F.lit(1)).try_cast("double"), F.lit(-1.0)),
        "left_word": F.right("before", F.lit(1)).rlike(r"[\p{L}\p{N}_\"'=]").cast("double"),
        "right_word": F.left("after", F.lit(1)).rlike(r"[\p{L}\p{N}_\"']").cast("double"),
        "for_": context, "against": before.rlike(rf"(?:^|[^a-z])(?:{AGAINST})[^a-z]{{0,4}}$").cast("double"),
    }
    return VectorAssembler(inputCols=list(values), outputCol="features").transform(
        spans.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in values.items()})).drop(*values)


def fit(found: DataFrame) -> tuple[GBTClassificationModel, dict[int, float]] | None:
    """(model, threshold by kind) from all labelled spans; None if there is nothing to tell apart."""
    base = F.filter("strict", lambda s: s["ok"])
    other = F.filter(F.concat("strict", "wide"), lambda w: (~w["ok"] | (w["kind"] == KINDS.index("email"))) & ~F.exists(
        base, lambda b: (w["start"] < b["stop"]) & (b["start"] < w["stop"])))
    label = lambda spans, y: F.transform(spans, lambda s: F.struct(F.lit(y).alias("label"), s.alias("s")))
    spans = found.select("uid", F.explode(F.concat(label(base, 1.0), label(other, 0.0))).alias("x")).select("uid", "x.label", "x.s.*")
    rows = materialise(_features(spans).select(
        "kind", "label", "features", (F.pmod(F.xxhash64("uid"), F.lit(4)) == 0).alias("out")), "spans")
    learn = rows.where("NOT out")
    if learn.select("label").distinct().count() < 2:
        return None
    counts = rows.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n")).collect()  # 8 rows at most
    weight = F.coalesce(*[F.when((F.col("kind") == r["kind"]) & (F.col("label") == r["label"]), F.lit(
        min(1.0, GROUP_WEIGHT / r["n"]))) for r in counts])
    model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=4, stepSize=0.3, seed=42,
                          subsamplingRate=1.0, cacheNodeIds=False, minInstancesPerNode=5).fit(
        learn.select("label", "features", weight.alias("weight")))
    # A rounded score has at most 51 values per kind: a bounded table.
    scored = _score(rows.where("out AND label = 1"), model).groupBy("kind", F.round(F.col("score") * 50).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    thresholds = {}
    for kind in range(len(KINDS)):
        bins = sorted((r["bin"], r["n"]) for r in scored if r["kind"] == kind)
        n, below, low = sum(c for _, c in bins), 0, STRICTEST
        for at, c in bins if n >= ENOUGH else ():
            below += c
            if below > (1 - RECALL) * n:
                low = at / 50 - 0.01
                break
        thresholds[kind] = low
    return model, thresholds


def _score(rows: DataFrame, model: GBTClassificationModel) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def _join_spans(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, base, spans), both array<struct<kind, start, stop>> in the order kind, start."""
    return _find(_rows(docs)).drop("uid")


def _find(texts: DataFrame) -> DataFrame:
    """``find`` for (uid, doc_id, text), with the uid."""
    found = candidates(texts)
    fitted = fit(found)
    place = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    base = F.transform(F.filter("strict", lambda s: s["ok"]), place)
    rows = found.select("uid", "doc_id", base.alias("base"))
    if fitted is None:
        return rows.select("uid", "doc_id", "base", F.col("base").alias("spans"))
    model, thresholds = fitted
    base_spans = F.filter("strict", lambda s: s["ok"])
    fresh = F.filter("wide", lambda w: w["ok"] & ~F.exists(
        base_spans, lambda b: (w["start"] < b["stop"]) & (b["start"] < w["stop"])))
    proposed = found.select("uid", F.explode(fresh).alias("s")).select("uid", "s.*")
    least = F.element_at(F.array(*[F.lit(thresholds[k]) for k in range(len(KINDS))]), F.col("kind") + 1)
    good = _score(_features(proposed), model).where(F.col("score") >= least).select("uid", F.struct(
        (-F.col("score")).alias("order"), "kind", "start", "stop").alias("s"))
    # A group holds the accepted spans of one text.
    chosen = good.groupBy("uid").agg(F.sort_array(F.collect_list("s")).alias("a")).select("uid", F.aggregate(
        "a", F.array().cast("array<struct<kind:int,start:int,stop:int>>"),
        lambda acc, s: F.when(F.exists(acc, lambda x: (x["start"] < s["stop"]) & (s["start"] < x["stop"])), acc).otherwise(
            F.concat(acc, F.array(place(s))))).alias("added"))
    return rows.join(chosen, "uid", "left").select(
        "uid", "doc_id", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(
            F.sort_array(F.concat("base", "added"))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    def of(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return find(docs).select("doc_id", *counts, F.sha2(_join_spans(F.col("base")), 256).alias("base_sha256"),
                             _join_spans(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row, every span replaced by its kind in brackets; NULL text stays NULL."""
    texts = materialise(docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                                    F.col("text").cast("string").alias("text")), "texts")
    spans = _find(texts.withColumn("text", text_or_empty())).select("uid", "spans")
    return texts.join(spans, "uid").select("doc_id", _replace(F.col("text"), F.col("spans")).alias("text"))


def _replace(text: Column, spans: Column) -> Column:
    name = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["stop"].alias("b"), s["kind"].alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["a"] - acc["at"]))
        new = F.when(s["a"] >= acc["at"], F.concat(acc["out"], kept, F.element_at(name, s["k"] + 1))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["b"]).alias("at"), new.alias("out"))

    return F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
