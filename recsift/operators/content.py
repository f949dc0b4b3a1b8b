"""Item documents, tokens, vocabulary and TF-IDF vectors.

The model is a table, not a driver-side matrix: ``vocab(term, df, tf_total,
idf)`` and ``vectors(item_id, term, tf, weight)`` with L2-normalised weights.

Term counts are computed from the document *parts* (title + genres, each
distinct user tag with its count, each relevant genome tag) and summed per
(item, term).  Tokens never cross the blank that joins the parts, so this
equals tokenising the concatenated document, but no task ever builds or
scans one giant per-item string, and the tag side is counted before it is
tokenised (a tag applied a million times is tokenised once).

Weights follow the public defaults of the usual TF-IDF vectoriser (raw counts,
``idf = ln((1 + N) / (1 + df)) + 1`` with N = all items, L2 norm over the kept
vocabulary); Spark ML's ``IDF`` omits the ``+ 1`` and is therefore not used.
"""

from __future__ import annotations

import logging
import math

from pyspark.errors import AnalysisException, DateTimeException, NumberFormatException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsift.functions.text import concat_blank, english_stop_words, join_words, tokens
from recsift.operators.lookup import tag_lookup
from recsift.operators.numbering import numbered, running_total, unused
from recsift.session import cut_lineage

# Fixed values from the reference: vocabulary caps of 5000 (full document) and
# 1000 (simple document).
MAX_FEATURES = 5000
MAX_FEATURES_SIMPLE = 1000
#: Vocabularies up to this many terms are held as a local relation; larger ones stay a table.
LOCAL_VOCABULARY = 50_000
UNSET = "unset"
#: Characters of documents whose terms a task counts.
CHARS_PER_TASK = 1 << 22


def genome_text(tag_scores: DataFrame, tag_names: DataFrame) -> DataFrame:
    """Relevant genome tag names per item joined by blanks (sorted)."""
    named = tag_lookup(tag_scores, tag_names)
    return named.groupBy("item_id").agg(
        F.array_join(F.sort_array(F.collect_list("tag")), " ").alias("genome_text"))


def item_document(items: DataFrame, tags: DataFrame | None = None, tag_scores: DataFrame | None = None,
                  tag_names: DataFrame | None = None) -> DataFrame:
    """``title genres tags genome-tags`` per item (tags/genome optional, '' if absent)."""
    from recsift.operators.stats import item_tag_text

    doc = items.select("item_id", "title", join_words(F.col("genres")).alias("genres_str"))
    if tags is not None:
        doc = doc.join(item_tag_text(tags), "item_id", "left")
    else:
        doc = doc.withColumn("tag_text", F.lit(None).cast("string"))
    if tag_scores is not None and tag_names is not None:
        doc = doc.join(genome_text(tag_scores, tag_names), "item_id", "left")
    else:
        doc = doc.withColumn("genome_text", F.lit(None).cast("string"))
    text = concat_blank(F.col("title"), F.col("genres_str"), F.coalesce("tag_text", F.lit("")),
                        F.coalesce("genome_text", F.lit("")))
    return doc.select("item_id", text.alias("document"))


#: Characters of a document (its parts and the blanks between them) that begin in one chunk.
CHUNK_CHARS = 1 << 16


def document_parts(items: DataFrame, tags: DataFrame | None = None, tag_scores: DataFrame | None = None,
                   tag_names: DataFrame | None = None) -> DataFrame:
    """(item_id, section, part, n): the parts of ``item_document`` with how often each stands there in a row.

    Sections: 0 title, 1 genres, 2 tags, 3 genome tags; parts of a section are
    in the order of their text.  A section without tags is one empty part.
    """
    one = F.lit(1).cast("long")
    ids = items.select("item_id")
    base = items.select("item_id", F.explode(F.filter(F.array(
        F.struct(F.lit(0).alias("section"), F.col("title").alias("part")),
        F.struct(F.lit(1).alias("section"), join_words(F.col("genres")).alias("part"))),
        lambda x: x["part"].isNotNull())).alias("p")).select("item_id", "p.section", "p.part", one.alias("n"))
    named = tag_lookup(tag_scores, tag_names) if tag_scores is not None and tag_names is not None else None
    for section, rows in ((2, tags), (3, named)):
        empty = F.lit("").alias("part")
        if rows is None:
            base = base.unionByName(ids.select("item_id", F.lit(section).alias("section"), empty, one.alias("n")))
            continue
        counted = (rows.where(F.col("tag").isNotNull()).groupBy("item_id", F.col("tag").alias("part"))
                   .agg(F.count(F.lit(1)).alias("n")))
        # Items without such tags have one empty part; tags of unknown items have no document.
        found = ids.join(counted, "item_id", "left").select(
            "item_id", F.lit(section).alias("section"), F.coalesce("part", F.lit("")).alias("part"),
            F.coalesce("n", one).alias("n"))
        base = base.unionByName(found)
    return base


def item_document_chunks(items: DataFrame, tags: DataFrame | None = None, tag_scores: DataFrame | None = None,
                         tag_names: DataFrame | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """T1 in bounded pieces: (item_id, chunk, text); an item's chunks joined by blanks are its document.

    A part belongs to the chunk in which it begins, counting characters of the
    document.  Neither an item with very many tags nor a tag that was given very
    often is ever one array or string: a run of equal tags is cut by arithmetic,
    and the running length spans partitions.  A chunk without a beginning is left out.
    """
    parts = document_parts(items, tags, tag_scores, tag_names).withColumn("step", F.length("part") + F.lit(1))
    placed = running_total(parts.withColumn("chars", F.col("n") * F.col("step")), ["item_id"], ["section", "part"],
                           "chars", "start")
    c, chunk = F.lit(chunk_chars), F.col("chunk")
    last = F.floor((F.col("start") + (F.col("n") - 1) * F.col("step")) / c)
    runs = placed.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / c), last)))
    first = F.greatest(F.lit(0), F.ceil((chunk * c - F.col("start")) / F.col("step")))
    end = F.least(F.col("n") - 1, F.floor(((chunk + 1) * c - 1 - F.col("start")) / F.col("step")))
    runs = runs.withColumn("copies", (end - first + 1).cast("int")).where("copies > 0")
    piece = F.array_join(F.array_repeat("part", F.col("copies")), " ")
    texts = runs.select("item_id", "chunk", F.struct("section", "part", piece.alias("piece")).alias("p"))
    return texts.groupBy("item_id", "chunk").agg(F.sort_array(F.collect_list("p")).alias("ps")).select(
        "item_id", "chunk", F.array_join(F.col("ps.piece"), " ").alias("text"))


def item_document_simple(items: DataFrame, limit: int | None = None) -> DataFrame:
    """``title genres`` per item; ``limit`` (first items by id) is optional."""
    src = items.orderBy("item_id").limit(limit) if limit is not None else items
    return src.select("item_id", concat_blank(F.col("title"), join_words(F.col("genres"))).alias("document"))


def _explode_terms(df: DataFrame, text_col: str, weight_col: str | None = None) -> DataFrame:
    n = F.col(weight_col) if weight_col else F.lit(1).cast("bigint")
    return df.select("item_id", F.explode(tokens(F.col(text_col))).alias("term"), n.alias("n"))


def _drop_stop_words(df: DataFrame, stop_words: bool) -> DataFrame:
    if not stop_words:
        return df
    return df.where(~F.col("term").isin(list(english_stop_words())))


def document_terms(docs: DataFrame, stop_words: bool = True, id_col: str = "item_id",
                   text_col: str = "document") -> DataFrame:
    """T3 on ready documents: (id, term, tf), over the whole text of each document.

    Documents are spread by id, into tasks by their characters: the terms of a task are
    bounded however few splits the scan has, and need no further shuffle.
    """
    d = docs.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("document"))
    chars = d.agg(F.sum(F.length("document"))).first()[0] or 0
    d = d.repartition(max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(chars / CHARS_PER_TASK)), "item_id")
    t = _drop_stop_words(_explode_terms(d, "document"), stop_words)
    out = t.groupBy("item_id", "term").agg(F.sum("n").alias("tf"))
    return out if id_col == "item_id" else out.withColumnRenamed("item_id", id_col)


def item_terms(items: DataFrame, tags: DataFrame | None = None, tag_scores: DataFrame | None = None,
               tag_names: DataFrame | None = None, stop_words: bool = True) -> DataFrame:
    """T3 for the full document, from its parts: (item_id, term, tf)."""
    base = items.select("item_id", concat_blank(F.col("title"), join_words(F.col("genres"))).alias("text"))
    parts = _explode_terms(base, "text")
    if tags is not None:
        tag_counts = (tags.where(F.col("tag").isNotNull())
                      .groupBy("item_id", "tag").agg(F.count(F.lit(1)).alias("cnt")))
        parts = parts.unionByName(_explode_terms(tag_counts, "tag", "cnt"))
    if tag_scores is not None and tag_names is not None:
        parts = parts.unionByName(genome_terms(tag_scores, tag_names))
    parts = _drop_stop_words(parts, stop_words)
    return parts.groupBy("item_id", "term").agg(F.sum("n").alias("tf"))


def genome_terms(tag_scores: DataFrame, tag_names: DataFrame) -> DataFrame:
    """(item_id, term, n) of the relevant genome tags.

    Each tag *name* is tokenised once on the small dimension and its terms
    are joined to the relevant (item, tag) scores, instead of running the
    tokeniser on every score row.  Unknown tag ids have no name, hence no
    terms, exactly as the '' default of the lookup.
    """
    from recsift.operators.lookup import relevant_tags

    names = tag_names.select(F.col("tag_id"), F.explode(tokens(F.col("tag"))).alias("term"))
    name_terms = names.groupBy("tag_id", "term").agg(F.count(F.lit(1)).alias("n"))
    rel = relevant_tags(tag_scores).select("item_id", "tag_id")
    return rel.join(name_terms, "tag_id").select("item_id", "term", "n")


def vocabulary(terms: DataFrame, n_docs: int, max_features: int | None = MAX_FEATURES) -> DataFrame:
    """T4: (term, df, tf_total, idf) for the ``max_features`` most frequent terms.

    Frequency is the corpus total of raw counts; ties go to the smaller term.
    ``n_docs`` is the number of documents (all items, also those without
    any term; see ``count_docs``).  The result has at most ``max_features``
    rows, which is the size bound that lets it be broadcast.
    """
    v = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf_total"))
    if max_features is not None and max_features <= LOCAL_VOCABULARY:
        v = v.orderBy(F.desc("tf_total"), "term").limit(max_features)
    elif max_features is not None:  # a limit would gather the terms in one task
        place = unused(v, "place")
        v = numbered(v, F.desc("tf_total"), F.asc("term"), name=place).where(F.col(place) < max_features).drop(place)
    idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return v.select("term", "df", "tf_total", idf.alias("idf"))


def count_docs(items: DataFrame) -> int:
    """N of the IDF formula: one small scalar, fitted like any estimator parameter."""
    return items.count()


def tfidf_vectors(terms: DataFrame, vocab: DataFrame, bounded_vocab: bool = True) -> DataFrame:
    """T5: (item_id, term, tf, weight), weight = tf * idf / L2 norm over kept terms.

    The planner broadcasts the vocabulary while its size is below Spark's
    threshold and shuffles it beyond.  The per-item norm is a window over one item's kept terms (at most
    ``max_features`` rows), so no item's group is unbounded.
    """
    extra = ["term_idx"] if "term_idx" in vocab.columns else []
    v = vocab.select("term", "idf", *extra)
    w = terms.join(v, "term").select("item_id", "term", *extra, "tf", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("item_id")))
    return w.select("item_id", "term", *extra, "tf", (F.col("w") / norm).alias("weight"))


class ContentModel:
    """TF-IDF model of the item catalogue held as two tables."""

    def __init__(self, vocab: DataFrame, vectors: DataFrame, n_items: int | None = None, kind: str | None = None):
        self.vocab, self.vectors, self.n_items, self.kind = vocab, vectors, n_items, kind

    @classmethod
    def fit(cls, items: DataFrame, tags: DataFrame | None = None, tag_scores: DataFrame | None = None,
            tag_names: DataFrame | None = None, max_features: int | None | str = UNSET,
            simple: bool = False) -> "ContentModel":
        """``max_features``: a cap, None for no cap; unset: 5000, or 1000 for the simple document."""
        if max_features == UNSET:
            max_features = MAX_FEATURES_SIMPLE if simple else MAX_FEATURES
        if simple:
            terms = document_terms(item_document_simple(items))
        else:
            terms = item_terms(items, tags, tag_scores, tag_names)
        # The term table feeds both the vocabulary and the vectors: written
        # once to the shared checkpoint folder, which also cuts the lineage
        # back to the rating/tag joins (a lost executor re-reads, not redoes).
        terms = cut_lineage(terms)
        n_items = count_docs(items)
        vocab = vocabulary(terms, n_items, max_features)
        if max_features is not None and max_features > LOCAL_VOCABULARY:
            vocab = cut_lineage(numbered(vocab, "term", name="term_idx").withColumn("term_idx", F.col("term_idx").cast("int")))
        elif max_features is not None:
            # Like CountVectorizer.fit: the capped vocabulary (at most
            # max_features rows) is fitted once and held as a local relation,
            # so the term pipeline is not recomputed inside the broadcast.  Each
            # term gets a dense index (term order), which the similarity job
            # ships instead of the term text.
            spark = items.sparkSession
            rows = sorted(vocab.collect(), key=lambda r: r["term"])
            schema = T.StructType(vocab.schema.fields + [T.StructField("term_idx", T.IntegerType(), False)])
            vocab = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)
        return cls(vocab, tfidf_vectors(terms, vocab), n_items, "simple" if simple else "full")

    @classmethod
    def fit_or_simple(cls, items: DataFrame, tags: DataFrame | None = None, tag_scores: DataFrame | None = None,
                      tag_names: DataFrame | None = None) -> "ContentModel":
        """T1 with T2 as fallback: the full document model, or the title+genres
        model (1000 terms) when a tag table cannot be resolved or holds values
        that cannot be parsed.  Any other failure (a lost executor, a full disk) is raised.  ``kind`` of the
        model says which one it is."""
        try:
            return cls.fit(items, tags, tag_scores, tag_names)
        except (AnalysisException, NumberFormatException, DateTimeException) as e:
            logging.getLogger(__name__).warning("full content model not possible, fitting the simple one: %s", e)
            return cls.fit(items, simple=True)

    def save(self, path: str) -> None:
        """The model as two Parquet tables under ``path``."""
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.vectors.write.mode("overwrite").parquet(f"{path}/item_vectors")

    @classmethod
    def load(cls, spark, path: str) -> "ContentModel":
        return cls(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/item_vectors"))
