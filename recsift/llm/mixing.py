"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the total by weight.  No source may be used
for more than ``max_epochs`` times its size; what is above is shared out again
by weight among the others until none is above.  The fixed point is a water
level: sorted by cap / weight, the capped sources are a prefix, and the level
follows from prefix sums, so no iteration is needed.

Each document is then taken ``floor(target / size)`` whole times.  The
fractional repetition is a seeded sample: documents in the order of a seeded
hash, up to the missing number of words, the last of them in part (its first
words), so that a source comes within a word of its target at any size.  The
running sum is two-level: hash buckets of about ``BUCKET_ROWS`` rows are summed
and accumulated first, and only the one bucket of a source in which the limit
falls is sorted row by row.  A hot source is never gathered in one task.

Defined results
  * NULL text has size 0; documents of size 0 are taken 0 times.
  * A NULL source is a source of its own, sorted last.
  * A source of size 0 has target 0; an empty table gives an empty result.
  * Rows that repeat id and text are separate rows, each counted.
Sources may be as many as hosts of the web: their ranks and prefix sums come from
range partitions, and only three totals and the level reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise, word_count
from recsift.operators.numbering import numbered, running_total

#: Fixed values of the production mix.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 42
BUCKET_ROWS = 4096


@dataclass
class MixPlan:
    """``params``: one row per source; ``bits``: log2 of the hash buckets per source."""

    params: DataFrame
    bits: int


def _source_key(name: str = "source") -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(name).cast("string")), F.lit("n"))


def measure(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__src``, ``__size`` (words) and ``__h`` (seeded position, 63 bits)."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 1)
    return docs.withColumns({"__src": _source_key(), "__size": word_count(), "__h": h})


def water_fill(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(__src, source_size) -> the same rows with ``target`` (DOUBLE).

    Weights repeat over the sources by code point, the NULL source last.
    """
    columns = sources.columns
    ranked = numbered(sources, F.col("__src") == "n", F.col("__src"), name="__rank")
    weighed = ranked.withColumn("__w", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                    (F.col("__rank") % len(weights) + 1).cast("int")).cast("long"))
    capped = weighed.withColumn("__cap", F.col("source_size") * max_epochs)
    capped = capped.withColumn("__ratio", F.col("__cap") / F.col("__w"))
    for value, name in (("__cap", "__caps"), ("__w", "__ws")):  # sums over the sources before
        capped = running_total(capped, [], ["__ratio", "__rank"], value, name)
    words, weight = capped.agg(F.sum("source_size"), F.sum("__w")).first()
    level = materialise(capped.withColumn("__level", (F.lit(words).cast("long") - F.col("__caps")).cast("double")
                                          / (F.lit(weight).cast("long") - F.col("__ws"))), "levels")
    full = F.col("__ratio") <= F.col("__level")
    water = F.lit(level.where(~full).agg(F.max("__level")).first()[0]).cast("double")
    target = F.when(full, F.col("__cap").cast("double")).otherwise(water * F.col("__w"))
    return level.select(*columns, target.alias("target"))


def plan_mix(measured: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> MixPlan:
    """Statistics over all rows of ``measured`` and the cut of every source."""
    sums = measured.groupBy("__src").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("__n"))
    sums = materialise(sums, "sources")
    most = sums.agg(F.max("__n")).first()[0] or 1
    bits = max(0, (most // BUCKET_ROWS).bit_length())
    goals = water_fill(sums.drop("__n"), weights, max_epochs)
    goals = goals.withColumn("__whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                             .otherwise(0).cast("long"))
    goals = materialise(goals.withColumn(
        "__extra", F.round(F.col("target") - F.col("__whole") * F.col("source_size")).cast("long")), "goals")
    buckets = measured.groupBy("__src", _bucket(bits).alias("__b")).agg(F.sum("__size").alias("__words"))
    up_to = Window.partitionBy("__src").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = buckets.withColumn("__base", F.coalesce(F.sum("__words").over(up_to), F.lit(0).cast("long")))
    cut = (before.join(goals.select("__src", "__extra"), "__src")
           .where(F.col("__base") + F.col("__words") > F.col("__extra"))
           .groupBy("__src").agg(F.min(F.struct("__b", "__base")).alias("__cut")))
    params = goals.join(cut, "__src", "left").select(
        "__src", "source_size", "target", "__whole", "__extra",
        F.coalesce("__cut.__b", F.lit(1 << bits)).cast("long").alias("__cut_b"),
        F.coalesce("__cut.__base", F.lit(0)).cast("long").alias("__cut_base"))
    return MixPlan(materialise(params, "mix"), bits)


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("__h"), 63 - bits) if bits else F.lit(0).cast("long")


def take(measured: DataFrame, plan: MixPlan) -> DataFrame:
    """``measured`` with ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    The table of sources was written out, so its size is known: Spark
    broadcasts it while it is below its threshold and shuffles beyond.
    """
    rows = measured.withColumn("__b", _bucket(plan.bits)).join(plan.params, "__src")
    whole = F.col("__whole") * F.col("__size")
    clear = rows.where(F.col("__b") != F.col("__cut_b")).withColumn(
        "taken", whole + F.when(F.col("__b") < F.col("__cut_b"), F.col("__size")).otherwise(0))
    up_to = (Window.partitionBy("__src").orderBy("__h", "doc_id", "__size")
             .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("__extra") - F.col("__cut_base") - F.coalesce(F.sum("__size").over(up_to), F.lit(0))
    at_cut = rows.where(F.col("__b") == F.col("__cut_b")).withColumn(
        "taken", whole + F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), left)))
    return clear.unionByName(at_cut)


def mix_report(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target, taken)."""
    narrow = materialise(measure(docs.select("doc_id", "source", "text"), seed).drop("text"), "sizes")
    return take(narrow, plan_mix(narrow, weights, max_epochs)).select(
        "doc_id", "source", F.col("__size").alias("size"), "source_size", "target", "taken")


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each repetition.

    Texts are whole: the one document of a source at which its target ends is taken
    once more if the target reaches half of it, else not, so a source's words lie
    within one document of its target.
    """
    cols = docs.columns
    # The input's columns go into one struct first: their names can't clash with working columns.
    packed = docs.select("doc_id", "source", "text", F.struct(*cols).alias("__doc"))
    narrow = materialise(measure(packed.drop("__doc"), seed).select("doc_id", "__src", "__size", "__h"), "sizes")
    rows = measure(packed, seed).select("doc_id", "__src", "__size", "__h", "__doc")
    taken = take(rows, plan_mix(narrow, weights, max_epochs)).where(F.col("taken") > 0)
    rest = F.col("taken") % F.col("__size")
    copies = F.floor(F.col("taken") / F.col("__size")) + F.when(2 * rest >= F.col("__size"), 1).otherwise(0)
    return taken.withColumn("__n", copies.cast("int")).where("__n > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select("__doc.*")
