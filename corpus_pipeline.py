"""The corpus pipeline over ``documents`` (part of ``recsift.llm``).

Each stage takes the documents that its predecessor kept, as a Parquet table,
and returns those it keeps with the same columns; the last returns the packed
pieces.  Stages inherit the operators' rules for NULLs, empty texts, ties and
empty tables.  Nothing here can be stated in SQL: the first stage learns a
model, the third hashes with XXH64.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recsift.llm import exact_dedup, mixing, packing, simhash, toxicity
from recsift.llm.common import new_path, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns from ``labels``."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs, exact_dedup.temporary_index(spark))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 3-word-shingle fingerprints within 2 bits."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets; a document comes once for each repetition."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = new_path(spark, name.split()[0].lower())
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
