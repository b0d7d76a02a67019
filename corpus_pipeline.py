"""A corpus pipeline in five stages; each stage reads what the one before wrote.

``documents`` -> good texts -> one of equal texts -> one of each group of near copies -> texts
without benchmark items -> packed pieces. All but the last stage return the columns of documents.

Every stage takes an empty table and gives one, reads very long texts whole, keeps columns it does not know, and
counts a NULL text as empty, unless it says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, jaccard, packing, quality
from tidemark.llm.common import read_table
from tidemark.session import scratch_path, with_code


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of these documents.

    NULL and empty texts are judged by their (zero) measures, repeated rows alike; without labels every score is the prior.
    """
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, a NULL id only if no other is there; of repeated rows one."""
    return exact_dedup.drop_copies(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by five words and a similarity of 0.8, the row with the smallest doc_id stays.

    Texts without a word all stay; of repeated rows one.
    """
    return jaccard.drop_near_copies(docs, size=5, share=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; those without a text, and all if there are no items, stay."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in training sequences; an empty text is its end id alone, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", with_code(keep_good)),
    ("exact dedup", with_code(keep_one_copy)),
    ("near duplicates", with_code(keep_one_near_copy)),
    ("benchmark decontamination", with_code(drop_benchmark)),
    ("packing", with_code(pack)),
]

#: A trained model and token ids are beyond SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again. An empty table gives an empty result."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
