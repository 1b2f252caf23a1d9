"""The stages of the training-data pipeline. Each takes ``(spark, docs, sf_dir)`` and works on all rows of
``docs``; all but the last return the columns of documents as they came.

Cases: rows with a null id or text go through every stage; repeated rows meet the same decision, and one of
them stays after near-duplicate removal; an empty table stays empty; further columns are carried along,
also when they share a name with a statistic of a stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, lines, packing, quality, simhash
from . import text as tx


def _kept(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``(id, dig)`` is in ``decisions``."""
    return tx.with_rows(docs, decisions.select("id", "dig").distinct(), "left_semi").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return _kept(docs, quality.judged(docs).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that other documents repeat; n_chars follows. A document whose lines all go
    stays with an empty text."""
    return lines.without_repeated_lines(docs, least_docs=5, least_points=40)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays (a null id is smallest;
    then the smallest text digest; one of equal rows)."""
    found = simhash.near_duplicates(docs, shingle=3, radius=3, group="class")
    first = found.groupBy("class").agg(F.min(F.struct("id", "dig")).alias("first")).select("first.id", "first.dig")
    return tx.with_rows(docs, first, "left_semi").dropDuplicates(["id", "dig"]).select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/benchmark.parquet")
    return _kept(docs, decontamination.contaminated(docs, items, length=10).where("n_hit = 0"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in sequences of 1024 tokens."""
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end=2, capacity=1024)
    return out.select(tx.real_id().alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
