"""The training-data pipeline. Each stage takes ``(spark, docs, sf_dir)``; its result is written as
Parquet and read again as the next stage's documents. All but the last keep the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featuremart.llm.stages import STAGES
from featuremart.sources.scratch import cut

#: Robust estimates and 64-bit hashes of shingles have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
