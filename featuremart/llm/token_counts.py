"""Token counts through a digest cache.

The key of a stored count is the SHA-256 of the content (null counts as empty; nothing else is changed,
since counts follow every character) and the SHA-256 of the tokenizer's file. Distinct contents without a
stored count are encoded once each and appended to the cache; then every document takes its count from it.
Copies are dropped before texts shuffle, so a text that a third of the documents share is sent once for
each task. The cache is a Parquet folder that all executors reach.

Cases: null and empty text have no tokens and share one digest; repeated rows get the same count; two runs
that append the same content at once do no harm, as equal entries count once; an empty table appends nothing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut, scratch_dir

from . import text as tx
from .tokens import encoder, file_digest

CACHE = "content binary, tokenizer string, n_tokens long"


def _counts(path: str, version: str):
    def run(batches):
        encode = encoder(path).encode
        for rows, data, offsets in tx.chunks(batches):
            _, at = encode(data, offsets, ids=False)
            count = at[1:] - at[:-1]
            content = rows.column(rows.schema.get_field_index("content"))
            yield pa.RecordBatch.from_arrays(
                [content, pa.array([version] * len(count), pa.string()), pa.array(count, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """``id, n_bytes, n_tokens`` for each row of ``docs``; ``path`` is a file of the tokenizers library
    that every machine has. ``cache`` is the folder of stored counts; without one a new one begins."""
    spark = docs.sparkSession
    cache = cache or scratch_dir(spark, "token-counts")
    version = file_digest(path)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    keys = tx.keyed(docs).select("id", "text", F.unhex(F.sha2("text", 256)).alias("content"))
    distinct = keys.select("content", "text").dropDuplicates(["content"])
    misses = distinct.join(stored.select("content"), "content", "left_anti")
    misses.mapInArrow(_counts(path, version), CACHE).write.mode("append").parquet(cache)
    needed = keys.select("content", F.octet_length("text").cast("long").alias("n_bytes"), "id")
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    counts = stored.join(needed.select("content").distinct(), "content", "left_semi")
    counts = cut(counts.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return needed.join(counts, "content").select("id", "n_bytes", "n_tokens")
