"""Incremental claim extraction: contexts arrive as a stream, only those whose key isn't cached reach the model.

An extension: batches are appended to the cache table, each key once, whatever is replayed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from trovespark.operators.distil import claim_requests
from trovespark.sources.sinks import done

CONTEXTS = "qid string, pos int, id string, doc_id string, text string, ce_score double"


def contexts(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CONTEXTS).json(path)


def ingest(stream: DataFrame, cache: str, checkpoint: str, extract: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Runs until all input is taken in; `extract` maps requests (…, key, clip) to rows of the cache. A batch is written
    into a folder of its own, so that a replayed batch replaces itself."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = [p for p in (f"{cache}/batch-{i:06d}" for i in range(number)) if done(spark, p)]
        known = spark.read.parquet(*earlier) if earlier else None
        extract(claim_requests(batch, known)).write.mode("overwrite").parquet(f"{cache}/batch-{number:06d}")

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
