"""W2 as a stream: backlog episodes that open and close across micro-batches.

What a consumer leaves open is one row, the observation that opened the episode. Each
micro-batch is the batch operator (gaps and islands in blocks, so no task holds a whole
consumer) over its rows and the open rows of the batch before. Episodes, the telemetry
about them and the new open rows become visible by one commit, so a repeated batch starts
from the open rows of its predecessor again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.lag import backlog_episodes, lag_samples, with_lag
from zonepulse.streaming.commit import BatchCommit, committed


def still_open(offsets: DataFrame, key: str = "consumer_id", order: str = "seq") -> DataFrame:
    """For each consumer the row that opened the episode which no later zero lag closes.

    Two aggregates with map-side combine; the table between them has a row per consumer.
    """
    rows = with_lag(offsets)
    zeros = rows.groupBy(key).agg(F.max(F.when(F.col("lag") == 0, F.col(order))).alias("_zero"))
    after = rows.join(zeros, key).where((F.col("lag") > 0) & (F.col("_zero").isNull() | (F.col(order) > F.col("_zero"))))
    first = after.groupBy(key).agg(F.min_by(F.struct(*offsets.columns), order).alias("_first"))
    return first.select("_first.*")


def start_backlog_job(offsets: DataFrame, base: str, checkpoint: str, trigger: dict | None = None, every: int = 10):
    """Stream of offset observations (consumer_id, seq, msg_offset, high_watermark, processed_at,
    later batches holding later seq) to the outputs ``episodes``, ``samples`` (W1) and ``open``
    under ``base``; read them with ``read_committed``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = {k: n for k, n in committed(spark, base).items() if k < batch_id}
        rows = batch
        if before:
            rows = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{base}/open/{before[max(before)]}"))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with BatchCommit(spark, base, batch_id) as out:
                out.write("episodes", backlog_episodes(rows))
                out.write("samples", lag_samples(batch, every))
                out.write("open", still_open(rows))
        finally:
            rows.unpersist()

    return (offsets.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
