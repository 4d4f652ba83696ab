"""T5 as a stream: route every attempt to the answer, retry or dead-letter output."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.requests import route_failures
from zonepulse.sources.requests_io import encode_failed


def route_batch(base: str):
    """foreachBatch body: one persisted batch, each output idempotent per batch.

    ``{base}/routed/{answer,retry,dlq}`` hold the attempts; ``{base}/retry`` and
    ``{base}/dlq`` the whole requests as JSON messages for the topics of those names.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route_failures(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for route in ("answer", "retry", "dlq"):
                part = routed.where(F.col("route") == route).drop("route")
                part.write.mode("overwrite").parquet(f"{base}/routed/{route}/batch_id={batch_id}")
                if route != "answer":
                    encode_failed(part).write.mode("overwrite").text(f"{base}/{route}/batch_id={batch_id}")
        finally:
            routed.unpersist()
    return write
