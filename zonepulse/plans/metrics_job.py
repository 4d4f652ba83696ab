"""The sliding-window metrics job: S1 -> S2 -> P1 -> P2 -> T1 -> A5 -> P10 -> S6."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from zonepulse.session import ensure_utc
from zonepulse.sources.telemetry_io import decode_telemetry, read_telemetry_stream
from zonepulse.streaming.upsert import upsert_windows
from zonepulse.streaming.windows import windowed_stream


def start_metrics_job(spark: SparkSession, target: str, checkpoint: str, source: str = "kafka",
                      path: str | None = None, delay: str = "1 minute", length: str = "1 minute",
                      slide: str = "10 seconds", trigger: dict | None = None,
                      compact_every: int = 100, **source_options) -> StreamingQuery:
    ensure_utc(spark)
    raw = read_telemetry_stream(spark, source, path, **source_options)
    docs = windowed_stream(decode_telemetry(raw), delay, length, slide)
    return upsert_windows(docs, target, checkpoint, trigger, compact_every=compact_every)
