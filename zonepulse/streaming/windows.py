"""Watermarked sliding-window metrics on a telemetry stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.telemetry import drop_invalid, window_documents, window_metrics, with_event_time


def windowed_stream(telemetry: DataFrame, delay: str = "1 minute", length: str = "1 minute",
                    slide: str = "10 seconds") -> DataFrame:
    """Decoded telemetry stream -> window documents, with state bounded by the watermark.

    Rows arriving after the watermark has passed their window are dropped (the
    watermark is the previous micro-batch's max event time minus ``delay``).
    """
    events = drop_invalid(with_event_time(telemetry)).withWatermark("event_time", delay)
    return window_documents(window_metrics(events, length, slide))
