"""J4 as a stream: telemetry meets run records, both live, on two watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.experiments import BUCKET_SECONDS


def assign_runs_stream(events: DataFrame, runs: DataFrame, ts: str = "timestamp", delay: str = "2 days",
                       bucket: float = BUCKET_SECONDS) -> DataFrame:
    """``events`` (stream) with the run whose [start_time, end_time) contains them (inner).

    A run record is listed under every time bucket it overlaps, with the bucket's start as
    its event time; an event looks up its own bucket. The equality on the bucket and the
    bound of an event to the length of a bucket after its start let both watermarks
    clear the state: a run or an event waits for the other side for ``delay`` at most.
    """
    b = F.lit(bucket)
    at = lambda c: F.timestamp_micros((c * F.lit(1e6)).cast("long"))
    spans = runs.select(
        "run_id", F.col("start_time").alias("_rs"), F.col("end_time").alias("_re"),
        F.explode(F.sequence(F.floor(F.col("start_time") / b).cast("long"),
                             F.floor(F.col("end_time") / b).cast("long"))).alias("_run_bucket"))
    spans = spans.withColumn("_run_time", at(F.col("_run_bucket") * b)).withWatermark("_run_time", delay)
    ev = events.withColumns({"_event_time": at(F.col(ts)), "_bucket": F.floor(F.col(ts) / b).cast("long")}).withWatermark("_event_time", delay)
    met = ev.join(spans, (F.col("_bucket") == F.col("_run_bucket")) & (F.col("_event_time") >= F.col("_run_time"))
                  & (F.col("_event_time") < F.col("_run_time") + F.expr(f"INTERVAL {int(bucket)} SECONDS")))
    return (met.where((F.col(ts) >= F.col("_rs")) & (F.col(ts) < F.col("_re")))
            .drop("_bucket", "_run_bucket", "_event_time", "_run_time", "_rs", "_re"))
