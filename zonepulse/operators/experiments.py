"""Experiment runs: event-to-run assignment, per-run summary, comparison and report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators.telemetry import telemetry_totals

# Width of the time buckets used to turn the interval join into an equi-join.
BUCKET_SECONDS = 86400.0

CONFIG_COLUMNS = ["experiment", "distribution", "eviction_policy", "maxmemory", "ttl"]

# Which configuration column each experiment varies.
VARIED = {
    "dist_comparison": "distribution",
    "policy_comparison": "eviction_policy",
    "size_comparison": "maxmemory",
    "ttl_comparison": "ttl",
}


def assign_runs(events: DataFrame, runs: DataFrame, ts: str = "timestamp",
                bucket: float = BUCKET_SECONDS) -> DataFrame:
    """Events with the run whose [start_time, end_time) contains them (inner).

    Each run is listed under every time bucket it overlaps; events look up their own
    bucket, so the interval join is an equi-join plus a range check (no nested loop).
    """
    b = F.lit(bucket)
    spans = runs.select(
        F.col("run_id"), F.col("start_time").alias("_rs"), F.col("end_time").alias("_re"),
        F.explode(F.sequence(F.floor(F.col("start_time") / b).cast("long"),
                             F.floor(F.col("end_time") / b).cast("long"))).alias("_bucket"))
    ev = events.withColumn("_bucket", F.floor(F.col(ts) / b).cast("long"))
    return (ev.join(spans, "_bucket")
            .where((F.col(ts) >= F.col("_rs")) & (F.col(ts) < F.col("_re")))
            .drop("_bucket", "_rs", "_re"))


def experiment_hit_rate(exps: DataFrame) -> DataFrame:
    """Hits / sent * 100, 0 when nothing was sent."""
    return exps.withColumn("log_hit_rate", F.when(F.col("sent") > 0,
                                                  F.col("hits") / F.col("sent") * F.lit(100.0))
                           .otherwise(F.lit(0.0)))


def summarise_runs(events: DataFrame, runs: DataFrame, **kw) -> DataFrame:
    """Per run, the cumulative statistics of its events plus its configuration.
    Runs without events report zeros; ``evicted_keys`` is carried from the run table."""
    per_run = telemetry_totals(assign_runs(events, runs), by=["run_id"], **kw)
    r = experiment_hit_rate(runs)
    out = r.join(per_run, "run_id", "left")
    zero = lambda c, z=0: F.coalesce(F.col(c), F.lit(z))
    return out.select(
        "run_id", *CONFIG_COLUMNS,
        zero("hit_rate", 0.0).alias("hit_rate"),
        zero("total_hits").cast("long").alias("total_hits"),
        zero("total_misses").cast("long").alias("total_misses"),
        zero("latency_p50_ms", 0.0).alias("latency_p50_ms"),
        zero("latency_p95_ms", 0.0).alias("latency_p95_ms"),
        F.col("evicted_keys").cast("long").alias("evicted_keys"),
        "log_hit_rate")


def _label() -> F.Column:
    e = F.col("experiment")
    expr = None
    for name, col in VARIED.items():
        v = F.concat(F.col(col).cast("string"), F.lit("s")) if col == "ttl" else F.col(col)
        expr = F.when(e == name, v) if expr is None else expr.when(e == name, v)
    return expr


def compare_experiment(summary: DataFrame, name: str | None = None) -> DataFrame:
    """One row per (configuration label, metric) of an experiment (all when None)."""
    s = summary if name is None else summary.where(F.col("experiment") == name)
    s = s.select("experiment", _label().alias("label"), "hit_rate", "latency_p50_ms", "latency_p95_ms")
    return s.unpivot(["experiment", "label"], ["hit_rate", "latency_p50_ms", "latency_p95_ms"],
                     "metric", "value")


def experiment_report(summary: DataFrame) -> DataFrame:
    """Report rows: title-cased experiment, configuration label, metrics to one
    decimal, evictions."""
    return summary.select(
        F.initcap(F.regexp_replace("experiment", "_", " ")).alias("title"),
        _label().alias("label"),
        F.round("hit_rate", 1).alias("hit_rate"),
        F.round("latency_p50_ms", 1).alias("latency_p50_ms"),
        F.round("latency_p95_ms", 1).alias("latency_p95_ms"),
        "evicted_keys")
