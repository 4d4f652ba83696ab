"""A6, A7 and A9 live: cumulative statistics kept across micro-batches, with reset.

A micro-batch reduces to mergeable partial aggregates: one row per (query type, zone) and
one per distinct latency. Every row carries the epoch it counts in: the order of the last
reset message (event type ``reset``) seen, -1 before the first. Events up to and including a
reset's order belong to closed epochs and are not kept; the event log is not touched.

All partials of a batch become visible by one commit, so a repeated batch adds nothing
twice. Batches whose id is a multiple of ``merge_every`` hold the merge of all before them,
so a reader takes at most ``merge_every`` batches. What is kept grows with distinct keys and
latencies, not with events. Later batches must hold later orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.operators.selection import nearest_rank_low, rank_counted
from zonepulse.operators.telemetry import EXACT, LATENCY_TYPES, totals_of
from zonepulse.functions import pct
from zonepulse.streaming.commit import BatchCommit, committed

RESET = "reset"
KEY = ("query_type", "zone_id")
_COUNTS = {"hits": "hit", "misses": "miss", "retries": "retry", "recoveries": "recovery", "dlq": "dlq"}
_LAST = {"lag": "consumer_lag", "recovery": "recovery_time"}
_KEYS = ("epoch long, query_type string, zone_id string, " + ", ".join(f"{c} long" for c in _COUNTS)
         + ", lat_sum decimal(38,9), lat_n long, "
         + ", ".join(f"{c} struct<at: long, value: double>" for c in _LAST))
_LATENCIES = "epoch long, value double, n long"


def partial_keys(events: DataFrame, epoch: int, order: str = "seq") -> DataFrame:
    """One row per (query type, zone): counts, exact latency sum, last lag and recovery time."""
    kind = F.col("event_type")
    lat = F.when(kind.isin(*LATENCY_TYPES), F.col("latency_ms").cast(EXACT))
    at = F.struct(F.col(order).cast("long").alias("at"), F.col("latency_ms").alias("value"))
    return events.groupBy(*KEY).agg(
        *[F.count_if(kind == t).alias(c) for c, t in _COUNTS.items()],
        F.sum(lat).cast(EXACT).alias("lat_sum"), F.count(lat).alias("lat_n"),
        *[F.max_by(at, F.when(kind == t, F.col(order))).alias(c) for c, t in _LAST.items()]
    ).select(F.lit(epoch).cast("long").alias("epoch"), "*")


def partial_latencies(events: DataFrame, epoch: int) -> DataFrame:
    """How often each latency occurs (hit, miss and recovery; no nulls, no NaN)."""
    v = F.col("latency_ms")
    return (events.where(F.col("event_type").isin(*LATENCY_TYPES) & v.isNotNull() & ~F.isnan(v))
            .groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(epoch).cast("long").alias("epoch"), "value", "n"))


def merge_keys(parts: DataFrame) -> DataFrame:
    return parts.groupBy("epoch", *KEY).agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.sum("lat_sum").cast(EXACT).alias("lat_sum"),
        F.sum("lat_n").alias("lat_n"), *[F.max_by(c, f"{c}.at").alias(c) for c in _LAST])


def merge_latencies(parts: DataFrame) -> DataFrame:
    return parts.groupBy("epoch", "value").agg(F.sum("n").alias("n"))


def _parts(spark: SparkSession, base: str, output: str, schema: str, names: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{base}/{output}/{n}" for n in names])


def _visible(spark: SparkSession, base: str, merge_every: int, below: int | None = None) -> list[str]:
    """Committed attempts a reader needs: the last merged batch and those after it."""
    done = {k: n for k, n in committed(spark, base).items() if below is None or k < below}
    start = max((k for k in done if k % merge_every == 0), default=0)
    return [done[k] for k in sorted(done) if k >= start]


def _epoch(spark: SparkSession, base: str, names: list[str]) -> int:
    row = _parts(spark, base, "epoch", "epoch long", names).agg(F.max("epoch")).first() if names else None
    return -1 if row is None or row[0] is None else row[0]


def start_totals_job(events: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                     order: str = "seq", merge_every: int = 32):
    """Stream of telemetry and reset messages to the partial aggregates under ``base``."""
    base = base.rstrip("/")

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _visible(spark, base, merge_every, below=batch_id)
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = rows.agg(F.max(F.when(F.col("event_type") == RESET, F.col(order)))).first()[0]
            epoch = max(_epoch(spark, base, before), -1 if seen is None else seen)
            live = rows.where((F.col(order) > epoch) & (F.col("event_type") != RESET))
            keys, lats = partial_keys(live, epoch, order), partial_latencies(live, epoch)
            if before and batch_id % merge_every == 0:
                current = lambda df: df.where(F.col("epoch") == epoch)
                keys = merge_keys(keys.unionByName(current(_parts(spark, base, "keys", _KEYS, before))))
                lats = merge_latencies(lats.unionByName(current(_parts(spark, base, "latencies", _LATENCIES, before))))
            with BatchCommit(spark, base, batch_id) as out:
                out.write("epoch", spark.createDataFrame([(epoch,)], "epoch long"))
                out.write("keys", keys)
                out.write("latencies", lats)
        finally:
            rows.unpersist()

    return (events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def _current(spark: SparkSession, base: str, merge_every: int) -> tuple[DataFrame, DataFrame]:
    """(keys, latencies) of the current epoch, merged."""
    base = base.rstrip("/")
    names = _visible(spark, base, merge_every)
    if not names:
        return spark.createDataFrame([], _KEYS), spark.createDataFrame([], _LATENCIES)
    now = F.col("epoch") == _epoch(spark, base, names)
    return (merge_keys(_parts(spark, base, "keys", _KEYS, names).where(now)),
            merge_latencies(_parts(spark, base, "latencies", _LATENCIES, names).where(now)))


def live_totals(spark: SparkSession, base: str, ps: Sequence[int] = (50, 95), merge_every: int = 32) -> DataFrame:
    """One row as ``telemetry_totals`` gives it for the events after the last reset."""
    keys, lats = _current(spark, base, merge_every)
    c = keys.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in _COUNTS],
                 F.sum("lat_sum").alias("_lat_sum"), F.coalesce(F.sum("lat_n"), F.lit(0)).alias("_lat_n"),
                 F.coalesce(F.sum(F.col("lag.value").cast(EXACT)).cast("double"), F.lit(0.0)).alias("backlog_size"),
                 F.greatest(F.coalesce(F.max("recovery.value"), F.lit(0.0)), F.lit(0.0)).alias("last_recovery_time_ms"))
    size = lats.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    want = size.select(F.explode(F.array(*[
        F.struct(F.lit(f"p{p}").alias("name"), nearest_rank_low(p)(F.col("n")).alias("_k")) for p in ps])).alias("r")).select("r.*")
    each = lats.select(F.explode(F.array(*[F.lit(f"p{p}") for p in ps])).alias("name"), F.col("value").alias("_v"),
                       F.col("n").alias("_cnt"))
    found = rank_counted(each, want, ["name"]).agg(F.struct(*[
        F.coalesce(F.round(F.max(F.when(F.col("name") == f"p{p}", F.col("_value"))), 3), F.lit(0.0)).alias(f"p{p}")
        for p in ps])).scalar()
    return totals_of(c, ["backlog_size", "last_recovery_time_ms"]).select(
        "*", *[found[f"p{p}"].alias(f"latency_p{p}_ms") for p in ps])


def live_by_query_zone(spark: SparkSession, base: str, merge_every: int = 32) -> DataFrame:
    """A7 for the events after the last reset."""
    keys, _ = _current(spark, base, merge_every)
    return keys.select(
        F.concat_ws(":", *KEY).alias("key"), *KEY, "hits", "misses", "retries", "dlq",
        pct(F.col("hits"), F.col("hits") + F.col("misses")).alias("hit_rate"))
