"""Test views derived from the driver's tables (see FIXTURES.md).

Each view is computed by Spark from ``events`` or ``lineitem`` so its size grows
with the scale factor. The same views exist as SQL text for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.session import ensure_utc
from zonepulse.sources.tables import read_table


def _epoch_seconds(ts: str) -> Column:
    # events.ts is TIMESTAMP_NTZ; with a UTC session the cast keeps the wall clock.
    return F.unix_micros(F.col(ts).cast("timestamp")).cast("double") / F.lit(1_000_000.0)


def _zone_of_user(uid: Column) -> Column:
    m = uid % 10
    return (F.when(m < 5, "Z1").when(m < 7, "Z2").when(m == 7, "Z3")
            .when(m == 8, "Z4").otherwise("Z5"))


def _query_of_event(eid: Column) -> Column:
    m = eid % 10
    return (F.when(m < 4, "Q1").when(m < 6, "Q2").when(m < 8, "Q3")
            .when(m == 8, "Q4").otherwise("Q5"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, timestamp, event_type, query_type, zone_id, cache_key, latency_ms."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    eid, et = F.col("event_id"), F.col("event_type")
    kind = (F.when(et.isin("view", "click"), "hit")
            .when(et == "purchase", "miss")
            .when((et == "error") & (eid % 4 == 0), "dlq")
            .when(et == "error", "retry")
            .when(eid % 4 == 0, "consumer_lag")
            .when(eid % 4 == 1, "recovery_time")
            .otherwise("recovery"))
    return ev.select(
        eid.alias("seq"),
        _epoch_seconds("ts").alias("timestamp"),
        kind.alias("event_type"),
        _query_of_event(eid).alias("query_type"),
        _zone_of_user(F.col("user_id")).alias("zone_id"),
        F.concat(F.lit("key:"), (eid % 70).cast("string")).alias("cache_key"),
        F.col("value").alias("latency_ms"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log with deliberate invalid rows (zone Z9, type Q6, Q4 without zone_id_b)."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    eid, uid = F.col("event_id"), F.col("user_id")
    zone = F.when(eid % 50 == 7, "Z9").otherwise(_zone_of_user(uid))
    qtype = F.when(eid % 50 == 13, "Q6").otherwise(_query_of_event(eid))
    conf = (F.when(eid % 3 == 0, F.lit(0.0)).when(eid % 3 == 1, F.lit(0.5))
            .otherwise(F.lit(0.7)))
    zone_b = F.when((eid % 10 == 8) & (eid % 50 != 28),
                    F.when(uid % 10 < 5, "Z2").otherwise("Z1"))
    return ev.select(
        eid.alias("seq"),
        _epoch_seconds("ts").alias("t_start"),
        zone.alias("zone_id"),
        qtype.alias("query_type"),
        conf.alias("confidence_min"),
        F.when(eid % 4 < 2, 5).otherwise(10).alias("bins"),
        zone_b.cast("string").alias("zone_id_b"),
        (eid % 5).cast("int").alias("attempt_retries"),
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded completion time of each request: seq, completed_at."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "value")
    return ev.select(F.col("event_id").alias("seq"),
                     (_epoch_seconds("ts") + F.col("value") / F.lit(1000.0)).alias("completed_at"))


def buildings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building tiles before zone assignment (coordinates and a WKT geometry)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                    "l_quantity")
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    frac_lat = ((ok * 7919 + pk * 31 + ln * 104729) % 100000).cast("double") / F.lit(100000.0)
    frac_lon = ((ok * 6101 + pk * 577 + ln * 15485863) % 100000).cast("double") / F.lit(100000.0)
    area = F.when(pk % 97 == 0, F.lit(None).cast("double")).otherwise(
        F.col("l_quantity") * F.lit(4.0) + ln.cast("double") / F.lit(2.0))
    conf = ((ok * 31 + pk * 17 + ln) % 1001).cast("double") / F.lit(1000.0)
    geometry = F.when(pk % 89 == 0, F.lit("POLYGON EMPTY")).otherwise(F.concat(
        F.lit("POINT (-70."), F.lpad((ok * 6101 % 1000000).cast("string"), 6, "0"),
        F.lit(" -33."), F.lpad((pk * 7919 % 1000000).cast("string"), 6, "0"), F.lit(")")))
    row = F.struct(
        (F.lit(-33.54) + F.lit(0.16) * frac_lat).alias("latitude"),
        (F.lit(-70.82) + F.lit(0.28) * frac_lon).alias("longitude"),
        area.alias("area_in_meters"),
        conf.alias("confidence"),
        geometry.alias("geometry"),
    )
    # Emitted through a one-row generator so that filters on these computed columns
    # read them instead of inlining the formulas into every predicate, as they would
    # for columns stored in a file.
    return li.select(F.inline(F.array(row)))


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer offset observations: lag rises and returns to 0 every 97 events."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    eid = F.col("event_id")
    return ev.select(
        eid.alias("seq"),
        (F.col("user_id") % 3).alias("consumer_id"),
        eid.alias("msg_offset"),
        (eid + 1 + F.when(eid % 97 > 50, eid % 97 - 50).otherwise(0)).alias("high_watermark"),
        _epoch_seconds("ts").alias("processed_at"),
    )


def runs(spark: SparkSession) -> DataFrame:
    """Ten experiment runs of 2.5 days, one every 3 days from 2024-01-01."""
    i = F.col("id").cast("int")
    start = F.lit(1704067200) + (i - 1) * 259200
    return spark.range(1, 11).select(
        i.alias("run_id"),
        F.when(i < 3, "dist_comparison").when(i < 6, "policy_comparison")
         .when(i < 9, "size_comparison").otherwise("ttl_comparison").alias("experiment"),
        start.cast("double").alias("start_time"),
        (start + 216000).cast("double").alias("end_time"),
        F.when(i == 2, "uniform").otherwise("zipf").alias("distribution"),
        F.when(i == 4, "LFU").when(i == 5, "FIFO/Random").otherwise("LRU").alias("eviction_policy"),
        F.when(i == 6, "50mb").when(i == 8, "500mb").otherwise("200mb").alias("maxmemory"),
        F.when(i == 9, 30).when(i == 10, 60).otherwise(300).alias("ttl"),
        F.when(i == 10, 0).otherwise(500).alias("sent"),
        F.when(i == 10, 0).otherwise(400 + i * 7).alias("hits"),
        F.when(i == 10, 0).otherwise(100 - i * 7).alias("misses"),
        F.lit(0).alias("evicted_keys"),
    )
