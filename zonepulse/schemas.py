"""Declared schemas of the data model (no inference on read)."""

from pyspark.sql import types as T

# Telemetry event, as published on the metrics topic and appended to the event log.
TELEMETRY = T.StructType([
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("query_type", T.StringType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("cache_key", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
])

# Zone question. confidence_min and bins have defaults applied on decode.
REQUEST = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("query_type", T.StringType()),
    T.StructField("confidence_min", T.DoubleType()),
    T.StructField("bins", T.IntegerType()),
    T.StructField("zone_id_b", T.StringType()),
])

# Envelope around a request on the request / retry / dead-letter topics.
ENVELOPE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("req", REQUEST),
    T.StructField("retries", T.IntegerType()),
    T.StructField("t_start", T.DoubleType()),
    T.StructField("cache_key", T.StringType()),
])

BUILDINGS = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("area_in_meters", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("zone_id", T.StringType()),
])

# Raw tile rows: coordinates, or a WKT point in `geometry`.
RAW_TILE = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("area_in_meters", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("geometry", T.StringType()),
])

EXPERIMENT_LOG = T.StructType([
    T.StructField("experiment_id", T.LongType()),
    T.StructField("start_time", T.DoubleType()),
    T.StructField("end_time", T.DoubleType()),
    T.StructField("distribution", T.StringType()),
    T.StructField("zipf_alpha", T.DoubleType()),
    T.StructField("n_requests", T.LongType()),
    T.StructField("request_rate", T.DoubleType()),
    T.StructField("sent", T.LongType()),
    T.StructField("success", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("hits", T.LongType()),
    T.StructField("misses", T.LongType()),
])

EXPERIMENT_SUMMARY = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("distribution", T.StringType()),
    T.StructField("eviction_policy", T.StringType()),
    T.StructField("maxmemory", T.StringType()),
    T.StructField("ttl", T.LongType()),
    T.StructField("hit_rate", T.DoubleType()),
    T.StructField("total_hits", T.LongType()),
    T.StructField("total_misses", T.LongType()),
    T.StructField("latency_p50_ms", T.DoubleType()),
    T.StructField("latency_p95_ms", T.DoubleType()),
    T.StructField("evicted_keys", T.LongType()),
])

EVENT_TYPES = ["hit", "miss", "retry", "recovery", "dlq", "consumer_lag", "recovery_time"]
