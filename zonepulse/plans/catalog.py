"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver's tables through the fixture views, so its work grows with
the scale factor. Output columns carry the same names as the DuckDB oracles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.operators import buildings as bld
from zonepulse.operators import experiments as exq
from zonepulse.operators import lag as lg
from zonepulse.operators import requests as rq
from zonepulse.operators import telemetry as tel
from zonepulse.plans import request_flow as flow
from zonepulse.plans.metrics_job import start_metrics_job
from zonepulse.session import scratch_path, scratch_table
from zonepulse.sources import buildings_io as bio
from zonepulse.sources import experiments_io as xio
from zonepulse.sources import requests_io as rio
from zonepulse.sources import fixtures as fx
from zonepulse.sources import telemetry_io as tio
from zonepulse.sources.tables import read_table
from zonepulse.sources.zones import zones as zone_table
from zonepulse.streaming.backlog import start_backlog_job
from zonepulse.streaming.commit import read_committed
from zonepulse.streaming.runs import assign_runs_stream
from zonepulse.streaming.totals import RESET, live_by_query_zone, live_totals, start_totals_job
from zonepulse.streaming.ttl_state import ttl_replay_event_time, ttl_replay_stream
from zonepulse.streaming.upsert import compact, read_upserted

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ telemetry

@register("window_metrics")
def q_window_metrics(spark, sf_dir):
    return tel.sliding_window_report(fx.telemetry(spark, sf_dir), "1 minute", "10 seconds")


@register("window_metrics_6h")
def q_window_metrics_6h(spark, sf_dir):
    return tel.sliding_window_report(fx.telemetry(spark, sf_dir), "6 hours", "1 hour")


@register("telemetry_totals")
def q_telemetry_totals(spark, sf_dir):
    return tel.telemetry_totals(fx.telemetry(spark, sf_dir))


@register("telemetry_by_query_zone")
def q_by_query_zone(spark, sf_dir):
    return tel.telemetry_by_query_zone(fx.telemetry(spark, sf_dir))


@register("latency_percentiles_by_zone")
def q_latency_percentiles_by_zone(spark, sf_dir):
    return tel.latency_percentiles(fx.telemetry(spark, sf_dir), (50, 90, 95, 99), by=["zone_id"])


@register("latency_percentiles_refined")
def q_latency_percentiles_refined(spark, sf_dir):
    """A8 with a coarse sketch and no slack: brackets that miss their rank are counted again."""
    return tel.latency_percentiles(fx.telemetry(spark, sf_dir), (50, 90, 95, 99), by=["zone_id"],
                                   sketch=8, grid=64, slack=0)


@register("backlog_state")
def q_backlog_state(spark, sf_dir):
    return tel.backlog_state(fx.telemetry(spark, sf_dir))


@register("zone_hit_rate")
def q_zone_hit_rate(spark, sf_dir):
    return tel.zone_hit_rate(fx.telemetry(spark, sf_dir))


@register("throughput_series")
def q_throughput_series(spark, sf_dir):
    return tel.throughput_series(fx.telemetry(spark, sf_dir))


@register("throughput_mean")
def q_throughput_mean(spark, sf_dir):
    return tel.throughput_mean(fx.telemetry(spark, sf_dir))


@register("latency_histogram")
def q_latency_histogram(spark, sf_dir):
    return tel.latency_histogram(fx.telemetry(spark, sf_dir), 30)


@register("latency_median")
def q_latency_median(spark, sf_dir):
    return tel.latency_median(fx.telemetry(spark, sf_dir))


# ------------------------------------------------------------------ buildings


TTL_FIXTURE = 21600.0  # the request log spans 30 days; hours-long TTL gives a mix


def _buildings(spark, sf_dir):
    return bld.prepare_buildings(fx.buildings_raw(spark, sf_dir))


def _valid_requests(spark, sf_dir):
    # the reduced table serves the validation and the answers: one scan of the buildings
    b = bld.reduce_by_confidence(_buildings(spark, sf_dir))
    req = fx.requests(spark, sf_dir)
    return rq.validate_requests(req, rq.zone_ids(b)).where(F.col("error_reason").isNull()), b


@register("buildings")
def q_buildings(spark, sf_dir):
    return _buildings(spark, sf_dir)


@register("buildings_from_wkt")
def q_buildings_from_wkt(spark, sf_dir):
    raw = fx.buildings_raw(spark, sf_dir).drop("latitude", "longitude")
    return bld.prepare_buildings(raw)


@register("buildings_grid")
def q_buildings_grid(spark, sf_dir):
    """J1 by the intervals of the Z-order curve (the path of zone tables)."""
    points = bld.project_complete(bld.filter_global_bbox(fx.buildings_raw(spark, sf_dir)))
    return bld.assign_zone_index(points, zone_table(spark))


@register("buildings_custom_zones")
def q_buildings_custom_zones(spark, sf_dir):
    """Preparation with another zone table: boxes of a quarter degree beside the built-in ones."""
    tile = F.col("id").cast("int")
    lat = F.lit(-33.54) + tile.cast("double") * F.lit(0.04)
    zones = spark.range(4).select(
        tile.alias("priority"), F.concat(F.lit("G"), tile.cast("string")).alias("zone_id"), F.lit("grid").alias("name"),
        lat.alias("lat_min"), (lat + F.lit(0.04)).alias("lat_max"), F.lit(-70.83).alias("lon_min"),
        F.lit(-70.5).alias("lon_max"), F.lit(33.4).alias("ref_lat"))
    return bld.zone_inventory(bld.prepare_buildings(fx.buildings_raw(spark, sf_dir), zones))


@register("zone_inventory")
def q_zone_inventory(spark, sf_dir):
    return bld.zone_inventory(_buildings(spark, sf_dir))


def _conf_params(valid):
    return valid.where(F.col("query_type").isin("Q1", "Q2", "Q3", "Q4")) \
        .select("zone_id", "confidence_min")


@register("q1_count")
def q_q1(spark, sf_dir):
    valid, b = _valid_requests(spark, sf_dir)
    return bld.q1_count(b, _conf_params(valid))


@register("q2_area")
def q_q2(spark, sf_dir):
    valid, b = _valid_requests(spark, sf_dir)
    return bld.q2_area(b, _conf_params(valid))


@register("q3_density")
def q_q3(spark, sf_dir):
    valid, b = _valid_requests(spark, sf_dir)
    return bld.q3_density(b, _conf_params(valid))


@register("q4_compare")
def q_q4(spark, sf_dir):
    valid, b = _valid_requests(spark, sf_dir)
    return bld.q4_compare(b, valid.where(F.col("query_type") == "Q4"))


@register("q5_histogram")
def q_q5(spark, sf_dir):
    valid, b = _valid_requests(spark, sf_dir)
    return bld.q5_histogram(b, valid.where(F.col("query_type") == "Q5"))


# ------------------------------------------------------------------ requests

@register("cache_keys")
def q_cache_keys(spark, sf_dir):
    return rq.with_cache_key(fx.requests(spark, sf_dir)).select("seq", "cache_key")


@register("validate_requests")
def q_validate(spark, sf_dir):
    b = _buildings(spark, sf_dir)
    return rq.validate_requests(fx.requests(spark, sf_dir), rq.zone_ids(b)) \
        .select("seq", "error_status", "error_reason")


@register("answer_requests")
def q_answer_requests(spark, sf_dir):
    ans = rq.answer_requests(fx.requests(spark, sf_dir), _buildings(spark, sf_dir))
    counts = F.concat_ws(",", F.transform(F.col("buckets"), lambda b: b["counts"].cast("string")))
    return ans.select("seq", "query_type", "zone_id", "zone_id_b", "confidence_min", "bins",
                      "count", "avg_area", "total_area", "n", "density_per_km2", "area_km2",
                      "density_a", "density_b", "winner",
                      F.when(F.col("buckets").isNotNull(), counts).alias("bucket_counts"))


@register("ttl_replay")
def q_ttl_replay(spark, sf_dir):
    r = flow.replayed(fx.requests(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    return r.select("seq", "cache_key", "cached")


@register("ttl_replay_parallel")
def q_ttl_replay_parallel(spark, sf_dir):
    """T4 with every segment above 20 rows on the parallel path."""
    r = flow.replayed(fx.requests(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE, segment_limit=20)
    return r.select("seq", "cache_key", "cached")


@register("ttl_replay_odd_rows")
def q_ttl_replay_odd_rows(spark, sf_dir):
    """T4 on a log with repeated order values and rows without time or key."""
    r = fx.requests(spark, sf_dir)
    seq = F.col("seq")
    r = r.withColumn("t_start", F.when(seq % 13 != 0, F.col("t_start"))) \
        .withColumn("id", seq).withColumn("seq", F.floor(seq / 4).cast("long"))
    kv = flow.keyed_and_validated(r, _buildings(spark, sf_dir)).withColumn("valid", F.col("error_reason").isNull())
    kv = kv.withColumn("cache_key", F.when(F.col("id") % 17 != 0, F.col("cache_key")))
    return rq.ttl_replay(kv, TTL_FIXTURE).groupBy("seq").agg(
        F.count("*").alias("n"), F.count("t_start").alias("timed"), F.count("cache_key").alias("keyed"),
        F.count_if("cached").alias("hits"))


@register("route_failures")
def q_route_failures(spark, sf_dir):
    a = flow.attempts(fx.requests(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    return rq.route_failures(a).select("seq", "route", "retries")


@register("attempt_events")
def q_attempt_events(spark, sf_dir):
    a = flow.attempts(fx.requests(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    return rq.attempt_events(a).select("seq", "event_index", "event_type", "query_type",
                                       "zone_id", "cache_key")


@register("attempt_telemetry")
def q_attempt_telemetry(spark, sf_dir):
    """T6 as telemetry rows: the recorded completion time gives timestamp and latency."""
    a = flow.attempts(fx.requests(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    a = a.join(fx.completions(spark, sf_dir), "seq")
    return rq.attempt_events(a, completed=F.col("completed_at")).select(
        "seq", "event_index", "timestamp", "event_type", "query_type", "zone_id", "cache_key", "latency_ms")


def _request_log(spark, sf_dir):
    """The requests with what an envelope adds, dealt out: a file of few row groups is read by
    as few tasks, and writing and parsing JSON takes many times the time of the scan."""
    return fx.requests(spark, sf_dir).repartition("seq", "t_start").select(
        "*", F.concat(F.lit("req_"), F.col("seq").cast("string")).alias("id"),
        F.col("attempt_retries").alias("retries"))


def _messages(spark, sf_dir):
    """The request log as wrapped messages, with some that are no request object."""
    r = _request_log(spark, sf_dir)
    junk = r.where(F.col("seq") % 89 == 0).select(
        "seq", F.when(F.col("seq") % 2 == 0, F.lit("not json")).otherwise(F.lit('{"req": 5}')).alias("value"))
    return rio.encode_requests(r, keep=["seq"]).unionByName(junk)


@register("retry_envelopes")
def q_retry_envelopes(spark, sf_dir):
    """T5's messages for the retry and dead-letter topics, read back by S8."""
    out = flow.process_requests(_messages(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    return rio.decode_requests(out["failed"].withColumnRenamed("route", "topic"), F.lit(FIXED_NOW))


@register("request_rejects")
def q_request_rejects(spark, sf_dir):
    """Messages that are no request object, by their text."""
    out = flow.process_requests(_messages(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    return out["rejects"].groupBy("value").agg(F.count("*").alias("n"))


@register("expand_failures")
def q_expand_failures(spark, sf_dir):
    """T7 over the log: five attempts in a row belong to one request id."""
    a = flow.attempts(fx.requests(spark, sf_dir), _buildings(spark, sf_dir), TTL_FIXTURE)
    return rq.expand_failures(a.withColumn("id", F.floor(F.col("seq") / 5).cast("long")))


@register("traffic_fit")
def q_traffic_fit(spark, sf_dir):
    return rq.traffic_fit(fx.requests(spark, sf_dir))


@register("sample_requests_observed")
def q_sample_observed(spark, sf_dir):
    """G2 by the frequencies of the request log."""
    log = fx.requests(spark, sf_dir)
    return rq.sample_requests(log.select("seq"), seed=11, observed=rq.observed_weights(log))


@register("sample_requests_zipf")
def q_sample_zipf(spark, sf_dir):
    ids = read_table(spark, sf_dir, "events", "event_id").withColumnRenamed("event_id", "seq")
    return rq.sample_requests(ids, "zipf", 1.5, 42)


@register("sample_requests_uniform")
def q_sample_uniform(spark, sf_dir):
    ids = read_table(spark, sf_dir, "events", "event_id").withColumnRenamed("event_id", "seq")
    return rq.sample_requests(ids, "uniform", 1.5, 7)


# ------------------------------------------------------------------ lag, experiments


@register("lag_samples")
def q_lag_samples(spark, sf_dir):
    return lg.lag_samples(fx.offsets(spark, sf_dir))


@register("backlog_episodes")
def q_backlog_episodes(spark, sf_dir):
    return lg.backlog_episodes(fx.offsets(spark, sf_dir))


@register("lag_events")
def q_lag_events(spark, sf_dir):
    message = fx.telemetry(spark, sf_dir).select("seq", "query_type", "zone_id", "cache_key")
    return lg.lag_events(fx.offsets(spark, sf_dir).join(message, "seq"))


@register("assign_runs")
def q_assign_runs(spark, sf_dir):
    return exq.assign_runs(fx.telemetry(spark, sf_dir), fx.runs(spark)).select("seq", "run_id")


def _summary(spark, sf_dir):
    return exq.summarise_runs(fx.telemetry(spark, sf_dir), fx.runs(spark))


@register("run_summary")
def q_run_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@register("compare_experiment")
def q_compare_experiment(spark, sf_dir):
    return exq.compare_experiment(_summary(spark, sf_dir))


@register("experiment_report")
def q_experiment_report(spark, sf_dir):
    return exq.experiment_report(_summary(spark, sf_dir))


# ------------------------------------------------------------------ sources and sinks


FIXED_NOW = 1.7e9  # ingest time used where a timestamp is missing (deterministic checks)


@register("telemetry_roundtrip")
def q_telemetry_roundtrip(spark, sf_dir):
    t = fx.telemetry(spark, sf_dir)
    t = t.withColumn("timestamp", F.when(F.col("seq") % 101 == 0, F.lit(0.0)).otherwise(F.col("timestamp")))
    t = tel.normalise_telemetry(t, F.lit(FIXED_NOW))                        # S3
    msgs = tio.encode_telemetry(t)                                           # S4
    junk = t.where(F.col("seq") % 97 == 0).select(F.lit('{"timestamp": oops').alias("value"))
    decoded = tio.decode_telemetry(msgs.unionByName(junk))                   # S2
    out = tel.drop_invalid(tel.with_event_time(decoded))                     # P1, P2
    return out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@register("telemetry_topic")
def q_telemetry_topic(spark, sf_dir):
    """S4 -> S1: telemetry published by a job and by a stream to one message log, consumed as a
    stream. Even events are published by the job, odd ones by the stream."""
    base = scratch_path(spark, "topic")
    t = fx.telemetry(spark, sf_dir)
    encoded = lambda rows: tio.encode_telemetry(rows, key="cache_key")
    tio.write_topic(encoded(t.where(F.col("seq") % 2 == 0)), f"{base}/topic", "message_log", partitions=4)
    t.where(F.col("seq") % 2 == 1).drop("seq").write.parquet(f"{base}/in")
    src = spark.readStream.schema(t.drop("seq").schema).parquet(f"{base}/in")
    tio.write_topic_stream(encoded(src), f"{base}/topic", f"{base}/published", "message_log", {"availableNow": True},
                           partitions=4).awaitTermination()
    got = tio.read_telemetry_stream(spark, "message_log", f"{base}/topic", startingOffsets="earliest")
    (tio.decode_telemetry(got, keep=("partition", "offset")).writeStream.format("parquet").option("path", f"{base}/out")
     .option("checkpointLocation", f"{base}/consumed").trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(f"{base}/out")
    # a partition's messages have the offsets 0, 1, 2, ...; all messages of a key share a partition
    per_key = out.groupBy("cache_key").agg(
        F.count("*").alias("messages"), F.sum(F.col("latency_ms").cast("decimal(28,9)")).cast("double").alias("latency"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
        F.min("partition").alias("partition"), F.max("partition").alias("_other"))
    whole = out.groupBy("partition").agg((F.max("offset") + 1).alias("next"), F.countDistinct("offset").alias("offsets"))
    return per_key.join(whole, "partition").select(
        "cache_key", "messages", "latency", "first", "last", (F.col("partition") == F.col("_other")).alias("one_partition"),
        (F.col("next") == F.col("offsets")).alias("no_gap"))


def _envelopes(spark, sf_dir):
    r = fx.requests(spark, sf_dir)
    seq = F.col("seq")
    r = r.select("*", F.concat(F.lit("req_"), seq.cast("string")).alias("id"),
                 F.col("attempt_retries").alias("retries"),
                 F.when(seq % 5 == 0, F.concat(F.lit("pre:"), seq.cast("string")))
                 .when(seq % 11 == 0, F.lit("")).alias("cache_key"))
    r = r.withColumn("t_start", F.when(seq % 7 == 0, F.lit(0.0)).otherwise(F.col("t_start")))
    bare = rio.encode_bare_requests(r.where(seq % 3 == 0))
    failed = rio.encode_failed(r.where((seq % 3 != 0) & F.col("cache_key").isNotNull()))
    plain = rio.encode_requests(r.where((seq % 3 != 0) & F.col("cache_key").isNull()))
    return bare.unionByName(failed).unionByName(plain)


@register("request_envelopes")
def q_request_envelopes(spark, sf_dir):
    return rio.decode_requests(_envelopes(spark, sf_dir), F.lit(FIXED_NOW))   # S9 -> S8


@register("telemetry_log_roundtrip")
def q_telemetry_log(spark, sf_dir):
    path = scratch_path(spark, "event-log")
    tio.append_telemetry(fx.telemetry(spark, sf_dir), path)                  # S5
    return tel.telemetry_by_query_zone(tio.read_telemetry_log(spark, path))


@register("buildings_roundtrip")
def q_buildings_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "buildings")
    bio.write_buildings(_buildings(spark, sf_dir), base)                    # S12
    b = bio.load_buildings(spark, base)                                      # S11
    return b.groupBy("zone_id").agg(F.count(F.lit(1)).alias("buildings"),
                                    F.sum("area_in_meters").alias("total_area"))


@register("buildings_box")
def q_buildings_box(spark, sf_dir):
    """P4 over the clustered copy (S12): the buildings of a small box that lies in two zones."""
    base = scratch_path(spark, "buildings-clustered")
    bio.write_clustered(_buildings(spark, sf_dir), base)
    b = bio.load_buildings(spark, base).where(F.col("latitude").between(-33.43, -33.41) & F.col("longitude").between(-70.61, -70.59))
    return b.groupBy("zone_id").agg(F.count(F.lit(1)).alias("buildings"),
                                    F.sum("area_in_meters").alias("total_area"), F.min("confidence").alias("least_confidence"))


@register("buildings_csv_fallback")
def q_buildings_csv_fallback(spark, sf_dir):
    """S11 where only the CSV copy exists."""
    base = scratch_path(spark, "buildings-csv")
    bio.write_buildings(_buildings(spark, sf_dir), base, formats=("csv",))
    b = bio.load_buildings(spark, base)
    return b.groupBy("zone_id").agg(F.count(F.lit(1)).alias("buildings"),
                                    F.sum("area_in_meters").alias("total_area"))


@register("tiles_mixed")
def q_tiles_mixed(spark, sf_dir):
    """S10 over tiles with coordinates, tiles of another column order and tiles with WKT only."""
    path = scratch_path(spark, "tiles-mixed")
    raw = fx.buildings_raw(spark, sf_dir)
    pick = F.pmod(F.xxhash64("latitude", "longitude", "area_in_meters"), F.lit(3))
    point = F.concat(F.lit("POINT ("), F.col("longitude").cast("string"), F.lit(" "), F.col("latitude").cast("string"), F.lit(")"))
    forms = (["latitude", "longitude", "area_in_meters", "confidence"],
             ["confidence", "geometry", "longitude", "area_in_meters", "latitude"],
             ["area_in_meters", "confidence", point.alias("geometry"), F.lit("x").alias("full_plus_code")])
    for i, columns in enumerate(forms):
        raw.where(pick == i).select(*columns).write.option("header", True).option("compression", "gzip").csv(f"{path}/{i}")
    return bld.prepare_buildings(bio.scan_tiles(spark, f"{path}/*"))


@register("tiles_scan")
def q_tiles_scan(spark, sf_dir):
    path = scratch_path(spark, "tiles")
    # tiles arrive as many gzip files (one scan task each); a tile holds so many rows at most
    fx.buildings_raw(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).write.option("header", True) \
        .option("maxRecordsPerFile", 100_000).option("compression", "gzip").csv(path)
    return bld.prepare_buildings(bio.scan_tiles(spark, path))              # S10


@register("experiment_log")
def q_experiment_log(spark, sf_dir):
    """The runs' counters appended to the experiment log in two parts and read back."""
    path = scratch_path(spark, "experiments")
    seen = exq.assign_runs(fx.telemetry(spark, sf_dir), fx.runs(spark)).groupBy("run_id").agg(
        F.count_if(F.col("event_type") == "hit").alias("hits"), F.count_if(F.col("event_type") == "miss").alias("misses"),
        F.count_if(F.col("event_type") == "dlq").alias("errors"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = fx.runs(spark).drop("hits", "misses", "sent").join(seen, "run_id", "left").select(
        F.col("run_id").cast("long").alias("experiment_id"), "start_time", "end_time", "distribution",
        F.when(F.col("distribution") == "zipf", F.lit(1.5)).alias("zipf_alpha"),
        (n("hits") + n("misses")).alias("n_requests"), F.lit(10.0).alias("request_rate"),
        (n("hits") + n("misses") + n("errors")).alias("sent"), (n("hits") + n("misses")).alias("success"),
        n("errors").alias("errors"), n("hits").alias("hits"), n("misses").alias("misses"))
    xio.append_experiments(rows.where("experiment_id % 2 = 0"), path)
    xio.append_experiments(rows.where("experiment_id % 2 = 1"), path)
    return exq.experiment_hit_rate(xio.read_experiments(spark, path))


@register("summary_roundtrip")
def q_summary_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "summary")
    xio.write_summary(_summary(spark, sf_dir), path)                         # S14
    return exq.experiment_report(xio.read_summary(spark, path))


# ------------------------------------------------------------------ streaming


@register("window_metrics_stream")
def q_window_metrics_stream(spark, sf_dir):
    base = scratch_path(spark, "metrics-stream")
    tio.encode_telemetry(fx.telemetry(spark, sf_dir)).write.text(f"{base}/in")
    q = start_metrics_job(spark, f"{base}/out", f"{base}/checkpoint", source="text",
                          path=f"{base}/in", trigger={"availableNow": True})
    q.awaitTermination()
    return read_upserted(spark, f"{base}/out")


def _metrics_run(spark, base, **options):
    q = start_metrics_job(spark, f"{base}/out", f"{base}/checkpoint", source="text", path=f"{base}/in",
                          trigger={"availableNow": True}, recursiveFileLookup=True, **options)
    q.awaitTermination()


@register("window_metrics_late")
def q_window_metrics_late(spark, sf_dir):
    """Three batches (event ids modulo 3). The third meets the watermark of the first:
    its rows count only in windows that end after it."""
    base = scratch_path(spark, "metrics-late")
    t = fx.telemetry(spark, sf_dir)
    conf, empty_batches = spark.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(empty_batches)
    conf.set(empty_batches, "false")        # a part is one batch, also at the end of a run
    try:
        for part in range(3):
            tio.write_topic(tio.encode_telemetry(t.where(F.col("seq") % 3 == part)), f"{base}/in", "message_log")
            start_metrics_job(spark, f"{base}/out", f"{base}/checkpoint", source="message_log", path=f"{base}/in",
                              trigger={"availableNow": True}, startingOffsets="earliest").awaitTermination()
    finally:
        conf.set(empty_batches, before)
    return read_upserted(spark, f"{base}/out")


@register("window_metrics_restart")
def q_window_metrics_restart(spark, sf_dir):
    """The job ends half way, its changes are compacted, and it goes on from its
    checkpoint: the documents equal one run over everything."""
    base = scratch_path(spark, "metrics-restart")
    t = fx.telemetry(spark, sf_dir)
    middle = t.agg(F.percentile_approx("timestamp", 0.5)).first()[0]
    for part, rows in enumerate((t.where(F.col("timestamp") < middle), t.where(F.col("timestamp") >= middle))):
        tio.encode_telemetry(rows).write.text(f"{base}/in/{part}")
        _metrics_run(spark, base)
        compact(spark, f"{base}/out")
    return read_upserted(spark, f"{base}/out")


@register("ttl_replay_stream")
def q_ttl_replay_stream(spark, sf_dir):
    base = scratch_path(spark, "ttl-stream")
    kv = flow.keyed_and_validated(fx.requests(spark, sf_dir), _buildings(spark, sf_dir)) \
        .withColumn("valid", F.col("error_reason").isNull())
    kv.select("seq", "t_start", "cache_key", "valid").write.parquet(f"{base}/in")
    src = spark.readStream.schema(spark.read.parquet(f"{base}/in").schema).parquet(f"{base}/in")
    q = (ttl_replay_stream(src, TTL_FIXTURE).writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("seq", "cache_key", "cached")


@register("ttl_replay_event_time")
def q_ttl_replay_event_time(spark, sf_dir):
    """T4 over arrivals up to half a day out of order, in three parts with a restart after each:
    the watermark's timers judge them in time order, so the result equals the batch replay."""
    base = scratch_path(spark, "ttl-timers")
    kv = flow.keyed_and_validated(fx.requests(spark, sf_dir), _buildings(spark, sf_dir)).select(
        "seq", "t_start", "cache_key", F.col("error_reason").isNull().alias("valid"))
    late = kv.withColumn("arrived", F.col("t_start") + F.pmod(F.xxhash64("seq"), F.lit(43_200)))
    late = scratch_table(late, "late-requests")
    lo, hi = late.agg(F.min("arrived"), F.max("arrived")).first()
    last = spark.createDataFrame([(-1, hi + 10 * 86_400.0, "", False)], "seq long, t_start double, cache_key string, valid boolean")
    cuts = [lo + (hi - lo) * k / 3 for k in range(3)] + [float("inf")]
    for k in range(3):
        part = late.where((F.col("arrived") >= cuts[k]) & (F.col("arrived") < cuts[k + 1])).drop("arrived")
        (part.unionByName(last) if k == 2 else part).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(last.schema).parquet(f"{base}/in")
        q = (ttl_replay_event_time(src, TTL_FIXTURE, "1 day").writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("seq", "cache_key", "cached")


@register("backlog_episodes_live")
def q_backlog_episodes_live(spark, sf_dir):
    """W2 as a stream: the offsets arrive in three parts, with a restart after each."""
    base = scratch_path(spark, "backlog-live")
    o = scratch_table(fx.offsets(spark, sf_dir), "offset-log")
    n = o.agg(F.max("seq")).first()[0] + 1
    for k in range(3):
        o.where((F.col("seq") >= n * k // 3) & (F.col("seq") < n * (k + 1) // 3)).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(o.schema).parquet(f"{base}/in")
        start_backlog_job(src, f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return read_committed(spark, f"{base}/out", "episodes")


def _live_totals(spark, sf_dir):
    """Telemetry in three parts with a restart after each, and a reset after half of it."""
    base = scratch_path(spark, "totals-live")
    t = scratch_table(fx.telemetry(spark, sf_dir), "telemetry-log")
    n = t.agg(F.max("seq")).first()[0] + 1
    reset = t.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields if f.name not in ("seq", "event_type")],
                     "seq", F.lit(RESET).alias("event_type")).where(F.col("seq") == n // 2).limit(1)
    for k in range(3):
        part = t.where((F.col("seq") >= n * k // 3) & (F.col("seq") < n * (k + 1) // 3))
        (part.unionByName(reset) if k == 1 else part).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(t.schema).parquet(f"{base}/in")
        start_totals_job(src, f"{base}/out", f"{base}/checkpoint", {"availableNow": True}, merge_every=2).awaitTermination()
    return f"{base}/out"


@register("telemetry_totals_live")
def q_telemetry_totals_live(spark, sf_dir):
    """A6 live: totals since the reset, from the state of the stream."""
    return live_totals(spark, _live_totals(spark, sf_dir), merge_every=2)


@register("telemetry_by_query_zone_live")
def q_by_query_zone_live(spark, sf_dir):
    """A7 live: counts per key since the reset."""
    return live_by_query_zone(spark, _live_totals(spark, sf_dir), merge_every=2)


@register("assign_runs_stream")
def q_assign_runs_stream(spark, sf_dir):
    """J4 as a stream-stream join: events meet the run records on two watermarks."""
    base = scratch_path(spark, "runs-stream")
    t, r = fx.telemetry(spark, sf_dir).select("seq", "timestamp"), fx.runs(spark).select("run_id", "start_time", "end_time")
    t.write.parquet(f"{base}/events")
    r.write.parquet(f"{base}/runs")
    read = lambda df, name: spark.readStream.schema(df.schema).parquet(f"{base}/{name}")
    q = (assign_runs_stream(read(t, "events"), read(r, "runs")).writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("seq", "run_id")


@register("request_outcomes")
def q_request_outcomes(spark, sf_dir):
    """End to end: requests as envelopes on a log -> decode -> key -> validate -> TTL
    replay -> telemetry events (equal to attempt_events on the same requests)."""
    r = _request_log(spark, sf_dir)
    msgs = rio.encode_requests(r, keep=["seq"])                               # S9
    out = flow.process_requests(msgs, _buildings(spark, sf_dir), TTL_FIXTURE)
    return out["events"].select("seq", "event_index", "event_type", "query_type", "zone_id",
                                "cache_key")


@register("request_outcomes_stream")
def q_request_outcomes_stream(spark, sf_dir):
    """The streaming request consumer over the same envelopes (first attempts on the main
    topic, later ones on the retry topic): its events equal the batch replay's."""
    return _consumed(spark, sf_dir).select(
        F.regexp_extract("id", r"^req_(\d+)$", 1).cast("long").alias("seq"),
        "event_index", "event_type", "query_type", "zone_id", "cache_key")


@register("request_answers_stream")
def q_request_answers_stream(spark, sf_dir):
    """The answers that the streaming consumer writes for its misses."""
    ans = _consumed(spark, sf_dir, "answers")
    return ans.select(F.regexp_extract("id", r"^req_(\d+)$", 1).cast("long").alias("seq"), "query_type", "zone_id",
                      "zone_id_b", "confidence_min", "bins", "count", "avg_area", "total_area", "n", "density_per_km2",
                      "area_km2", "density_a", "density_b", "winner", F.when(F.col("buckets").isNotNull(), F.concat_ws(
                          ",", F.transform(F.col("buckets"), lambda b: b["counts"].cast("string")))).alias("bucket_counts"))


def _consumed(spark, sf_dir, output="events"):
    base = scratch_path(spark, "consumer")
    r = _request_log(spark, sf_dir)
    rio.encode_requests(r.where("retries = 0")).write.text(f"{base}/main")
    rio.encode_requests(r.where("retries > 0")).write.text(f"{base}/retry")
    msgs = rio.read_requests_stream(spark, "text", (f"{base}/main", f"{base}/retry"))
    q = flow.start_request_consumer(msgs, _buildings(spark, sf_dir), TTL_FIXTURE, f"{base}/out",
                                    f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return read_committed(spark, f"{base}/out", output)
