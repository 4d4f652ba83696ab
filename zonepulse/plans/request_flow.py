"""Request path: decode -> key -> validate -> TTL replay -> answer / route / events."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators import buildings as bld
from zonepulse.operators import requests as rq
from zonepulse.session import scratch_table
from zonepulse.sources.requests_io import decodable, decode_requests, encode_failed

#: What J3 adds to a request.
ANSWER_COLUMNS = ["count", "avg_area", "total_area", "n", "density_per_km2", "area_km2", "density_a", "density_b", "winner", "buckets"]


def keyed_and_validated(req: DataFrame, buildings: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """P7 + P9: every request with its cache key and validation outcome.

    ``loaded`` are the ids of the loaded zones where the job has written them already."""
    return rq.validate_requests(rq.with_cache_key(req, keep_existing=True),
                                rq.zone_ids(buildings) if loaded is None else loaded)


def replayed(req: DataFrame, buildings: DataFrame, ttl: float, **options) -> DataFrame:
    """P7 + P9 + T4: requests with ``cached`` (hit under the TTL)."""
    kv = keyed_and_validated(req, buildings).withColumn("valid", F.col("error_reason").isNull())
    return rq.ttl_replay(kv, ttl, **options)


def attempts(req: DataFrame, buildings: DataFrame, ttl: float,
             retries_col: str = "attempt_retries") -> DataFrame:
    """Each request row as one consumer attempt with its incoming retry count."""
    return replayed(req, buildings, ttl).withColumn("retries", F.col(retries_col).cast("int"))


class RequestOutcomes(Mapping):
    """Outputs of the request consumer, each planned when it is first asked for.

    ``rejects`` reads the messages only; the others share one replay.
    """

    def __init__(self, messages: DataFrame, buildings: DataFrame, ttl: float, now=None, completed=None):
        self._messages, self._buildings, self._ttl = messages, buildings, ttl
        self._now, self._completed = now, completed
        self._plans = {
            "answers": lambda: rq.answer_requests(self.replay.where(~F.col("cached")), self._buildings).select(
                *self.requests.columns, *ANSWER_COLUMNS),
            "routed": lambda: rq.route_failures(self.replay),
            "failed": lambda: encode_failed(self["routed"].where(F.col("route") != "answer"), keep=["route"]),
            "retry": lambda: self["failed"].where(F.col("route") == "retry").select("value"),
            "dlq": lambda: self["failed"].where(F.col("route") == "dlq").select("value"),
            "events": lambda: rq.attempt_events(self.replay, completed=self._completed),
            "rejects": lambda: self._messages.where(~decodable(F.col("value"))),
        }
        self._built: dict[str, DataFrame] = {}

    @cached_property
    def requests(self) -> DataFrame:
        """The decoded requests, written once: the replay reads them twice, and a filter that
        moves before the decoding would parse a message again for every column it asks."""
        judged = self._messages.withColumn("_request", decodable(F.col("value")))
        return scratch_table(decode_requests(judged, self._now), "requests").where("_request").drop("_request")

    @cached_property
    def replay(self) -> DataFrame:
        """P7, P9 and T4 of the requests."""
        return replayed(self.requests, self._buildings, self._ttl)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._plans[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


def process_requests(messages: DataFrame, buildings: DataFrame, ttl: float, now=None,
                     completed=None) -> RequestOutcomes:
    """The request consumer as a batch job over a message log (``value`` plus an arrival
    order ``seq``): S8 -> P7 -> P9 -> T4, then J3 for the misses (hits are served from
    the cache), T5 routing and T6 telemetry events. Outputs are planned on demand.

    ``rejects`` are messages that are no request object; they cause no event and no retry.
    ``retry`` and ``dlq`` are the messages for those topics, in the form S8 reads; ``failed``
    holds both with their ``route``. ``completed`` is the recorded completion time of a
    request, where the log has one.
    """
    return RequestOutcomes(messages, buildings, ttl, now, completed)


def start_request_consumer(messages: DataFrame, buildings: DataFrame, ttl: float, base: str,
                           checkpoint: str, trigger: dict | None = None):
    """The request consumer as one Structured Streaming job.

    ``messages`` is the stream of S7 (value, topic, seq). Before the start the buildings are
    reduced to counts per (zone, confidence) and written once under ``{base}/reduced``, the
    ids of their zones under ``{base}/zones``, so no micro-batch scans the building table or
    writes an intermediate; restart the job to take up new buildings. Per micro-batch: decode
    (S8), key (P7), validate (P9), replay the cache with per-key state (T4), then write:

    * ``events``: telemetry events (T6) with the time of the batch and the latency;
    * ``answers``: the answers (J3) of the misses that are valid;
    * ``routed``: the attempts by route (T5);
    * ``failed``: JSON messages for the retry and dead-letter topics, by route.

    All outputs of a micro-batch become visible at once, by one manifest
    (``streaming.commit``); read them with ``read_committed``. After the commit the
    messages go to ``{base}/retry`` and ``{base}/dlq`` as text, a part per batch that a
    repeated batch replaces; S7 reads ``{base}/retry`` back.
    """
    from pyspark import StorageLevel

    from zonepulse.streaming.commit import BatchCommit
    from zonepulse.streaming.ttl_state import ttl_replay_stream

    spark = messages.sparkSession
    bld.reduce_by_confidence(buildings).write.mode("overwrite").parquet(f"{base}/reduced")
    reduced = spark.read.parquet(f"{base}/reduced")
    rq.loaded_zones(reduced).write.mode("overwrite").parquet(f"{base}/zones")
    loaded = spark.read.parquet(f"{base}/zones")
    kv = keyed_and_validated(decode_requests(messages.where(decodable(F.col("value")))), reduced, loaded) \
        .withColumn("valid", F.col("error_reason").isNull())
    labelled = ttl_replay_stream(kv, ttl, keep=(
        "id", "query_type", "zone_id", "zone_id_b", "confidence_min", "bins", "retries", "error_reason", "t_start"),
        state_seconds=None if "availableNow" in (trigger or {}) else max(2 * ttl, 3600.0))

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
            asked = b.where(~F.col("cached")).select(
                "seq", "id", "cache_key", "query_type", "zone_id", "zone_id_b", "confidence_min", "bins", "t_start", "error_reason")
            routed = rq.route_failures(b)
            with BatchCommit(spark, base, batch_id) as out:
                out.write("events", rq.attempt_events(b, completed=now))
                out.write("answers", rq.answer_requests(asked, reduced).drop("error_reason"))
                out.write("routed", routed)
                failed = encode_failed(routed.where(F.col("route") != "answer"), keep=["route"])
                out.write("failed", failed)
            for route in ("retry", "dlq"):
                failed.where(F.col("route") == route).select("value").write.mode("overwrite").text(
                    f"{base}/{route}/batch_id={batch_id}")
        finally:
            b.unpersist()

    return (labelled.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
