"""Telemetry operators: event time, sliding-window metrics, cumulative stats, reports."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions import event_time_from_epoch, hist_bin, pct
from zonepulse.operators.selection import median_ranks, nearest_rank_low, select_ranks
from zonepulse.schemas import EVENT_TYPES

def _et():
    return F.col("event_type")


def _n(cond: Column) -> Column:
    return F.count_if(cond)


# ---------------------------------------------------------------- P1, P2, S3

def with_event_time(df: DataFrame, epoch_col: str = "timestamp") -> DataFrame:
    """``event_time`` from epoch seconds, truncated to whole seconds."""
    return df.withColumn("event_time", event_time_from_epoch(F.col(epoch_col)))


def drop_invalid(df: DataFrame) -> DataFrame:
    """Rows without an event time cannot be windowed."""
    return df.where(F.col("event_time").isNotNull())


def normalise_telemetry(df: DataFrame, now: Column | None = None) -> DataFrame:
    """S3: a missing or zero timestamp becomes the ingest time."""
    now = now if now is not None else F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    ts = F.col("timestamp")
    return df.withColumn("timestamp", F.coalesce(F.nullif(ts, F.lit(0.0)), now.cast("double")))


# ---------------------------------------------------------------- A5, P10

#: Size parameter of the KLL sketch of a pane: exact up to about so many latencies in a
#: window, else a rank error of about 2.3 / SKETCH^0.9 (0.13 %).
SKETCH = 4096

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def interval_seconds(text: str) -> int:
    """Whole seconds of an interval such as ``10 seconds`` or ``1 hour 30 minutes``."""
    words = text.lower().split()
    if not words or len(words) % 2:
        raise ValueError(f"not an interval: {text!r}")
    return sum(int(n) * _UNITS[unit.removesuffix("s")] for n, unit in zip(words[::2], words[1::2], strict=True))


def _rates(windows: DataFrame, requests: Column, rows: Column, hits: Column, retries: Column,
           p50: Column, p95: Column) -> DataFrame:
    return windows.agg(
        requests.alias("total_requests"), requests.alias("throughput_per_min"),
        p50.alias("latency_p50"), p95.alias("latency_p95"),
        (hits / rows).alias("hit_rate"), (retries / rows).alias("retry_rate"))


def pane_metrics(df: DataFrame, pane: str, time_col: str = "event_time") -> DataFrame:
    """Mergeable partial metrics per pane: counts and a KLL sketch of the latencies. Every event
    meets one pane; rows without a time meet none."""
    return (df.groupBy(F.window(F.col(time_col), pane).alias("pane"))
            .agg(F.count(F.lit(1)).alias("rows"), _n(_et().isin("hit", "miss")).alias("requests"),
                 _n(_et() == "hit").alias("hits"), _n(_et() == "retry").alias("retries"),
                 F.count("latency_ms").alias("latencies"),
                 F.kll_sketch_agg_double("latency_ms", F.lit(SKETCH)).alias("sketch"))
            .select(F.col("pane.start").alias("pane"), "rows", "requests", "hits", "retries",
                    F.when(F.col("latencies") > 0, F.col("sketch")).alias("sketch")))


def merge_panes(panes: DataFrame, length: str, slide: str) -> DataFrame:
    """Sliding-window metrics from panes whose length divides both ``length`` and ``slide``."""
    merged = F.kll_merge_agg_double("sketch")
    some = F.count("sketch") > 0
    at = lambda p: F.when(some, F.kll_sketch_get_quantile_double(merged, F.lit(p)))
    return _rates(panes.groupBy(F.window(F.col("pane"), length, slide).alias("window")),
                  F.sum("requests"), F.sum("rows"), F.sum("hits"), F.sum("retries"), at(0.5), at(0.95))


def window_metrics(df: DataFrame, length: str = "1 minute", slide: str = "10 seconds",
                   time_col: str = "event_time") -> DataFrame:
    """A5: sliding-window request metrics.

    Rates divide by all rows of the window (the denominator counts every event), so the
    divisor is never zero. Percentiles are approximate, by mergeable sketches; nulls do not
    count, a window without latencies has none.

    Each event is aggregated once, into the pane (the greatest common part of length and
    slide) it falls into; only panes are expanded to the windows that cover them. A stream
    aggregates its windows directly: a sink in update mode takes one aggregation.
    """
    if not df.isStreaming:
        pane = math.gcd(interval_seconds(length), interval_seconds(slide))
        return merge_panes(pane_metrics(df, f"{pane} seconds", time_col), length, slide)
    return _rates(df.groupBy(F.window(F.col(time_col), length, slide).alias("window")),
                  _n(_et().isin("hit", "miss")), F.count(F.lit(1)), _n(_et() == "hit"), _n(_et() == "retry"),
                  F.percentile_approx("latency_ms", 0.5), F.percentile_approx("latency_ms", 0.95))


def window_documents(df: DataFrame) -> DataFrame:
    """P10: flatten the window; ``@timestamp`` = window end, ``doc_id`` = window start text."""
    start = F.col("window.start").cast("timestamp_ntz")
    end = F.col("window.end").cast("timestamp_ntz")
    return df.select(
        start.alias("window_start"), end.alias("window_end"),
        "total_requests", "throughput_per_min", "latency_p50", "latency_p95",
        "hit_rate", "retry_rate",
        end.alias("@timestamp"), start.cast("string").alias("doc_id"))


def sliding_window_report(telemetry: DataFrame, length: str = "1 minute",
                          slide: str = "10 seconds") -> DataFrame:
    """P1 -> P2 -> A5 -> P10 (the metrics job as a batch plan)."""
    events = drop_invalid(with_event_time(telemetry))
    return window_documents(window_metrics(events, length, slide))


# ---------------------------------------------------------------- A6 - A9

LATENCY_TYPES = ("hit", "miss", "recovery")
# Sums of doubles depend on order; summing as a wide decimal makes them exact.
EXACT = "decimal(38,9)"


def latency_percentiles(df: DataFrame, ps: Sequence[int] = (50, 95), by: Sequence[str] = (),
                        **kw) -> DataFrame:
    """Exact nearest-rank-low percentiles of latency over hit, miss and recovery,
    rounded to 3 decimals, 0 when empty. Columns ``latency_p{p}_ms``."""
    lat = df.where(_et().isin(*LATENCY_TYPES))
    ranks = {f"latency_p{p}_ms": nearest_rank_low(p) for p in ps}
    out = select_ranks(lat, "latency_ms", ranks, by=by, **kw)
    return out.select(*by, *[F.coalesce(F.round(F.col(c), 3), F.lit(0.0)).alias(c) for c in ranks])


def backlog_state(df: DataFrame, order: Sequence[str] = ("seq",),
                  key: Sequence[str] = ("query_type", "zone_id")) -> DataFrame:
    """backlog = sum over keys of the last consumer_lag; last recovery time = max over
    keys of the last recovery_time, at least 0. "Last" follows ``order`` (arrival order)."""
    last = F.max_by("latency_ms", F.struct(*order))
    per_key = (df.where(_et().isin("consumer_lag", "recovery_time"))
               .groupBy(*key, "event_type").agg(last.alias("last_value")))
    return per_key.agg(
        F.coalesce(F.sum(F.when(_et() == "consumer_lag", F.col("last_value").cast(EXACT)))
                   .cast("double"), F.lit(0.0)).alias("backlog_size"),
        F.greatest(F.coalesce(F.max(F.when(_et() == "recovery_time", F.col("last_value"))),
                              F.lit(0.0)), F.lit(0.0)).alias("last_recovery_time_ms"))


def _counters(df: DataFrame, by: Sequence[str]) -> DataFrame:
    lat = F.when(_et().isin(*LATENCY_TYPES), F.col("latency_ms").cast(EXACT))
    return df.groupBy(*by).agg(
        _n(_et() == "hit").alias("total_hits"), _n(_et() == "miss").alias("total_misses"),
        _n(_et() == "retry").alias("total_retries"), _n(_et() == "recovery").alias("total_recoveries"),
        _n(_et() == "dlq").alias("total_dlq"),
        F.sum(lat).alias("_lat_sum"), F.count(lat).alias("_lat_n"))


def since(df: DataFrame, start: float | None, ts: str = "timestamp") -> DataFrame:
    """Events at or after ``start`` (epoch seconds): counters "reset" at ``start``
    without touching the log."""
    return df if start is None else df.where(F.col(ts) >= F.lit(float(start)))


def totals_of(c: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rates and mean latency of summed counters; ``keep`` names further columns."""
    total = F.col("total_hits") + F.col("total_misses")
    return c.select(
        *keep,
        total.alias("total_requests"), "total_hits", "total_misses",
        pct(F.col("total_hits"), total).alias("hit_rate"),
        pct(F.col("total_retries"), F.col("total_misses")).alias("retry_rate"),
        pct(F.col("total_recoveries"), F.col("total_retries")).alias("recovery_rate"),
        pct(F.col("total_dlq"), F.col("total_misses")).alias("dlq_rate"),
        F.when(F.col("_lat_n") > 0, F.round(F.col("_lat_sum").cast("double") / F.col("_lat_n"), 3))
        .otherwise(F.lit(0.0)).alias("avg_latency_ms"))


def telemetry_totals(df: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("seq",),
                     start: float | None = None, **kw) -> DataFrame:
    """Cumulative statistics (percent rates rounded to 2, 0 when undefined), exact
    percentiles (A8) and backlog (A9). With ``by`` one row per group (A15); with
    ``start`` only events since that reset time count."""
    df = since(df, start)
    stats = totals_of(_counters(df, by), by)
    perc = latency_percentiles(df, (50, 95), by=by, **kw)
    if by:
        out = stats.join(perc, list(by), "left")
        return out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0))
                                for c in ("latency_p50_ms", "latency_p95_ms")})
    # one-row side results enter as scalar subqueries (one each), not as joins
    backlog = backlog_state(df, order).select(F.struct("*")).scalar()
    p = perc.select(F.struct("*")).scalar()
    return stats.select(
        "*",
        backlog["backlog_size"].alias("backlog_size"),
        backlog["last_recovery_time_ms"].alias("last_recovery_time_ms"),
        p["latency_p50_ms"].alias("latency_p50_ms"),
        p["latency_p95_ms"].alias("latency_p95_ms"))


def telemetry_by_query_zone(df: DataFrame, start: float | None = None) -> DataFrame:
    """Per ``query_type:zone_id`` hits, misses, retries, dlq and hit rate (percent)."""
    c = since(df, start).groupBy("query_type", "zone_id").agg(
        _n(_et() == "hit").alias("hits"), _n(_et() == "miss").alias("misses"),
        _n(_et() == "retry").alias("retries"), _n(_et() == "dlq").alias("dlq"))
    return c.select(
        F.concat_ws(":", "query_type", "zone_id").alias("key"), "query_type", "zone_id",
        "hits", "misses", "retries", "dlq",
        pct(F.col("hits"), F.col("hits") + F.col("misses")).alias("hit_rate"))


# ---------------------------------------------------------------- A10 - A12

def zone_hit_rate(df: DataFrame) -> DataFrame:
    """A10: event counts per zone and type, hit rate percent (null when no hit/miss), total."""
    counts = df.groupBy("zone_id").agg(*[_n(_et() == t).alias(t) for t in EVENT_TYPES])
    hm = F.col("hit") + F.col("miss")
    return counts.select(
        "*",
        F.when(hm > 0, F.col("hit") / hm * F.lit(100.0)).alias("hit_rate"),
        hm.alias("total"))


def throughput_series(df: DataFrame) -> DataFrame:
    """Events per whole second since the first event (all event types)."""
    first = df.select(F.min("timestamp")).scalar()
    second = F.floor(F.col("timestamp") - first).cast("long")
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(second.alias("second")).agg(F.count(F.lit(1)).alias("events")))


def throughput_mean(df: DataFrame) -> DataFrame:
    """Mean events per second over the seconds that have events."""
    return throughput_series(df).agg(
        F.count(F.lit(1)).alias("seconds"), F.sum("events").alias("events"),
        (F.sum("events") / F.count(F.lit(1))).alias("mean_per_second"))


def latency_histogram(df: DataFrame, bins: int = 30, types: Sequence[str] = ("hit", "miss")) -> DataFrame:
    """Equal-width latency histogram per event type over [min, max] of that type
    (widened by 0.5 on both sides when min = max), numpy edge rule, empty bins kept."""
    lat = df.where(_et().isin(*types) & F.col("latency_ms").isNotNull() & ~F.isnan("latency_ms")) \
        .select("event_type", F.col("latency_ms").alias("x"))
    rng = lat.groupBy("event_type").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    rng = rng.select(
        "event_type",
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    # one row per event type: a bounded broadcast side
    binned = lat.join(F.broadcast(rng), "event_type").select(
        "event_type", hist_bin(F.col("x"), F.col("lo"), F.col("hi") - F.col("lo"), F.lit(bins))
        .alias("bin"))
    counts = binned.groupBy("event_type", "bin").agg(F.count(F.lit(1)).alias("count"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    grid = rng.select("event_type", "lo", "hi",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")))
                      .alias("bin"))
    return (grid.join(counts, ["event_type", "bin"], "left")
            .select("event_type", "bin",
                    (F.col("lo") + F.col("bin") * step).alias("bin_min"),
                    F.when(F.col("bin") == bins - 1, F.col("hi"))
                    .otherwise(F.col("lo") + (F.col("bin") + 1) * step).alias("bin_max"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def latency_median(df: DataFrame, types: Sequence[str] = ("hit", "miss"), **kw) -> DataFrame:
    """N and exact median (mean of the two middle values for even n) per event type."""
    lat = df.where(_et().isin(*types))
    m = select_ranks(lat, "latency_ms", median_ranks(), by=["event_type"], **kw)
    return m.select("event_type", "n",
                    ((F.col("_mid_lo") + F.col("_mid_hi")) / F.lit(2.0)).alias("median_ms"))
