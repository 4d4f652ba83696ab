"""Request operators: cache key, validation, answers, TTL replay, retries, outcomes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from zonepulse.functions import cache_key
from zonepulse.operators import buildings as bld
from zonepulse.session import scratch_table

QUERY_TYPES = ["Q1", "Q2", "Q3", "Q4", "Q5"]
MAX_RETRIES = 3
#: A histogram of more bins is refused: its answer would be one array of that length.
MAX_BINS = 1_000_000


# ------------------------------------------------------------- P7

def with_cache_key(df: DataFrame, keep_existing: bool = False) -> DataFrame:
    """Canonical cache key; with ``keep_existing`` a non-empty ``cache_key`` wins."""
    k = cache_key(F.col("query_type"), F.col("zone_id"), F.col("zone_id_b"),
                  F.col("confidence_min"), F.col("bins"))
    if keep_existing and "cache_key" in df.columns:
        k = F.coalesce(F.nullif(F.col("cache_key"), F.lit("")), k)
    return df.withColumn("cache_key", k)


# ------------------------------------------------------------- P9

def loaded_zones(buildings: DataFrame) -> DataFrame:
    """Zones that have buildings (only these answer; others are 'not found').
    Accepts the buildings or their reduced form."""
    return buildings.select("zone_id").distinct()


def zone_ids(buildings: DataFrame) -> DataFrame:
    """The loaded zones as a written table, for all validations of a job."""
    return scratch_table(loaded_zones(buildings), "loaded-zones")


def validate_requests(req: DataFrame, loaded: DataFrame) -> DataFrame:
    """``error_status`` and ``error_reason`` (null = valid), first failing rule wins:
    missing fields 422, unknown zone 404, Q4 without zone_id_b 400, unknown type 400,
    Q4 with an unknown zone_id_b 500, Q5 with bins < 1 or above ``MAX_BINS`` 500.

    ``loaded`` is joined as it is. Pass a written table (``zone_ids``): its size is known
    when the joins are planned, so Spark broadcasts it below its threshold and splits hot
    zones beyond it.
    """
    ids = loaded.select("zone_id").distinct()
    z = ids.select(F.col("zone_id").alias("_zk"))
    zb = ids.select(F.col("zone_id").alias("_zbk"))
    j = (req.join(z, req.zone_id == z._zk, "left")
         .join(zb, req.zone_id_b == zb._zbk, "left"))
    qt, zone_b = F.col("query_type"), F.col("zone_id_b")
    rules = [
        (F.col("zone_id").isNull() | qt.isNull(), 422, "invalid_request"),
        (F.col("_zk").isNull(), 404, "zone_not_found"),
        ((qt == "Q4") & (zone_b.isNull() | (zone_b == "")), 400, "missing_zone_b"),
        (~qt.isin(*QUERY_TYPES), 400, "unknown_query_type"),
        ((qt == "Q4") & F.col("_zbk").isNull(), 500, "zone_b_not_found"),
        ((qt == "Q5") & (F.col("bins").isNull() | (F.col("bins") < 1) | (F.col("bins") > MAX_BINS)),
         500, "invalid_bins"),
    ]
    status = reason = None
    for cond, code, text in rules:
        status = F.when(cond, F.lit(code)) if status is None else status.when(cond, F.lit(code))
        reason = F.when(cond, F.lit(text)) if reason is None else reason.when(cond, F.lit(text))
    return j.withColumns({"error_status": status, "error_reason": reason}).drop("_zk", "_zbk")


# ------------------------------------------------------------- J3

def answer_requests(req: DataFrame, buildings: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Answer every valid request (Q1-Q5) in one plan.

    The buildings are reduced once to (zone, confidence) counts and the requests once
    to their distinct parameter tuples (equal exchanges are reused inside the plan).
    One table holds the answer of every tuple, and the requests meet it in a single join
    on their parameters (broadcast when Spark's size check allows, split by AQE at hot
    parameters beyond it); the answer columns of other query types are null. Requests that
    carry ``error_reason`` have been validated (P9) and are not validated again.
    """
    reduced = bld.reduce_by_confidence(buildings)
    checked = req if "error_reason" in req.columns else validate_requests(req, zone_ids(reduced))
    valid = checked.where(F.col("error_reason").isNull())
    params = valid.select("query_type", "zone_id", "zone_id_b", "confidence_min", "bins") \
        .distinct()
    qt = F.col("query_type")
    pair_params = params.where(qt == "Q4").select("zone_id", "zone_id_b", "confidence_min").distinct()
    conf_params = params.where(qt.isin("Q1", "Q2", "Q3", "Q4")).select("zone_id", "confidence_min") \
        .unionByName(pair_params.select(F.col("zone_id_b").alias("zone_id"), "confidence_min"))
    hist_params = params.where(qt == "Q5").select("zone_id", "bins")

    stats = bld.zone_answers(reduced, conf_params, zones)
    pairs = bld.compare_pairs(pair_params, stats).select(
        F.col("zone_a").alias("zone_id"), F.col("zone_b").alias("zone_id_b"), "confidence_min",
        "density_a", "density_b", "winner")
    hists = bld.q5_nested(bld.q5_histogram(reduced, hist_params))

    # one row per parameter tuple with its answer; the requests meet it in a single join
    names = ["query_type", "zone_id", "zone_id_b", "confidence_min", "bins"]
    answers = (params.join(stats, ["zone_id", "confidence_min"], "left")
               .join(pairs, ["zone_id", "zone_id_b", "confidence_min"], "left")
               .join(hists, ["zone_id", "bins"], "left"))
    keyed = answers.select(*[F.col(c).alias(f"_{c}") for c in names],
                           *[c for c in answers.columns if c not in names])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    out = valid.join(keyed, same, "left")
    is_ = lambda *t: qt.isin(*t)
    return out.select(
        *[c for c in req.columns],
        F.when(is_("Q1"), F.col("n")).alias("count"),
        F.when(is_("Q2"), F.col("avg_area")).alias("avg_area"),
        F.when(is_("Q2"), F.col("total_area")).alias("total_area"),
        F.when(is_("Q2"), F.col("n")).alias("n"),
        F.when(is_("Q3"), F.col("density_per_km2")).alias("density_per_km2"),
        F.when(is_("Q3"), F.col("area_km2")).alias("area_km2"),
        F.when(is_("Q4"), F.col("density_a")).alias("density_a"),
        F.when(is_("Q4"), F.col("density_b")).alias("density_b"),
        F.when(is_("Q4"), F.col("winner")).alias("winner"),
        F.when(is_("Q5"), F.col("buckets")).alias("buckets"))


# ------------------------------------------------------------- T4 (batch)

def fold_run(t: np.ndarray, ok: np.ndarray, expiry: float, ttl: float) -> tuple[np.ndarray, float]:
    """Cache decisions for one key's requests sorted by (t, seq), starting from
    ``expiry``; returns (cached flags, final expiry).

    From the current expiry a binary search finds the next valid request at or after it
    (the next miss that fills the cache); every row before it is a hit iff it is earlier
    than the expiry. Python steps once per cache fill, not once per request.
    """
    m = len(t)
    cached = np.zeros(m, dtype=bool)
    valid_at = np.flatnonzero(ok)
    pos = 0
    while pos < m:
        first_late = max(pos, int(np.searchsorted(t, expiry, "left")))
        k = int(np.searchsorted(valid_at, first_late, "left"))
        fill = int(valid_at[k]) if k < len(valid_at) else m
        cached[pos:fill] = t[pos:fill] < expiry
        if fill >= m:
            break
        expiry, pos = float(t[fill]) + ttl, fill + 1
    return cached, expiry


def _fold_sorted(ttl: float):
    """Fold rows sorted by (_key, _segment, _t, _seq), batch by batch; the cache state is
    reset at every new (key, segment) and carried across batch boundaries. Memory is
    one Arrow batch. All columns are passed on, ``cached`` is added."""
    def run(batches):
        carry_group, carry_expiry = None, float("-inf")
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            keys, segs, ts, ok = (column(c) for c in ("_key", "_segment", "_t", "_valid"))
            cached = np.zeros(n, dtype=bool)
            new_run = np.ones(n, dtype=bool)
            new_run[1:] = (keys[1:] != keys[:-1]) | (segs[1:] != segs[:-1])
            starts = np.flatnonzero(new_run)
            for s, e in zip(starts, np.append(starts[1:], n)):
                group = (keys[s], segs[s])
                expiry = carry_expiry if group == carry_group else float("-inf")
                cached[s:e], expiry = fold_run(ts[s:e], ok[s:e].astype(bool), expiry, ttl)
                carry_group, carry_expiry = group, expiry
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cached)], [*batch.schema.names, "cached"])
    return run


def ttl_replay(req: DataFrame, ttl: float, time_col: str = "t_start", order_col: str = "seq",
               valid_col: str = "valid", segment_limit: int = 5_000_000) -> DataFrame:
    """T4: ``req`` plus ``cached``: each request of a log as cache hit or miss under a TTL.

    Per cache key in (time, order) order: a request is a hit iff its time is before the
    current expiry; a miss of a valid request sets expiry = time + ttl; hits do not
    extend it and failed requests never populate. A row without key or time takes no
    part and is a miss. Rows keep all their columns, so an order value may repeat.

    Keys are independent, and inside a key the log splits into segments that cannot
    influence each other: time is cut into blocks of length ``ttl``; a block whose
    previous block holds no valid request starts with an empty cache (any expiry set
    earlier has passed), so its first valid request is a certain miss. Segment ids come
    from a window over one summary row per non-empty (key, block).

    Segments of at most ``segment_limit`` rows are hashed across tasks, sorted inside
    each task and folded in one streaming pass. Larger segments (a hot key with
    uninterrupted traffic) are labelled in parallel by pointer doubling over the
    "next miss" function (``ttl_parallel``), so no task ever holds such a segment.
    """
    ttl = float(ttl)
    key, t = F.col("cache_key"), F.col(time_col).cast("double")
    apart = key.isNull() | t.isNull() | F.isnan(t)
    live = F.coalesce(~apart, F.lit(False))
    ev = req.withColumns({
        "_key": F.when(live, key), "_seq": F.col(order_col).cast("long"), "_t": F.when(live, t),
        "_valid": live & F.coalesce(F.col(valid_col), F.lit(False)),
        "_block": F.when(live, F.floor(t / F.lit(ttl)).cast("long"))})
    blocks = ev.where(F.col("_block").isNotNull()).groupBy("_key", "_block").agg(F.max(F.col("_valid").cast("int")).alias("has_valid"),
                                              F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy("_key").orderBy("_block")
    prev_block = F.lag("_block").over(w)
    prev_valid = F.lag("has_valid").over(w)
    starts = blocks.withColumn("is_start", prev_block.isNull() | (prev_block != F.col("_block") - 1)
                               | (prev_valid == 0))
    # one row per non-empty (key, block): small, written once for the size check and the plan
    seg = starts.withColumn("_segment", F.max(F.when(F.col("is_start"), F.col("_block"))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    seg = scratch_table(seg.select("_key", "_block", "_segment", "rows"), "ttl-segments")
    # rows that take no part have no segment; they are spread by a hash and come out as misses
    tagged = ev.join(seg.select("_key", "_block", "_segment"), ["_key", "_block"], "left").withColumn(
        "_segment", F.coalesce("_segment", F.xxhash64("_seq", time_col)))
    big = (seg.groupBy("_key", "_segment").agg(F.sum("rows").alias("rows"))
           .where(F.col("rows") > segment_limit).select("_key", "_segment"))
    out = [*req.columns, "cached"]
    if big.isEmpty():
        return _fold(tagged, ttl).select(*out)
    from zonepulse.operators.ttl_parallel import replay_by_doubling
    small = tagged.join(big, ["_key", "_segment"], "left_anti")
    # a written table gives every row of the large segments a stable id of its own
    large = scratch_table(tagged.join(big, ["_key", "_segment"], "left_semi")
                          .withColumn("_id", F.monotonically_increasing_id()), "ttl-large")
    labels = replay_by_doubling(large.select(
        F.col("_key").alias("key"), F.col("_segment").alias("segment"), F.col("_seq").alias("seq"),
        F.col("_t").alias("t"), F.col("_valid").alias("valid"), F.col("_id").alias("id")), ttl)
    labelled = large.join(labels.withColumnRenamed("id", "_id"), "_id")
    return _fold(small, ttl).select(*out).unionByName(labelled.select(*out))


def _fold(tagged: DataFrame, ttl: float) -> DataFrame:
    rows = tagged.repartition("_key", "_segment").sortWithinPartitions("_key", "_segment", "_t", "_seq")
    return rows.mapInArrow(_fold_sorted(ttl), T.StructType(
        [*rows.schema.fields, T.StructField("cached", T.BooleanType())]))


# ------------------------------------------------------------- T5 - T7

def route_failures(attempts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """T5: where each attempt goes: 'answer' (cached or answered), else the attempt
    failed, ``retries`` grows by one and it goes to 'retry' while retries <= max, then
    'dlq'. Needs ``cached`` (T4), ``error_reason`` (P9) and incoming ``retries``."""
    failed = ~F.col("cached") & F.col("error_reason").isNotNull()
    new_r = F.col("retries") + 1
    return attempts.withColumns({
        "route": F.when(~failed, F.lit("answer")).when(new_r <= max_retries, F.lit("retry"))
                  .otherwise(F.lit("dlq")),
        "retries": F.when(failed, new_r).otherwise(F.col("retries")),
    })


def attempt_events(attempts: DataFrame, max_retries: int = MAX_RETRIES,
                   completed: Column | None = None) -> DataFrame:
    """Telemetry events of one attempt, in emission order (``event_index``):
    cached -> hit; answered -> recovery if retries > 0 else miss; failed -> miss only on
    the first failure, then retry (while new retries <= max) or dlq.

    ``completed`` (epoch seconds: a recorded column, or the clock of a live job) adds the
    ``timestamp`` of the events and ``latency_ms`` since ``t_start``; retry and dlq
    events have latency 0."""
    cached, failed = F.col("cached"), ~F.col("cached") & F.col("error_reason").isNotNull()
    r = F.col("retries")
    new_r = r + 1
    first = (F.when(cached, F.lit("hit"))
             .when(~failed, F.when(r > 0, F.lit("recovery")).otherwise(F.lit("miss")))
             .when(new_r == 1, F.lit("miss")))
    second = F.when(failed, F.when(new_r <= max_retries, F.lit("retry")).otherwise(F.lit("dlq")))
    events = F.filter(F.array(first, second), lambda x: x.isNotNull())
    keep = [c for c in attempts.columns if c not in ("event_type",)]
    out = attempts.select(*keep, F.posexplode(events).alias("event_index", "event_type"))
    if completed is None:
        return out
    out = out.withColumn("timestamp", completed.cast("double"))
    return out.withColumn("latency_ms", F.when(F.col("event_type").isin("retry", "dlq"), F.lit(0.0)).otherwise(
        (F.col("timestamp") - F.col("t_start")) * F.lit(1000.0)))


def expand_failures(attempts: DataFrame, id_col: str = "id", max_retries: int = MAX_RETRIES) -> DataFrame:
    """The life of every request with a failed attempt, from its attempts in the log.

    One row per id: the attempts seen, the least and greatest retry count, the events they
    emitted by type (T6), how the life ends (``dead``: a dlq event; ``recovered``: answered
    or hit at its greatest retry count; else ``open``) and whether the log holds the whole
    of it (``complete``: every retry count from 0 to the last). Only counts and bits are
    kept per id, so an id with any number of attempts is added up before the shuffle.
    Attempts without an id are no request's and are left out.
    """
    events = attempt_events(attempts, max_retries)
    tried = F.least(F.greatest(F.col("retries"), F.lit(0)), F.lit(62))
    of = lambda kind: F.count_if(F.col("event_type") == kind)
    ended = F.struct("retries", (F.col("cached") | F.col("error_reason").isNull()).alias("well"))
    lives = events.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.count_if(F.col("event_index") == 0).alias("attempts"), F.min("retries").alias("first_try"), F.max("retries").alias("last_try"),
        of("hit").alias("hits"), of("miss").alias("misses"), of("recovery").alias("recoveries"), of("retry").alias("retries"),
        of("dlq").alias("dlqs"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), tried)).alias("_tries"),
        F.max(ended).alias("_end"))
    outcome = F.when(F.col("dlqs") > 0, "dead").when(F.col("_end.well"), "recovered").otherwise("open")
    whole = F.col("_tries") == F.call_function("shiftleft", F.lit(1).cast("long"), F.col("last_try") + 1) - 1
    return lives.where((F.col("retries") > 0) | (F.col("dlqs") > 0)).withColumns({"outcome": outcome, "complete": whole}).drop("_tries", "_end")


# ------------------------------------------------------------- G1, G2

# Zones, query type weights, confidence levels and bin choices of the traffic.
ZONES = ["Z1", "Z2", "Z3", "Z4", "Z5"]
QUERY_WEIGHTS = [0.40, 0.20, 0.20, 0.10, 0.10]
CONFIDENCE_LEVELS = [0.0, 0.5, 0.7]
BIN_CHOICES = [5, 10]

_LCG_A, _LCG_C, _LCG_M = 1103515245, 12345, 2 ** 31


def zipf_weights(n: int, alpha: float) -> list[float]:
    """G1: 1 / rank^alpha normalised over ranks 1..n."""
    raw = [1.0 / (r ** alpha) for r in range(1, n + 1)]
    total = sum(raw)
    return [w / total for w in raw]


def uniform01(ids: Column, stream: int, seed: int) -> Column:
    """Deterministic uniform [0, 1) per (id, stream): two steps of a 31-bit LCG.
    Depends only on the row id, so it is stable under any repartitioning or retry."""
    x = (ids * 8 + stream + seed) % _LCG_M
    for _ in range(2):
        x = (x * _LCG_A + _LCG_C) % _LCG_M
    return x.cast("double") / F.lit(float(_LCG_M))


def _pick(u: Column, cum: Sequence[float], values: Sequence) -> Column:
    """First value whose cumulative weight exceeds u * total (weighted choice)."""
    total = cum[-1]
    x = u * F.lit(total)
    expr = None
    for c, v in zip(cum[:-1], values[:-1]):
        expr = F.when(x < F.lit(c), F.lit(v)) if expr is None else expr.when(x < F.lit(c), F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


def traffic_fit(req: DataFrame) -> DataFrame:
    """G1 against a request log: per zone its requests, rank and share, and the shares that
    Zipf weights of the fitted exponent and uniform weights would give it.

    The exponent is that of the least-squares line through (ln rank, ln requests); with one
    zone it is 0. Windows run over one row per zone. Requests without a zone are left out.
    """
    n, everything = F.col("requests"), Window.partitionBy()
    zones = req.where(F.col("zone_id").isNotNull()).groupBy("zone_id").agg(F.count("*").alias("requests"))
    ranked = zones.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("requests"), "zone_id")))
    x, y = F.ln(F.col("rank").cast("double")), F.ln(n.cast("double"))
    fitted = ranked.withColumn("alpha", F.coalesce(-F.regr_slope(y, x).over(everything), F.lit(0.0)))
    weight = F.pow(F.col("rank").cast("double"), -F.col("alpha"))
    return fitted.select("zone_id", "requests", "rank", F.round("alpha", 6).alias("alpha"),
                         F.round(n / F.sum(n).over(everything), 9).alias("share"),
                         F.round(weight / F.sum(weight).over(everything), 9).alias("zipf_share"),
                         F.round(F.lit(1.0) / F.count("*").over(everything), 9).alias("uniform_share"))


def observed_weights(req: DataFrame) -> dict[str, list[float]]:
    """How often a request log names each zone and each query type of the traffic: one row of
    counts, as long as those two lists."""
    counts = {c: [F.count_if(F.col(c) == v).cast("double") for v in values]
              for c, values in (("zone_id", ZONES), ("query_type", QUERY_TYPES))}
    row = req.select(*[F.array(*[n for n in ns]).alias(c) for c, ns in counts.items()]).first()
    return row.asDict()


def sample_requests(ids: DataFrame, distribution: str = "zipf", alpha: float = 1.5,
                    seed: int = 42, id_col: str = "seq", observed: dict[str, list[float]] | None = None) -> DataFrame:
    """One synthetic request per input row (zone by Zipf or uniform weights, query
    type by fixed weights, uniform confidence and bins, a different zone for Q4).
    ``observed`` (from ``observed_weights``) takes both from a request log instead."""
    zw = zipf_weights(len(ZONES), alpha) if distribution == "zipf" else [0.2] * 5
    zw, qw = (observed["zone_id"], observed["query_type"]) if observed else (zw, QUERY_WEIGHTS)
    i = F.col(id_col).cast("long")
    zone = _pick(uniform01(i, 0, seed), list(accumulate(zw)), ZONES)
    qtype = _pick(uniform01(i, 1, seed), list(accumulate(qw)), QUERY_TYPES)
    conf_i = F.floor(uniform01(i, 2, seed) * len(CONFIDENCE_LEVELS)).cast("int")
    bins_i = F.floor(uniform01(i, 3, seed) * len(BIN_CHOICES)).cast("int")
    other_i = F.floor(uniform01(i, 4, seed) * (len(ZONES) - 1)).cast("int")
    out = ids.select(F.col(id_col).alias("seq"), zone.alias("zone_id"), qtype.alias("query_type"),
                     F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE_LEVELS]), conf_i + 1)
                     .alias("confidence_min"),
                     F.element_at(F.array(*[F.lit(b) for b in BIN_CHOICES]), bins_i + 1).alias("bins"),
                     other_i.alias("_other"))
    others = F.filter(F.array(*[F.lit(z) for z in ZONES]), lambda z: z != F.col("zone_id"))
    return out.select("seq", "zone_id", "query_type", "confidence_min", "bins",
                      F.when(F.col("query_type") == "Q4", F.element_at(others, F.col("_other") + 1))
                      .alias("zone_id_b"))
