"""Unit and property tests on literal rows for the semantic traps."""

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.functions import cache_key, hist_bin
from zonepulse.operators import buildings as bld
from zonepulse.operators import experiments as exq
from zonepulse.operators import lag as lg
from zonepulse.operators import requests as rq
from zonepulse.operators import telemetry as tel
from zonepulse.operators.selection import nearest_rank_low, select_ranks
from zonepulse.sources import requests_io as rio
from zonepulse.sources import telemetry_io as tio
from zonepulse.sources.zones import zones


# ------------------------------------------------------------ histogram rule

@pytest.mark.parametrize("bins", [5, 10, 7, 30])
def test_hist_bins_equal_numpy_on_grid(spark, bins):
    xs = [k / 1000 for k in range(1001)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", hist_bin(F.col("x"), F.lit(0.0), F.lit(1.0), F.lit(bins)).alias("b")) \
        .orderBy("x").collect()
    counts, _ = np.histogram(xs, bins=bins, range=(0, 1))
    mine = np.bincount([r.b for r in got], minlength=bins)
    assert mine.tolist() == counts.tolist()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(min_value=-1e3, max_value=1e3, allow_nan=False), min_size=2, max_size=40))
def test_latency_histogram_matches_numpy(spark, xs):
    rows = [(float(i), "hit", "Q1", "Z1", "k", float(x)) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "timestamp double, event_type string, query_type string, "
                                     "zone_id string, cache_key string, latency_ms double")
    h = tel.latency_histogram(df, bins=30).where("event_type = 'hit'").orderBy("bin").collect()
    lo, hi = min(xs), max(xs)
    rng = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    counts, _ = np.histogram(xs, bins=30, range=rng)
    assert [r["count"] for r in h] == counts.tolist()


# ------------------------------------------------------------ exact ranks

@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=300),
       st.sampled_from([50, 90, 95, 99]))
def test_nearest_rank_vs_sorted_list(spark, xs, p):
    df = spark.createDataFrame([(float(x) / 4,) for x in xs], "v double")
    # a coarse sketch without slack makes brackets miss
    out = select_ranks(df, "v", {"q": nearest_rank_low(p)}, sketch=8, grid=16, slack=0).collect()[0]
    data = sorted(float(x) / 4 for x in xs)
    assert out["q"] == data[max(0, int(len(data) * p / 100) - 1)]


def test_grouped_ranks_with_rounds(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if i % 3 else "b", float(rng.integers(0, 10_000))) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p50, r.p95) for r in select_ranks(
        df, "v", {"p50": nearest_rank_low(50), "p95": nearest_rank_low(95)}, by=["g"],
        sketch=8, grid=64, slack=0).collect()}
    for g in ("a", "b"):
        d = sorted(v for k, v in rows if k == g)
        assert got[g] == (d[len(d) * 50 // 100 - 1], d[len(d) * 95 // 100 - 1])


def test_ranks_with_infinite_and_huge_values(spark):
    xs = [float("-inf")] * 3 + [-1.7e308, 1.7e308, 5e-324, 0.0] + [float(i) for i in range(60)] + [float("inf")] * 2
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for k in (1, 4, 5, 30, len(xs) - 2, len(xs)):
        got = select_ranks(df, "x", {"r": lambda n, k=k: F.lit(k)}, sketch=8, grid=4, slack=0).first()
        assert (got.n, got.r) == (len(xs), sorted(xs)[k - 1])


def test_ranks_of_null_and_hot_groups(spark):
    """A group of null key, one value that most rows share, nulls and NaN, a rank out of range."""
    rows = [(None, float(i)) for i in range(50)] + [("hot", 7.0)] * 2000 + [("hot", float(i)) for i in range(20)]
    rows += [("hot", None), ("hot", float("nan")), ("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.mid, r.tenth) for r in select_ranks(
        df, "v", {"mid": nearest_rank_low(50), "tenth": lambda n: F.lit(10)}, by=["g"], sketch=8, grid=16, slack=0).collect()}
    hot = sorted([7.0] * 2000 + [float(i) for i in range(20)])
    assert got == {None: (50, 24.0, 9.0), "hot": (2020, hot[1009], hot[9]), "one": (1, 3.0, None)}


def test_percentiles_empty_are_zero(spark):
    df = spark.createDataFrame([(1.0, "retry", "Q1", "Z1", "k", 5.0, 1)],
                               "timestamp double, event_type string, query_type string, zone_id string, "
                               "cache_key string, latency_ms double, seq long")
    r = tel.telemetry_totals(df).collect()[0]
    assert (r.latency_p50_ms, r.latency_p95_ms, r.avg_latency_ms, r.retry_rate) == (0.0, 0.0, 0.0, 0.0)


# ------------------------------------------------------------ zones and questions

def _buildings(spark, rows):
    return spark.createDataFrame(rows, "latitude double, longitude double, area_in_meters double, "
                                       "confidence double, zone_id string")


def test_overlap_goes_to_first_zone(spark):
    pts = spark.createDataFrame([(-33.44, -70.635, 10.0, 0.9), (-33.45, -70.65, 10.0, 0.9),
                                 (-33.0, -70.0, 1.0, 1.0)],
                                "latitude double, longitude double, area_in_meters double, confidence double")
    got = [r.zone_id for r in bld.assign_zone(pts, zones(spark)).orderBy("latitude").collect()]
    assert got == ["Z4", "Z1"]  # the overlap point (-33.44, -70.635) is Z1; outside dropped


def test_bounds_are_inclusive(spark):
    pts = spark.createDataFrame([(-33.445, -70.640, 1.0, 0.5)],
                                "latitude double, longitude double, area_in_meters double, confidence double")
    assert bld.assign_zone(pts).collect()[0].zone_id == "Z1"


def test_q4_tie_goes_to_b_and_empty_zone_answers_zero(spark):
    b = _buildings(spark, [(-33.43, -70.62, 10.0, 0.9, "Z1"), (-33.41, -70.57, 20.0, 0.1, "Z2")])
    pairs = spark.createDataFrame([("Z1", "Z1", 0.5), ("Z2", "Z1", 0.95)],
                                  "zone_id string, zone_id_b string, confidence_min double")
    got = {(r.zone_a, r.zone_b): r.winner for r in bld.q4_compare(b, pairs).collect()}
    assert got == {("Z1", "Z1"): "Z1", ("Z2", "Z1"): "Z1"}
    q2 = bld.q2_area(b, spark.createDataFrame([("Z2", 0.5)], "zone_id string, confidence_min double"))
    assert q2.collect()[0][2:] == (0.0, 0.0, 0)


def test_confidence_threshold_inclusive_and_nan(spark):
    b = _buildings(spark, [(0.0, 0.0, 1.0, 0.5, "Z1"), (0.0, 0.0, 1.0, float("nan"), "Z1"),
                           (0.0, 0.0, 1.0, 0.4999, "Z1")])
    assert bld.filter_confidence(b, 0.5).count() == 1


def test_parse_point_only_without_latitude(spark):
    raw = spark.createDataFrame([("POINT (-70.61 -33.43)", 1.0, 0.5), ("garbage", 1.0, 0.5)],
                                "geometry string, area_in_meters double, confidence double")
    got = bld.parse_point(raw).collect()
    assert (got[0].longitude, got[0].latitude) == (-70.61, -33.43)
    assert got[1].latitude is None


def test_zone_area_of_a_known_box(spark):
    # a box of 2.775 km by 4.44 km at the equator, narrowed at 33.43 degrees
    a = {r.zone_id: r.area_km2 for r in bld.zone_areas(spark).collect()}
    assert a["Z1"] == pytest.approx(10.282607819, rel=1e-9)


# ------------------------------------------------------------ requests

def test_cache_keys(spark):
    df = spark.createDataFrame(
        [("Q1", "Z1", None, 0.5, 5), ("Q4", "Z1", None, 0.0, 5), ("Q5", "Z2", None, 0.7, 10),
         ("Q9", "Z1", None, 0.0, 5)],
        "query_type string, zone_id string, zone_id_b string, confidence_min double, bins int")
    got = [r.k for r in df.select(cache_key(*[F.col(c) for c in df.columns]).alias("k")).collect()]
    import hashlib
    assert got[:3] == ["count:Z1:conf=0.5", "compare:density:Z1:None:conf=0.0", "confidence_dist:Z2:bins=10"]
    assert got[3] == hashlib.md5(b"Q9:Z1:None:0.0:5").hexdigest()


def test_decode_bare_wrapped_and_malformed(spark):
    msgs = [json.dumps({"id": "a", "req": {"zone_id": "Z1", "query_type": "Q1"}, "retries": 2,
                        "t_start": 5.0}),
            json.dumps({"zone_id": "Z2", "query_type": "Q5", "bins": 10}),
            json.dumps({"req": {"zone_id": "Z1", "query_type": "Q2", "confidence_min": 0.7},
                        "cache_key": "kept", "t_start": 0}),
            "not json"]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = rio.decode_requests(df, F.lit(99.0)).collect()
    assert (got[0].retries, got[0].t_start, got[0].cache_key) == (2, 5.0, "count:Z1:conf=0.0")
    assert (got[1].zone_id, got[1].bins, got[1].retries, got[1].t_start) == ("Z2", 10, 0, 99.0)
    assert (got[2].cache_key, got[2].t_start, got[2].confidence_min) == ("kept", 99.0, 0.7)
    assert got[3].zone_id is None


def test_encode_omits_null_zone_b(spark):
    df = spark.createDataFrame([("r1", "Z1", "Q1", 0.0, 5, None, 0, 1.0)],
                               "id string, zone_id string, query_type string, confidence_min double, "
                               "bins int, zone_id_b string, retries int, t_start double")
    v = json.loads(rio.encode_requests(df).collect()[0].value)
    assert "zone_id_b" not in v["req"] and v["retries"] == 0


def _attempts(spark, rows):
    return spark.createDataFrame(rows, "seq long, cached boolean, error_reason string, retries int")


def test_attempt_events_and_routes(spark):
    a = _attempts(spark, [(1, True, None, 2), (2, False, None, 0), (3, False, None, 1),
                          (4, False, "x", 0), (5, False, "x", 1), (6, False, "x", 3)])
    ev = {}
    for r in rq.attempt_events(a).orderBy("seq", "event_index").collect():
        ev.setdefault(r.seq, []).append(r.event_type)
    assert ev == {1: ["hit"], 2: ["miss"], 3: ["recovery"], 4: ["miss", "retry"], 5: ["retry"],
                  6: ["dlq"]}
    routes = {r.seq: (r.route, r.retries) for r in rq.route_failures(a).collect()}
    assert routes[4] == ("retry", 1) and routes[6] == ("dlq", 4) and routes[1] == ("answer", 2)


def test_expand_failures_lifecycle(spark):
    lives = {"a": [(0, False, "x"), (1, False, "x"), (2, False, "x"), (3, False, "x")],      # the whole of a dead life
             "b": [(0, False, "x"), (1, False, None)], "c": [(0, False, "x"), (2, True, None)],  # answered; hit, one attempt lost
             "d": [(1, False, "x")], "e": [(0, False, None)], "f": [(0, True, None)],
             "g": [(0, False, "x")] * 40, None: [(0, False, "x")]}
    rows = [(i, r, cached, why) for i, tries in lives.items() for r, cached, why in tries]
    a = spark.createDataFrame(rows, "id string, retries int, cached boolean, error_reason string")
    got = {r.id: (r.attempts, r.last_try, r.misses, r.retries, r.dlqs, r.outcome, r.complete) for r in rq.expand_failures(a).collect()}
    assert got == {"a": (4, 3, 1, 3, 1, "dead", True), "b": (2, 1, 1, 1, 0, "recovered", True),
                   "c": (2, 2, 1, 1, 0, "recovered", False), "d": (1, 1, 0, 1, 0, "open", False),
                   "g": (40, 0, 40, 40, 0, "open", True)}
    assert rq.expand_failures(a.limit(0)).collect() == []


def test_traffic_fit_finds_the_exponent(spark):
    counts = {f"z{r}": round(1e6 / r ** 1.5) for r in range(1, 8)}
    log = spark.createDataFrame([*counts.items(), (None, 9)], "zone_id string, n long").select(
        "zone_id", F.explode(F.array_repeat(F.lit(1), F.least(F.col("n"), F.lit(10 ** 6)).cast("int"))))
    got = rq.traffic_fit(log).orderBy("rank").collect()
    assert [(r.zone_id, r.requests) for r in got] == list(counts.items())
    assert all(abs(r.alpha - 1.5) < 1e-3 and abs(r.share - r.zipf_share) < 1e-3 for r in got)
    one = rq.traffic_fit(log.where("zone_id = 'z7'")).collect()
    assert [(r.alpha, r.share, r.zipf_share, r.uniform_share) for r in one] == [(0.0, 1.0, 1.0, 1.0)]
    assert rq.traffic_fit(log.limit(0)).collect() == []


def _replay_python(rows, ttl):
    by_key, out = {}, {}
    for key, seq, t, ok in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        exp = by_key.get(key, float("-inf"))
        hit = t < exp
        if not hit and ok:
            by_key[key] = t + ttl
        out[seq] = hit
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 400), st.booleans()),
                min_size=1, max_size=80))
def test_ttl_replay_vs_python(spark, events):
    rows = [(k, i, float(t), ok) for i, (k, t, ok) in enumerate(events)]
    df = spark.createDataFrame(rows, "cache_key string, seq long, t_start double, valid boolean")
    got = {r.seq: r.cached for r in rq.ttl_replay(df, 30.0).collect()}
    assert got == _replay_python(rows, 30.0)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 300), st.booleans()),
                min_size=1, max_size=60))
def test_ttl_replay_doubling_vs_python(spark, events):
    rows = [(k, i, float(t), ok) for i, (k, t, ok) in enumerate(events)]
    df = spark.createDataFrame(rows, "cache_key string, seq long, t_start double, valid boolean")
    # segment_limit 0 sends every segment through the parallel path
    got = {r.seq: r.cached for r in rq.ttl_replay(df, 30.0, segment_limit=0).collect()}
    assert got == _replay_python(rows, 30.0)


def test_ttl_replay_doubling_on_fixture(spark):
    from tests.conftest import SF_SMALL
    from zonepulse.operators.buildings import prepare_buildings
    from zonepulse.plans import request_flow as flow
    from zonepulse.sources import fixtures as fx
    b = prepare_buildings(fx.buildings_raw(spark, SF_SMALL))
    kv = flow.keyed_and_validated(fx.requests(spark, SF_SMALL), b) \
        .withColumn("valid", F.col("error_reason").isNull())
    fold = {r.seq: r.cached for r in rq.ttl_replay(kv, 7200.0).collect()}
    par = {r.seq: r.cached for r in rq.ttl_replay(kv, 7200.0, segment_limit=5).collect()}
    assert fold == par and sum(fold.values()) > 0


def test_zipf_weights():
    w = rq.zipf_weights(5, 1.5)
    assert sum(w) == pytest.approx(1.0) and w == sorted(w, reverse=True)


def test_validation_rules(spark):
    loaded = spark.createDataFrame([("Z1",), ("Z2",)], "zone_id string")
    req = spark.createDataFrame(
        [(1, "Z9", "Q1", None, 5), (2, "Z1", "Q4", "", 5), (3, "Z1", "Q7", None, 5),
         (4, "Z1", "Q4", "Z5", 5), (5, "Z1", "Q5", None, 0), (6, "Z1", "Q4", "Z2", 5)],
        "seq long, zone_id string, query_type string, zone_id_b string, bins int")
    got = {r.seq: (r.error_status, r.error_reason) for r in rq.validate_requests(req, loaded).collect()}
    assert got == {1: (404, "zone_not_found"), 2: (400, "missing_zone_b"),
                   3: (400, "unknown_query_type"), 4: (500, "zone_b_not_found"),
                   5: (500, "invalid_bins"), 6: (None, None)}


# ------------------------------------------------------------ lag

def _episodes_python(rows):
    out, state = [], {}
    for seq, k, t, lag in sorted(rows):
        open_ = state.get(k)
        if lag > 0 and open_ is None:
            state[k] = (seq, t)
        elif lag == 0 and open_ is not None:
            out.append((k, open_[0], seq))
            state[k] = None
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 2)), min_size=1, max_size=120),
       st.sampled_from([1, 3, 7, 1 << 20]))
def test_backlog_episodes_blocks_vs_python(spark, obs, block):
    rows = [(i, k, float(i), lag) for i, (k, lag) in enumerate(obs)]
    df = spark.createDataFrame([(s, k, s, s + 1 + lag, t) for s, k, t, lag in rows],
                               "seq long, consumer_id long, msg_offset long, high_watermark long, "
                               "processed_at double")
    got = sorted((r.consumer_id, r.open_seq, r.close_seq)
                 for r in lg.backlog_episodes(df, block=block).collect())
    assert got == _episodes_python(rows)


# ------------------------------------------------------------ experiments

def test_assign_runs_half_open(spark):
    runs = spark.createDataFrame([(1, 0.0, 100.0), (2, 100.0, 300000.0)],
                                 "run_id int, start_time double, end_time double")
    ev = spark.createDataFrame([(0.0,), (99.9,), (100.0,), (299999.0,), (300000.0,)], "timestamp double")
    got = sorted((r.timestamp, r.run_id) for r in exq.assign_runs(ev, runs).collect())
    assert got == [(0.0, 1), (99.9, 1), (100.0, 2), (299999.0, 2)]


def test_experiment_log_roundtrip(spark, tmp_dir):
    from zonepulse.schemas import EXPERIMENT_LOG
    from zonepulse.sources import experiments_io as xio
    rows = [(1, 0.0, 10.0, "zipf", 1.5, 500, 20.0, 500, 500, 0, 485, 15),
            (2, 10.0, 20.0, "uniform", 1.5, 500, 20.0, 0, 0, 0, 0, 0)]
    xio.append_experiments(spark.createDataFrame(rows, EXPERIMENT_LOG), tmp_dir)
    back = exq.experiment_hit_rate(xio.read_experiments(spark, tmp_dir)).orderBy("experiment_id")
    assert [r.log_hit_rate for r in back.collect()] == [97.0, 0.0]


# ------------------------------------------------------------ telemetry codec

def test_telemetry_decode_malformed_gives_nulls(spark):
    df = spark.createDataFrame([('{"timestamp": 1.5, "event_type": "hit"}',), ("[1,2]",), ("",)],
                               "value string")
    got = tio.decode_telemetry(df).collect()
    assert got[0].timestamp == 1.5 and got[1].timestamp is None and got[2].event_type is None
    assert tel.drop_invalid(tel.with_event_time(tio.decode_telemetry(df))).count() == 1


def test_event_time_truncates(spark):
    df = spark.createDataFrame([(59.999,)], "timestamp double")
    r = tel.with_event_time(df).select(F.unix_seconds("event_time").alias("s")).collect()[0]
    assert r.s == 59


def test_window_rate_divides_by_all_rows(spark):
    rows = [(10.0, "hit", 1.0), (11.0, "miss", 2.0), (12.0, "retry", 0.0), (13.0, None, None)]
    df = spark.createDataFrame(rows, "timestamp double, event_type string, latency_ms double")
    w = tel.sliding_window_report(df).where("window_start = timestamp_ntz'1970-01-01 00:00:10'").collect()[0]
    assert (w.total_requests, w.hit_rate, w.retry_rate) == (2, 0.25, 0.25)


# ------------------------------------------------------------ sources, plans

def test_panes_expand_no_event(spark):
    """Windows from panes: an uneven slide, null times and latencies; events are not expanded."""
    rng = np.random.default_rng(4)
    rows = [(float(rng.integers(0, 400)), str(rng.choice(["hit", "miss", "retry"])),
             None if i % 7 == 0 else float(rng.integers(0, 90))) for i in range(600)]
    rows += [(None, "hit", 1.0), (1000.0, "retry", None)]
    df = tel.with_event_time(spark.createDataFrame(rows, "timestamp double, event_type string, latency_ms double"))
    out = tel.window_metrics(df, "1 minute 30 seconds", "20 seconds")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("kll_sketch_agg_double")       # above the panes, not below
    assert "Expand" not in plan[plan.index("kll_sketch_agg_double"):]
    got = {int(r.window.start.timestamp()): r for r in out.collect()}
    starts = {s for t, _, _ in rows if t is not None for s in range(int(t) // 20 * 20 - 80, int(t) + 1, 20) if s <= t < s + 90}
    assert set(got) == starts
    for s in starts:
        inside = [r for r in rows if r[0] is not None and s <= r[0] < s + 90]
        lat = sorted(x for _, _, x in inside if x is not None)
        r = got[s]
        assert r.total_requests == sum(e in ("hit", "miss") for _, e, _ in inside)
        assert r.retry_rate == sum(e == "retry" for _, e, _ in inside) / len(inside)
        want = [lat[-(-len(lat) * p // 100) - 1] if lat else None for p in (50, 95)]
        assert [r.latency_p50, r.latency_p95] == want


def test_interval_seconds():
    assert [tel.interval_seconds(t) for t in ("10 seconds", "1 minute", "6 hours", "1 day 2 hours")] == [10, 60, 21_600, 93_600]
    with pytest.raises(ValueError):
        tel.interval_seconds("minute")


def test_requests_stream_reads_main_and_retry(spark, tmp_dir):
    import os
    for sub, payload in (("main", {"req": {"zone_id": "Z1", "query_type": "Q1"}, "retries": 0}),
                         ("retry", {"req": {"zone_id": "Z2", "query_type": "Q2"}, "retries": 1})):
        os.makedirs(f"{tmp_dir}/{sub}")
        with open(f"{tmp_dir}/{sub}/a.json", "w") as f:
            f.write(json.dumps(payload) + "\n")
    s = rio.read_requests_stream(spark, "text", (f"{tmp_dir}/main", f"{tmp_dir}/retry"))
    q = (rio.decode_requests(s, F.lit(1.0)).writeStream.format("memory").queryName("req_in")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.topic, r.zone_id, r.retries) for r in spark.sql("select * from req_in").collect())
    assert got == [("consultas_geoespaciales", "Z1", 0), ("consultas_retry", "Z2", 1)]


def test_load_buildings_falls_back_to_csv(spark, tmp_dir):
    from zonepulse.sources import buildings_io as bio
    b = _buildings(spark, [(-33.43, -70.62, 10.0, 0.9, "Z1")])
    b.write.option("header", True).csv(f"{tmp_dir}/csv")
    assert bio.load_buildings(spark, tmp_dir).collect()[0].zone_id == "Z1"
    with pytest.raises(FileNotFoundError):
        bio.load_buildings(spark, f"{tmp_dir}/nothing")


def test_scan_tiles_gzip_with_wkt_only(spark, tmp_dir):
    import gzip
    from zonepulse.sources import buildings_io as bio
    with gzip.open(f"{tmp_dir}/t.csv.gz", "wt") as f:
        f.write("area_in_meters,confidence,geometry,full_plus_code\n")
        f.write('12.5,0.8,"POINT (-70.62 -33.43)",X\n')
        f.write('3.0,0.1,"POINT (-75.0 -30.0)",Y\n')
    got = bld.prepare_buildings(bio.scan_tiles(spark, f"{tmp_dir}/t.csv.gz")).collect()
    assert [(r.zone_id, r.latitude, r.area_in_meters) for r in got] == [("Z1", -33.43, 12.5)]


def test_since_bound_resets_counters(spark):
    rows = [(1.0, "hit", "Q1", "Z1", "k", 5.0, 1), (10.0, "miss", "Q1", "Z1", "k", 7.0, 2)]
    df = spark.createDataFrame(rows, "timestamp double, event_type string, query_type string, "
                                     "zone_id string, cache_key string, latency_ms double, seq long")
    r = tel.telemetry_totals(df, start=5.0).collect()[0]
    assert (r.total_hits, r.total_misses, r.latency_p50_ms) == (0, 1, 7.0)


def test_process_requests_end_to_end(spark):
    from zonepulse.plans.request_flow import process_requests
    b = _buildings(spark, [(-33.43, -70.62, 10.0, 0.9, "Z1"), (-33.41, -70.57, 20.0, 0.6, "Z2")])
    msgs = [(1, {"req": {"zone_id": "Z1", "query_type": "Q1", "confidence_min": 0.5}, "t_start": 100.0}),
            (2, {"req": {"zone_id": "Z1", "query_type": "Q1", "confidence_min": 0.5}, "t_start": 110.0}),
            (3, {"req": {"zone_id": "Z9", "query_type": "Q1"}, "t_start": 120.0}),
            (4, {"zone_id": "Z2", "query_type": "Q5", "bins": 5, "t_start": 130.0})]
    df = spark.createDataFrame([(s, json.dumps(m)) for s, m in msgs], "seq long, value string")
    out = process_requests(df, b, 300.0, F.lit(1000.0))
    ev = sorted((r.seq, r.event_type) for r in out["events"].collect())
    assert ev == [(1, "miss"), (2, "hit"), (3, "miss"), (3, "retry"), (4, "miss")]
    ans = {r.seq: (r["count"], r.buckets is not None) for r in out["answers"].collect()}
    assert ans == {1: (1, False), 4: (None, True)}
    assert {r.seq: r.route for r in out["routed"].collect()}[3] == "retry"


def test_grid_assignment_equals_case_chain(spark):
    from tests.conftest import SF_SMALL
    from zonepulse.sources import fixtures as fx
    pts = bld.project_complete(fx.buildings_raw(spark, SF_SMALL))
    case = sorted(tuple(r) for r in bld.assign_zone(pts).collect())
    grid = sorted(tuple(r) for r in bld.assign_zone_index(pts, zones(spark)).collect())
    assert case == grid and len(case) > 0


def test_large_zone_table_uses_grid(spark):
    # 300 small boxes generated by rule, overlapping in pairs; priority = index
    rows = [(i, f"G{i}", -34.0 + (i // 20) * 0.01, -34.0 + (i // 20) * 0.01 + 0.015,
             -71.0 + (i % 20) * 0.01, -71.0 + (i % 20) * 0.01 + 0.015, -34.0) for i in range(300)]
    zt = spark.createDataFrame(rows, "priority int, zone_id string, lat_min double, lat_max double, "
                                     "lon_min double, lon_max double, ref_lat double")
    pts_rows = [(-34.0 + a * 0.0037, -71.0 + b * 0.0041, 1.0, 0.5) for a in range(45) for b in range(55)]
    pts = spark.createDataFrame(pts_rows, "latitude double, longitude double, area_in_meters double, "
                                          "confidence double")
    got = {(r.latitude, r.longitude): r.zone_id for r in bld.assign_zone(pts, zt).collect()}
    want = {}
    for la, lo, _, _ in pts_rows:
        for p, zid, a, b, c, d, _ in rows:
            if a <= la <= b and c <= lo <= d:
                want[(la, lo)] = zid
                break
    assert got == want


# Total hits, total misses and the hit rate (percent, 2 decimals) of the
# eleven recorded experiment runs.
RECORDED_RUNS = [
    (485, 15, 97.0), (451, 49, 90.2), (477, 23, 95.4), (485, 15, 97.0), (485, 15, 97.0),
    (463, 37, 92.6), (474, 26, 94.8), (479, 21, 95.8), (873, 57, 93.87), (762, 115, 86.89),
    (724, 145, 83.31),
]


def test_float_text_like_python(spark):
    from zonepulse.functions.expressions import float_text
    xs = [0.0, -0.0, 0.5, 0.7, 0.0005, 1e-05, 1.5e-5, 123456789.0, 1e7, 12345678.25, 1e15, 1e16, 1.25e16, 1.5e300, -2e-7,
          0.001, 0.0001, 1e22, float("nan"), float("inf"), -float("inf"), 9007199254740993.0, 0.1 + 0.2, 1.234e-4]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", float_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.x) for r in rows]


def test_bad_epochs_are_no_event_time(spark):
    df = spark.createDataFrame([(1.7e15,), (1e300,), (float("nan"),), (None,), (-5.9,)], "timestamp double")
    got = [r.event_time for r in tel.with_event_time(df).collect()]
    assert got[:4] == [None] * 4 and got[4] is not None


def test_histogram_without_nan(spark):
    rows = [("hit", 1.0), ("hit", 3.0), ("hit", float("nan")), ("miss", float("nan"))]
    got = tel.latency_histogram(spark.createDataFrame(rows, "event_type string, latency_ms double"), 2).collect()
    assert sorted((r.event_type, r.bin_min, r["count"]) for r in got) == [("hit", 1.0, 1), ("hit", 2.0, 1)]


def test_custom_zone_outside_the_built_in_box(spark):
    zt = spark.createDataFrame([(1, "Far", "far", 10.0, 11.0, 20.0, 21.0, 10.5)], zones(spark).schema)
    raw = spark.createDataFrame([(10.5, 20.5, 3.0, 0.9), (-33.43, -70.62, 3.0, 0.9)],
                                "latitude double, longitude double, area_in_meters double, confidence double")
    assert [r.zone_id for r in bld.prepare_buildings(raw, zt).collect()] == ["Far"]


def test_tiles_of_different_headers_and_broken_copies(spark, tmp_dir):
    from zonepulse.sources import buildings_io as bio
    for name, text in (("a", "latitude,longitude,area_in_meters,confidence\n-33.43,-70.62,1.5,0.9\n"),
                       ("b", "confidence,area_in_meters,longitude,latitude\n0.8,20.0,-70.62,-33.43\n"),
                       ("c", 'geometry,confidence,area_in_meters\n"POINT (-70.62 -33.43)",0.7,oops\n'), ("d", "")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)
    got = sorted((r.latitude, r.longitude, r.area_in_meters, r.confidence) for r in bio.scan_tiles(spark, f"{tmp_dir}/*.csv").collect()
                 if r.area_in_meters is not None)
    assert got == [(-33.43, -70.62, 1.5, 0.9), (-33.43, -70.62, 20.0, 0.8)]
    assert bio.scan_tiles(spark, f"{tmp_dir}/c.csv").collect()[0].latitude == -33.43
    # a Parquet copy that cannot be read is an error, not a reason to take the CSV copy
    b = _buildings(spark, [(-33.43, -70.62, 10.0, 0.9, "Z1")])
    b.write.option("header", True).csv(f"{tmp_dir}/t/csv")
    b.drop("confidence").write.parquet(f"{tmp_dir}/t/parquet")
    with pytest.raises(Exception, match="confidence"):
        bio.load_buildings(spark, f"{tmp_dir}/t").collect()


def test_messages_that_are_no_request(spark):
    rows = ["not json", "[1]", "5", "null", '{"req": null}', '{"req": 5}', "", None, '{"req": {"zone_id": "Z1"}}', '{"bins": "abc"}']
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    assert [r.ok for r in df.select(rio.decodable(F.col("value")).alias("ok")).collect()] == [False] * 8 + [True] * 2


@pytest.mark.parametrize("limit", [5_000_000, 0])
def test_ttl_replay_keeps_rows(spark, limit):
    rows = [("a", 1, 0.0, True, "x"), ("a", 1, 10.0, True, "y"), ("a", 1, 10.0, True, "y"), (None, 2, 5.0, True, "z"),
            ("a", 3, None, True, "n"), ("a", 3, 40.0, True, "m")]
    df = spark.createDataFrame(rows, "cache_key string, seq long, t_start double, valid boolean, tag string")
    got = sorted((r.tag, r.cached) for r in rq.ttl_replay(df, 30.0, segment_limit=limit).collect())
    assert got == [("m", False), ("n", False), ("x", False), ("y", True), ("y", True), ("z", False)]


def test_queries_run_from_another_folder(tmp_dir):
    """Workers import the package although neither the folder nor PYTHONPATH leads to it."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; sys.path.remove({root!r})\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.sql.session.timeZone', 'UTC')"
            ".config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', {tmp!r})"
            ".config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
            "print('TOPIC', e.queries()['telemetry_topic'](s, '/root/testdata/sf0.001').count())\n"
            "print('ROWS', e.queries()['ttl_replay'](s, '/root/testdata/sf0.001').count()); s.stop()").format(root=root, tmp=tmp_dir)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000" in out.stdout and "TOPIC 70" in out.stdout, out.stderr


def test_recorded_hit_rates_reproduced(spark):
    from zonepulse.functions import pct
    df = spark.createDataFrame(RECORDED_RUNS, "h long, m long, rate double")
    got = [(r.rate, r.mine) for r in df.select(
        "rate", pct(F.col("h"), F.col("h") + F.col("m")).alias("mine")).collect()]
    assert all(a == b for a, b in got)


def test_ttl_fold_carries_state_across_arrow_batches(spark):
    rng = np.random.default_rng(7)
    rows = [(["a", "b"][i % 2], i, float(rng.integers(0, 2000)), bool(rng.integers(0, 4)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "cache_key string, seq long, t_start double, valid boolean")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")  # every segment spans many batches
    try:
        got = {r.seq: r.cached for r in rq.ttl_replay(df, 120.0).collect()}
    finally:
        spark.conf.set(key, old)
    assert got == _replay_python(rows, 120.0)


def test_scratch_under_checkpoint_dir_and_cluster_sizing(spark):
    from zonepulse.session import cluster_conf, scratch_path
    root = spark.sparkContext.getCheckpointDir()
    assert root and scratch_path(spark, "x").startswith(root.rstrip("/"))
    conf = cluster_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(cluster_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 192


def test_threshold_stats_by_suffix_sums(spark):
    """10^6 confidences against 10^4 thresholds, no join of one with the other."""
    n, m = 1_000_000, 10_000
    b = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("A")).otherwise(F.lit("B")).alias("zone_id"),
                              ((F.col("id") * 7919 % n) / F.lit(float(n))).alias("confidence"), F.lit(1).cast("long").alias("_n"),
                              F.lit(2.5).cast(bld.AREA).alias("_area"))
    p = spark.range(m).select(F.when(F.col("id") % 2 == 0, F.lit("A")).otherwise(F.lit("C")).alias("zone_id"),
                              (F.col("id") / F.lit(float(m))).alias("confidence_min"))
    out = bld.threshold_stats(b, p)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    values = np.sort(np.array([(i * 7919 % n) / n for i in range(0, n, 3)]))
    got = {(r.zone_id, r.confidence_min): (r["count"], r.total_area) for r in out.collect()}
    assert len(got) == m
    for i in range(m):
        want = len(values) - int(np.searchsorted(values, i / m, "left")) if i % 2 == 0 else 0
        assert got["A" if i % 2 == 0 else "C", i / m] == (want, want * 2.5 if want else None)


def test_threshold_stats_odd_values(spark):
    rows = [("A", c, 1, 1.0) for c in (-5.0, -0.0, 0.0, 0.25, 0.25000001, 1.0, 7.0, float("inf"))] + [(None, 0.5, 1, 1.0)]
    b = spark.createDataFrame(rows, "zone_id string, confidence double, _n long, _area double").withColumn("_area", F.col("_area").cast(bld.AREA))
    asked = [-9.0, -5.0, -0.0, 0.0, 0.25, 0.250000005, 1.0, 1.5, 8.0, float("inf"), float("nan"), None]
    p = spark.createDataFrame([("A", c) for c in asked] + [(None, 0.0), ("Z", 0.5)], "zone_id string, confidence_min double")
    got = sorted(((str(r.zone_id), str(r.confidence_min)), r["count"]) for r in bld.threshold_stats(b, p).collect())
    want = {("A", str(c)): sum(v >= c for z, v, *_ in rows if z) if c is not None else 0 for c in asked if str(c) != "-0.0"}
    want |= {("None", "0.0"): 0, ("Z", "0.5"): 0}
    assert dict(got) | {("A", "-0.0"): 0} == want | {("A", "-0.0"): 0}


def test_zone_index_against_boxes(spark):
    """Boxes from a point to a country, overlapping, crossed and null ones: at most four intervals a zone."""
    rng = np.random.default_rng(5)
    boxes = []
    for i in range(300):
        side = float(10.0 ** rng.uniform(-5, 1.5))
        a, c = float(rng.uniform(-60, 30)), float(rng.uniform(-150, 100))
        boxes.append((i + 1, f"z{i}", a, a + side * float(rng.uniform(0, 1)), c, c + side))
    boxes += [(900, "country", -56.0, -17.0, -76.0, -66.0), (901, "point", -33.45, -33.45, -70.65, -70.65),
              (902, "crossed", 5.0, -5.0, 0.0, 1.0), (903, "null", None, 1.0, 0.0, 1.0), (950, "world", -90.0, 90.0, -180.0, 180.0)]
    schema = "priority int, zone_id string, lat_min double, lat_max double, lon_min double, lon_max double"
    z = spark.createDataFrame(boxes, schema)
    assert bld.zone_intervals(z).groupBy("zone_id").count().agg(F.max("count")).first()[0] <= 4
    pts = [(float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180)), i) for i in range(1500)]
    for _, _, a, b, c, d in boxes[:303]:
        if a is not None and a <= b:
            pts += [(a, c, 1), (b, d, 2), ((a + b) / 2, (c + d) / 2, 3)]
    pts += [(None, 1.0, 0), (-33.45, -70.65, 0), (500.0, 0.0, 0)]
    df = spark.createDataFrame(pts, "latitude double, longitude double, k int")
    want = sorted((la, lo, k, next(n for _, n, a, b, c, d in boxes if a is not None and a <= la <= b and c <= lo <= d))
                  for la, lo, k in pts if la is not None and la <= 90)
    out = bld.assign_zone_index(df, z)
    assert sorted(tuple(r) for r in out.collect()) == want
    assert bld.assign_zone_index(df, z.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_messages_are_parsed_once(spark):
    """The check of a message parses it once, and the replay of a batch reads decoded requests."""
    from zonepulse.plans.request_flow import process_requests
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    row = '{"id": "a", "req": {"zone_id": "Z1", "query_type": "Q1"}, "t_start": 5.0}'
    df = spark.createDataFrame([(0, row), (1, '{"req": 5}'), (2, '{"req": null}'), (3, None), (4, ' [1]'), (5, ' {"zone_id": "Z1"}')], "seq bigint, value string")
    asked = df.where(rio.decodable(F.col("value")))
    assert [r.seq for r in asked.orderBy("seq").collect()] == [0, 5]
    assert plan(asked).count("parseJson") == 1
    b = spark.createDataFrame([("Z1", 10.0, 0.9)], "zone_id string, area_in_meters double, confidence double")
    out = process_requests(df, b, 300.0, F.lit(9.0))
    assert "from_json" not in plan(out["events"]) and "parseJson" not in plan(out["events"])
    assert sorted((r.seq, r.event_type) for r in out["events"].collect()) == [(0, "miss"), (5, "miss"), (5, "retry")]
    assert out["rejects"].count() == 4


def test_request_log_is_dealt_out(spark, tmp_dir):
    """A log that one task reads is encoded by many."""
    from zonepulse.plans import catalog
    rows = spark.range(50).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id")
    rows.union(rows.where("event_id < 3")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    log = catalog._request_log(spark, tmp_dir)
    assert "RepartitionByExpression" in log._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.id for r in log.collect()) == sorted(f"req_{i}" for i in [*range(50), 0, 1, 2])
