"""DuckDB SQL equal in result to each registered Spark query."""

from oracles.views import VIEWS, with_views

ORACLES: dict[str, str] = {}


def _window_sql(length_s: int, slide_s: int) -> str:
    k = length_s // slide_s
    return with_views(f"""
WITH e AS (
  SELECT *, CAST(trunc(timestamp) AS BIGINT) AS sec FROM telemetry WHERE timestamp IS NOT NULL
), w AS (
  SELECT e.*, (sec - sec % {slide_s}) - r.k * {slide_s} AS ws FROM e, range(0, {k}) AS r(k)
)
SELECT make_timestamp(ws * 1000000) AS window_start,
  make_timestamp((ws + {length_s}) * 1000000) AS window_end,
  count(*) FILTER (WHERE event_type IN ('hit', 'miss')) AS total_requests,
  count(*) FILTER (WHERE event_type IN ('hit', 'miss')) AS throughput_per_min,
  quantile_disc(latency_ms, 0.5) AS latency_p50,
  quantile_disc(latency_ms, 0.95) AS latency_p95,
  count(*) FILTER (WHERE event_type = 'hit') / count(*) AS hit_rate,
  count(*) FILTER (WHERE event_type = 'retry') / count(*) AS retry_rate,
  make_timestamp((ws + {length_s}) * 1000000) AS "@timestamp",
  CAST(make_timestamp(ws * 1000000) AS VARCHAR) AS doc_id
FROM w GROUP BY ws""", "telemetry")


ORACLES["window_metrics"] = _window_sql(60, 10)
ORACLES["window_metrics_6h"] = _window_sql(21600, 3600)


def _pct(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) > 0 THEN round(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"
            f" * CAST(100 AS DOUBLE), 2) ELSE CAST(0 AS DOUBLE) END")


def _nearest_rank(p: int) -> str:
    return (f"coalesce(round(max(CASE WHEN rn = greatest(1, n * {p} // 100) THEN v END), 3),"
            f" CAST(0 AS DOUBLE))")


_LAT = """lat AS (
  SELECT {keys} latency_ms AS v,
    row_number() OVER (PARTITION BY {part} ORDER BY latency_ms) AS rn,
    count(*) OVER (PARTITION BY {part}) AS n
  FROM telemetry
  WHERE event_type IN ('hit', 'miss', 'recovery') AND latency_ms IS NOT NULL AND NOT isnan(latency_ms))"""

_BACKLOG = """lastk AS (
  SELECT query_type, zone_id, event_type, arg_max(latency_ms, seq) AS lv FROM telemetry
  WHERE event_type IN ('consumer_lag', 'recovery_time') GROUP BY query_type, zone_id, event_type
), b AS (
  SELECT coalesce(CAST(sum(CAST(lv AS DECIMAL(38, 9))) FILTER (WHERE event_type = 'consumer_lag') AS DOUBLE), CAST(0 AS DOUBLE)) AS backlog_size,
    greatest(coalesce(max(lv) FILTER (WHERE event_type = 'recovery_time'), CAST(0 AS DOUBLE)),
             CAST(0 AS DOUBLE)) AS last_recovery_time_ms
  FROM lastk)"""

ORACLES["backlog_state"] = with_views(f"WITH {_BACKLOG}\nSELECT * FROM b", "telemetry")

ORACLES["telemetry_totals"] = with_views(f"""
WITH c AS (
  SELECT count(*) FILTER (WHERE event_type = 'hit') AS h,
    count(*) FILTER (WHERE event_type = 'miss') AS m,
    count(*) FILTER (WHERE event_type = 'retry') AS r,
    count(*) FILTER (WHERE event_type = 'recovery') AS rec,
    count(*) FILTER (WHERE event_type = 'dlq') AS d,
    sum(CAST(latency_ms AS DECIMAL(38, 9))) FILTER (WHERE event_type IN ('hit', 'miss', 'recovery')) AS ls,
    count(latency_ms) FILTER (WHERE event_type IN ('hit', 'miss', 'recovery')) AS ln
  FROM telemetry
), {_LAT.format(keys='', part='1')},
p AS (SELECT {_nearest_rank(50)} AS p50, {_nearest_rank(95)} AS p95 FROM lat),
{_BACKLOG}
SELECT h + m AS total_requests, h AS total_hits, m AS total_misses,
  {_pct('h', 'h + m')} AS hit_rate,
  {_pct('r', 'm')} AS retry_rate,
  {_pct('rec', 'r')} AS recovery_rate,
  {_pct('d', 'm')} AS dlq_rate,
  CASE WHEN ln > 0 THEN round(CAST(ls AS DOUBLE) / CAST(ln AS DOUBLE), 3) ELSE CAST(0 AS DOUBLE) END AS avg_latency_ms,
  b.backlog_size, b.last_recovery_time_ms,
  p.p50 AS latency_p50_ms, p.p95 AS latency_p95_ms
FROM c, p, b""", "telemetry")

ORACLES["latency_percentiles_by_zone"] = with_views(f"""
WITH {_LAT.format(keys='zone_id,', part='zone_id')}
SELECT zone_id, {_nearest_rank(50)} AS latency_p50_ms, {_nearest_rank(90)} AS latency_p90_ms,
  {_nearest_rank(95)} AS latency_p95_ms, {_nearest_rank(99)} AS latency_p99_ms
FROM lat GROUP BY zone_id""", "telemetry")

ORACLES["telemetry_by_query_zone"] = with_views(f"""
WITH c AS (
  SELECT query_type, zone_id,
    count(*) FILTER (WHERE event_type = 'hit') AS hits,
    count(*) FILTER (WHERE event_type = 'miss') AS misses,
    count(*) FILTER (WHERE event_type = 'retry') AS retries,
    count(*) FILTER (WHERE event_type = 'dlq') AS dlq
  FROM telemetry GROUP BY query_type, zone_id)
SELECT concat_ws(':', query_type, zone_id) AS key, query_type, zone_id, hits, misses, retries, dlq,
  {_pct('hits', 'hits + misses')} AS hit_rate
FROM c""", "telemetry")

_TYPES = ["hit", "miss", "retry", "recovery", "dlq", "consumer_lag", "recovery_time"]

ORACLES["zone_hit_rate"] = with_views(f"""
WITH c AS (
  SELECT zone_id, {', '.join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES)}
  FROM telemetry GROUP BY zone_id)
SELECT *, CASE WHEN hit + miss > 0 THEN CAST(hit AS DOUBLE) / CAST(hit + miss AS DOUBLE) * CAST(100 AS DOUBLE) END AS hit_rate,
  hit + miss AS total
FROM c""", "telemetry")

_SERIES = """s AS (
  SELECT CAST(floor(timestamp - (SELECT min(timestamp) FROM telemetry)) AS BIGINT) AS second, count(*) AS events
  FROM telemetry WHERE timestamp IS NOT NULL GROUP BY 1)"""

ORACLES["throughput_series"] = with_views(f"WITH {_SERIES}\nSELECT * FROM s", "telemetry")
ORACLES["throughput_mean"] = with_views(f"""
WITH {_SERIES}
SELECT count(*) AS seconds, CAST(sum(events) AS BIGINT) AS events, CAST(sum(events) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_per_second
FROM s""", "telemetry")

ORACLES["latency_histogram"] = with_views("""
WITH l AS (
  SELECT event_type, latency_ms AS x FROM telemetry
  WHERE event_type IN ('hit', 'miss') AND latency_ms IS NOT NULL
), r0 AS (SELECT event_type, min(x) AS mn, max(x) AS mx FROM l GROUP BY event_type
), r AS (
  SELECT event_type,
    CASE WHEN mn = mx THEN mn - CAST(0.5 AS DOUBLE) ELSE mn END AS lo,
    CASE WHEN mn = mx THEN mx + CAST(0.5 AS DOUBLE) ELSE mx END AS hi
  FROM r0
), b0 AS (
  SELECT l.event_type, x, lo, hi, (hi - lo) / CAST(30 AS DOUBLE) AS step,
    least(CAST(floor((x - lo) / (hi - lo) * CAST(30 AS DOUBLE)) AS BIGINT), 29) AS i0
  FROM l JOIN r USING (event_type)
), b AS (
  SELECT event_type,
    CASE WHEN x < lo + i0 * step THEN i0 - 1
         WHEN i0 <> 29 AND x >= lo + (i0 + 1) * step THEN i0 + 1 ELSE i0 END AS bin
  FROM b0
), c AS (SELECT event_type, bin, count(*) AS cnt FROM b GROUP BY ALL
), g AS (SELECT event_type, lo, hi, CAST(k AS BIGINT) AS bin FROM r, range(0, 30) AS t(k))
SELECT g.event_type, g.bin,
  lo + g.bin * ((hi - lo) / CAST(30 AS DOUBLE)) AS bin_min,
  CASE WHEN g.bin = 29 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / CAST(30 AS DOUBLE)) END AS bin_max,
  coalesce(c.cnt, 0) AS count
FROM g LEFT JOIN c USING (event_type, bin)""", "telemetry")

ORACLES["latency_median"] = with_views("""
WITH l AS (
  SELECT event_type, latency_ms AS v,
    row_number() OVER (PARTITION BY event_type ORDER BY latency_ms) AS rn,
    count(*) OVER (PARTITION BY event_type) AS n
  FROM telemetry WHERE event_type IN ('hit', 'miss') AND latency_ms IS NOT NULL AND NOT isnan(latency_ms))
SELECT event_type, max(n) AS n,
  (max(CASE WHEN rn = (n + 1) // 2 THEN v END) + max(CASE WHEN rn = n // 2 + 1 THEN v END)) / CAST(2 AS DOUBLE) AS median_ms
FROM l GROUP BY event_type""", "telemetry")


# ------------------------------------------------------------------ buildings

def D(x: str) -> str:
    return f"CAST('{x}' AS DOUBLE)"


_BUILDINGS = """bb AS (
  SELECT latitude, longitude, area_in_meters, confidence FROM {src}
  WHERE latitude BETWEEN (SELECT min(lat_min) FROM zones) AND (SELECT max(lat_max) FROM zones)
    AND longitude BETWEEN (SELECT min(lon_min) FROM zones) AND (SELECT max(lon_max) FROM zones)
    AND area_in_meters IS NOT NULL AND confidence IS NOT NULL
    AND NOT isnan(latitude) AND NOT isnan(longitude) AND NOT isnan(area_in_meters) AND NOT isnan(confidence)
), buildings AS (
  SELECT * FROM (
    SELECT bb.*, (SELECT z.zone_id FROM zones z
                  WHERE bb.latitude BETWEEN z.lat_min AND z.lat_max
                    AND bb.longitude BETWEEN z.lon_min AND z.lon_max
                  ORDER BY z.priority LIMIT 1) AS zone_id
    FROM bb) WHERE zone_id IS NOT NULL
)"""

_WKT = """wkt AS (
  SELECT TRY_CAST(nullif(regexp_extract(geometry, 'POINT \\(([^ ]+) ([^ )]+)\\)', 2), '') AS DOUBLE) AS latitude,
    TRY_CAST(nullif(regexp_extract(geometry, 'POINT \\(([^ ]+) ([^ )]+)\\)', 1), '') AS DOUBLE) AS longitude,
    area_in_meters, confidence
  FROM buildings_raw)"""

ORACLES["buildings"] = with_views(
    f"WITH {_BUILDINGS.format(src='buildings_raw')}\nSELECT * FROM buildings", "buildings_raw", "zones")
ORACLES["buildings_from_wkt"] = with_views(
    f"WITH {_WKT}, {_BUILDINGS.format(src='wkt')}\nSELECT * FROM buildings", "buildings_raw", "zones")
ORACLES["zone_inventory"] = with_views(
    f"WITH {_BUILDINGS.format(src='buildings_raw')}\n"
    "SELECT zone_id, count(*) AS buildings FROM buildings GROUP BY zone_id", "buildings_raw", "zones")

_VALID = """loaded AS (SELECT DISTINCT zone_id FROM buildings
), checked AS (
  SELECT r.*,
    CASE WHEN r.zone_id IS NULL OR r.query_type IS NULL THEN 422
         WHEN r.zone_id NOT IN (SELECT zone_id FROM loaded) THEN 404
         WHEN r.query_type = 'Q4' AND (r.zone_id_b IS NULL OR r.zone_id_b = '') THEN 400
         WHEN r.query_type NOT IN ('Q1', 'Q2', 'Q3', 'Q4', 'Q5') THEN 400
         WHEN r.query_type = 'Q4' AND r.zone_id_b NOT IN (SELECT zone_id FROM loaded) THEN 500
         WHEN r.query_type = 'Q5' AND (r.bins IS NULL OR r.bins < 1) THEN 500 END AS error_status,
    CASE WHEN r.zone_id IS NULL OR r.query_type IS NULL THEN 'invalid_request'
         WHEN r.zone_id NOT IN (SELECT zone_id FROM loaded) THEN 'zone_not_found'
         WHEN r.query_type = 'Q4' AND (r.zone_id_b IS NULL OR r.zone_id_b = '') THEN 'missing_zone_b'
         WHEN r.query_type NOT IN ('Q1', 'Q2', 'Q3', 'Q4', 'Q5') THEN 'unknown_query_type'
         WHEN r.query_type = 'Q4' AND r.zone_id_b NOT IN (SELECT zone_id FROM loaded) THEN 'zone_b_not_found'
         WHEN r.query_type = 'Q5' AND (r.bins IS NULL OR r.bins < 1) THEN 'invalid_bins' END AS error_reason
  FROM requests r
), v AS (SELECT * FROM checked WHERE error_reason IS NULL)"""

_AREA = """za AS (
  SELECT zone_id, (lat_max - lat_min) * (lon_max - lon_min) * CAST(111 AS DOUBLE) * CAST(111 AS DOUBLE)
    * cos(radians(ref_lat)) AS area FROM zones)"""

_STATS = """p AS (
  SELECT DISTINCT zone_id, confidence_min FROM v WHERE query_type IN ('Q1', 'Q2', 'Q3', 'Q4')
), p4 AS (SELECT DISTINCT zone_id, zone_id_b, confidence_min FROM v WHERE query_type = 'Q4'
), pall AS (SELECT zone_id, confidence_min FROM p UNION SELECT zone_id_b, confidence_min FROM p4
), st AS (
  SELECT p.zone_id, p.confidence_min, count(b.zone_id) AS n, sum(b.area_in_meters) AS total
  FROM pall p LEFT JOIN buildings b ON b.zone_id = p.zone_id AND b.confidence >= p.confidence_min
  GROUP BY p.zone_id, p.confidence_min
), dens AS (
  SELECT st.*, round(n / coalesce(za.area, CAST(1 AS DOUBLE)), 4) AS density_per_km2,
    round(coalesce(za.area, CAST(1 AS DOUBLE)), 4) AS area_km2
  FROM st LEFT JOIN za USING (zone_id)
), cmp AS (
  SELECT p4.zone_id AS zone_a, p4.zone_id_b AS zone_b, p4.confidence_min,
    a.density_per_km2 AS density_a, b.density_per_km2 AS density_b,
    CASE WHEN a.density_per_km2 > b.density_per_km2 THEN p4.zone_id ELSE p4.zone_id_b END AS winner
  FROM p4 JOIN dens a ON a.zone_id = p4.zone_id AND a.confidence_min = p4.confidence_min
  JOIN dens b ON b.zone_id = p4.zone_id_b AND b.confidence_min = p4.confidence_min
)"""

_HIST = """p5 AS (SELECT DISTINCT zone_id, bins FROM v WHERE query_type = 'Q5' AND bins >= 1
), hb0 AS (
  SELECT p5.zone_id, p5.bins, b.confidence AS x, CAST(1 AS DOUBLE) / CAST(p5.bins AS DOUBLE) AS step,
    least(CAST(floor(b.confidence * CAST(p5.bins AS DOUBLE)) AS BIGINT), p5.bins - 1) AS i0
  FROM p5 JOIN buildings b ON b.zone_id = p5.zone_id
  WHERE b.confidence BETWEEN CAST(0 AS DOUBLE) AND CAST(1 AS DOUBLE) AND NOT isnan(b.confidence)
), hb AS (
  SELECT zone_id, bins,
    CASE WHEN x < i0 * step THEN i0 - 1
         WHEN i0 <> bins - 1 AND x >= (i0 + 1) * step THEN i0 + 1 ELSE i0 END AS bucket
  FROM hb0
), hc AS (SELECT zone_id, bins, bucket, count(*) AS cnt FROM hb GROUP BY ALL
), hg AS (SELECT zone_id, bins, CAST(unnest(range(0, bins)) AS BIGINT) AS bucket FROM p5
), hist AS (
  SELECT hg.zone_id, hg.bins, hg.bucket,
    round(hg.bucket * (CAST(1 AS DOUBLE) / CAST(hg.bins AS DOUBLE)), 4) AS min,
    round(CASE WHEN hg.bucket = hg.bins - 1 THEN CAST(1 AS DOUBLE)
               ELSE (hg.bucket + 1) * (CAST(1 AS DOUBLE) / CAST(hg.bins AS DOUBLE)) END, 4) AS max,
    coalesce(hc.cnt, 0) AS counts
  FROM hg LEFT JOIN hc USING (zone_id, bins, bucket)
)"""

_BV = ["requests", "buildings_raw", "zones"]


def _bq(body: str) -> str:
    return with_views(f"WITH {_BUILDINGS.format(src='buildings_raw')}, {_VALID}, {_AREA}, {_STATS}, "
                      f"{_HIST}\n{body}", *_BV)


ORACLES["q1_count"] = _bq("SELECT st.zone_id, st.confidence_min, st.n AS count FROM st JOIN p USING (zone_id, confidence_min)")
ORACLES["q2_area"] = _bq("""SELECT st.zone_id, st.confidence_min,
  CASE WHEN n > 0 THEN total / n ELSE CAST(0 AS DOUBLE) END AS avg_area,
  coalesce(total, CAST(0 AS DOUBLE)) AS total_area, n
FROM st JOIN p USING (zone_id, confidence_min)""")
ORACLES["q3_density"] = _bq("SELECT zone_id, confidence_min, density_per_km2, area_km2 FROM dens JOIN p USING (zone_id, confidence_min)")
ORACLES["q4_compare"] = _bq("SELECT * FROM cmp")
ORACLES["q5_histogram"] = _bq("SELECT * FROM hist")

# ------------------------------------------------------------------ requests

_KEY = """CASE WHEN query_type = 'Q1' THEN 'count:' || coalesce(zone_id, 'None') || ':conf=' || coalesce(CAST(confidence_min AS VARCHAR), 'None')
     WHEN query_type = 'Q2' THEN 'area:' || coalesce(zone_id, 'None') || ':conf=' || coalesce(CAST(confidence_min AS VARCHAR), 'None')
     WHEN query_type = 'Q3' THEN 'density:' || coalesce(zone_id, 'None') || ':conf=' || coalesce(CAST(confidence_min AS VARCHAR), 'None')
     WHEN query_type = 'Q4' THEN 'compare:density:' || coalesce(zone_id, 'None') || ':' || coalesce(zone_id_b, 'None') || ':conf=' || coalesce(CAST(confidence_min AS VARCHAR), 'None')
     WHEN query_type = 'Q5' THEN 'confidence_dist:' || coalesce(zone_id, 'None') || ':bins=' || coalesce(CAST(bins AS VARCHAR), 'None')
     ELSE md5(coalesce(query_type, 'None') || ':' || coalesce(zone_id, 'None') || ':' || coalesce(zone_id_b, 'None') || ':'
              || coalesce(CAST(confidence_min AS VARCHAR), 'None') || ':' || coalesce(CAST(bins AS VARCHAR), 'None')) END"""

ORACLES["cache_keys"] = with_views(f"SELECT seq, {_KEY} AS cache_key FROM requests", "requests")
ORACLES["validate_requests"] = with_views(
    f"WITH {_BUILDINGS.format(src='buildings_raw')}, {_VALID}\nSELECT seq, error_status, error_reason FROM checked", *_BV)

ORACLES["answer_requests"] = _bq("""
, hs AS (SELECT zone_id, bins, string_agg(CAST(counts AS VARCHAR), ',' ORDER BY bucket) AS bucket_counts
         FROM hist GROUP BY zone_id, bins)
SELECT v.seq, v.query_type, v.zone_id, v.zone_id_b, v.confidence_min, v.bins,
  CASE WHEN v.query_type = 'Q1' THEN d.n END AS count,
  CASE WHEN v.query_type = 'Q2' THEN CASE WHEN d.n > 0 THEN d.total / d.n ELSE CAST(0 AS DOUBLE) END END AS avg_area,
  CASE WHEN v.query_type = 'Q2' THEN coalesce(d.total, CAST(0 AS DOUBLE)) END AS total_area,
  CASE WHEN v.query_type = 'Q2' THEN d.n END AS n,
  CASE WHEN v.query_type = 'Q3' THEN d.density_per_km2 END AS density_per_km2,
  CASE WHEN v.query_type = 'Q3' THEN d.area_km2 END AS area_km2,
  CASE WHEN v.query_type = 'Q4' THEN c.density_a END AS density_a,
  CASE WHEN v.query_type = 'Q4' THEN c.density_b END AS density_b,
  CASE WHEN v.query_type = 'Q4' THEN c.winner END AS winner,
  CASE WHEN v.query_type = 'Q5' THEN hs.bucket_counts END AS bucket_counts
FROM v
LEFT JOIN dens d ON d.zone_id = v.zone_id AND d.confidence_min = v.confidence_min
LEFT JOIN cmp c ON c.zone_a = v.zone_id AND c.zone_b = v.zone_id_b AND c.confidence_min = v.confidence_min
LEFT JOIN hs ON hs.zone_id = v.zone_id AND hs.bins = v.bins""".replace("\n, hs AS", ", hs AS", 1))

_REPLAY = """keyed AS (
  SELECT c.*, """ + _KEY + """ AS cache_key, c.error_reason IS NULL AS valid FROM checked c
), ordered AS (
  SELECT seq, cache_key, t_start, valid,
    row_number() OVER (PARTITION BY cache_key ORDER BY t_start, seq) AS rn FROM keyed
), fold AS (
  SELECT cache_key, rn, seq, false AS cached,
    CASE WHEN valid THEN t_start + CAST(21600 AS DOUBLE) ELSE CAST('-inf' AS DOUBLE) END AS expiry
  FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.cache_key, o.rn, o.seq, o.t_start < f.expiry,
    CASE WHEN o.t_start < f.expiry THEN f.expiry
         WHEN o.valid THEN o.t_start + CAST(21600 AS DOUBLE) ELSE f.expiry END
  FROM fold f JOIN ordered o ON o.cache_key = f.cache_key AND o.rn = f.rn + 1
), att AS (
  SELECT k.*, f.cached, k.attempt_retries AS r, (NOT f.cached AND k.error_reason IS NOT NULL) AS failed
  FROM keyed k JOIN fold f USING (seq)
)"""


def _rq(body: str) -> str:
    sql = with_views(f"WITH RECURSIVE {_BUILDINGS.format(src='buildings_raw')}, {_VALID}, {_REPLAY}\n{body}", *_BV)
    # with_views put the fixture CTEs first; RECURSIVE must follow WITH directly
    return "WITH RECURSIVE " + sql[len("WITH "):].replace("RECURSIVE ", "", 1)


ORACLES["ttl_replay"] = _rq("SELECT seq, cache_key, cached FROM att")
ORACLES["route_failures"] = _rq("""SELECT seq,
  CASE WHEN NOT failed THEN 'answer' WHEN r + 1 <= 3 THEN 'retry' ELSE 'dlq' END AS route,
  CASE WHEN failed THEN r + 1 ELSE r END AS retries
FROM att""")
ORACLES["attempt_events"] = _rq("""
, ev AS (
  SELECT seq, query_type, zone_id, cache_key,
    CASE WHEN cached THEN 'hit' WHEN NOT failed THEN CASE WHEN r > 0 THEN 'recovery' ELSE 'miss' END
         WHEN r + 1 = 1 THEN 'miss' END AS e1,
    CASE WHEN failed THEN CASE WHEN r + 1 <= 3 THEN 'retry' ELSE 'dlq' END END AS e2
  FROM att)
SELECT seq, 0 AS event_index, e1 AS event_type, query_type, zone_id, cache_key FROM ev WHERE e1 IS NOT NULL
UNION ALL
SELECT seq, CASE WHEN e1 IS NULL THEN 0 ELSE 1 END, e2, query_type, zone_id, cache_key FROM ev WHERE e2 IS NOT NULL
""".replace("\n, ev AS", ", ev AS", 1))
ORACLES["expand_failures"] = _rq("""
, life AS (
  SELECT CAST(floor(seq / 5) AS BIGINT) AS id, count(*) AS attempts, min(r) AS first_try, max(r) AS last_try,
    count(*) FILTER (WHERE cached) AS hits,
    count(*) FILTER (WHERE NOT cached AND ((NOT failed AND r = 0) OR (failed AND r = 0))) AS misses,
    count(*) FILTER (WHERE NOT cached AND NOT failed AND r > 0) AS recoveries,
    count(*) FILTER (WHERE failed AND r + 1 <= 3) AS retries, count(*) FILTER (WHERE failed AND r + 1 > 3) AS dlqs,
    count(DISTINCT r) AS tries, bool_or(NOT failed) FILTER (WHERE last) AS ends_well
  FROM (SELECT *, r = max(r) OVER (PARTITION BY floor(seq / 5)) AS last FROM att) GROUP BY 1)
SELECT id, attempts, first_try, last_try, hits, misses, recoveries, retries, dlqs,
  CASE WHEN dlqs > 0 THEN 'dead' WHEN ends_well THEN 'recovered' ELSE 'open' END AS outcome, tries = last_try + 1 AS complete
FROM life WHERE retries > 0 OR dlqs > 0
""".replace("\n, life AS", ", life AS", 1))


# ------------------------------------------------------------------ generator

ORACLES["traffic_fit"] = with_views("""
WITH z AS (SELECT zone_id, count(*) AS requests FROM requests GROUP BY zone_id),
k AS (SELECT *, row_number() OVER (ORDER BY requests DESC, zone_id) AS rank FROM z),
a AS (SELECT coalesce(-regr_slope(ln(requests), ln(rank)), 0) AS alpha FROM k),
w AS (SELECT k.*, alpha, pow(CAST(rank AS DOUBLE), -alpha) AS weight FROM k, a)
SELECT zone_id, requests, rank, round(alpha, 6) AS alpha, round(CAST(requests AS DOUBLE) / sum(requests) OVER (), 9) AS share,
  round(weight / sum(weight) OVER (), 9) AS zipf_share, round(CAST(1 AS DOUBLE) / count(*) OVER (), 9) AS uniform_share
FROM w""", "requests")

def _u(stream: int, seed: int) -> str:
    x = f"((seq * 8 + {stream} + {seed}) % 2147483648)"
    for _ in range(2):
        x = f"(({x} * 1103515245 + 12345) % 2147483648)"
    return f"(CAST({x} AS DOUBLE) / CAST(2147483648 AS DOUBLE))"


def _choice(u: str, weights: list[float], values: list[str]) -> str:
    cum, acc = [], 0.0
    for w in weights:
        acc += w
        cum.append(acc)
    total = cum[-1]
    parts = [f"WHEN {u} * CAST('{total!r}' AS DOUBLE) < CAST('{c!r}' AS DOUBLE) THEN {v}"
             for c, v in zip(cum[:-1], values[:-1])]
    return f"CASE {' '.join(parts)} ELSE {values[-1]} END"


def _sample_sql(dist: str, alpha: float, seed: int) -> str:
    zones = ["'Z1'", "'Z2'", "'Z3'", "'Z4'", "'Z5'"]
    if dist == "zipf":
        raw = [1.0 / (r ** alpha) for r in range(1, 6)]
        zw = [w / sum(raw) for w in raw]
    else:
        zw = [0.2] * 5
    qt = ["'Q1'", "'Q2'", "'Q3'", "'Q4'", "'Q5'"]
    return f"""
WITH s AS (
  SELECT event_id AS seq,
    {_choice(_u(0, seed), zw, zones)} AS zone_id,
    {_choice(_u(1, seed), [0.40, 0.20, 0.20, 0.10, 0.10], qt)} AS query_type,
    [CAST(0 AS DOUBLE), CAST('0.5' AS DOUBLE), CAST('0.7' AS DOUBLE)][CAST(floor({_u(2, seed)} * 3) AS INT) + 1] AS confidence_min,
    [5, 10][CAST(floor({_u(3, seed)} * 2) AS INT) + 1] AS bins,
    CAST(floor({_u(4, seed)} * 4) AS INT) AS other
  FROM events)
SELECT seq, zone_id, query_type, confidence_min, bins,
  CASE WHEN query_type = 'Q4' THEN list_filter(['Z1', 'Z2', 'Z3', 'Z4', 'Z5'], lambda z: z <> zone_id)[other + 1] END AS zone_id_b
FROM s"""


def _observed(u: str, column: str, values: list[str]) -> str:
    upto = [f"(SELECT count(*) FILTER (WHERE {column} IN ({', '.join(values[:k + 1])})) FROM requests)" for k in range(len(values))]
    parts = [f"WHEN {u} * {upto[-1]} < {c} THEN {v}" for c, v in zip(upto[:-1], values[:-1])]
    return f"CASE {' '.join(parts)} ELSE {values[-1]} END"


ORACLES["sample_requests_observed"] = with_views(f"""
WITH s AS (
  SELECT seq, {_observed(_u(0, 11), "zone_id", ["'Z1'", "'Z2'", "'Z3'", "'Z4'", "'Z5'"])} AS zone_id,
    {_observed(_u(1, 11), "query_type", ["'Q1'", "'Q2'", "'Q3'", "'Q4'", "'Q5'"])} AS query_type,
    [CAST(0 AS DOUBLE), CAST('0.5' AS DOUBLE), CAST('0.7' AS DOUBLE)][CAST(floor({_u(2, 11)} * 3) AS INT) + 1] AS confidence_min,
    [5, 10][CAST(floor({_u(3, 11)} * 2) AS INT) + 1] AS bins, CAST(floor({_u(4, 11)} * 4) AS INT) AS other
  FROM requests)
SELECT seq, zone_id, query_type, confidence_min, bins,
  CASE WHEN query_type = 'Q4' THEN list_filter(['Z1', 'Z2', 'Z3', 'Z4', 'Z5'], lambda z: z <> zone_id)[other + 1] END AS zone_id_b
FROM s""", "requests")
ORACLES["sample_requests_zipf"] = _sample_sql("zipf", 1.5, 42)
ORACLES["sample_requests_uniform"] = _sample_sql("uniform", 1.5, 7)


# ------------------------------------------------------------------ lag

ORACLES["lag_samples"] = with_views("""
SELECT *, high_watermark - msg_offset - 1 AS lag FROM offsets
WHERE high_watermark - msg_offset - 1 > 0 AND (high_watermark - msg_offset - 1) % 10 = 0""", "offsets")

ORACLES["backlog_episodes"] = with_views("""
WITH o AS (SELECT *, high_watermark - msg_offset - 1 AS lag FROM offsets
), i AS (
  SELECT *, coalesce(sum(CASE WHEN lag = 0 THEN 1 ELSE 0 END) OVER (
    PARTITION BY consumer_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS isl
  FROM o
), g AS (
  SELECT consumer_id, isl,
    min(seq) FILTER (WHERE lag > 0) AS open_seq,
    arg_min(processed_at, seq) FILTER (WHERE lag > 0) AS open_time,
    max(seq) FILTER (WHERE lag = 0) AS close_seq,
    arg_max(processed_at, seq) FILTER (WHERE lag = 0) AS close_time
  FROM i GROUP BY consumer_id, isl)
SELECT consumer_id, open_seq, open_time, close_seq, close_time,
  (close_time - open_time) * CAST(1000 AS DOUBLE) AS duration_ms
FROM g WHERE open_seq IS NOT NULL AND close_seq IS NOT NULL""", "offsets")

# ------------------------------------------------------------------ experiments

_RUNS = """a AS (
  SELECT t.*, r.run_id FROM telemetry t JOIN runs r ON t.timestamp >= r.start_time AND t.timestamp < r.end_time
), c AS (
  SELECT run_id, count(*) FILTER (WHERE event_type = 'hit') AS h, count(*) FILTER (WHERE event_type = 'miss') AS m
  FROM a GROUP BY run_id
), lat AS (
  SELECT run_id, latency_ms AS v,
    row_number() OVER (PARTITION BY run_id ORDER BY latency_ms) AS rn,
    count(*) OVER (PARTITION BY run_id) AS n
  FROM a WHERE event_type IN ('hit', 'miss', 'recovery') AND latency_ms IS NOT NULL AND NOT isnan(latency_ms)
), p AS (SELECT run_id, """ + _nearest_rank(50) + " AS p50, " + _nearest_rank(95) + """ AS p95 FROM lat GROUP BY run_id
), summary AS (
  SELECT r.run_id, r.experiment, r.distribution, r.eviction_policy, r.maxmemory, r.ttl,
    coalesce(""" + _pct('c.h', 'c.h + c.m') + """, CAST(0 AS DOUBLE)) AS hit_rate,
    coalesce(c.h, 0) AS total_hits, coalesce(c.m, 0) AS total_misses,
    coalesce(p.p50, CAST(0 AS DOUBLE)) AS latency_p50_ms, coalesce(p.p95, CAST(0 AS DOUBLE)) AS latency_p95_ms,
    CAST(r.evicted_keys AS BIGINT) AS evicted_keys,
    CASE WHEN r.sent > 0 THEN r.hits / r.sent * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS log_hit_rate
  FROM runs r LEFT JOIN c USING (run_id) LEFT JOIN p USING (run_id)
), labelled AS (
  SELECT *, CASE experiment WHEN 'dist_comparison' THEN distribution WHEN 'policy_comparison' THEN eviction_policy
    WHEN 'size_comparison' THEN maxmemory WHEN 'ttl_comparison' THEN CAST(ttl AS VARCHAR) || 's' END AS label
  FROM summary)"""

ORACLES["assign_runs"] = with_views(
    "SELECT t.seq, r.run_id FROM telemetry t JOIN runs r ON t.timestamp >= r.start_time AND t.timestamp < r.end_time",
    "telemetry", "runs")
ORACLES["run_summary"] = with_views(f"WITH {_RUNS}\nSELECT * FROM summary", "telemetry", "runs")
ORACLES["compare_experiment"] = with_views(f"""WITH {_RUNS}
SELECT experiment, label, 'hit_rate' AS metric, hit_rate AS value FROM labelled
UNION ALL SELECT experiment, label, 'latency_p50_ms', latency_p50_ms FROM labelled
UNION ALL SELECT experiment, label, 'latency_p95_ms', latency_p95_ms FROM labelled""", "telemetry", "runs")
_REPORT = """SELECT
  list_aggr(list_transform(string_split(replace(experiment, '_', ' '), ' '),
            lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS title,
  label, round(hit_rate, 1) AS hit_rate, round(latency_p50_ms, 1) AS latency_p50_ms,
  round(latency_p95_ms, 1) AS latency_p95_ms, evicted_keys
FROM labelled"""
ORACLES["experiment_report"] = with_views(f"WITH {_RUNS}\n{_REPORT}", "telemetry", "runs")
ORACLES["summary_roundtrip"] = ORACLES["experiment_report"]

# ------------------------------------------------------------------ sources and sinks

ORACLES["telemetry_roundtrip"] = with_views("""
SELECT CASE WHEN seq % 101 = 0 THEN CAST(1700000000 AS DOUBLE) ELSE timestamp END AS timestamp,
  event_type, query_type, zone_id, cache_key, latency_ms,
  make_timestamp(CAST(trunc(CASE WHEN seq % 101 = 0 THEN CAST(1700000000 AS DOUBLE) ELSE timestamp END) AS BIGINT) * 1000000) AS event_time
FROM telemetry""", "telemetry")

ORACLES["telemetry_topic"] = with_views("""
SELECT cache_key, count(*) AS messages, CAST(sum(CAST(latency_ms AS DECIMAL(28,9))) AS DOUBLE) AS latency,
  min(timestamp) AS first, max(timestamp) AS last, TRUE AS one_partition, TRUE AS no_gap
FROM telemetry GROUP BY cache_key""", "telemetry")

ORACLES["request_envelopes"] = with_views(f"""
WITH e AS (
  SELECT *,
    CASE WHEN seq % 3 = 0 THEN NULL ELSE 'req_' || CAST(seq AS VARCHAR) END AS id,
    CASE WHEN seq % 3 = 0 THEN 0 ELSE attempt_retries END AS retries,
    CASE WHEN seq % 3 = 0 OR seq % 7 = 0 THEN CAST(1700000000 AS DOUBLE) ELSE t_start END AS t_start2,
    CASE WHEN seq % 3 = 0 THEN NULL WHEN seq % 5 = 0 THEN 'pre:' || CAST(seq AS VARCHAR) END AS given_key
  FROM requests)
SELECT id, zone_id, query_type, confidence_min, bins, zone_id_b, retries, t_start2 AS t_start,
  coalesce(given_key, {_KEY}) AS cache_key
FROM e""", "requests")

ORACLES["telemetry_log_roundtrip"] = ORACLES["telemetry_by_query_zone"]
ORACLES["buildings_roundtrip"] = with_views(
    f"WITH {_BUILDINGS.format(src='buildings_raw')}\n"
    "SELECT zone_id, count(*) AS buildings, sum(area_in_meters) AS total_area FROM buildings GROUP BY zone_id",
    "buildings_raw", "zones")
ORACLES["buildings_box"] = with_views(f"""WITH {_BUILDINGS.format(src='buildings_raw')}
SELECT zone_id, count(*) AS buildings, sum(area_in_meters) AS total_area, min(confidence) AS least_confidence FROM buildings
WHERE latitude BETWEEN {D('-33.43')} AND {D('-33.41')} AND longitude BETWEEN {D('-70.61')} AND {D('-70.59')}
GROUP BY zone_id""", "buildings_raw", "zones")
ORACLES["tiles_scan"] = ORACLES["buildings"]

# ------------------------------------------------------------------ streaming

ORACLES["window_metrics_stream"] = ORACLES["window_metrics"]
ORACLES["ttl_replay_stream"] = ORACLES["ttl_replay"]

ORACLES["request_outcomes"] = ORACLES["attempt_events"]
ORACLES["request_outcomes_stream"] = ORACLES["attempt_events"]


# ------------------------------------------------------------------ other paths of the same operators

ORACLES["buildings_grid"] = ORACLES["buildings"]
ORACLES["latency_percentiles_refined"] = ORACLES["latency_percentiles_by_zone"]
ORACLES["ttl_replay_parallel"] = ORACLES["ttl_replay"]
ORACLES["buildings_csv_fallback"] = ORACLES["buildings_roundtrip"]
ORACLES["window_metrics_restart"] = ORACLES["window_metrics"]
ORACLES["tiles_mixed"] = ORACLES["buildings"]

ORACLES["buildings_custom_zones"] = with_views(f"""
, g AS (SELECT i, 'G' || CAST(i AS STRING) AS zone_id,
    {D('-33.54')} + CAST(i AS DOUBLE) * {D('0.04')} AS lo, ({D('-33.54')} + CAST(i AS DOUBLE) * {D('0.04')}) + {D('0.04')} AS hi
  FROM (VALUES (0), (1), (2), (3)) AS t(i)
), hit AS (
  SELECT (SELECT min(g.i) FROM g WHERE b.latitude >= g.lo AND b.latitude <= g.hi) AS i
  FROM buildings_raw b
  WHERE b.area_in_meters IS NOT NULL AND b.confidence IS NOT NULL
    AND b.longitude >= {D('-70.83')} AND b.longitude <= {D('-70.5')}
)
SELECT 'G' || CAST(i AS STRING) AS zone_id, count(*) AS buildings FROM hit WHERE i IS NOT NULL GROUP BY i
""", "buildings_raw")

ORACLES["attempt_telemetry"] = _rq(""", done AS (
  SELECT event_id AS seq, CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) + value / CAST(1000 AS DOUBLE) AS done_at FROM events
), ev AS (
  SELECT att.seq, query_type, zone_id, cache_key, t_start, done_at,
    CASE WHEN cached THEN 'hit' WHEN NOT failed THEN CASE WHEN r > 0 THEN 'recovery' ELSE 'miss' END
         WHEN r + 1 = 1 THEN 'miss' END AS e1,
    CASE WHEN failed THEN CASE WHEN r + 1 <= 3 THEN 'retry' ELSE 'dlq' END END AS e2
  FROM att JOIN done USING (seq))
SELECT seq, 0 AS event_index, done_at AS timestamp, e1 AS event_type, query_type, zone_id, cache_key,
  (done_at - t_start) * CAST(1000 AS DOUBLE) AS latency_ms FROM ev WHERE e1 IS NOT NULL
UNION ALL
SELECT seq, CASE WHEN e1 IS NULL THEN 0 ELSE 1 END, done_at, e2, query_type, zone_id, cache_key, CAST(0 AS DOUBLE) FROM ev WHERE e2 IS NOT NULL
""")

ORACLES["retry_envelopes"] = _rq("""SELECT CASE WHEN r + 1 <= 3 THEN 'retry' ELSE 'dlq' END AS topic,
  'req_' || CAST(seq AS STRING) AS id, zone_id, query_type, confidence_min, bins, zone_id_b, r + 1 AS retries, t_start, cache_key
FROM att WHERE failed""")

ORACLES["request_rejects"] = """SELECT CASE WHEN event_id % 2 = 0 THEN 'not json' ELSE '{"req": 5}' END AS value, count(*) AS n
FROM events WHERE event_id % 89 = 0 GROUP BY 1"""

ORACLES["lag_events"] = f"""
WITH o AS (
  SELECT v.*, high_watermark - msg_offset - 1 AS lag, query_type, zone_id, cache_key
  FROM ({VIEWS['offsets']}) v JOIN ({VIEWS['telemetry']}) t USING (seq)
), marked AS (
  SELECT *, coalesce(sum(CASE WHEN lag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY consumer_id ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island
  FROM o
), closed AS (
  SELECT consumer_id, min_by(processed_at, seq) FILTER (WHERE lag > 0) AS opened, max(seq) FILTER (WHERE lag = 0) AS seq
  FROM marked GROUP BY consumer_id, island
), c AS (
  SELECT o.consumer_id, o.seq, o.processed_at, o.query_type, o.zone_id, o.cache_key,
    (o.processed_at - closed.opened) * CAST(1000 AS DOUBLE) AS ms
  FROM closed JOIN o ON o.consumer_id = closed.consumer_id AND o.seq = closed.seq WHERE closed.opened IS NOT NULL
)
SELECT consumer_id, seq, 0 AS event_index, processed_at AS timestamp, 'consumer_lag' AS event_type, query_type, zone_id, cache_key,
  CAST(lag AS DOUBLE) AS latency_ms FROM o WHERE lag > 0 AND lag % 10 = 0
UNION ALL SELECT consumer_id, seq, 0, processed_at, 'recovery_time', query_type, zone_id, cache_key, ms FROM c
UNION ALL SELECT consumer_id, seq, 1, processed_at, 'consumer_lag', query_type, zone_id, cache_key, CAST(0 AS DOUBLE) FROM c"""

ORACLES["experiment_log"] = with_views("""
, seen AS (
  SELECT r.run_id, count(*) FILTER (WHERE event_type = 'hit') AS hits, count(*) FILTER (WHERE event_type = 'miss') AS misses,
    count(*) FILTER (WHERE event_type = 'dlq') AS errors
  FROM telemetry t JOIN runs r ON t.timestamp >= r.start_time AND t.timestamp < r.end_time GROUP BY r.run_id
), e AS (
  SELECT r.run_id, start_time, end_time, distribution, coalesce(s.hits, 0) AS h, coalesce(s.misses, 0) AS m, coalesce(s.errors, 0) AS x
  FROM runs r LEFT JOIN seen s USING (run_id)
)
SELECT CAST(run_id AS BIGINT) AS experiment_id, start_time, end_time, distribution,
  CASE WHEN distribution = 'zipf' THEN CAST('1.5' AS DOUBLE) END AS zipf_alpha, h + m AS n_requests, CAST(10 AS DOUBLE) AS request_rate,
  h + m + x AS sent, h + m AS success, x AS errors, h AS hits, m AS misses,
  CASE WHEN h + m + x > 0 THEN CAST(h AS DOUBLE) / CAST(h + m + x AS DOUBLE) * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS log_hit_rate
FROM e""", "telemetry", "runs")

_ANSWERS = ORACLES["answer_requests"]
_REPLAYED = ORACLES["ttl_replay"]
ORACLES["request_answers_stream"] = f"SELECT a.* FROM ({_ANSWERS}) a JOIN ({_REPLAYED}) t USING (seq) WHERE NOT t.cached"

# rows without time or key are misses; order values repeat four times
_TIMED = VIEWS["requests"].strip()
ORACLES["ttl_replay_odd_rows"] = _rq("""SELECT CAST(floor(event_id / 4) AS BIGINT) AS seq, count(*) AS n,
  count(*) FILTER (WHERE event_id % 13 <> 0) AS timed, count(*) FILTER (WHERE event_id % 17 <> 0) AS keyed,
  count(*) FILTER (WHERE att.cached) AS hits
FROM events LEFT JOIN att ON att.seq = event_id GROUP BY 1""").replace(
    _TIMED, _TIMED + "\nWHERE event_id % 13 <> 0 AND event_id % 17 <> 0")

# the third batch counts only in windows that end after the first batch's watermark
ORACLES["window_metrics_late"] = ORACLES["window_metrics"].replace(
    "FROM w GROUP BY ws",
    "FROM w WHERE seq % 3 < 2 OR ws + 60 > (SELECT max(sec) - 60 FROM e WHERE seq % 3 = 0) GROUP BY ws")

ORACLES["ttl_replay_event_time"] = ORACLES["ttl_replay"]
ORACLES["backlog_episodes_live"] = ORACLES["backlog_episodes"]
ORACLES["assign_runs_stream"] = ORACLES["assign_runs"]

# Live totals: what follows the reset, which has the position of the middle of the log.
for _name in ("telemetry_totals", "telemetry_by_query_zone"):
    ORACLES[f"{_name}_live"] = ORACLES[_name].replace(
        "FROM telemetry", "FROM (SELECT * FROM telemetry WHERE seq > (SELECT (max(seq) + 1) // 2 FROM telemetry))")
