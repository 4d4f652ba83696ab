"""The FIXTURES.md views as DuckDB SQL, inlined as CTEs by each oracle."""

US = "epoch_us(ts)"

VIEWS = {
    "telemetry": f"""
SELECT event_id AS seq,
  CAST({US} AS DOUBLE) / CAST(1000000 AS DOUBLE) AS timestamp,
  CASE WHEN event_type IN ('view','click') THEN 'hit'
       WHEN event_type = 'purchase' THEN 'miss'
       WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'dlq'
       WHEN event_type = 'error' THEN 'retry'
       WHEN event_id % 4 = 0 THEN 'consumer_lag'
       WHEN event_id % 4 = 1 THEN 'recovery_time'
       ELSE 'recovery' END AS event_type,
  CASE WHEN event_id % 10 < 4 THEN 'Q1' WHEN event_id % 10 < 6 THEN 'Q2'
       WHEN event_id % 10 < 8 THEN 'Q3' WHEN event_id % 10 = 8 THEN 'Q4' ELSE 'Q5' END AS query_type,
  CASE WHEN user_id % 10 < 5 THEN 'Z1' WHEN user_id % 10 < 7 THEN 'Z2'
       WHEN user_id % 10 = 7 THEN 'Z3' WHEN user_id % 10 = 8 THEN 'Z4' ELSE 'Z5' END AS zone_id,
  'key:' || CAST(event_id % 70 AS STRING) AS cache_key,
  value AS latency_ms
FROM events""",
    "requests": f"""
SELECT event_id AS seq,
  CAST({US} AS DOUBLE) / CAST(1000000 AS DOUBLE) AS t_start,
  CASE WHEN event_id % 50 = 7 THEN 'Z9'
       WHEN user_id % 10 < 5 THEN 'Z1' WHEN user_id % 10 < 7 THEN 'Z2'
       WHEN user_id % 10 = 7 THEN 'Z3' WHEN user_id % 10 = 8 THEN 'Z4' ELSE 'Z5' END AS zone_id,
  CASE WHEN event_id % 50 = 13 THEN 'Q6'
       WHEN event_id % 10 < 4 THEN 'Q1' WHEN event_id % 10 < 6 THEN 'Q2'
       WHEN event_id % 10 < 8 THEN 'Q3' WHEN event_id % 10 = 8 THEN 'Q4' ELSE 'Q5' END AS query_type,
  CASE WHEN event_id % 3 = 0 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 3 = 1 THEN CAST('0.5' AS DOUBLE) ELSE CAST('0.7' AS DOUBLE) END AS confidence_min,
  CASE WHEN event_id % 4 < 2 THEN 5 ELSE 10 END AS bins,
  CASE WHEN event_id % 10 = 8 AND event_id % 50 <> 28
       THEN CASE WHEN user_id % 10 < 5 THEN 'Z2' ELSE 'Z1' END END AS zone_id_b,
  CAST(event_id % 5 AS INT) AS attempt_retries
FROM events""",
    "buildings_raw": """
SELECT
  CAST('-33.54' AS DOUBLE) + CAST('0.16' AS DOUBLE) *
    (CAST((l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 104729) % 100000 AS DOUBLE) / CAST(100000 AS DOUBLE)) AS latitude,
  CAST('-70.82' AS DOUBLE) + CAST('0.28' AS DOUBLE) *
    (CAST((l_orderkey * 6101 + l_partkey * 577 + l_linenumber * 15485863) % 100000 AS DOUBLE) / CAST(100000 AS DOUBLE)) AS longitude,
  CASE WHEN l_partkey % 97 = 0 THEN NULL
       ELSE l_quantity * CAST(4 AS DOUBLE) + CAST(l_linenumber AS DOUBLE) / CAST(2 AS DOUBLE) END AS area_in_meters,
  CAST((l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE) AS confidence,
  CASE WHEN l_partkey % 89 = 0 THEN 'POLYGON EMPTY'
       ELSE 'POINT (-70.' || LPAD(CAST(l_orderkey * 6101 % 1000000 AS STRING), 6, '0')
            || ' -33.' || LPAD(CAST(l_partkey * 7919 % 1000000 AS STRING), 6, '0') || ')' END AS geometry
FROM lineitem""",
    "zones": """
SELECT priority, zone_id, name, CAST(a AS DOUBLE) AS lat_min, CAST(b AS DOUBLE) AS lat_max,
  CAST(c AS DOUBLE) AS lon_min, CAST(d AS DOUBLE) AS lon_max, CAST(r AS DOUBLE) AS ref_lat
FROM (VALUES
  (1, 'Z1', 'Providencia',     '-33.445', '-33.420', '-70.640', '-70.600', '33.43'),
  (2, 'Z2', 'Las Condes',      '-33.420', '-33.390', '-70.600', '-70.550', '33.405'),
  (3, 'Z3', 'Maipu',           '-33.530', '-33.490', '-70.790', '-70.740', '33.51'),
  (4, 'Z4', 'Santiago Centro', '-33.460', '-33.430', '-70.670', '-70.630', '33.445'),
  (5, 'Z5', 'Pudahuel',        '-33.470', '-33.430', '-70.810', '-70.760', '33.45')
) AS t(priority, zone_id, name, a, b, c, d, r)""",
    "offsets": f"""
SELECT event_id AS seq, user_id % 3 AS consumer_id, event_id AS msg_offset,
  event_id + 1 + CASE WHEN event_id % 97 > 50 THEN event_id % 97 - 50 ELSE 0 END AS high_watermark,
  CAST({US} AS DOUBLE) / CAST(1000000 AS DOUBLE) AS processed_at
FROM events""",
    "runs": """
SELECT i AS run_id,
  CASE WHEN i < 3 THEN 'dist_comparison' WHEN i < 6 THEN 'policy_comparison'
       WHEN i < 9 THEN 'size_comparison' ELSE 'ttl_comparison' END AS experiment,
  CAST(1704067200 + (i - 1) * 259200 AS DOUBLE) AS start_time,
  CAST(1704067200 + (i - 1) * 259200 + 216000 AS DOUBLE) AS end_time,
  CASE WHEN i = 2 THEN 'uniform' ELSE 'zipf' END AS distribution,
  CASE WHEN i = 4 THEN 'LFU' WHEN i = 5 THEN 'FIFO/Random' ELSE 'LRU' END AS eviction_policy,
  CASE WHEN i = 6 THEN '50mb' WHEN i = 8 THEN '500mb' ELSE '200mb' END AS maxmemory,
  CASE WHEN i = 9 THEN 30 WHEN i = 10 THEN 60 ELSE 300 END AS ttl,
  CASE WHEN i = 10 THEN 0 ELSE 500 END AS sent,
  CASE WHEN i = 10 THEN 0 ELSE 400 + i * 7 END AS hits,
  CASE WHEN i = 10 THEN 0 ELSE 100 - i * 7 END AS misses,
  0 AS evicted_keys
FROM (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10)) AS t(i)""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named fixture views as CTEs (a body may add more CTEs)."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
