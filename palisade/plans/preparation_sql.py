"""DuckDB SQL for the preparation queries that SQL can express."""

SQL = {
    "p2_found": r"""
WITH ev AS (
  SELECT 'c' AS kind, uid, -1 AS depth, lower(regexp_replace(id_origin_host, '^\s+|\s+$', '', 'g')) AS host,
         epoch_us("timestamp") AS us, ingest_time FROM zeek_conn
  UNION ALL
  SELECT 'h', uid, trans_depth, lower(regexp_replace(id_origin_host, '^\s+|\s+$', '', 'g')),
         epoch_us("timestamp"), ingest_time FROM zeek_http),
one AS (
  SELECT host, us FROM ev WHERE host <> '' AND us IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY kind, uid, depth ORDER BY ingest_time, us, host) = 1),
cut AS (
  SELECT host, us, CASE WHEN us - lag(us) OVER (PARTITION BY host ORDER BY us) <= 1800000000 THEN 0 ELSE 1 END AS opens FROM one),
numbered AS (
  SELECT host, us, sum(opens) OVER (PARTITION BY host ORDER BY us ROWS UNBOUNDED PRECEDING) AS n FROM cut)
SELECT host AS id_origin_host, min(us) AS start_us, max(us) AS end_us, count(*) AS n_events
FROM numbered GROUP BY host, n""",
    "p1_zeek_ts": r"""
WITH k AS (SELECT log_file, CASE WHEN regexp_full_match(ts, '\d+\.\d+') THEN 'decimal' WHEN regexp_full_match(ts, '\d+') THEN 'integer' ELSE 'text' END AS form, count(*) AS n
  FROM zeek_conn WHERE log_file IS NOT NULL AND ts IS NOT NULL GROUP BY ALL),
f AS (SELECT log_file, form FROM k QUALIFY row_number() OVER (PARTITION BY log_file ORDER BY n DESC, form DESC) = 1),
c AS (SELECT log_file, form, lag(form) OVER (PARTITION BY regexp_extract(log_file, '^(.*)/[^/]*$', 1) ORDER BY log_file) AS before FROM f)
SELECT log_file AS source_file, 'ts' AS field, 'retyped' AS change, '' AS new_field FROM c WHERE form <> before""",
    "p7_zeek_hours": """
WITH e AS (SELECT uid, epoch_us("timestamp") AS us, min(epoch_us(ingest_time)) AS arr FROM zeek_conn
  WHERE "timestamp" IS NOT NULL AND uid IS NOT NULL AND ingest_time IS NOT NULL GROUP BY ALL),
h AS (SELECT us, arr, us // 3600000000 * 3600000000 AS hour_start FROM e),
k AS (SELECT us, arr, hour_start, us - lag(us) OVER (PARTITION BY hour_start ORDER BY us) AS gap FROM h WHERE arr <= hour_start + 3600000000 * 25)
SELECT 'zeek_conn' AS src, hour_start, CAST(count(*) FILTER (arr <= hour_start + 4200000000) AS BIGINT) AS n_first, count(*) AS n_final,
  min(us) AS first_us, max(us) AS last_us, coalesce(max(gap), 0) AS max_gap_us FROM k GROUP BY hour_start""",
    "p5_found": """
SELECT row_id FROM (
  SELECT row_id, row_number() OVER (PARTITION BY sha256(message) ORDER BY kafka_ts NULLS LAST, row_id) AS k
  FROM threatintel WHERE message IS NOT NULL) WHERE k > 1""",
}
