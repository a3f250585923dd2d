"""DuckDB text of the derived input tables, for use in check queries."""

POSTS = """
posts AS (
SELECT event_id AS post_id, ts, user_id,
  concat('post ', CAST(event_id AS STRING), ' #', event_type,
    CASE WHEN event_id % 17 = 0 OR CAST(ts AS DATE) = DATE '2024-01-15' THEN ' #Breaking' ELSE '' END,
    CASE WHEN event_id % 10 = 0 THEN ' @user7' ELSE '' END) AS text,
  CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 7 = 1 THEN 'EN-us' ELSE lang END AS lang,
  CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE least(value / CAST(100 AS DOUBLE) - CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE)) END AS sentiment
FROM events LEFT JOIN documents ON event_id % (SELECT count(*) FROM documents) = doc_id)"""

PASSENGERS = """
passengers AS (
SELECT o_orderkey AS passenger_id,
  CAST(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS INT) AS survived,
  least(CAST(substr(o_orderpriority,1,1) AS INT),3) AS pclass,
  CASE WHEN o_custkey % 3 = 0 THEN 'female' ELSE 'male' END AS sex,
  concat('Surname', CAST(o_custkey AS STRING), ', ',
    CASE WHEN o_orderkey % 101 = 0 THEN 'Dr' WHEN o_orderkey % 103 = 0 THEN 'Rev' WHEN o_orderkey % 107 = 0 THEN 'the Countess'
         WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'Mrs' WHEN o_custkey % 3 = 0 THEN 'Miss'
         WHEN o_orderkey % 11 = 0 THEN 'Master' ELSE 'Mr' END, '. Given') AS name,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE CAST(o_custkey % 80 AS DOUBLE) + CAST(o_orderkey % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS age,
  CAST(o_orderkey % 9 AS INT) AS sibsp, CAST(o_custkey % 7 AS INT) AS parch,
  concat('T', CAST(o_orderkey % 1000 AS STRING)) AS ticket,
  CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice / CAST(1000 AS DOUBLE) END AS fare,
  CASE WHEN o_orderkey % 13 < 10 THEN CAST(NULL AS STRING)
       ELSE concat(substr('ABCDEFG', CAST(o_custkey % 7 AS INT) + 1, 1), CAST(o_orderkey % 120 AS STRING)) END AS cabin,
  CASE WHEN o_orderkey % 500 = 0 THEN CAST(NULL AS STRING) WHEN c_mktsegment = 'AUTOMOBILE' THEN 'C'
       WHEN c_mktsegment = 'BUILDING' THEN 'Q' ELSE 'S' END AS embarked
FROM orders JOIN customer ON o_custkey = c_custkey)"""

REQUEST_LOG = """
request_log AS (
SELECT event_id AS request_id, ts, CASE WHEN user_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version,
  CASE WHEN event_type='error' THEN 500 ELSE 200 END AS status, value AS latency_ms,
  CAST((event_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS confidence
FROM events)"""

PREDICTIONS = """
predictions AS (
SELECT o_orderkey AS passenger_id, CAST(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS INT) AS label,
  CAST((o_orderkey * 7919) % 750 + CASE WHEN o_orderstatus='F' THEN 249 ELSE 0 END AS DOUBLE) / CAST(1000 AS DOUBLE) AS score
FROM orders)"""

TRIALS = """
trials AS (
SELECT p_partkey % 50 AS trial, CAST(floor(p_partkey / 50) AS BIGINT) AS study,
  3 + p_size % 8 AS max_depth, CAST(p_size AS DOUBLE) / CAST(170 AS DOUBLE) AS learning_rate,
  CAST((p_partkey * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS auc,
  CAST((p_partkey * 104729) % 97 AS INT) AS model_kb
FROM part)"""

FEATURE_VALUES = """
feature_values AS (
SELECT l_suppkey AS entity_id, l_shipdate AS feature_ts, max(l_quantity) AS quantity, count(*) AS n_items
FROM lineitem GROUP BY l_suppkey, l_shipdate)"""

VERSIONS = (
    TRIALS
    + """,
versions AS (
SELECT 'model' || CAST(study AS VARCHAR) AS name, CAST(trial + 1 AS INT) AS version,
  CASE WHEN trial % 7 = 3 THEN 'Production' WHEN trial % 7 = 5 THEN 'Archived' ELSE 'Staging' END AS stage,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(trial * 7 AS INT)) AS trained_at,
  auc, CAST(model_kb AS DOUBLE) AS model_kb, max_depth, trial
FROM trials)"""
)

TAGGED = (
    POSTS
    + """,
tagged AS (
SELECT DISTINCT * EXCLUDE (raw), lower(raw) AS hashtag
FROM (SELECT *, unnest(regexp_extract_all(text, '#([\\p{L}\\p{N}_]+)', 1)) AS raw FROM posts)),
counts AS (
SELECT hashtag, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
  coalesce(sum(sentiment), 0) AS sentiment_sum, count(sentiment) AS sentiment_n
FROM tagged GROUP BY ALL)"""
)

DENSE = (
    TAGGED
    + """,
slots AS (
SELECT hashtag, unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 DAY)) AS window_start
FROM counts GROUP BY hashtag),
dense AS (
SELECT hashtag, window_start, coalesce(n, 0) AS n, coalesce(sentiment_sum, 0) AS sentiment_sum,
  coalesce(sentiment_n, 0) AS sentiment_n
FROM slots LEFT JOIN counts USING (hashtag, window_start))"""
)

STATS = """
stats AS (
SELECT *, count(*) OVER b AS history, avg(n) OVER b AS baseline_mean,
  stddev_samp(n) OVER b AS baseline_std,
  CASE WHEN sum(sentiment_n) OVER b > 0 THEN sum(sentiment_sum) OVER b / sum(sentiment_n) OVER b END
    AS baseline_sentiment
FROM dense
WINDOW b AS (PARTITION BY hashtag ORDER BY window_start ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
scored AS (
SELECT *, CASE WHEN history >= 2 AND baseline_std > 0 THEN (n - baseline_mean) / baseline_std END AS zscore,
  n / nullif(baseline_mean, 0) AS magnitude,
  CASE WHEN sentiment_n > 0 THEN sentiment_sum / sentiment_n END - baseline_sentiment AS sentiment_shift
FROM stats)"""

SCORED = f"{DENSE},{STATS}"


def bucket(key: str, seed: int, buckets: int) -> str:
    """DuckDB text of the seeded md5 bucket."""
    return f"{draw(key, seed)} % {buckets}"


def draw(key: str, seed: int) -> str:
    return f"CAST(('0x'||substr(md5(concat(CAST({key} AS VARCHAR),':{seed}')),1,8)) AS BIGINT)"
