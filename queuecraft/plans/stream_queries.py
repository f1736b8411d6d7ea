"""Event streams run to the end of what has arrived, read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuecraft.operators import drift
from queuecraft.plans import views as V
from queuecraft.plans.registry import query, rounded
from queuecraft.streaming import events as E
from queuecraft.streaming import windows as W

WEIGHTS, INTERCEPT, TOP_AT, MIDDLE_AT = {"value": 0.05, "hour_of_day": 0.02}, -1.0, 0.85, 0.6
LATENESS = "1 hour"
WIDTH = "1 day"


def _stream(spark, sf):
    schema = V.table(spark, sf, "events").schema
    return E.read_stream(spark, sf, "events.parquet", schema, "ts").withColumn("hour_of_day", F.hour("ts").cast("double"))


@query("stream_score", f"""
SELECT event_id, round(s, 9) AS score, CASE WHEN s >= {TOP_AT} THEN 'SIU' WHEN s >= {MIDDLE_AT} THEN 'Manual Review' ELSE 'Approve' END AS bucket
FROM (SELECT event_id, 1 / (1 + exp(-({INTERCEPT} + 0.05::DOUBLE * value + 0.02::DOUBLE * hour(ts)))) AS s FROM events)""")
def stream_score(spark, sf):
    scored = E.score_events(_stream(spark, sf), WEIGHTS, INTERCEPT, TOP_AT, MIDDLE_AT).select("event_id", "score", "bucket")
    return rounded(E.run_to_end(scored, "stream-score"), 9)


QUEUES = {"top_count": 85.0, "middle_count": 60.0}


def _window_sql(closed: str) -> str:
    return f"""WITH b AS (SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS w, value, event_type FROM events)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_rows, round(avg((event_type = 'error')::INT), 6) AS flag_rate,
       round(avg(value), 6) AS mean_value, round(stddev_pop(value), 6) AS std_value, min(value) AS min_value, max(value) AS max_value,
       count(*) FILTER (WHERE value >= 85) AS top_count, count(*) FILTER (WHERE value >= 60 AND value < 85) AS middle_count,
       """ + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {name}" for name, p in W.QUANTILES.items()) + f"""
FROM b GROUP BY w{closed}"""


_CLOSED = " HAVING w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


def _profiled(counts):
    return W.profile(counts, "value", QUEUES)


def _dated(df):
    return rounded(df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


@query("stream_window_stats", _window_sql(_CLOSED))
def stream_window_stats(spark, sf):
    """Closed windows only: a window is written once, when the watermark has passed its end."""
    edges = drift.order_edges(V.table(spark, sf, "events"), ["value"])
    counts = W.value_counts(_stream(spark, sf), "ts", WIDTH, ["value"], edges, F.col("event_type") == "error", LATENESS)
    return _dated(W.close_windows(counts, "stream-windows", _profiled))


@query("window_stats", _window_sql(""))
def window_stats(spark, sf):
    """The same aggregate over the stored events, all windows."""
    events = V.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    edges = drift.order_edges(events, ["value"])
    return _dated(_profiled(W.value_counts(events, "ts", WIDTH, ["value"], edges, F.col("event_type") == "error")))


_FEATURES = "[{'feature': 'value', 'v': value}, {'feature': 'k', 'v': json_extract_string(props, '$.k')::DOUBLE}, {'feature': 'hour_of_day', 'v': hour(ts)::DOUBLE}]"
_DRIFT_SQL = f"""WITH long AS (
  SELECT w, f.feature, f.v AS v FROM (SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS w, {_FEATURES} AS fs FROM events), unnest(fs) AS t(f)
  WHERE f.v IS NOT NULL), reference AS (
  SELECT feature, v, sum(n) OVER (PARTITION BY feature ORDER BY v) AS c0, sum(n) OVER (PARTITION BY feature) AS t0
  FROM (SELECT feature, v, count(*) AS n FROM long GROUP BY ALL)), own AS (
  SELECT w, feature, v, count(*) AS n FROM long GROUP BY ALL HAVING w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR), gaps AS (
  SELECT p.w, r.feature, c0, t0, sum(coalesce(n, 0)) OVER (PARTITION BY p.w, r.feature ORDER BY r.v) AS c, sum(coalesce(n, 0)) OVER (PARTITION BY p.w, r.feature) AS t
  FROM (SELECT DISTINCT w, feature FROM own) p JOIN reference r USING (feature) LEFT JOIN own o ON o.w = p.w AND o.feature = r.feature AND o.v = r.v), ks AS (
  SELECT w, feature, max(t0)::BIGINT AS n_reference, max(t)::BIGINT AS n_window, max(abs(c::DOUBLE / t - c0::DOUBLE / t0)) AS distance FROM gaps GROUP BY ALL), tests AS (
  SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
         lambda i: (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * i * i * lam * lam))))) END AS p_value
  FROM (SELECT *, sqrt(n_reference::DOUBLE * n_window / (n_reference + n_window)) * distance AS lam FROM ks WHERE n_reference > 10 AND n_window > 10)), scaled AS (
  SELECT *, p_value * count(*) OVER (PARTITION BY w) / row_number() OVER (PARTITION BY w ORDER BY p_value, feature) AS s FROM tests), adjusted AS (
  SELECT *, least(1.0, min(s) OVER (PARTITION BY w ORDER BY p_value, feature ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adjusted FROM scaled)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, feature, n_reference, n_window, round(distance, 6) AS distance, round(p_value, 6) AS p_value,
       round(p_adjusted, 6) AS p_adjusted, p_adjusted < 0.05 AS drift FROM adjusted"""


@query("stream_drift", _DRIFT_SQL)
def stream_drift(spark, sf):
    """Every feature of every closed window against the stored events as the reference, exactly; p-values are adjusted
    inside the window, and rows are appended per micro-batch."""
    features = ["value", "k", "hour_of_day"]
    number = F.get_json_object("props", "$.k").cast("double")
    stored = V.table(spark, sf, "events").withColumn("hour_of_day", F.hour("ts").cast("double")).withColumn("k", number)
    edges = drift.order_edges(stored, features)
    reference = W.reference_counts(stored, features, edges)
    counts = W.value_counts(_stream(spark, sf).withColumn("k", number), "ts", WIDTH, features, edges, lateness=LATENESS)
    return _dated(W.close_windows(counts, "stream-drift", lambda closed: W.window_tests(closed, reference)))
