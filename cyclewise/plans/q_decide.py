"""Catalog entries: gates and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decide, evaluate
from ..sources import tables
from .q_ensemble import _long, _metrics_sql
from .registry import present, r, register
from .sqlviews import MEMBERS, MEMBERS_LONG, TELEMETRY_EVENTS, with_

AS_OF = "2002-01-01 00:00:00"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

R1_SQL = (
    "WITH st AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS nd, ("
    + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ORDER_COLS)
    + ") AS nulls, max(o_orderdate) AS last_ts, avg(o_totalprice) AS mu, stddev_pop(o_totalprice) AS sd FROM orders),\n"
    "o AS (SELECT count(*) FILTER (WHERE abs(o_totalprice - st.mu) > 3.0 * st.sd) AS o FROM orders, st),\n"
    "c AS (\n"
    "  SELECT 'minimum_samples' AS name, 1000.0 AS threshold, CAST(n AS DOUBLE) AS actual FROM st UNION ALL\n"
    f"  SELECT 'data_freshness', 24.0, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_ts)) / 3.6e9, 2) FROM st UNION ALL\n"
    f"  SELECT 'data_completeness', 0.05, nulls / greatest(n * {len(ORDER_COLS)}, 1) FROM st UNION ALL\n"
    "  SELECT 'no_duplicates', 0.01, (n - nd) / greatest(n, 1) FROM st UNION ALL\n"
    "  SELECT 'outlier_check', 0.02, o.o / greatest(st.n, 1) FROM o, st)\n"
    "SELECT name, threshold, " + r("actual") + " AS actual, CASE WHEN name = 'minimum_samples' THEN actual >= threshold ELSE actual <= threshold END AS passed,\n"
    " bool_and(CASE WHEN name = 'minimum_samples' THEN actual >= threshold ELSE actual <= threshold END) OVER () AS overall_passed FROM c"
)


def _r1(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders")
    return decide.quality_gate(orders, "o_orderkey", "o_orderdate", "o_totalprice", AS_OF)


@register("r1_data_quality_gate", R1_SQL)
def q_r1(spark, sf_dir):
    return present(_r1(spark, sf_dir))


def _shadow(spark, sf_dir):
    prod = tables.shadow_requests(spark, sf_dir, "forest")
    parts = []
    for cand in ("boosted", "sequence"):
        j = decide.shadow_join(prod, tables.shadow_requests(spark, sf_dir, cand), ["unit_id", "time_cycle"]).withColumn("candidate", F.lit(cand))
        parts.append(j)
    return decide.shadow_compare(parts[0].unionByName(parts[1]), by=["candidate"])


SHADOW_CTE = [
    TELEMETRY_EVENTS, MEMBERS,
    """sh AS (SELECT 'boosted' AS candidate, forest AS pp, y AS pl, forest IS NULL AS pe, boosted AS cp, y * 1.05 AS cl, boosted IS NULL AS ce FROM members
            UNION ALL SELECT 'sequence', forest, y, forest IS NULL, sequence, y * 1.2, sequence IS NULL FROM members)""",
    """agg AS (SELECT candidate, count(*) AS requests, count(*) FILTER (WHERE NOT pe AND NOT ce) AS comparisons,
             count(*) FILTER (WHERE NOT pe AND NOT ce AND abs(pp - cp) < 5) AS matches,
             count(*) FILTER (WHERE pe) AS prod_errors, count(*) FILTER (WHERE ce) AS cand_errors,
             round(avg(pl) FILTER (WHERE NOT pe), 2) AS prod_avg_latency_ms, round(avg(cl) FILTER (WHERE NOT ce), 2) AS cand_avg_latency_ms,
             list_sort(list(pl) FILTER (WHERE NOT pe)) AS pls, list_sort(list(cl) FILTER (WHERE NOT ce)) AS cls FROM sh GROUP BY candidate)""",
    """shadow AS (SELECT candidate, requests, comparisons, round(matches / comparisons, 4) AS prediction_match_rate, prod_avg_latency_ms, cand_avg_latency_ms,
             round(pls[CAST(floor(0.95 * len(pls)) AS INTEGER) + 1], 2) AS prod_p95_latency_ms, round(cls[CAST(floor(0.95 * len(cls)) AS INTEGER) + 1], 2) AS cand_p95_latency_ms,
             round(cand_avg_latency_ms / prod_avg_latency_ms, 4) AS latency_ratio,
             round(cand_errors / greatest(requests, 1) - prod_errors / greatest(requests, 1), 4) AS error_rate_diff FROM agg)""",
]
SHADOW_PASS = "prediction_match_rate >= 0.95 AND latency_ratio <= 1.1 AND error_rate_diff <= 0.01"


@register("j4_r2_shadow_comparison", with_(*SHADOW_CTE) + f"SELECT *, {SHADOW_PASS} AS passed FROM shadow")
def q_r2(spark, sf_dir):
    return _shadow(spark, sf_dir)


@register(
    "r3_x10_drift_event_filter",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'psi' WHEN 'error' THEN 'concept' WHEN 'view' THEN 'prediction' END AS drift_type,
  round(value / 100.0, 4) AS drift_score FROM events
WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 <> 0 AND round(value / 100.0, 4) >= 0.25 AND event_type IN ('click', 'error', 'view')""",
)
def q_r3(spark, sf_dir):
    ev = decide.drift_event_filter(decide.parse_drift_events(tables.drift_webhooks(spark, sf_dir)))
    return ev.select("event_id", F.col("event.drift_type").alias("drift_type"), F.col("event.drift_score").alias("drift_score"))


@register(
    "r4_alert_name_filter",
    """SELECT event_id, CASE WHEN k % 4 = 0 THEN 'NoPredictions' ELSE name END AS alertname FROM (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'click' THEN 'DataDriftDetected' WHEN 'error' THEN 'ConceptDriftDetected' WHEN 'view' THEN 'HighPredictionLatency'
              WHEN 'purchase' THEN 'CriticalDataDrift' WHEN 'signup' THEN 'PredictionDriftDetected' END AS name FROM events)
WHERE k % 4 <> 0 AND name IN ('DataDriftDetected', 'CriticalDataDrift', 'ConceptDriftDetected', 'PredictionDriftDetected')""",
)
def q_r4(spark, sf_dir):
    return decide.alert_filter(tables.alert_webhooks(spark, sf_dir)).select("event_id", "alertname")


R5_SQL = """SELECT event_id, source,
  CASE WHEN source = 'manual' THEN 0.0 ELSE coalesce(score, 0.3) END AS drift_score,
  CASE WHEN source = 'manual' THEN 'manual' ELSE coalesce(dtype, 'psi') END AS drift_type,
  CAST(coalesce(lb, 30) AS INTEGER) AS lookback_days,
  CASE WHEN source = 'manual' THEN 'manual-retraining' END AS experiment_name
FROM (SELECT event_id, ts, CASE WHEN event_type = 'signup' THEN 'manual' ELSE 'webhook' END AS source,
        CASE WHEN k % 7 = 0 THEN NULL ELSE round(value / 100.0, 4) END AS score,
        CASE event_type WHEN 'click' THEN 'psi' WHEN 'error' THEN 'concept' WHEN 'view' THEN 'prediction' WHEN 'purchase' THEN 'data' END AS dtype,
        CASE WHEN k % 5 = 0 THEN k END AS lb
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


@register("r5_payload_defaults", R5_SQL)
def q_r5(spark, sf_dir):
    d = decide.payload_defaults(decide.parse_drift_events(tables.drift_webhooks(spark, sf_dir)))
    return d.select("event_id", "source", "drift_score", "drift_type", "lookback_days", "experiment_name")


@register(
    "r6_x7_trigger_rate_limit",
    f"""SELECT event_id, source, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY trig, date_trunc('hour', ts) ORDER BY ts, event_id) AS rn FROM (
    SELECT event_id, ts, source, CASE WHEN source = 'manual' THEN 'manual' ELSE 'drift-webhook' END AS trig FROM ({R5_SQL.replace("SELECT event_id, source,", "SELECT event_id, ts, source,", 1)})
    WHERE source = 'manual' OR (drift_score >= 0.25 AND drift_type IN ('psi', 'concept', 'prediction'))))
WHERE source = 'manual' OR rn = 1""",
)
def q_r6(spark, sf_dir):
    ev = decide.payload_defaults(decide.parse_drift_events(tables.drift_webhooks(spark, sf_dir)))
    ok = ev.filter((F.col("source") == "manual") | ((F.col("drift_score") >= decide.TRIGGER_MIN_SCORE) & F.col("drift_type").isin(*decide.TRIGGER_TYPES)))
    ok = ok.withColumn("trigger", F.when(F.col("source") == "manual", "manual").otherwise("drift-webhook"))
    out = decide.rate_limit(ok, "trigger", "ts", ["ts", "event_id"])
    return out.select("event_id", "source", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register(
    "r7_retrain_plan",
    with_(*SHADOW_CTE, MEMBERS_LONG, "mm AS (" + _metrics_sql("members_long", ["model"], digits=4) + ")", "q AS (" + R1_SQL + ")")
    + f"""SELECT s.candidate, (SELECT bool_and(passed) FROM q) AS quality_passed, (p.rmse - c.rmse) / p.rmse >= 0.02 AS improved,
  {SHADOW_PASS.replace('prediction_match_rate', 's.prediction_match_rate')} AS shadow_passed,
  CASE WHEN NOT (SELECT bool_and(passed) FROM q) THEN 'quality_failed' WHEN NOT ((p.rmse - c.rmse) / p.rmse >= 0.02) THEN 'not_improved'
       WHEN NOT ({SHADOW_PASS}) THEN 'shadow_failed' ELSE 'promoted' END AS outcome
FROM shadow s JOIN mm c ON c.model = s.candidate JOIN mm p ON p.model = 'forest'""",
)
def q_r7(spark, sf_dir):
    quality = _r1(spark, sf_dir).agg(F.min(F.col("passed").cast("int")).alias("q")).first()["q"] == 1  # one scalar
    m = present(evaluate.regression_metrics(_long(spark, sf_dir), by=["model"]), 4)
    prod = m.filter(F.col("model") == "forest").select(F.col("rmse").alias("prod_rmse"))
    cand = m.select(F.col("model").alias("candidate"), F.col("rmse").alias("cand_rmse"))
    prod_rmse = prod.first()["prod_rmse"]  # one scalar
    sh = _shadow(spark, sf_dir).select("candidate", F.col("passed").alias("shadow_passed"))
    j = cand.join(sh, "candidate")
    improved = (F.lit(prod_rmse) - F.col("cand_rmse")) / F.lit(prod_rmse) >= evaluate.MIN_RMSE_IMPROVEMENT
    return j.select("candidate", F.lit(quality).alias("quality_passed"), improved.alias("improved"), "shadow_passed",
                    decide.retrain_plan(F.lit(quality), improved, F.col("shadow_passed")).alias("outcome"))


@register(
    "s13_lookback_manifest",
    """SELECT strftime(max(ts) - INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS start_date, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_date,
  (SELECT count(*) FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY) AS total_samples FROM events""",
)
def q_s13(spark, sf_dir):
    _, man = decide.lookback(tables.table(spark, sf_dir, "events"), "ts", days=7)
    return man.select(F.date_format("start_date", "yyyy-MM-dd HH:mm:ss").alias("start_date"), F.date_format("end_date", "yyyy-MM-dd HH:mm:ss").alias("end_date"), "total_samples")
