"""Driver tables and the telemetry stand-in views built from them.

The test tables hold no turbofan data, so two telemetry views stand in:

* ``telemetry_lineitem``: unit = supplier, cycle = shipping order, channels are the
  four numeric line measures.
* ``telemetry_events``: unit = user, cycle = event order, one channel ``value``.

Plus ``drift_long`` (reference vs current sample in long form) and
``prediction_log`` (a scored-request fact table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

LINEITEM_CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_CHANNELS = ["value"]

# The split instant between reference and current drift samples.
DRIFT_SPLIT_TS = "2024-01-16 00:00:00"
# Model names given to prediction_log rows by (k mod 3).
MODEL_TYPES = ["forest", "boosted", "sequence"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry_lineitem(spark: SparkSession, sf_dir: str, skew_safe: bool = False) -> DataFrame:
    """(unit_id bigint, time_cycle int, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate).

    The cycle is a dense 1..n per unit.  The order is made unique by the full key
    (shipdate, orderkey, linenumber, partkey); Spark sees through the alias so the
    row_number and any later per-unit window share one exchange.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("unit_id"),  # source type kept: unit filters push down to the scan
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", *LINEITEM_CHANNELS,
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    if skew_safe:  # positions over ranges: no unit is ever numbered in one task
        from ..operators.windows import dense_cycles

        d = dense_cycles(li, "unit_id", order)
        return d.select("unit_id", "time_cycle", *LINEITEM_CHANNELS, "l_shipdate")
    # partition by the derived key itself so later per-unit windows reuse this exchange
    w = Window.partitionBy("unit_id").orderBy(*order)
    return li.select(
        "unit_id",
        F.row_number().over(w).alias("time_cycle"),
        *LINEITEM_CHANNELS,
        "l_shipdate",
    )


def telemetry_events(spark: SparkSession, sf_dir: str, skew_safe: bool = False) -> DataFrame:
    """(unit_id bigint, time_cycle int, ts, event_type, value)."""
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("unit_id"), "ts", "event_id", "event_type", "value"
    )
    if skew_safe:
        from ..operators.windows import dense_cycles

        d = dense_cycles(ev, "unit_id", ["ts", "event_id"])
        return d.select("unit_id", "time_cycle", "ts", "event_type", "value")
    w = Window.partitionBy("unit_id").orderBy("ts", "event_id")
    return ev.select(
        "unit_id",
        F.row_number().over(w).alias("time_cycle"),
        "ts",
        "event_type",
        "value",
    )


def drift_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature, value, side) with side 'ref' before the split instant, 'cur' after."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("feature"),
        F.col("value"),
        F.when(F.col("ts") < F.lit(DRIFT_SPLIT_TS).cast("timestamp_ntz"), F.lit("ref"))
        .otherwise(F.lit("cur"))
        .alias("side"),
    )


def model_type_expr(k: F.Column) -> F.Column:
    idx = F.pmod(k, F.lit(3))
    return (
        F.when(idx == 0, F.lit(MODEL_TYPES[0]))
        .when(idx == 1, F.lit(MODEL_TYPES[1]))
        .otherwise(F.lit(MODEL_TYPES[2]))
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, ts, model_type, status, latency_s, unit_id, rul)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        model_type_expr(k).alias("model_type"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("success")).alias("status"),
        (F.col("value") / 1000.0).alias("latency_s"),
        F.col("user_id").alias("unit_id"),
        F.col("value").alias("rul"),
    )


def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored-request stream: per event, the forecast = mean of the same user's
    previous 5 values, the actual = the value; keyed by model_type.

    (model_type, ts, request_id, side, prediction, actual); events without
    history (first per user) carry no prediction and are left out.
    """
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-5, -1)
    out = ev.select(
        model_type_expr(k).alias("model_type"),
        "ts",
        F.col("event_id").alias("request_id"),
        F.when(F.col("ts") < F.lit(DRIFT_SPLIT_TS).cast("timestamp_ntz"), F.lit("ref")).otherwise(F.lit("cur")).alias("side"),
        F.avg("value").over(w).alias("prediction"),
        F.col("value").alias("actual"),
    )
    return out.filter(F.col("prediction").isNotNull())


def member_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic ensemble members over ``telemetry_events``: y = value;
    forest = previous value; boosted = mean of the previous 5 (from cycle 6);
    sequence = mean of the previous 20 (from cycle 21).  Missing = null."""
    t = telemetry_events(spark, sf_dir)
    w = Window.partitionBy("unit_id").orderBy("time_cycle")
    return t.select(
        "unit_id", "time_cycle", "ts",
        F.col("value").alias("y"),
        F.lag("value", 1).over(w).alias("forest"),
        F.when(F.col("time_cycle") > 5, F.avg("value").over(w.rowsBetween(-5, -1))).alias("boosted"),
        F.when(F.col("time_cycle") > 20, F.avg("value").over(w.rowsBetween(-20, -1))).alias("sequence"),
    )


# Stand-in webhook payload mapping from event type.
EVENT_DRIFT_TYPE = {"click": "psi", "error": "concept", "view": "prediction", "purchase": "data"}
EVENT_ALERT_NAME = {
    "click": "DataDriftDetected", "error": "ConceptDriftDetected", "view": "HighPredictionLatency",
    "purchase": "CriticalDataDrift", "signup": "PredictionDriftDetected",
}


def _case(col: str, mapping: dict) -> F.Column:
    e = None
    for k, v in mapping.items():
        e = F.when(F.col(col) == k, F.lit(v)) if e is None else e.when(F.col(col) == k, F.lit(v))
    return e


def drift_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift-event webhook bodies (JSON text) derived from ``events``:
    (event_id, ts, source, body).  Some scores / lookbacks are absent so the
    defaults apply; sign-ups stand for manual triggers."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    body = F.to_json(F.struct(
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.round(F.col("value") / 100.0, 4)).alias("drift_score"),
        _case("event_type", EVENT_DRIFT_TYPE).alias("drift_type"),
        F.array(F.col("event_type")).alias("features_affected"),
        F.lit("rul-model").alias("model_name"),
        F.when(k % 5 == 0, k.cast("int")).alias("data_lookback_days"),
    ))
    return ev.select(
        "event_id", "ts",
        F.when(F.col("event_type") == "signup", F.lit("manual")).otherwise(F.lit("webhook")).alias("source"),
        body.alias("body"),
    )


def alert_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert-notification webhook bodies derived from ``events``: (event_id, ts, body);
    every fourth payload carries a non-drift alert first."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    main = F.struct(
        F.create_map(F.lit("alertname"), _case("event_type", EVENT_ALERT_NAME), F.lit("drift_type"), F.coalesce(_case("event_type", EVENT_DRIFT_TYPE), F.lit("psi"))).alias("labels"),
        F.create_map(F.lit("drift_score"), F.round(F.col("value") / 100.0, 4).cast("string")).alias("annotations"),
    )
    other = F.struct(
        F.create_map(F.lit("alertname"), F.lit("NoPredictions"), F.lit("drift_type"), F.lit("none")).alias("labels"),
        F.create_map(F.lit("drift_score"), F.lit("0")).alias("annotations"),
    )
    alerts = F.when(k % 4 == 0, F.array(other, main)).otherwise(F.array(main))
    return ev.select("event_id", "ts", F.to_json(F.struct(alerts.alias("alerts"))).alias("body"))


def shadow_requests(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """Per-request records of one ensemble member as a deployed model:
    (unit_id, time_cycle, prediction, latency_ms, error)."""
    m = member_forecasts(spark, sf_dir)
    factor = {"forest": 1.0, "boosted": 1.05, "sequence": 1.2}[model]
    return m.select(
        "unit_id", "time_cycle", F.col(model).alias("prediction"),
        (F.col("y") * F.lit(factor)).alias("latency_ms"), F.col(model).isNull().alias("error"),
    )
