"""Declarative streaming monitors (X5, X8, X10, X7): watermarks, event-time windows,
update-mode aggregates and stateless filters.

Late data policy (not in the reference): watermark 10 minutes; later rows are
dropped by the state store and counted in ``StreamingQueryProgress``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decide
from ..sources import tables
from .runner import with_event_time

WATERMARK = "10 minutes"


def prediction_log_stream(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return with_event_time(events).select(
        "event_time", F.col("event_id").alias("request_id"), tables.model_type_expr(k).alias("model_type"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 1000.0).alias("latency_s"), F.col("user_id").alias("unit_id"), F.col("value").alias("rul"),
    )


def sliding_rates(log: DataFrame, width: str = "5 minutes", slide: str = "30 seconds", watermark: str = WATERMARK) -> DataFrame:
    """Per (window, model, status): count, rate, latency sum; append mode
    emits a window once the watermark passes its end.

    Two chained stateful aggregations: raw rows are counted per ``slide`` slot
    first, and only the slot rows are fanned out to the ``width / slide``
    sliding windows (``window_time`` carries the slot's event time), so the
    state store and the shuffle see one row per slot instead of ten per event."""
    slots = (
        log.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", slide).alias("s"), "model_type", "status")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("latency_s").alias("latency_sum"))
    )
    count, unit = width.split()
    width_s = int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit.rstrip("s")]
    return (
        slots.groupBy(F.window(F.window_time("s"), width, slide).alias("w"), "model_type", "status")
        .agg(F.sum("n").alias("n"), F.sum("latency_sum").alias("latency_sum"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "model_type", "status", "n",
                (F.col("n") / float(width_s)).alias("rate"), "latency_sum")
    )


def latest_gauge(log: DataFrame) -> DataFrame:
    """Latest RUL per unit, update mode (max_by over (time, request))."""
    return log.groupBy("unit_id").agg(F.max_by("rul", F.struct("event_time", "request_id")).alias("rul"))


def drift_event_stream(raw: DataFrame) -> DataFrame:
    """Webhook bodies -> typed events -> R3 filter (stateless)."""
    return decide.drift_event_filter(decide.parse_drift_events(raw))
