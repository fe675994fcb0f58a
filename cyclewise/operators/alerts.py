"""Alert rules over metric series of any label set (O11): one rule table, one plan.

A series is rows (metric, labels, at, value) with a map of labels; which labels a metric has is its own
affair.  Every sample holds for an interval: that of a window metric for one step of its grid, that of
a gauge until the next sample of the series.  Samples meet the rules of their metric; true intervals
that touch form an island; an island fires once it has lasted the rule's hold time.

A label map is grouped and joined by its canonical text (sorted ``name=value`` pairs).  The next sample
of a series and the start of an island come from ranges of the series (``scan.ranged``) and one row for
a series and range, so no series is ever ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import join_small
from .scan import ranged

# Name, metric, comparison, threshold, hold seconds, severity.
RULES = [
    ("HighPredictionLatency", "latency_p95", ">", 1.0, 300, "warning"),
    ("CriticalPredictionLatency", "latency_p99", ">", 2.0, 120, "critical"),
    ("HighPredictionErrorRate", "error_ratio", ">", 0.05, 300, "warning"),
    ("CriticalPredictionErrorRate", "error_ratio", ">", 0.1, 120, "critical"),
    ("NoPredictions", "request_rate", "==", 0.0, 300, "warning"),
    ("DataDriftDetected", "drift_psi", ">", 0.25, 600, "warning"),
    ("CriticalDataDrift", "drift_psi", ">", 0.4, 300, "critical"),
    ("ConceptDriftDetected", "concept_drift", "==", 1.0, 600, "warning"),
    ("PredictionDriftDetected", "prediction_drift", "==", 1.0, 600, "warning"),
    ("InferenceServiceNotReady", "ready", "==", 0.0, 300, "warning"),
    ("HighCPUUsage", "cpu_share", ">", 0.9, 600, "warning"),
    ("HighMemoryUsage", "memory_share", ">", 0.9, 600, "warning"),
    ("TrackingServerUnavailable", "up", "==", 0.0, 300, "critical"),
    ("CriticalRULPrediction", "rul", "<", 10.0, 60, "critical"),
    ("WarningRULPrediction", "rul", "<", 25.0, 300, "warning"),
    ("PredictionLatencySLOBreach", "latency_slo_share", "<", 0.99, 300, "warning"),
    ("PredictionAvailabilitySLOBreach", "success_share_1h", "<", 0.999, 600, "critical"),
    ("HighPredictionVolume", "total_rate", ">", 100.0, 600, "info"),
    ("ScaleUpRecommended", "scale_up", "==", 1.0, 600, "info"),
]


def rule_table(spark: SparkSession, rules: Sequence[tuple] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "rule string, metric string, op string, threshold double, hold_s int, severity string")


def label_text(labels: Column) -> Column:
    """``a=1,b=2`` in the order of the names.  Maps of one label need no sorting (lambdas are not compiled)."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    one = F.concat(F.element_at(F.map_keys(labels), 1), F.lit("="), F.element_at(F.map_values(labels), 1))
    return F.when(F.size(labels) == 0, "").when((F.size(labels) == 1) & F.element_at(F.map_values(labels), 1).isNotNull(), one).otherwise(F.array_join(pairs, ","))


def labels_of(**columns: Column) -> Column:
    """A label map; labels without a value are left out."""
    none = F.create_map().cast("map<string,string>")
    maps = [F.when(c.isNull(), none).otherwise(F.create_map(F.lit(n), c.cast("string"))) for n, c in columns.items()]
    return F.map_concat(*maps) if len(maps) > 1 else maps[0]


def window_series(df: DataFrame, metric: str, labels: Column, value: Column, step_s: int, start: str = "window_start") -> DataFrame:
    """Samples of a window metric: each holds from its window's start for one step (microseconds)."""
    at = F.unix_micros(F.col(start).cast("timestamp"))
    return df.select(F.lit(metric).alias("metric"), labels.alias("labels"), at.alias("since"), (at + F.lit(step_s * 1_000_000)).alias("until"), value.cast("double").alias("value"))


def gauge_samples(df: DataFrame, metric: str, labels: Column, value: Column, ts: str, tie: str) -> DataFrame:
    """Samples of a gauge: (metric, labels, since, _tie, value), to be held by ``hold``."""
    return df.select(F.lit(metric).alias("metric"), labels.alias("labels"), F.unix_micros(F.col(ts).cast("timestamp")).alias("since"), F.col(tie).alias("_tie"), value.cast("double").alias("value"))


def hold(samples: DataFrame, end: Column) -> DataFrame:
    """Samples of any gauges: each holds until the next one of its metric and labels, the last until ``end`` (microseconds).

    The next sample is in the same range, or the first of the series' next range (one row for a series and range)."""
    keys = ["metric", "_key"]
    # written before the ranges are sampled: samples may be dear to compute
    b = ranged(cut_lineage(samples.filter("since IS NOT NULL").withColumn("_key", label_text(F.col("labels")))), keys, ["since", "_tie"])
    firsts = b.groupBy(*keys, "_bkt").agg(F.min("since").alias("_first"))
    firsts = firsts.withColumn("_first", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bkt")))
    after = F.lead("since").over(Window.partitionBy(*keys, "_bkt").orderBy("since", "_tie"))
    held = join_small(b.withColumn("_next", after), firsts, on=[*keys, "_bkt"]).select("metric", "labels", "since", F.coalesce("_next", "_first", end).alias("until"), "value")
    return held.filter("until > since")  # of samples at one instant the last holds


def gauge_series(df: DataFrame, metric: str, labels: Column, value: Column, ts: str, tie: str, end: Column) -> DataFrame:
    """Samples of one gauge, held (several gauges meet in one ``hold``)."""
    return hold(gauge_samples(df, metric, labels, value, ts, tie), end)


def evaluate(series: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule, severity, labels, started_at, ended_at, fired_at) of every island that lasts its hold time.

    ``ranged`` writes the true intervals once, however many metrics they come from.  Islands are formed
    within the ranges; the first one of a range goes on with the last one before it if they touch, which
    is settled with one row for a series and range."""
    met = join_small(series.filter("value IS NOT NULL"), rules, on=["metric"], known_small=True)
    over = F.expr("CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold ELSE value = threshold END")
    true = met.filter(over).select("rule", "severity", "hold_s", label_text(F.col("labels")).alias("key"), "since", "until")
    keys = ["rule", "severity", "hold_s", "key"]
    b = ranged(cut_lineage(true), keys, ["since"])
    w = Window.partitionBy(*keys, "_bkt").orderBy("since")
    marked = b.withColumn("_prev", F.lag("until").over(w)).withColumn("_start", F.expr("CASE WHEN _prev <> since THEN since END"))
    begun = marked.withColumn("_begun", F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = begun.groupBy(*keys, "_bkt", "_begun").agg(F.min("since").alias("_since"), F.max("until").alias("ended"))
    along = Window.partitionBy(*keys).orderBy("_bkt")
    edges = parts.groupBy(*keys, "_bkt").agg(F.min("_since").alias("_first"), F.max("_begun").alias("_last"), F.max("ended").alias("_until"))
    edges = edges.withColumn("_own", F.when(F.coalesce(F.lag("_until").over(along) != F.col("_first"), F.lit(True)), F.col("_first")))
    carried = F.max(F.coalesce("_last", "_own")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select(*keys, "_bkt", F.coalesce("_own", carried).alias("_open"))
    whole = join_small(parts, edges, on=[*keys, "_bkt"])
    islands = whole.groupBy(*keys, F.coalesce("_begun", "_open").alias("started")).agg(F.max("ended").alias("ended"))
    fired = F.col("started") + F.col("hold_s") * F.lit(1_000_000)
    return islands.filter(F.col("ended") > fired).select(
        "rule", "severity", F.col("key").alias("labels"), F.timestamp_micros("started").alias("started_at"), F.timestamp_micros("ended").alias("ended_at"),
        F.timestamp_micros(fired).alias("fired_at"))
