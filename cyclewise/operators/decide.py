"""Data gates and decisions.

Every gate is one aggregate pass that ends in a small long-form check table
(name, threshold, actual, passed) - the rows of a decision, never raw data on
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import exact_quantiles

# Data-quality gate thresholds.
MIN_SAMPLES = 1000
MAX_AGE_HOURS = 24
MAX_MISSING = 0.05
MAX_DUPLICATES = 0.01
MAX_OUTLIERS = 0.02
OUTLIER_Z = 3.0
# Shadow-test pass criteria.
SHADOW_MATCH_CYCLES = 5
SHADOW_MIN_MATCH = 0.95
SHADOW_MAX_LATENCY_RATIO = 1.1
SHADOW_MAX_ERROR_DIFF = 0.01
# Retraining trigger rules.
TRIGGER_MIN_SCORE = 0.25
TRIGGER_TYPES = ["psi", "concept", "prediction"]
DRIFT_ALERTS = ["DataDriftDetected", "CriticalDataDrift", "ConceptDriftDetected", "PredictionDriftDetected"]
DEFAULT_SCORE = 0.3
DEFAULT_TYPE = "psi"
DEFAULT_LOOKBACK_DAYS = 30
DEFAULT_EXPERIMENT = "manual-retraining"

DRIFT_EVENT_SCHEMA = T.StructType([
    T.StructField("drift_score", T.DoubleType()),
    T.StructField("drift_type", T.StringType()),
    T.StructField("detected_at", T.StringType()),
    T.StructField("features_affected", T.ArrayType(T.StringType())),
    T.StructField("drift_details", T.StructType([
        T.StructField("max_psi", T.DoubleType()), T.StructField("mean_psi", T.DoubleType()),
        T.StructField("features_above_threshold", T.IntegerType()),
    ])),
    T.StructField("recommendation", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("current_model_version", T.StringType()),
    T.StructField("experiment_name", T.StringType()),
    T.StructField("data_lookback_days", T.IntegerType()),
])

ALERT_SCHEMA = T.StructType([
    T.StructField("alerts", T.ArrayType(T.StructType([
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("annotations", T.MapType(T.StringType(), T.StringType())),
    ]))),
])


def quality_gate(df: DataFrame, key: str, ts: str, numeric: str, as_of: str,
                 min_samples: int = MIN_SAMPLES, max_age_h: float = MAX_AGE_HOURS, max_missing: float = MAX_MISSING,
                 max_dup: float = MAX_DUPLICATES, max_out: float = MAX_OUTLIERS, z: float = OUTLIER_Z) -> DataFrame:
    """Five checks from one aggregate pass (+ one pass for z-score outliers,
    using the first pass's mean / std).  Returns (name, threshold, actual,
    passed, overall_passed)."""
    cols = df.columns
    null_cells = sum(F.count_if(F.col(c).isNull()) for c in cols)
    st = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(key).alias("nd"),
        null_cells.alias("nulls"),
        F.max(ts).alias("last_ts"),
        F.avg(numeric).alias("mu"),
        F.stddev_pop(numeric).alias("sd"),
    ).first()  # one row of scalars
    n = st["n"]
    outliers = df.agg(F.count_if(F.abs(F.col(numeric) - F.lit(st["mu"])) > F.lit(z) * F.lit(st["sd"])).alias("o"))
    age_h = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.lit(st["last_ts"]).cast("timestamp"))) / F.lit(3.6e9)
    def chk(name, threshold, actual):
        return F.struct(F.lit(name).alias("name"), F.lit(float(threshold)).alias("threshold"), actual.cast("double").alias("actual"))

    checks = outliers.select(
        F.explode(F.array(
            chk("minimum_samples", min_samples, F.lit(float(n))),
            chk("data_freshness", max_age_h, F.round(age_h, 2)),
            chk("data_completeness", max_missing, F.lit(st["nulls"] / max(n * len(cols), 1))),
            chk("no_duplicates", max_dup, F.lit((n - st["nd"]) / max(n, 1))),
            chk("outlier_check", max_out, F.col("o") / F.lit(max(n, 1))),
        )).alias("c")
    ).select("c.*")
    passed = F.when(F.col("name") == "minimum_samples", F.col("actual") >= F.col("threshold")).otherwise(F.col("actual") <= F.col("threshold"))
    out = checks.withColumn("passed", passed)
    return out.withColumn("overall_passed", F.min(F.col("passed").cast("int")).over(Window.partitionBy()) == 1)


def shadow_join(prod: DataFrame, cand: DataFrame, key: Sequence[str]) -> DataFrame:
    """Production vs candidate prediction of the same request (equi join on the request key)."""
    p = prod.select(*key, F.col("prediction").alias("prod_prediction"), F.col("latency_ms").alias("prod_latency_ms"), F.col("error").alias("prod_error"))
    c = cand.select(*key, F.col("prediction").alias("cand_prediction"), F.col("latency_ms").alias("cand_latency_ms"), F.col("error").alias("cand_error"))
    return p.join(c, list(key), "inner")


def shadow_compare(j: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """R2: match share within 5 cycles, average and p95 latency (order statistic
    ``sorted[int(.95 n)]``), latency ratio of the rounded averages, error-rate
    difference, pass flag."""
    both = ~F.col("prod_error") & ~F.col("cand_error")
    base = j.groupBy(*by).agg(
        F.count_if(both).alias("comparisons"),
        F.count_if(both & (F.abs(F.col("prod_prediction") - F.col("cand_prediction")) < SHADOW_MATCH_CYCLES)).alias("matches"),
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("prod_error")).alias("prod_errors"),
        F.count_if(F.col("cand_error")).alias("cand_errors"),
        F.round(F.avg(F.when(~F.col("prod_error"), F.col("prod_latency_ms"))), 2).alias("prod_avg_latency_ms"),
        F.round(F.avg(F.when(~F.col("cand_error"), F.col("cand_latency_ms"))), 2).alias("cand_avg_latency_ms"),
    )
    keys = list(by) if by else ["_all"]
    jj = j if by else j.withColumn("_all", F.lit(0))
    pp = exact_quantiles(jj.filter(~F.col("prod_error")), keys, "prod_latency_ms", [0.95], names=["prod_p95_latency_ms"], method="index").drop("n")
    cp = exact_quantiles(jj.filter(~F.col("cand_error")), keys, "cand_latency_ms", [0.95], names=["cand_p95_latency_ms"], method="index").drop("n")
    b = base if by else base.withColumn("_all", F.lit(0))
    out = b.join(pp, keys, "left").join(cp, keys, "left")
    match = F.round(F.col("matches") / F.col("comparisons"), 4)
    ratio = F.round(F.col("cand_avg_latency_ms") / F.col("prod_avg_latency_ms"), 4)
    diff = F.round(F.col("cand_errors") / F.greatest(F.col("requests"), F.lit(1)) - F.col("prod_errors") / F.greatest(F.col("requests"), F.lit(1)), 4)
    res = out.select(
        *by, "requests", "comparisons", match.alias("prediction_match_rate"), "prod_avg_latency_ms", "cand_avg_latency_ms",
        F.round("prod_p95_latency_ms", 2).alias("prod_p95_latency_ms"), F.round("cand_p95_latency_ms", 2).alias("cand_p95_latency_ms"),
        ratio.alias("latency_ratio"), diff.alias("error_rate_diff"),
    )
    passed = (F.col("prediction_match_rate") >= SHADOW_MIN_MATCH) & (F.col("latency_ratio") <= SHADOW_MAX_LATENCY_RATIO) & (F.col("error_rate_diff") <= SHADOW_MAX_ERROR_DIFF)
    return res.withColumn("passed", passed)


def parse_drift_events(raw: DataFrame, body: str = "body") -> DataFrame:
    """Webhook bodies (JSON text) -> typed drift events (explicit schema)."""
    return raw.withColumn("event", F.from_json(F.col(body), DRIFT_EVENT_SCHEMA))


def drift_event_filter(events: DataFrame) -> DataFrame:
    """Score >= 0.25 and type in (psi, concept, prediction)."""
    e = F.col("event")
    return events.filter((e["drift_score"] >= TRIGGER_MIN_SCORE) & e["drift_type"].isin(*TRIGGER_TYPES))


def alert_filter(raw: DataFrame, body: str = "body") -> DataFrame:
    """The FIRST alert's alertname is one of the four drift alerts."""
    a = F.from_json(F.col(body), ALERT_SCHEMA)
    name = F.element_at(F.element_at(a["alerts"], 1)["labels"], F.lit("alertname"))
    return raw.withColumn("alertname", name).filter(F.col("alertname").isin(*DRIFT_ALERTS))


def payload_defaults(events: DataFrame, source: str = "source") -> DataFrame:
    """Score default 0.3, type 'psi' (manual: 0.0 / 'manual'), lookback 30 days, experiment name."""
    e = F.col("event")
    manual = F.col(source) == "manual"
    return events.select(
        "*",
        F.when(manual, F.lit(0.0)).otherwise(F.coalesce(e["drift_score"], F.lit(DEFAULT_SCORE))).alias("drift_score"),
        F.when(manual, F.lit("manual")).otherwise(F.coalesce(e["drift_type"], F.lit(DEFAULT_TYPE))).alias("drift_type"),
        F.coalesce(e["data_lookback_days"], F.lit(DEFAULT_LOOKBACK_DAYS)).alias("lookback_days"),
        F.when(manual, F.coalesce(e["experiment_name"], F.lit(DEFAULT_EXPERIMENT))).otherwise(e["experiment_name"]).alias("experiment_name"),
    )


def rate_limit(df: DataFrame, trigger: str, ts: str, order: Sequence[str], source: str = "source", per: str = "hour") -> DataFrame:
    """At most one accepted event per trigger and fixed hour (the first by
    ``order``); manual events unlimited.

    The first event per (trigger, hour) is a ``min`` over an ordering struct: a
    partial aggregate, so a hot trigger-hour never lands in one task."""
    bucket = F.date_trunc(per, F.col(ts)).alias("_hour")
    auto = df.filter(F.col(source) != "manual")
    first = auto.groupBy(F.col(trigger), bucket).agg(F.min(F.struct(*[F.col(o) for o in order])).alias("_first"))
    keep = first.select(F.col(trigger), *[F.col("_first")[o].alias(o) for o in order])
    accepted = auto.join(keep, [trigger, *order], "left_semi")
    return accepted.unionByName(df.filter(F.col(source) == "manual"))


def retrain_plan(quality_passed: Column, improved: Column, shadow_passed: Column) -> Column:
    """Quality -> train -> improved -> shadow -> promote, outcome per branch."""
    return (
        F.when(~quality_passed, F.lit("quality_failed"))
        .when(~improved, F.lit("not_improved"))
        .when(~shadow_passed, F.lit("shadow_failed"))
        .otherwise(F.lit("promoted"))
    )


def lookback(df: DataFrame, ts: str, days: int = DEFAULT_LOOKBACK_DAYS, now: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows in [now - days, now] (a literal range filter, pushed to the
    scan) and a manifest (start, end, total_samples).  ``now`` defaults to the
    latest timestamp in the data (one scalar)."""
    if now is None:
        now = df.agg(F.max(ts)).first()[0]
    end = F.lit(now).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {int(days)} DAYS")
    rows = df.filter((F.col(ts) >= start) & (F.col(ts) <= end))
    manifest = rows.agg(F.count(F.lit(1)).alias("total_samples")).select(
        start.alias("start_date"), end.alias("end_date"), "total_samples"
    )
    return rows, manifest
