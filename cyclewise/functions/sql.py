"""SQL surface: session views over the stand-in tables and SQL functions.

Scalar kernels are registered as SQL UDFs (``CREATE TEMPORARY FUNCTION ...
RETURN expr``), which Catalyst inlines like any built-in expression: no Python
at run time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources import tables
from .stats import KS_SMALL_LAMBDA, KS_TERMS

FUNCTIONS = {
    "ks_pvalue": f"""CREATE OR REPLACE TEMPORARY FUNCTION ks_pvalue(d DOUBLE, n BIGINT, m BIGINT) RETURNS DOUBLE RETURN
        CASE WHEN d * sqrt(CAST(n AS DOUBLE) * CAST(m AS DOUBLE) / CAST(n + m AS DOUBLE)) < {KS_SMALL_LAMBDA} THEN 1.0
        ELSE least(greatest(aggregate(sequence(1, {KS_TERMS}), 0.0D,
          (acc, k) -> acc + 2.0D * pow(-1.0D, k - 1) * exp(-2.0D * k * k * (d * sqrt(CAST(n AS DOUBLE) * CAST(m AS DOUBLE) / CAST(n + m AS DOUBLE))) * (d * sqrt(CAST(n AS DOUBLE) * CAST(m AS DOUBLE) / CAST(n + m AS DOUBLE))))), 0.0D), 1.0D) END""",
    "rul_severity": """CREATE OR REPLACE TEMPORARY FUNCTION rul_severity(rul DOUBLE) RETURNS STRING RETURN
        CASE WHEN rul < 10 THEN 'critical' WHEN rul < 25 THEN 'warning' ELSE 'ok' END""",
    "clip_rul": """CREATE OR REPLACE TEMPORARY FUNCTION clip_rul(rul DOUBLE, lo DOUBLE, hi DOUBLE) RETURNS DOUBLE RETURN
        least(greatest(rul, lo), hi)""",
}


def register(spark: SparkSession, sf_dir: str) -> None:
    """Create the temp views (telemetry_lineitem, telemetry_events, drift_long,
    prediction_log) and the SQL functions in this session."""
    tables.telemetry_lineitem(spark, sf_dir).createOrReplaceTempView("telemetry_lineitem")
    tables.telemetry_events(spark, sf_dir).createOrReplaceTempView("telemetry_events")
    tables.drift_long(spark, sf_dir).createOrReplaceTempView("drift_long")
    tables.prediction_log(spark, sf_dir).createOrReplaceTempView("prediction_log")
    for ddl in FUNCTIONS.values():
        spark.sql(ddl)
