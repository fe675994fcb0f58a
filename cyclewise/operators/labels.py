"""Remaining-useful-life labels (L1, J1, S3 label attach)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import MAX_RUL
from .joins import join_small


def rul_expr(clip: bool = True, max_rul: int = MAX_RUL, unit: str = "unit_id", order: str = "time_cycle"):
    """L1 as a window expression over the unit partition: max(cycle) - cycle, clipped.

    Returned as a function of nothing (uses its own spec) so it can share the
    exchange and sort of the feature window when both partition by unit.
    """
    spec = Window.partitionBy(unit)
    rul = F.max(F.col(order)).over(spec) - F.col(order)
    return (F.least(rul, F.lit(max_rul)) if clip else rul).cast("int").alias("RUL")


def rul_of(clip: bool = True, max_rul: int = MAX_RUL):
    """L1 from the unit's last cycle and the row's cycle (``windows.add_features(rul=...)``)."""
    def expr(last, cycle):
        rul = last - cycle
        return (F.least(rul, F.lit(max_rul)) if clip else rul).cast("int").alias("RUL")

    return expr


def add_rul(
    df: DataFrame,
    clip: bool = True,
    max_rul: int = MAX_RUL,
    unit: str = "unit_id",
    order: str = "time_cycle",
    method: str = "window",
) -> DataFrame:
    """L1: ``RUL = max(time_cycle) over unit - time_cycle`` (optionally clipped at max_rul).

    ``method="window"``: one unbounded window per unit; free when a per-unit
    feature window follows (same exchange).  ``method="join"`` (J1): per-unit max
    by a partial (map-side combined) aggregate and an equi join back; the
    aggregate side has one row per unit and is broadcast only under a checked
    size, so a hot unit never lands in one task.
    """
    if method == "window":
        return df.select("*", rul_expr(clip, max_rul, unit, order))
    if method != "join":
        raise ValueError("method must be 'window' or 'join'")
    max_cycle = df.groupBy(unit).agg(F.max(order).alias("max_cycle"))
    joined = join_small(df, max_cycle, on=[unit], how="inner")
    rul = F.col("max_cycle") - F.col(order)
    rul = F.least(rul, F.lit(max_rul)) if clip else rul
    return joined.withColumn("RUL", rul.cast("int")).drop("max_cycle")


def attach_test_rul(test: DataFrame, rul: DataFrame, unit: str = "unit_id", order: str = "time_cycle") -> DataFrame:
    """S3: label a truncated test trajectory with the given end-of-test RUL.

    RUL at cycle t = rul_at_end + (last observed cycle - t).
    """
    last = test.groupBy(unit).agg(F.max(order).alias("_last"))
    labels = join_small(last, rul.withColumnRenamed("rul", "_end_rul"), on=[unit], how="inner")
    out = join_small(test, labels, on=[unit], how="inner")
    return out.withColumn("RUL", (F.col("_end_rul") + F.col("_last") - F.col(order)).cast("int")).drop("_last", "_end_rul")
