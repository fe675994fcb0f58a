"""Ensemble kernels over member prediction columns.

Members are columns; a null member is "not available" for that row.  All
kernels are expressions over one array built per row: no UDF, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays

# Member weights of the offline ensemble (forest / boosted / sequence).
OFFLINE_WEIGHTS = {"forest": 0.25, "boosted": 0.35, "sequence": 0.40}
# Member weights of the online (serving) ensemble.
ONLINE_WEIGHTS = {"forest": 0.35, "boosted": 0.40, "sequence": 0.25}
CONFIDENCE_SCALE = 10.0
ONLINE_MAX_RUL = 125.0
ONLINE_SINGLE_CONFIDENCE = 0.8


def half_even(x: Column, digits: int) -> Column:
    """Round half to even on the binary product x * 10^d (close to Python's round;
    Spark's bround rounds the shortest decimal string instead)."""
    scale = float(10 ** digits)
    return F.bround(x * F.lit(scale), 0) / F.lit(scale)


def validate_weights(weights: Mapping[str, float], tol: float = 0.01) -> None:
    total = sum(weights.values())
    if abs(total - 1.0) > tol:
        raise ValueError(f"weights must sum to 1.0, got {total}")


def effective_weighted(members: Mapping[str, str], weights: Mapping[str, float]) -> Column:
    """sum(w * p) / sum(w) over the members present in the row.

    Members without a known weight get weight 0 while any known member is present;
    if no present member has a weight, the present members are averaged equally.
    """
    num = F.lit(0.0)
    den = F.lit(0.0)
    for name, col in members.items():
        w = float(weights.get(name, 0.0))
        p = F.col(col)
        num = num + F.when(p.isNotNull(), p * F.lit(w)).otherwise(F.lit(0.0))
        den = den + F.when(p.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    arr = F.array(*[F.col(c).cast("double") for c in members.values()])
    return F.when(den > 0, num / den).otherwise(arrays.arr_mean(arr))


def member_array(members: Mapping[str, str] | Sequence[str]) -> Column:
    cols = members.values() if isinstance(members, Mapping) else members
    return F.array(*[F.col(c).cast("double") for c in cols])


def combine(
    df: DataFrame,
    members: Mapping[str, str],
    method: str = "weighted",
    weights: Mapping[str, float] = OFFLINE_WEIGHTS,
    out: str = "ensemble",
) -> DataFrame:
    """E1 weighted (E4 renormalised) / E2 simple average / E3 median; clipped at 0."""
    arr = member_array(members)
    if method == "weighted":
        validate_weights(weights)
        e = effective_weighted(members, weights)
    elif method == "average":
        e = arrays.arr_mean(arr)
    elif method == "median":
        e = arrays.arr_median(arr)
    else:
        raise ValueError(f"unknown ensemble method {method!r}")
    return df.withColumn(out, F.when(e.isNotNull(), F.greatest(e, F.lit(0.0))))


def agreement_confidence(members: Mapping[str, str], scale: float = CONFIDENCE_SCALE) -> Column:
    """E5: 1 / (1 + std_pop / scale); 1.0 with a single member."""
    arr = member_array(members)
    n = F.size(arrays.present(arr))
    return F.when(n < 2, F.lit(1.0)).otherwise(F.lit(1.0) / (F.lit(1.0) + arrays.arr_std_pop(arr) / F.lit(scale)))


def uncertainty(df: DataFrame, members: Mapping[str, str]) -> DataFrame:
    """Mean, std_pop, min, max, range across the present members."""
    arr = arrays.present(member_array(members))
    return df.select(
        "*",
        arrays.arr_mean(arr).alias("pred_mean"),
        arrays.arr_std_pop(arr).alias("pred_std"),
        F.array_min(arr).alias("pred_min"),
        F.array_max(arr).alias("pred_max"),
        (F.array_max(arr) - F.array_min(arr)).alias("pred_range"),
    )


def online(df: DataFrame, members: Mapping[str, str], weights: Mapping[str, float] = ONLINE_WEIGHTS,
           rul_digits: int | None = 2, confidence_digits: int | None = 3) -> DataFrame:
    """Serving ensemble: weighted mean over present members, confidence
    clamp(1 - std_pop / (mean + 1e-6), 0, 1) (0.8 with one member), RUL clipped
    to [0, 125], rounded to 2 (RUL) and 3 (confidence) half-even like Python.  A row
    without any member is an error row: RUL -1, confidence 0 (M14)."""
    arr = member_array(members)
    n = F.size(arrays.present(arr))
    mean = arrays.arr_mean(arr)
    cv = arrays.arr_std_pop(arr) / (mean + F.lit(1e-6))
    conf = F.when(n > 1, F.least(F.greatest(F.lit(1.0) - cv, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(ONLINE_SINGLE_CONFIDENCE))
    rul = F.least(F.greatest(effective_weighted(members, weights), F.lit(0.0)), F.lit(ONLINE_MAX_RUL))
    return df.select(
        "*",
        F.when(n > 0, half_even(rul, rul_digits) if rul_digits is not None else rul).otherwise(F.lit(-1.0)).alias("rul"),
        F.when(n > 0, half_even(conf, confidence_digits) if confidence_digits is not None else conf).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(n > 0, F.lit("ensemble")).otherwise(F.lit("error")).alias("model_type"),
    )


def member_map(members: Mapping[str, str]) -> Column:
    """Member name -> prediction, of the members present in the row."""
    every = F.map_from_arrays(F.array(*[F.lit(m) for m in members]), member_array(members))
    return F.map_filter(every, lambda _, p: p.isNotNull())


def record(df: DataFrame, members: Mapping[str, str], weights: Mapping[str, float] = ONLINE_WEIGHTS, digits: int | None = 2) -> DataFrame:
    """The prediction record of E7 with its member map: ``individual_predictions`` (member -> prediction,
    rounded half-even), ``effective_weights`` (weights renormalised over the members present, equal ones
    where none has a weight) and ``contributions`` (weight x prediction; their sum is the RUL before clipping)."""
    present = member_map(members)
    known = F.map_from_arrays(F.array(*[F.lit(m) for m in members]), F.array(*[F.lit(float(weights.get(m, 0.0))) for m in members]))
    held = F.map_filter(known, lambda m, _: F.map_contains_key(F.col("_present"), m))
    total = F.aggregate(F.map_values("_held"), F.lit(0.0), lambda a, w: a + w)
    share = F.transform_values("_held", lambda _, w: F.when(F.col("_total") > 0, w / F.col("_total")).otherwise(F.lit(1.0) / F.size("_held")))
    out = online(df, members, weights, rul_digits=digits).withColumn("_present", present).withColumn("_held", held).withColumn("_total", total)
    out = out.withColumn("effective_weights", share).withColumn("contributions", F.map_zip_with("_present", "effective_weights", lambda _, p, w: p * w))
    shown = F.transform_values("_present", lambda _, p: half_even(p, digits)) if digits is not None else F.col("_present")
    return out.withColumn("individual_predictions", shown).drop("_present", "_held", "_total")
