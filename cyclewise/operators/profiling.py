"""Projections, filters, validation and profiling.

Every profile is ONE aggregate pass (partial aggregation on the map side), then
an ``unpivot`` into long form when a per-column answer is wanted, so cost grows
with rows and not with a Python loop over columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import NON_FEATURE_COLS, SENSOR_COLS

FIRST_ROWS = 1000  # rows that settle most columns of a table


class ValidationError(ValueError):
    pass


def unit_rows(df: DataFrame, unit_id: int, unit: str = "unit_id") -> DataFrame:
    """Rows of one unit (pushed down to the scan); error if the unit is absent."""
    out = df.filter(F.col(unit) == F.lit(unit_id))
    if out.limit(1).count() == 0:
        raise ValidationError(f"unit {unit_id} not found")
    return out


def sensor_columns(df: DataFrame, sensors: Sequence[str] = SENSOR_COLS) -> list[str]:
    """Sensors present, in canonical order."""
    have = set(df.columns)
    return [c for c in sensors if c in have]


def project_sensors(df: DataFrame, sensors: Sequence[str] = SENSOR_COLS, keep: Sequence[str] = ("unit_id", "time_cycle")) -> DataFrame:
    return df.select(*[c for c in keep if c in df.columns], *sensor_columns(df, sensors))


def numeric_features(df: DataFrame, exclude: Sequence[str] = NON_FEATURE_COLS) -> list[str]:
    """Numeric columns minus ids / labels (schema inspection, no job)."""
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)
    ]


def constant_column_table(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """P4 decision table: (column, mean, std, cv, dropped) from one aggregate pass.

    Dropped if sample std == 0, or std/|mean| < threshold when mean != 0.
    """
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_samp(c).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    long = wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"m__{c}").alias("mean"), F.col(f"s__{c}").alias("std"))
                    for c in columns
                ]
            )
        ).alias("s")
    ).select("s.*")
    cv = F.when(F.col("mean") != 0, F.col("std") / F.abs(F.col("mean")))
    dropped = (F.col("std") == 0) | (cv < F.lit(threshold))
    return long.select("column_name", "mean", "std", cv.alias("cv"), F.coalesce(dropped, F.lit(False)).alias("dropped"))


def drop_constant_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> tuple[DataFrame, list[str]]:
    """Returns (df without constant columns, dropped names).  The decision is
    a tiny one-row-per-column table collected once so it can be stored with the
    fitted pipeline and re-applied to other data."""
    decision = constant_column_table(df, columns, threshold).filter("dropped").select("column_name").collect()
    dropped = [r_["column_name"] for r_ in decision]
    return df.drop(*dropped), dropped


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row.

    A column with a value in the first rows is kept at once; the others take one count(col) pass over all rows."""
    first = df.select(*[F.col(c).isNotNull() for c in df.columns]).take(FIRST_ROWS)
    unsettled = [c for i, c in enumerate(df.columns) if not any(r[i] for r in first)]
    if not unsettled:
        return df
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in unsettled]).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n == 0])


def dataset_info(train: DataFrame, test: DataFrame | None = None, rul: DataFrame | None = None) -> DataFrame:
    """Samples, distinct units, max cycle (train / test); RUL min / max / mean.

    The inputs are tagged and unioned, then ONE conditional aggregate computes
    every figure (no joins between one-row results)."""
    parts = [train.select(F.lit("train").alias("_src"), "unit_id", "time_cycle", F.lit(None).cast("int").alias("rul"))]
    if test is not None:
        parts.append(test.select(F.lit("test").alias("_src"), "unit_id", "time_cycle", F.lit(None).cast("int").alias("rul")))
    if rul is not None:
        parts.append(rul.select(F.lit("rul").alias("_src"), "unit_id", F.lit(None).cast("int").alias("time_cycle"), "rul"))
    u = parts[0]
    for p_ in parts[1:]:
        u = u.unionByName(p_)
    aggs = []
    for src in ["train"] + (["test"] if test is not None else []):
        is_ = F.col("_src") == src
        aggs += [
            F.count(F.when(is_, 1)).alias(f"{src}_samples"),
            F.countDistinct(F.when(is_, F.col("unit_id"))).alias(f"{src}_units"),
            F.max(F.when(is_, F.col("time_cycle"))).alias(f"{src}_max_cycle"),
        ]
    if rul is not None:
        aggs += [F.min("rul").alias("rul_min"), F.max("rul").alias("rul_max"), F.avg("rul").alias("rul_mean")]
    return u.agg(*aggs)


def ingest_stats(df: DataFrame, label: str = "RUL") -> DataFrame:
    """Rows, units, columns, label min/max/mean/std(sample), missing cells."""
    missing = sum(F.sum(F.when(F.col(c).isNull() | (F.isnan(c) if _is_frac(df, c) else F.lit(False)), 1).otherwise(0)) for c in df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("unit_id").alias("n_units"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(label).cast("double").alias("label_min"),
        F.max(label).cast("double").alias("label_max"),
        F.avg(label).alias("label_mean"),
        F.stddev_samp(label).alias("label_std"),
        missing.cast("bigint").alias("missing_cells"),
    )


def _is_frac(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature (long form): rows, missing, min, max; one aggregate pass."""
    aggs = []
    for c in features:
        miss = F.col(c).isNull() | (F.isnan(c) if _is_frac(df, c) else F.lit(False))
        aggs += [
            F.sum(F.when(miss, 1).otherwise(0)).alias(f"n__{c}"),
            F.min(c).cast("double").alias(f"lo__{c}"),
            F.max(c).cast("double").alias(f"hi__{c}"),
        ]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    return wide.select(
        "n_rows",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(f"n__{c}").cast("bigint").alias("missing"),
                        F.col(f"lo__{c}").alias("min"),
                        F.col(f"hi__{c}").alias("max"),
                    )
                    for c in features
                ]
            )
        ).alias("s"),
    ).select("s.feature", "n_rows", "s.missing", "s.min", "s.max")


def head_per_unit(df: DataFrame, n: int, unit: str = "unit_id", order: str = "time_cycle") -> DataFrame:
    """First n cycles of every unit (a window rank filter, no global sort).

    With the cycle contract (dense 1..n) this is a pure filter ``time_cycle <= n``
    pushed to the scan; the rank form is used for arbitrary orders.
    """
    if order == "time_cycle":
        return df.filter(F.col(order) <= F.lit(n))
    w = Window.partitionBy(unit).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def align_columns(df: DataFrame, fitted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """P10: add missing fitted feature columns as 0 and order as fitted; nulls -> 0."""
    have = set(df.columns)
    cols = [F.col(k) for k in keep if k in have]
    for c in fitted:
        cols.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in have else F.lit(0.0).alias(c))
    return df.select(*cols)


def drop_non_features(df: DataFrame, cols: Sequence[str] = ("unit_id", "time_cycle", "RUL", "rul", "max_cycle")) -> DataFrame:
    """Drop ids and labels if present."""
    return df.drop(*[c for c in cols if c in df.columns])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def trajectory_report(df: DataFrame, unit: str = "unit_id", order: str = "time_cycle") -> DataFrame:
    """(rows, null keys, non-positive keys, units, dense units, ok).

    One aggregate per unit and block of 64 cycles, whose cycles are the bits of one
    number, so a task holds a row a block and not one a cycle; then per unit; then one
    global aggregate over the per-unit rows.  Dense = cycles are exactly 1..n.
    """
    whole = isinstance(df.schema[order].dataType, T.IntegralType)
    at = F.col(order).cast("long")
    block = F.shiftright(at, 6) if whole else F.col(order)
    bits = F.bit_or(F.expr(f"shiftleft(1L, CAST(CAST({_q(order)} AS LONG) & 63L AS INT))")) if whole else F.max(F.when(F.col(order).isNotNull(), F.lit(1).cast("long")))
    per_block = df.groupBy(F.col(unit).alias("_unit"), block.alias("_block")).agg(
        F.count(F.lit(1)).alias("n"),
        bits.alias("bits"),
        F.max(order).alias("mx"),
        F.min(order).alias("mn"),
        F.count_if(F.col(unit).isNull() | F.col(order).isNull()).alias("nk"),
        F.count_if((F.col(unit) <= 0) | (F.col(order) <= 0)).alias("np"),
    )
    per_unit = per_block.groupBy("_unit").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("nd"),
        F.max("mx").alias("mx"),
        F.min("mn").alias("mn"),
        F.sum("nk").alias("nk"),
        F.sum("np").alias("np"),
    )
    out = per_unit.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.sum("nk").cast("bigint").alias("null_keys"),
        F.sum("np").cast("bigint").alias("nonpositive_keys"),
        F.count(F.lit(1)).alias("n_units"),
        F.count_if((F.col("n") == F.col("nd")) & (F.col("mx") == F.col("n")) & (F.col("mn") == 1)).cast("bigint").alias("dense_units"),
    )
    ok = (F.col("n_rows") > 0) & (F.col("null_keys") == 0) & (F.col("nonpositive_keys") == 0)
    return out.withColumn("ok", ok)


def validate_trajectories(df: DataFrame, unit: str = "unit_id", order: str = "time_cycle") -> None:
    """S8 as a gate: raise if columns are missing (plan time) or the report fails."""
    missing = [c for c in (unit, order) if c not in df.columns]
    if missing:
        raise ValidationError(f"missing required columns {missing}")
    rep = trajectory_report(df, unit, order).first()
    if not rep["ok"]:
        raise ValidationError(f"invalid trajectories: {rep.asDict()}")


def validate_records(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Each field must be present and castable to double.

    Adds ``reasons array<string>`` and ``valid``; callers split with
    ``filter('valid')`` / ``filter('not valid')`` (quarantine) - rows are never lost.
    """
    reasons = []
    for c in fields:
        if c not in df.columns:
            reasons.append(F.lit(f"missing:{c}"))
            continue
        v = F.col(c)
        casted = F.expr(f"try_cast(`{c}` AS DOUBLE)") if not isinstance(df.schema[c].dataType, T.NumericType) else v.cast("double")
        reasons.append(F.when(v.isNull(), F.lit(f"null:{c}")).when(casted.isNull(), F.lit(f"not_numeric:{c}")))
    arr = F.filter(F.array(*reasons), lambda x: x.isNotNull()) if reasons else F.array().cast("array<string>")
    return df.withColumn("reasons", arr).withColumn("valid", F.size("reasons") == 0)


def batch_size_check(df: DataFrame, batch: str = "batch_id", lo: int = 1, hi: int = 1000) -> DataFrame:
    """(batch, n, within_bounds) per batch."""
    return (
        df.groupBy(batch)
        .agg(F.count(F.lit(1)).alias("n_samples"))
        .withColumn("within_bounds", (F.col("n_samples") >= lo) & (F.col("n_samples") <= hi))
    )
