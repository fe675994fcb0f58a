"""Evaluation (V1-V7): every metric set is ONE aggregate pass of sums.

Sums are partial-aggregated per partition before the shuffle, so a group of any
size costs one row per partition on the wire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import histogram

# Quality gate and promotion thresholds.
GATE_MIN_R2 = 0.85
GATE_MAX_RMSE = 25.0
MIN_RMSE_IMPROVEMENT = 0.02


class EvaluationError(ValueError):
    pass


def metric_aggs(y: str = "y", pred: str = "prediction") -> list[Column]:
    e = F.col(y) - F.col(pred)
    nz = F.col(y) != 0
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("_sse"),
        F.sum(F.abs(e)).alias("_sae"),
        F.var_pop(F.col(y)).alias("_vy"),
        F.sum(F.when(nz, F.abs(e / F.col(y)))).alias("_sape"),
        F.count(F.when(nz, 1)).alias("_nnz"),
    ]


def finish_metrics(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, r2 (1.0 / 0.0 for constant y like the reference), mape (x100,
    over y != 0; +inf if every y is 0)."""
    sst = F.col("_vy") * F.col("n")
    r2 = F.when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - F.col("_sse") / sst)
    mape = F.when(F.col("_nnz") > 0, F.col("_sape") / F.col("_nnz") * 100.0).otherwise(F.lit(float("inf")))
    return df.select(
        *keys,
        "n",
        F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
        (F.col("_sae") / F.col("n")).alias("mae"),
        r2.alias("r2"),
        mape.alias("mape"),
    )


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """V1 (no keys) / V2 (by split) / V3 (by model): (keys, n, rmse, mae, r2, mape).
    With no keys an empty input raises (checked with a one-row probe)."""
    if not by and df.limit(1).count() == 0:
        raise EvaluationError("Cannot compute metrics on empty input")
    agg = df.groupBy(*by).agg(*metric_aggs(y, pred)) if by else df.agg(*metric_aggs(y, pred))
    return finish_metrics(agg, by)


def compare_models(long: DataFrame, model: str = "model", y: str = "y", pred: str = "prediction", errors: DataFrame | None = None) -> DataFrame:
    """V3: metrics per model; failed models (``errors``: model, error) get rmse
    +inf, mae +inf, r2 -inf, mape +inf and their error text."""
    m = regression_metrics(long, y, pred, by=[model]).withColumn("error", F.lit(None).cast("string"))
    if errors is None:
        return m
    failed = errors.select(
        F.col(model), F.lit(0).cast("bigint").alias("n"), F.lit(float("inf")).alias("rmse"), F.lit(float("inf")).alias("mae"),
        F.lit(float("-inf")).alias("r2"), F.lit(float("inf")).alias("mape"), F.col("error"),
    )
    return m.unionByName(failed)


def select_best(metrics: DataFrame, metric: str = "rmse", model: str = "model") -> DataFrame:
    """Skip failed models and missing metrics; min for rmse / mae, max for r2."""
    ok = metrics.filter(F.col("error").isNull() & F.col(metric).isNotNull() & ~F.isnan(metric)) if "error" in metrics.columns else metrics
    ok = ok.filter(F.col(metric).isNotNull())
    best = F.max_by(F.col(model), F.col(metric)) if metric == "r2" else F.min_by(F.col(model), F.col(metric))
    val = F.max(metric) if metric == "r2" else F.min(metric)
    return ok.agg(best.alias("best_model"), val.alias(f"best_{metric}"), F.count(F.lit(1)).alias("valid_models"))


# Fixed value: the measure that names the best model of a report.
REPORT_METRIC = "rmse"
REPORT_MEASURES = ["rmse", "mae", "r2", "mape"]


def report_document(metrics: DataFrame, dataset: str = "FD001", model: str = "model", timestamp: str | None = None) -> DataFrame:
    """V5: one nested row (dataset, models, best_model, summary[, timestamp]) for ``write_json_report``.

    ``models``: map from name to measures of the models that were evaluated; a failed one (an error and an
    infinite rmse) only counts in ``summary.total_models_evaluated``.  ``best_model`` (name, metric, value) is the
    least finite rmse, ties to the smaller name, null if there is none.  No metrics at all give an empty map and
    zero counts.  The row holds what the evaluated models are: one entry for each, no data."""
    m = F.col(REPORT_METRIC)
    failed = F.col("error").isNotNull() & m.eqNullSafe(F.lit(float("inf"))) if "error" in metrics.columns else F.lit(False)
    usable = ~failed & m.isNotNull() & ~F.isnan(m) & (m < float("inf"))
    measures = F.struct(*[F.col(c) for c in REPORT_MEASURES if c in metrics.columns])
    best = F.min(F.when(usable, F.struct(m.alias("value"), F.col(model).alias("name"))))
    out = metrics.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(~failed, F.struct(F.col(model).alias("name"), measures.alias("measures")))))).alias("models"),
        best.alias("_best"),
        F.count(F.lit(1)).alias("_all"),
        F.count_if(~failed).alias("_ok"),
    )
    named = F.struct(F.col("_best.name").alias("name"), F.lit(REPORT_METRIC).alias("metric"), F.col("_best.value").alias("value"))
    cols = [
        F.lit(dataset).alias("dataset"), "models", F.when(F.col("_best").isNotNull(), named).alias("best_model"),
        F.struct(F.col("_all").alias("total_models_evaluated"), F.col("_ok").alias("successful_evaluations")).alias("summary"),
    ]
    return out.select(*cols, *([F.lit(timestamp).alias("timestamp")] if timestamp else []))


def residuals(df: DataFrame, y: str = "y", pred: str = "prediction", bins: int = 50) -> tuple[DataFrame, DataFrame]:
    """V6: residual = actual - prediction; (summary: mean, std_pop, n) and a
    ``bins``-bin density histogram over the residual range."""
    r = df.select((F.col(y) - F.col(pred)).alias("value"))
    summary = r.agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("n"))
    hist = histogram(r.select(F.lit("residual").alias("feature"), "value", F.lit("all").alias("side")), bins=bins)
    return summary, hist


def quality_gate(metrics: DataFrame, min_r2: float = GATE_MIN_R2, max_rmse: float = GATE_MAX_RMSE) -> DataFrame:
    """Booleans over metrics."""
    return metrics.withColumn("r2_ok", F.col("r2") >= min_r2).withColumn("rmse_ok", F.col("rmse") <= max_rmse).withColumn(
        "gate_passed", F.col("r2_ok") & F.col("rmse_ok")
    )


def candidate_vs_production(metrics: DataFrame, model: str = "model", production: str = "production", candidate: str = "candidate",
                            min_gain: float = MIN_RMSE_IMPROVEMENT) -> DataFrame:
    """V7: rmse / mae relative improvement (cur - new) / cur, r2 difference,
    passes when the rmse gain >= 2 %.  A pivot of the two rows (one aggregate)."""
    p = metrics.filter(F.col(model).isin(production, candidate)).groupBy().pivot(model, [production, candidate]).agg(
        F.first("rmse").alias("rmse"), F.first("mae").alias("mae"), F.first("r2").alias("r2")
    )
    cur, new = production, candidate
    rmse_gain = (F.col(f"{cur}_rmse") - F.col(f"{new}_rmse")) / F.col(f"{cur}_rmse")
    mae_gain = (F.col(f"{cur}_mae") - F.col(f"{new}_mae")) / F.col(f"{cur}_mae")
    return p.select(
        rmse_gain.alias("rmse_improvement"),
        mae_gain.alias("mae_improvement"),
        (F.col(f"{new}_r2") - F.col(f"{cur}_r2")).alias("r2_change"),
        (rmse_gain >= min_gain).alias("improved"),
    )
