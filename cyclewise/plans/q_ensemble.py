"""Catalog entries: ensemble kernels, evaluation, selection and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ensemble, evaluate
from ..sources import tables
from .registry import present, r, register
from .sqlviews import MEMBERS, MEMBERS_LONG, TELEMETRY_EVENTS, with_

M = {"forest": "forest", "boosted": "boosted", "sequence": "sequence"}
BASE = with_(TELEMETRY_EVENTS, MEMBERS)
P = "list_filter([forest, boosted, sequence], lambda x: x IS NOT NULL)"


def _weighted_sql(w: dict) -> str:
    num = " + ".join(f"coalesce({m} * CAST({w[m]} AS DOUBLE), 0.0)" for m in M)
    den = " + ".join(f"(CASE WHEN {m} IS NOT NULL THEN CAST({w[m]} AS DOUBLE) ELSE 0.0 END)" for m in M)
    mean = f"(CASE WHEN len({P}) > 0 THEN list_reduce(list_prepend(0.0, {P}), lambda a, b: a + b) / len({P}) END)"
    return f"(CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) ELSE {mean} END)"


MEAN_SQL = f"(CASE WHEN len({P}) > 0 THEN list_reduce(list_prepend(0.0, {P}), lambda a, b: a + b) / len({P}) END)"
STD_SQL = (
    f"(CASE WHEN len({P}) > 0 THEN sqrt(list_reduce(list_prepend(0.0, list_transform({P}, lambda x: (x - {MEAN_SQL}) * (x - {MEAN_SQL}))),"
    f" lambda a, b: a + b) / len({P})) END)"
)
S = f"list_sort({P})"
MEDIAN_SQL = (
    f"(CASE WHEN len({P}) = 0 THEN NULL WHEN len({P}) % 2 = 1 THEN {S}[CAST(floor((len({P}) - 1) / 2) AS INTEGER) + 1] "
    f"ELSE ({S}[CAST(floor((len({P}) - 1) / 2) AS INTEGER) + 1] + {S}[CAST(floor(len({P}) / 2) AS INTEGER) + 1]) / 2.0 END)"
)


def _clip0(e: str) -> str:
    return f"(CASE WHEN {e} IS NULL THEN NULL ELSE greatest({e}, 0.0) END)"


def _combine_q(method):
    def q(spark, sf_dir):
        m = tables.member_forecasts(spark, sf_dir)
        return present(ensemble.combine(m, M, method).select("unit_id", "time_cycle", "ensemble"))

    return q


register("e1_e4_weighted_ensemble", BASE + f"SELECT unit_id, time_cycle, {r(_clip0(_weighted_sql(ensemble.OFFLINE_WEIGHTS)))} AS ensemble FROM members")(
    _combine_q("weighted")
)
register("e2_average_ensemble", BASE + f"SELECT unit_id, time_cycle, {r(_clip0(MEAN_SQL))} AS ensemble FROM members")(_combine_q("average"))
register("e3_median_ensemble", BASE + f"SELECT unit_id, time_cycle, {r(_clip0(MEDIAN_SQL))} AS ensemble FROM members")(_combine_q("median"))


@register(
    "e5_agreement_confidence",
    BASE + f"SELECT unit_id, time_cycle, {r(f'CASE WHEN len({P}) < 2 THEN 1.0 ELSE 1.0 / (1.0 + {STD_SQL} / 10.0) END')} AS confidence FROM members",
)
def q_e5(spark, sf_dir):
    m = tables.member_forecasts(spark, sf_dir)
    return present(m.select("unit_id", "time_cycle", ensemble.agreement_confidence(M).alias("confidence")))


@register(
    "e6_uncertainty",
    BASE
    + f"""SELECT unit_id, time_cycle, {r(MEAN_SQL)} AS pred_mean, {r(STD_SQL)} AS pred_std,
  {r(f'list_min({P})')} AS pred_min, {r(f'list_max({P})')} AS pred_max, {r(f'list_max({P}) - list_min({P})')} AS pred_range FROM members""",
)
def q_e6(spark, sf_dir):
    m = tables.member_forecasts(spark, sf_dir)
    return present(ensemble.uncertainty(m, M).select("unit_id", "time_cycle", "pred_mean", "pred_std", "pred_min", "pred_max", "pred_range"))


def _online_sql() -> str:
    w = _weighted_sql(ensemble.ONLINE_WEIGHTS)
    cv = f"({STD_SQL} / ({MEAN_SQL} + 1e-6))"
    conf = f"(CASE WHEN len({P}) > 1 THEN least(greatest(1.0 - {cv}, 0.0), 1.0) ELSE 0.8 END)"
    return (
        BASE
        + f"""SELECT unit_id, time_cycle,
  CASE WHEN len({P}) > 0 THEN round(least(greatest({w}, 0.0), 125.0), 6) ELSE -1.0 END AS rul,
  CASE WHEN len({P}) > 0 THEN round_even({conf} * 1000.0, 0) / 1000.0 ELSE 0.0 END AS confidence,
  CASE WHEN len({P}) > 0 THEN 'ensemble' ELSE 'error' END AS model_type FROM members"""
    )


@register("e7_m14_online_ensemble", _online_sql())
def q_e7(spark, sf_dir):
    m = tables.member_forecasts(spark, sf_dir)
    # rul compared unrounded (6 digits): a 2-digit tie flips on the last ulp of a member
    return present(ensemble.online(m, M, rul_digits=None).select("unit_id", "time_cycle", "rul", "confidence", "model_type"))


def _metrics_sql(src: str, keys: list[str], y="y", p="prediction", digits=6) -> str:
    k = ", ".join(keys)
    sel = (k + ", ") if keys else ""
    grp = f" GROUP BY {k}" if keys else ""
    e = f"({y} - {p})"
    return f"""SELECT {sel}count(*) AS n, {r(f'sqrt(sum({e} * {e}) / count(*))', digits)} AS rmse, {r(f'sum(abs({e})) / count(*)', digits)} AS mae,
  {r(f'CASE WHEN var_pop({y}) * count(*) = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 - sum({e} * {e}) / (var_pop({y}) * count(*)) END', digits)} AS r2,
  {r(f"CASE WHEN count(*) FILTER (WHERE {y} <> 0) > 0 THEN sum(abs({e} / {y})) FILTER (WHERE {y} <> 0) / count(*) FILTER (WHERE {y} <> 0) * 100.0 ELSE 'inf'::DOUBLE END", digits)} AS mape
FROM {src}{grp}"""


def _ens(spark, sf_dir):
    m = tables.member_forecasts(spark, sf_dir)
    return ensemble.combine(m, M, "weighted", out="prediction").filter(F.col("prediction").isNotNull())


ENS_CTE = f"ens AS (SELECT *, {_clip0(_weighted_sql(ensemble.OFFLINE_WEIGHTS))} AS prediction FROM members WHERE forest IS NOT NULL)"


@register("v1_regression_metrics", with_(TELEMETRY_EVENTS, MEMBERS, ENS_CTE) + _metrics_sql("ens", [], digits=4))
def q_v1(spark, sf_dir):
    return present(evaluate.regression_metrics(_ens(spark, sf_dir)), 4)


@register(
    "v2_split_metrics",
    with_(TELEMETRY_EVENTS, MEMBERS, ENS_CTE, "s AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'train' ELSE 'val' END AS split FROM ens)")
    + _metrics_sql("s", ["split"], digits=4),
)
def q_v2(spark, sf_dir):
    e = _ens(spark, sf_dir).withColumn("split", F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "train").otherwise("val"))
    return present(evaluate.regression_metrics(e, by=["split"]), 4)


def _long(spark, sf_dir):
    """Members in long form (model, prediction): one unpivot of one pass over the
    member view, missing members dropped."""
    m = tables.member_forecasts(spark, sf_dir)
    long = m.unpivot(["unit_id", "time_cycle", "ts", "y"], list(M), "model", "prediction")
    return long.filter(F.col("prediction").isNotNull())


V3_SQL = with_(TELEMETRY_EVENTS, MEMBERS, MEMBERS_LONG) + (
    "SELECT *, NULL::VARCHAR AS error FROM (" + _metrics_sql("members_long", ["model"], digits=4) + ")"
    " UNION ALL SELECT 'broken', 0, 'inf'::DOUBLE, 'inf'::DOUBLE, '-inf'::DOUBLE, 'inf'::DOUBLE, 'no model file'"
)


def _v3(spark, sf_dir):
    errors = spark.createDataFrame([("broken", "no model file")], "model string, error string")
    return evaluate.compare_models(_long(spark, sf_dir), errors=errors)


@register("v3_compare_models", V3_SQL)
def q_v3(spark, sf_dir):
    return present(_v3(spark, sf_dir), 4)


@register(
    "v4_tail_alignment_by_key",
    with_(TELEMETRY_EVENTS, MEMBERS)
    + "SELECT count(*) AS n, "
    + r("sqrt(avg((a.y - b.sequence) * (a.y - b.sequence)))", 4)
    + " AS rmse FROM members a JOIN members b ON a.unit_id = b.unit_id AND a.time_cycle = b.time_cycle WHERE b.sequence IS NOT NULL",
)
def q_v4(spark, sf_dir):
    m = tables.member_forecasts(spark, sf_dir)
    ytab = m.select("unit_id", "time_cycle", "y")
    seq = m.select("unit_id", "time_cycle", "sequence").filter(F.col("sequence").isNotNull())
    j = ytab.join(seq, ["unit_id", "time_cycle"])
    e = F.col("y") - F.col("sequence")
    return present(j.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse")), 4)


@register(
    "v5_m10_evaluation_report",
    V3_SQL.replace("SELECT *, NULL::VARCHAR AS error FROM (", "SELECT * FROM (SELECT *, NULL::VARCHAR AS error FROM (", 1)
    .replace("UNION ALL SELECT 'broken'", "UNION ALL SELECT 'broken'", 1)
    .rstrip()
    .replace("'no model file'", "'no model file') m", 1)
    .replace("WITH ", "WITH ", 1)
    .join(["SELECT min_by(model, rmse) AS best_model, min(rmse) AS best_rmse, count(*) AS valid_models FROM (", ") WHERE error IS NULL"]),
)
def q_v5(spark, sf_dir):
    return present(evaluate.select_best(_v3(spark, sf_dir), "rmse"), 4)


V5_DOC_SQL = (
    with_(TELEMETRY_EVENTS, MEMBERS, MEMBERS_LONG, "v3 AS (" + _metrics_sql("members_long", ["model"], digits=4) + ")")
    + """SELECT 'FD001' AS dataset, model, rmse, mae, r2, mape, (SELECT min_by(model, rmse) FROM v3) AS best_name, 'rmse' AS best_metric,
  (SELECT min(rmse) FROM v3) AS best_value, (SELECT count(*) + 1 FROM v3) AS total_models_evaluated, (SELECT count(*) FROM v3) AS successful_evaluations FROM v3"""
)


@register("v5_report_document", V5_DOC_SQL)
def q_v5_document(spark, sf_dir):
    """The report of valid and failed models, written as a JSON document and read back."""
    from ..sources import telemetry

    doc = evaluate.report_document(present(_v3(spark, sf_dir), 4))
    path = telemetry.scratch_path(spark, "evaluation_report")
    telemetry.write_json_report(doc, path)
    back = spark.read.text(path).select(F.from_json("value", doc.schema).alias("d")).select("d.*")
    return back.select("dataset", F.explode("models").alias("model", "m"), "best_model", "summary").select(
        "dataset", "model", "m.*", F.col("best_model.name").alias("best_name"), F.col("best_model.metric").alias("best_metric"),
        F.col("best_model.value").alias("best_value"), "summary.*",
    )


@register(
    "m10_select_best_r2",
    V3_SQL.rstrip().replace("'no model file'", "'no model file') m", 1).replace("SELECT *, NULL::VARCHAR AS error FROM (", "SELECT * FROM (SELECT *, NULL::VARCHAR AS error FROM (", 1)
    .join(["SELECT max_by(model, r2) AS best_model, max(r2) AS best_r2, count(*) AS valid_models FROM (", ") WHERE error IS NULL"]),
)
def q_m10(spark, sf_dir):
    return present(evaluate.select_best(_v3(spark, sf_dir), "r2"), 4)


@register(
    "v6_residual_analysis",
    with_(
        TELEMETRY_EVENTS, MEMBERS, ENS_CTE,
        "res AS (SELECT y - prediction AS v FROM ens)",
        "rg AS (SELECT min(v) AS lo, max(v) AS hi, avg(v) AS mean, stddev_pop(v) AS std, count(*) AS n FROM res)",
        "c AS (SELECT least(greatest(CAST(floor((v - lo) / (hi - lo) * 50) AS INTEGER), 0), 49) AS bin, count(*) AS cnt FROM res, rg GROUP BY 1)",
    )
    + f"""SELECT CAST(g.bin AS INTEGER) AS bin, coalesce(cnt, 0) AS count, {r('coalesce(cnt, 0) / (n * ((hi - lo) / 50))')} AS density,
  {r('mean', 4)} AS mean, {r('std', 4)} AS std, n FROM (SELECT unnest(range(0, 50)) AS bin) g LEFT JOIN c ON g.bin = c.bin, rg""",
)
def q_v6(spark, sf_dir):
    summary, hist = evaluate.residuals(_ens(spark, sf_dir))
    s = present(summary, 4).first()
    return present(hist.select("bin", "count", "density")).select(
        "*", F.lit(s["mean"]).alias("mean"), F.lit(s["std"]).alias("std"), F.lit(s["n"]).cast("bigint").alias("n")
    )


@register(
    "v7_candidate_vs_production",
    with_(TELEMETRY_EVENTS, MEMBERS, MEMBERS_LONG, "mm AS (" + _metrics_sql("members_long", ["model"], digits=4) + ")")
    + f"""SELECT {r('(p.rmse - c.rmse) / p.rmse', 4)} AS rmse_improvement, {r('(p.mae - c.mae) / p.mae', 4)} AS mae_improvement,
  {r('c.r2 - p.r2', 4)} AS r2_change, (p.rmse - c.rmse) / p.rmse >= 0.02 AS improved
FROM mm p JOIN mm c ON p.model = 'forest' AND c.model = 'boosted'""",
)
def q_v7(spark, sf_dir):
    m = present(evaluate.regression_metrics(_long(spark, sf_dir), by=["model"]), 4)
    return present(evaluate.candidate_vs_production(m, production="forest", candidate="boosted"), 4)


@register(
    "m13_quality_gate",
    with_(TELEMETRY_EVENTS, MEMBERS, MEMBERS_LONG)
    + "SELECT model, rmse, r2, r2 >= 0.85 AS r2_ok, rmse <= 25.0 AS rmse_ok, r2 >= 0.85 AND rmse <= 25.0 AS gate_passed FROM ("
    + _metrics_sql("members_long", ["model"], digits=4)
    + ")",
)
def q_m13(spark, sf_dir):
    m = evaluate.regression_metrics(_long(spark, sf_dir), by=["model"])  # the gate decides before rounding
    return present(evaluate.quality_gate(m).select("model", "rmse", "r2", "r2_ok", "rmse_ok", "gate_passed"), 4)


def _record_sql() -> str:
    weights = ensemble.ONLINE_WEIGHTS
    total = "(" + " + ".join(f"(CASE WHEN {m} IS NOT NULL THEN CAST({weights[m]} AS DOUBLE) ELSE 0.0 END)" for m in M) + ")"
    part = lambda m: f"CASE WHEN {m} IS NOT NULL THEN {m} * (CAST({weights[m]} AS DOUBLE) / {total}) END"
    names = "array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN {m} IS NOT NULL THEN '{m}' END" for m in M) + "], lambda x: x IS NOT NULL)), ',')"
    cols = ", ".join(f"{r(m)} AS {m}, {r(part(m))} AS {m}_part" for m in M)
    return BASE + f"""SELECT unit_id, time_cycle, CASE WHEN len({P}) > 0 THEN 'ensemble' ELSE 'error' END AS model_type, CAST(len({P}) AS INTEGER) AS n_members, {names} AS members, {cols},
  {r('coalesce(' + ' + '.join(f'coalesce({part(m)}, 0.0)' for m in M) + ', 0.0)')} AS total FROM members"""


@register("e7_member_map_record", _record_sql())
def q_e7_record(spark, sf_dir):
    """The prediction record with its member map, weights and contributions as maps."""
    rec = ensemble.record(tables.member_forecasts(spark, sf_dir), M, digits=None)
    own = lambda c, m: F.try_element_at(F.col(c), F.lit(m))
    cols = [c for m in M for c in (own("individual_predictions", m).alias(m), own("contributions", m).alias(f"{m}_part"))]
    return present(rec.select(
        "unit_id", "time_cycle", "model_type", F.size("individual_predictions").alias("n_members"),
        F.array_join(F.array_sort(F.map_keys("individual_predictions")), ",").alias("members"), *cols,
        F.aggregate(F.map_values("contributions"), F.lit(0.0), lambda a, x: a + x).alias("total")))
