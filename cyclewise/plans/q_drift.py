"""Catalog entries: drift statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import ks_pvalue_sql
from ..operators import drift, evaluate
from ..sources import tables
from .registry import present, r, register
from .sqlviews import DRIFT_LONG, SCORED, TELEMETRY_LINEITEM, with_

DL = with_(DRIFT_LONG)


def _rng(src: str, keys: str, where: str = "") -> str:
    return (
        f"SELECT {keys}, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo, "
        f"CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM {src} {where} GROUP BY {keys}"
    )


def _bin(bins: int = 10) -> str:
    return f"least(greatest(CAST(floor((value - lo) / (hi - lo) * {bins}) AS INTEGER), 0), {bins - 1})"


@register(
    "d1_reference_profile",
    DL
    + f"""SELECT feature, {r('avg(value)')} AS mean, {r('stddev_pop(value)')} AS std, {r('min(value)')} AS min, {r('max(value)')} AS max,
  {r('quantile_cont(value, 0.5)')} AS median, {r('quantile_cont(value, 0.25)')} AS q25, {r('quantile_cont(value, 0.75)')} AS q75, count(value) AS n
FROM drift_long WHERE side = 'ref' GROUP BY feature""",
)
def q_d1(spark, sf_dir):
    long = tables.drift_long(spark, sf_dir).filter(F.col("side") == "ref")
    return present(drift.reference_profile(long))


@register(
    "d2_histogram",
    with_(DRIFT_LONG, "rng AS (" + _rng("drift_long", "feature, side") + ")",
          f"c AS (SELECT feature, side, {_bin()} AS bin, count(*) AS cnt FROM drift_long JOIN rng USING (feature, side) GROUP BY ALL)",
          "g AS (SELECT feature, side, lo, hi, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM rng)")
    + f"""SELECT g.feature, g.side, g.bin, {r('lo')} AS lo, {r('hi')} AS hi, coalesce(cnt, 0) AS count,
  {r('coalesce(cnt, 0) / (sum(coalesce(cnt, 0)) OVER (PARTITION BY g.feature, g.side) * ((hi - lo) / 10))')} AS density
FROM g LEFT JOIN c ON g.feature = c.feature AND g.side = c.side AND g.bin = c.bin""",
)
def q_d2(spark, sf_dir):
    return present(drift.histogram(tables.drift_long(spark, sf_dir)))


KS_CTE = [
    "dv AS (SELECT feature, value, count(*) FILTER (WHERE side = 'ref') AS a, count(*) FILTER (WHERE side = 'cur') AS b FROM drift_long GROUP BY ALL)",
    """cum AS (SELECT feature, value, sum(a) OVER w AS ca, sum(b) OVER w AS cb,
      sum(a) OVER (PARTITION BY feature) AS n, sum(b) OVER (PARTITION BY feature) AS m FROM dv
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "ks AS (SELECT feature, max(abs(ca / n - cb / m)) AS ks_stat, CAST(any_value(n) AS BIGINT) AS n_ref, CAST(any_value(m) AS BIGINT) AS n_cur FROM cum GROUP BY feature)",
]
KS_SELECT = f"SELECT feature, {r('ks_stat')} AS ks_stat, {r(ks_pvalue_sql('ks_stat', 'n_ref', 'n_cur'))} AS ks_pvalue, n_ref, n_cur FROM ks"


@register("d3_ks_two_sample", with_(DRIFT_LONG, *KS_CTE) + KS_SELECT)
def q_d3(spark, sf_dir):
    return present(drift.ks(tables.drift_long(spark, sf_dir)))


def _grid_cte(edges: str) -> list[str]:
    return [
        f"c AS (SELECT feature, {_bin()} AS bin, count(*) FILTER (WHERE side = 'ref') AS n_ref, count(*) FILTER (WHERE side = 'cur') AS n_cur "
        f"FROM drift_long JOIN {edges} USING (feature) GROUP BY ALL)",
        f"g0 AS (SELECT feature, lo, hi, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM {edges})",
        """g AS (SELECT g0.feature, g0.bin, g0.lo, g0.hi, coalesce(n_ref, 0) AS n_ref, coalesce(n_cur, 0) AS n_cur,
              sum(coalesce(n_ref, 0)) OVER (PARTITION BY g0.feature) AS tot_ref, sum(coalesce(n_cur, 0)) OVER (PARTITION BY g0.feature) AS tot_cur
            FROM g0 LEFT JOIN c ON g0.feature = c.feature AND g0.bin = c.bin)""",
    ]


PSI_CTE = ["edges AS (" + _rng("drift_long", "feature", "WHERE side = 'ref'") + ")", *_grid_cte("edges"),
           """p AS (SELECT feature, least(greatest(n_ref / (tot_ref + 1e-10), 1e-10), 1.0) AS rp,
                    least(greatest(n_cur / (tot_cur + 1e-10), 1e-10), 1.0) AS cp FROM g)""",
           "psi AS (SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM p GROUP BY feature)"]


@register("d4_psi", with_(DRIFT_LONG, *PSI_CTE) + f"SELECT feature, {r('psi')} AS psi FROM psi")
def q_d4(spark, sf_dir):
    return present(drift.psi(tables.drift_long(spark, sf_dir)))


@register(
    "d4b_psi_pooled",
    with_(
        DRIFT_LONG,
        "edges AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM drift_long GROUP BY feature)",
        *_grid_cte("edges"),
        "p AS (SELECT feature, lo = hi AS const, least(greatest(n_ref / tot_ref, 1e-4), 1.0) AS rp, least(greatest(n_cur / tot_cur, 1e-4), 1.0) AS cp FROM g)",
        "ps AS (SELECT feature, CASE WHEN any_value(const) THEN 0.0 ELSE sum((cp - rp) * ln(cp / rp)) END AS psi FROM p GROUP BY feature)",
    )
    + f"SELECT feature, {r('psi')} AS psi, psi > 0.1 AS drifted FROM ps",
)
def q_d4b(spark, sf_dir):
    return present(drift.psi_pooled(tables.drift_long(spark, sf_dir)))


JS_CTE = ["edges AS (" + _rng("drift_long", "feature") + ")", *_grid_cte("edges"),
          "pq AS (SELECT feature, n_ref / tot_ref AS p, n_cur / tot_cur AS q FROM g)",
          """js AS (SELECT feature, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2.0)) ELSE 0 END
                    + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2.0)) ELSE 0 END) / 2.0, 0.0)) AS js FROM pq GROUP BY feature)"""]


@register("d5_jensen_shannon", with_(DRIFT_LONG, *JS_CTE) + f"SELECT feature, {r('js')} AS js FROM js")
def q_d5(spark, sf_dir):
    return present(drift.js_distance(tables.drift_long(spark, sf_dir)))


SEV = """CASE WHEN psi >= 0.25 OR js >= 0.2 THEN 'critical' WHEN psi >= 0.1 OR js >= 0.1 THEN 'warning'
     WHEN ks_pvalue < 0.05 THEN 'warning' ELSE 'none' END"""
FD_CTE = [*KS_CTE, *PSI_CTE[:1], *[c.replace("edges", "edges") for c in PSI_CTE[1:]]]


def _fd_sql() -> str:
    psi_ctes = [c.replace(" c AS", " pc AS").replace("c AS (SELECT feature, least", "c AS (SELECT feature, least") for c in PSI_CTE]
    # build PSI and JS grids under distinct names
    psi_part = [
        "pe AS (" + _rng("drift_long", "feature", "WHERE side = 'ref'") + ")",
        *[x.replace("c AS (", "pc AS (", 1).replace("g0 AS (", "pg0 AS (", 1).replace("g AS (", "pg AS (", 1) for x in _grid_cte("pe")],
    ]
    psi_part = [x.replace("FROM g0 LEFT JOIN c ON g0.feature = c.feature AND g0.bin = c.bin", "FROM pg0 g0 LEFT JOIN pc c ON g0.feature = c.feature AND g0.bin = c.bin") for x in psi_part]
    psi_part += [
        """pp AS (SELECT feature, least(greatest(n_ref / (tot_ref + 1e-10), 1e-10), 1.0) AS rp,
                 least(greatest(n_cur / (tot_cur + 1e-10), 1e-10), 1.0) AS cp FROM pg)""",
        "psi AS (SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM pp GROUP BY feature)",
    ]
    js_part = [
        "je AS (" + _rng("drift_long", "feature") + ")",
        *[x.replace("c AS (", "jc AS (", 1).replace("g0 AS (", "jg0 AS (", 1).replace("g AS (", "jg AS (", 1) for x in _grid_cte("je")],
    ]
    js_part = [x.replace("FROM g0 LEFT JOIN c ON g0.feature = c.feature AND g0.bin = c.bin", "FROM jg0 g0 LEFT JOIN jc c ON g0.feature = c.feature AND g0.bin = c.bin") for x in js_part]
    js_part += [JS_CTE[-2].replace("FROM g)", "FROM jg)"), JS_CTE[-1]]
    del psi_ctes
    return with_(DRIFT_LONG, *KS_CTE, *psi_part, *js_part, "fd AS (SELECT ks.feature, ks_stat, " + ks_pvalue_sql("ks_stat", "n_ref", "n_cur")
                 + " AS ks_pvalue, psi, js, n_ref, n_cur FROM ks JOIN psi USING (feature) JOIN js USING (feature) WHERE n_cur >= 10)")


FD_SQL = _fd_sql()


@register(
    "d6_j5_feature_drift",
    FD_SQL
    + f"SELECT feature, {r('ks_stat')} AS ks_stat, {r('ks_pvalue')} AS ks_pvalue, {r('psi')} AS psi, {r('js')} AS js, n_ref, n_cur, "
    f"({SEV}) <> 'none' AS drift_detected, {SEV} AS severity FROM fd",
)
def q_d6(spark, sf_dir):
    return present(drift.feature_drift(tables.drift_long(spark, sf_dir)))


D7_SELECT = f"""SELECT CAST(count(*) FILTER (WHERE sev <> 'none') AS BIGINT) AS drifted_feature_count, count(*) AS total_features,
  {r("coalesce(count(*) FILTER (WHERE sev <> 'none') / count(*), 0.0)")} AS drift_share,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE sev <> 'none')), ','), '') AS drifted_features,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE sev = 'critical')), ','), '') AS critical_features,
  {r('avg(psi)')} AS avg_psi, {r('coalesce(max(psi), 0.0)')} AS max_psi, {r('avg(js)')} AS avg_js,
  coalesce(count(*) FILTER (WHERE sev <> 'none') / count(*), 0.0) >= 0.3 AS overall_drift
FROM (SELECT *, {SEV} AS sev FROM fd)"""


@register("d7_data_drift_summary", FD_SQL + D7_SELECT)
def q_d7(spark, sf_dir):
    s = drift.data_drift_summary(drift.feature_drift(tables.drift_long(spark, sf_dir)))
    return present(s.withColumn("drifted_features", F.array_join("drifted_features", ",")).withColumn("critical_features", F.array_join("critical_features", ",")))


# ---- error / prediction streams (scored view) -------------------------------------------

def _scored(spark, sf_dir):
    return tables.scored_stream(spark, sf_dir)


def _baseline(spark, sf_dir):
    s = _scored(spark, sf_dir).filter(F.col("side") == "ref")
    return evaluate.regression_metrics(s.withColumnRenamed("actual", "y"), by=["model_type"]).select("model_type", F.col("rmse").alias("baseline_error"))


@register(
    "d8_baseline_error",
    with_(SCORED) + f"SELECT model_type, {r('sqrt(avg((actual - prediction) * (actual - prediction)))', 4)} AS baseline_error FROM scored WHERE side = 'ref' GROUP BY model_type",
)
def q_d8(spark, sf_dir):
    return present(_baseline(spark, sf_dir), 4)


CONCEPT_CTE = [
    SCORED,
    "e AS (SELECT *, (prediction - actual) * (prediction - actual) AS err2 FROM scored)",
    "base AS (SELECT model_type, sqrt(avg(err2)) AS baseline_error FROM e WHERE side = 'ref' GROUP BY model_type)",
    """w AS (SELECT e.*, sqrt(avg(err2) OVER (PARTITION BY model_type ORDER BY ts, request_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)) AS current_error,
            CAST(least(row_number() OVER (PARTITION BY model_type ORDER BY ts, request_id), 1000) AS INTEGER) AS window_size FROM e)""",
    """v AS (SELECT w.*, base.baseline_error, (current_error - base.baseline_error) / (base.baseline_error + 1e-10) AS inc,
            row_number() OVER (PARTITION BY w.model_type, CAST(ts AS DATE) ORDER BY ts DESC, request_id DESC) AS rn_day,
            row_number() OVER (PARTITION BY w.model_type ORDER BY ts DESC, request_id DESC) AS rn_all
          FROM w JOIN base ON w.model_type = base.model_type)""",
]
TREND = "CASE WHEN inc > 0.1 THEN 'increasing' WHEN inc < -0.1 THEN 'decreasing' ELSE 'stable' END"


def _concept(spark, sf_dir):
    return drift.concept_drift(_scored(spark, sf_dir), ["model_type"], ["ts", "request_id"], _baseline(spark, sf_dir))


def _day_end(df, keys):
    return drift.last_per(df, [*keys, F.to_date("ts").alias("day")], ["ts", "request_id"])


@register(
    "d9_concept_drift",
    with_(*CONCEPT_CTE)
    + f"""SELECT model_type, strftime(ts, '%Y-%m-%d') AS day, {r('current_error', 4)} AS current_error, window_size,
  {r('inc * 100.0', 4)} AS error_increase_pct, inc >= 0.2 AS drift_detected, {TREND} AS trend FROM v WHERE rn_day = 1""",
)
def q_d9(spark, sf_dir):
    c = _day_end(_concept(spark, sf_dir), ["model_type"])
    return present(
        c.select("model_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "current_error", "window_size", "error_increase_pct", "drift_detected", "trend"), 4
    )


PH_CTE = [
    SCORED,
    "p AS (SELECT model_type, ts, request_id, abs(prediction - actual) AS x, CASE WHEN side = 'ref' THEN 0 ELSE 1 END AS epoch FROM scored)",
]


def _ph_sql(keys: str) -> str:
    part = f"PARTITION BY {keys} ORDER BY ts, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return with_(
        *PH_CTE,
        f"a AS (SELECT *, avg(x) OVER ({part}) AS m FROM p)",
        f"b AS (SELECT *, sum(x - m - 0.005) OVER ({part}) AS s FROM a)",
        f"c AS (SELECT *, s - min(s) OVER ({part}) AS ph, row_number() OVER (PARTITION BY {keys}, CAST(ts AS DATE) ORDER BY ts DESC, request_id DESC) AS rn FROM b)",
    ) + f"SELECT {keys}, strftime(ts, '%Y-%m-%d') AS day, {r('ph', 2)} AS ph_stat, {r('m', 4)} AS ph_mean FROM c WHERE rn = 1"


def _ph(spark, sf_dir, keys):
    s = _scored(spark, sf_dir).select(
        "model_type", "ts", "request_id", F.abs(F.col("prediction") - F.col("actual")).alias("x"),
        F.when(F.col("side") == "ref", 0).otherwise(1).alias("epoch"),
    )
    ph = drift.page_hinkley(s, keys, ["ts", "request_id"], "x")
    d = _day_end(ph, keys)
    return d.select(*keys, F.date_format("ts", "yyyy-MM-dd").alias("day"), F.round("ph_stat", 2).alias("ph_stat"), F.round("ph_mean", 4).alias("ph_mean"))


@register("d10_page_hinkley", _ph_sql("model_type"))
def q_d10(spark, sf_dir):
    return _ph(spark, sf_dir, ["model_type"])


@register("d14_baseline_reset_epochs", _ph_sql("model_type, epoch").replace("SELECT model_type, epoch, strftime", "SELECT model_type, CAST(epoch AS INTEGER) AS epoch, strftime"))
def q_d14(spark, sf_dir):
    return _ph(spark, sf_dir, ["model_type", "epoch"])


PD_CTE = [
    SCORED,
    "dv AS (SELECT model_type AS feature, prediction AS value, count(*) FILTER (WHERE side = 'ref') AS a, count(*) FILTER (WHERE side = 'cur') AS b FROM scored GROUP BY ALL)",
    KS_CTE[1],
    KS_CTE[2],
    """st AS (SELECT model_type, avg(prediction) FILTER (WHERE side = 'ref') AS ref_mean, stddev_pop(prediction) FILTER (WHERE side = 'ref') AS ref_std,
             avg(prediction) FILTER (WHERE side = 'cur') AS cur_mean, stddev_pop(prediction) FILTER (WHERE side = 'cur') AS cur_std FROM scored GROUP BY model_type)""",
    f"""pd AS (SELECT model_type, n_ref, n_cur, n_ref < 100 AS warming, ks_stat, {ks_pvalue_sql('ks_stat', 'n_ref', 'n_cur')} AS ks_pvalue,
             (cur_mean - ref_mean) / (ref_mean + 1e-10) AS ms, (cur_std - ref_std) / (ref_std + 1e-10) AS ss
           FROM ks JOIN st ON ks.feature = st.model_type)""",
]
PD_SELECT = f"""SELECT model_type, n_ref, n_cur, {r('CASE WHEN warming THEN 0.0 ELSE ks_stat END')} AS ks_stat,
  {r('CASE WHEN warming THEN 1.0 ELSE ks_pvalue END')} AS ks_pvalue, {r('CASE WHEN warming THEN 0.0 ELSE ms END')} AS mean_shift,
  {r('CASE WHEN warming THEN 0.0 ELSE ss END')} AS std_shift, {r('CASE WHEN warming THEN 0.0 ELSE ks_stat + abs(ms) * 0.5 + abs(ss) * 0.3 END')} AS drift_score,
  NOT warming AND ks_pvalue < 0.05 AS drift_detected, CASE WHEN warming THEN 'warming_up' ELSE 'checked' END AS verdict FROM pd"""


def _pdrift(spark, sf_dir):
    s = _scored(spark, sf_dir).select("model_type", "side", "prediction")
    return drift.prediction_drift(s, ["model_type"])


@register("d11_prediction_drift", with_(*PD_CTE) + PD_SELECT)
def q_d11(spark, sf_dir):
    return present(_pdrift(spark, sf_dir))


def _report(spark, sf_dir):
    data = drift.data_drift_summary(drift.feature_drift(tables.drift_long(spark, sf_dir)))
    c = _concept(spark, sf_dir)
    last = drift.last_per(c, ["model_type"], ["ts", "request_id"]).select("model_type", "error_increase_pct", F.col("drift_detected").alias("concept_drift"), "trend")
    p = _pdrift(spark, sf_dir).select("model_type", "ks_stat", "mean_shift", F.col("drift_detected").alias("prediction_drift"))
    return drift.drift_report(data, last, p)


def _report_sql(select: str) -> str:
    ctes = FD_SQL.replace("WITH ", "", 1).rstrip()
    concept = ",\n".join(CONCEPT_CTE[1:])
    pdv = PD_CTE[1].replace("dv AS (", "pdv AS (", 1)
    pks = [KS_CTE[1].replace("cum AS (", "pcum AS (", 1).replace("FROM dv", "FROM pdv"), KS_CTE[2].replace("ks AS (", "pks AS (", 1).replace("FROM cum", "FROM pcum")]
    pdc = pdv + ",\n" + ",\n".join(pks) + ",\n" + PD_CTE[4] + ",\n" + PD_CTE[5].replace("FROM ks JOIN st ON ks.feature", "FROM pks JOIN st ON pks.feature")
    pks = []
    summ = "summ AS (" + D7_SELECT.replace("coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE sev = 'critical')), ','), '') AS critical_features",
                                            "coalesce(list_sort(list(feature) FILTER (WHERE sev = 'critical')), []) AS critical_features") + ")"
    summ = summ.replace(r("avg(psi)"), "avg(psi)").replace(r("coalesce(count(*) FILTER (WHERE sev <> 'none') / count(*), 0.0)"), "coalesce(count(*) FILTER (WHERE sev <> 'none') / count(*), 0.0)")
    head = "WITH " + ctes + ",\n" + SCORED + ",\n" + concept + ",\n" + pdc + ",\n" + summ + ",\n"
    body = f"""lastc AS (SELECT model_type, inc * 100.0 AS error_increase_pct, inc >= 0.2 AS concept_drift, {TREND} AS trend FROM v WHERE rn_all = 1),
pdr AS (SELECT model_type, CASE WHEN warming THEN 0.0 ELSE ks_stat END AS ks_stat, CASE WHEN warming THEN 0.0 ELSE ms END AS mean_shift,
        NOT warming AND ks_pvalue < 0.05 AS prediction_drift FROM pd),
rep AS (SELECT lastc.*, pdr.ks_stat, pdr.mean_shift, pdr.prediction_drift, summ.* FROM lastc JOIN pdr USING (model_type), summ),
rec AS (SELECT *, list_filter([
   CASE WHEN overall_drift THEN printf('Data drift detected in %d features (%.1f%%). Consider retraining.', drifted_feature_count, drift_share * 100.0) END,
   CASE WHEN overall_drift AND len(critical_features) > 0 THEN 'Critical drift in features: ' || array_to_string(critical_features[1:5], ', ') END,
   CASE WHEN concept_drift THEN printf('Concept drift detected: error increased by %.1f%%. Model performance degraded.', error_increase_pct)
        WHEN trend = 'increasing' THEN 'Error trend is increasing. Monitor closely.' END,
   CASE WHEN prediction_drift THEN 'Prediction distribution shift detected. Mean shift: ' || printf('%.2f%%', mean_shift * 100.0) END], lambda x: x IS NOT NULL) AS recs,
 list_filter([
   CASE WHEN overall_drift THEN 'Data drift: ' || printf('%.1f%%', drift_share * 100.0) || ' features drifted' END,
   CASE WHEN concept_drift THEN printf('Concept drift: error increased %.1f%%', error_increase_pct) END,
   CASE WHEN prediction_drift THEN printf('Prediction drift: KS statistic %.4f', ks_stat) END], lambda x: x IS NOT NULL) AS rs FROM rep)
"""
    return head + body + select


D12_SELECT = """SELECT model_type, CASE WHEN len(recs) = 0 THEN 'No significant drift detected. Model is performing as expected.' ELSE array_to_string(recs, ' | ') END AS recommendations,
  array_to_string(rs, ' | ') AS reasons, len(rs) > 0 AS retrain FROM rec"""


@register("d12_d13_drift_report", _report_sql(D12_SELECT))
def q_d12(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return rep.select("model_type", F.array_join("recommendations", " | ").alias("recommendations"), F.array_join("reasons", " | ").alias("reasons"), "retrain")


@register("d15_drift_history")
def q_d15(spark, sf_dir):
    """Append one summary row per report to a history table in the shared checkpoint folder, read it back."""
    rep = _report(spark, sf_dir).select(
        F.current_timestamp().alias("reported_at"), "model_type", "retrain", F.col("overall_drift").alias("data_drift"),
        "concept_drift", "prediction_drift",
    )
    from ..sources.telemetry import scratch_path

    path = scratch_path(spark, "drift_history")  # a fresh history table per run keeps the result deterministic
    rep.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register(
    "d16_drift_summary_table",
    with_(
        DRIFT_LONG,
        "edges AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM drift_long GROUP BY feature)",
        *_grid_cte("edges"),
        "p AS (SELECT feature, lo = hi AS const, least(greatest(n_ref / tot_ref, 1e-4), 1.0) AS rp, least(greatest(n_cur / tot_cur, 1e-4), 1.0) AS cp FROM g)",
        "ps AS (SELECT feature, CASE WHEN any_value(const) THEN 0.0 ELSE sum((cp - rp) * ln(cp / rp)) END AS psi FROM p GROUP BY feature)",
        """ms AS (SELECT feature, avg(value) FILTER (WHERE side = 'ref') AS ref_mean, avg(value) FILTER (WHERE side = 'cur') AS cur_mean,
                stddev_pop(value) FILTER (WHERE side = 'ref') AS ref_std, stddev_pop(value) FILTER (WHERE side = 'cur') AS cur_std FROM drift_long GROUP BY feature)""",
    )
    + """SELECT feature, round(psi, 4) AS psi, round(ref_mean, 4) AS ref_mean, round(cur_mean, 4) AS cur_mean, round(ref_std, 4) AS ref_std,
  round(cur_std, 4) AS cur_std, psi > 0.1 AS drifted, round(max(psi) OVER (), 4) AS max_psi, round(avg(psi) OVER (), 4) AS mean_psi,
  CAST(count(*) FILTER (WHERE psi > 0.1) OVER () AS BIGINT) AS num_drifted FROM ps JOIN ms USING (feature)""",
)
def q_d16(spark, sf_dir):
    long = tables.drift_long(spark, sf_dir)
    return drift.summary_table(long)


@register(
    "d17_drift_injection",
    with_(TELEMETRY_LINEITEM, "s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_tax) AS m2, stddev_pop(l_tax) AS s2 FROM telemetry_lineitem)")
    + f"""SELECT unit_id, time_cycle, {r('l_extendedprice')} AS l_extendedprice, {r('l_discount')} AS l_discount,
  {r('l_quantity + 0.5 * s1', 4)} AS l_quantity, {r('m2 + (l_tax - m2) * 1.2 + 0.5 * s2', 4)} AS l_tax FROM telemetry_lineitem, s""",
)
def q_d17(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir).drop("l_shipdate")
    a = drift.inject_drift(t, ["l_quantity"], "shift", 0.5)
    b = drift.inject_drift(a, ["l_tax"], "mixed", 0.5, 1.2, stats=t.agg(F.avg("l_tax").alias("m__l_tax"), F.stddev_pop("l_tax").alias("s__l_tax")))
    return present(b.select("unit_id", "time_cycle", "l_extendedprice", "l_discount", F.round("l_quantity", 4).alias("l_quantity"), F.round("l_tax", 4).alias("l_tax")))


@register(
    "j6_pooled_sample",
    with_(DRIFT_LONG) + "SELECT feature, side, count(*) AS n, " + r("avg(value)") + " AS mean FROM drift_long GROUP BY ALL",
)
def q_j6(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events")
    split = F.lit(tables.DRIFT_SPLIT_TS).cast("timestamp_ntz")
    ref = ev.filter(F.col("ts") < split).select(F.col("event_type").alias("feature"), "value")
    cur = ev.filter(F.col("ts") >= split).select(F.col("event_type").alias("feature"), "value")
    p = drift.pooled(ref, cur)
    return present(p.groupBy("feature", "side").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")))


@register("sql_surface_ks_pvalue", with_(DRIFT_LONG, *KS_CTE) + KS_SELECT)
def q_sql_ks(spark, sf_dir):
    """The KS query written in Spark SQL against the registered views and the
    ``ks_pvalue`` SQL function."""
    from ..functions import sql as sqlsurface

    sqlsurface.register(spark, sf_dir)
    return spark.sql(
        """WITH dv AS (SELECT feature, value, count_if(side = 'ref') AS a, count_if(side = 'cur') AS b FROM drift_long GROUP BY feature, value),
        cum AS (SELECT feature, value, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS n, sum(b) OVER (PARTITION BY feature) AS m
                FROM dv WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        ks AS (SELECT feature, max(abs(ca / n - cb / m)) AS ks_stat, first(n) AS n_ref, first(m) AS n_cur FROM cum GROUP BY feature)
        SELECT feature, round(ks_stat, 6) AS ks_stat, round(ks_pvalue(ks_stat, n_ref, n_cur), 6) AS ks_pvalue, n_ref, n_cur FROM ks"""
    )
