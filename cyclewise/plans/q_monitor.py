"""Catalog entries: monitoring queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alerts, decide, drift, monitor, windows
from ..operators.scan import exact_quantiles
from ..session import cut_lineage
from ..sources import tables
from .registry import present, r, register
from .sqlviews import DRIFT_LONG, PREDICTION_LOG, with_

PL = with_(PREDICTION_LOG)
B = monitor.LATENCY_BOUNDS
BUCKET_SQL = "CASE " + " ".join(f"WHEN latency_s <= {b} THEN {i}" for i, b in enumerate(B)) + f" ELSE {len(B)} END"
LE_VALUES = "le AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, CAST({b} AS DOUBLE))" for i, b in enumerate(B)) + f", ({len(B)}, 'inf'::DOUBLE)) t(bucket, le))"
SLOT = "CAST(floor(epoch_us(ts) / 30000000) AS BIGINT)"
TS_FMT = "%Y-%m-%d %H:%M:%S"


def ts_sql(sec_expr: str) -> str:
    return f"strftime(make_timestamp(CAST({sec_expr} AS BIGINT) * 1000000), '{TS_FMT}')"


def fmt(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _log(spark, sf_dir):
    return tables.prediction_log(spark, sf_dir)


@register("o1_labelled_counters", PL + "SELECT model_type, status, count(*) AS count FROM prediction_log GROUP BY ALL")
def q_o1(spark, sf_dir):
    return monitor.counters(_log(spark, sf_dir))


@register(
    "o2_latency_histogram",
    with_(PREDICTION_LOG, LE_VALUES,
          f"c AS (SELECT model_type, {BUCKET_SQL} AS bucket, count(*) AS n FROM prediction_log GROUP BY ALL)",
          "t AS (SELECT model_type, count(*) AS count, sum(latency_s) AS sum FROM prediction_log GROUP BY ALL)")
    + f"""SELECT t.model_type, CAST(le.bucket AS INTEGER) AS bucket, le.le AS le,
  CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY t.model_type ORDER BY le.bucket ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum,
  t.count, {r('t.sum', 4)} AS sum FROM t CROSS JOIN le LEFT JOIN c ON c.model_type = t.model_type AND c.bucket = le.bucket""",
)
def q_o2(spark, sf_dir):
    return present(monitor.latency_histogram(_log(spark, sf_dir)), 4)


LATEST_RUL = "lr AS (SELECT unit_id, arg_max(rul, (ts, request_id)) AS rul FROM prediction_log GROUP BY unit_id)"


def _latest_rul(spark, sf_dir):
    return monitor.latest(_log(spark, sf_dir), ["unit_id"], "rul", ["ts", "request_id"])


@register("o3_latest_gauge", with_(PREDICTION_LOG, LATEST_RUL) + "SELECT unit_id, rul FROM lr")
def q_o3(spark, sf_dir):
    return _latest_rul(spark, sf_dir)


@register(
    "o4_batch_latency_attribution",
    PL + f"""SELECT unit_id, strftime(date_trunc('hour', ts), '{TS_FMT}') AS batch_hour, {r('sum(latency_s)')} AS batch_latency, count(*) AS n,
  {r('sum(latency_s) / greatest(count(*), 1)')} AS per_sample_latency FROM prediction_log GROUP BY ALL""",
)
def q_o4(spark, sf_dir):
    l_ = _log(spark, sf_dir).withColumn("batch_hour", fmt(F.date_trunc("hour", "ts")))
    return present(monitor.batch_latency(l_, ["unit_id", "batch_hour"]))


@register(
    "o5_rul_alert_levels",
    with_(PREDICTION_LOG, LATEST_RUL)
    + "SELECT CASE WHEN rul < 10 THEN 'critical' WHEN rul < 25 THEN 'warning' ELSE 'ok' END AS severity, count(*) AS units FROM lr GROUP BY 1",
)
def q_o5(spark, sf_dir):
    return _latest_rul(spark, sf_dir).groupBy(monitor.rul_severity(F.col("rul")).alias("severity")).agg(F.count(F.lit(1)).alias("units"))


def _fan(select_slot_cols: str, group: str, agg: str) -> list[str]:
    return [
        f"s AS (SELECT {group}, {SLOT} AS slot, {select_slot_cols} FROM prediction_log GROUP BY ALL)",
        f"f AS (SELECT *, unnest(range(slot - 9, slot + 1)) AS st FROM s)",
        f"w AS (SELECT {group}, st, {agg} FROM f GROUP BY ALL)",
    ]


@register(
    "o7_rate_5m",
    with_(PREDICTION_LOG, *_fan("count(*) AS n", "model_type, status", "CAST(sum(n) AS BIGINT) AS n"))
    + f"SELECT model_type, status, {ts_sql('st * 30')} AS window_start, n, {r('n / 300.0')} AS rate FROM w",
)
def q_o7(spark, sf_dir):
    out = monitor.rates(_log(spark, sf_dir))
    return present(out.select("model_type", "status", fmt(F.col("window_start")).alias("window_start"), "n", "rate"))


ER_CTE = _fan("count(*) AS n, count(*) FILTER (WHERE status = 'error') AS errors", "model_type",
              "CAST(sum(n) AS BIGINT) AS n, CAST(sum(errors) AS BIGINT) AS errors")


@register(
    "o8_j3_error_ratio",
    with_(PREDICTION_LOG, *ER_CTE)
    + f"""SELECT model_type, {ts_sql('st * 30')} AS window_start, n, errors, {r('errors / n')} AS error_ratio,
  CASE WHEN errors / n > 0.1 THEN 'critical' WHEN errors / n > 0.05 THEN 'warning' ELSE 'ok' END AS level FROM w""",
)
def q_o8(spark, sf_dir):
    out = monitor.error_ratio(_log(spark, sf_dir))
    return present(out.select("model_type", fmt(F.col("window_start")).alias("window_start"), "n", "errors", "error_ratio", "level"))


def _hq_ctes(prefix: str = "h", digits: int | None = 6) -> list[str]:
    """The quantile CTEs with prefixed names; the last one, ``{prefix}q``, holds
    (model_type, st, total, p50, p95, p99) unrounded."""
    parts = []
    for q in (0.5, 0.95, 0.99):
        p = f"p{int(round(q * 100))}"
        parts.append(
            f"arg_min(struct_pack(le := le, prev_le := prev_le, cum := cum, prev_cum := prev_cum), bucket) FILTER (WHERE cum >= {q} * total) AS s{p}"
        )
    sel = []
    for q in (0.5, 0.95, 0.99):
        p = f"p{int(round(q * 100))}"
        e = (f"CASE WHEN total = 0 THEN NULL WHEN s{p}.le = 'inf'::DOUBLE THEN {float(B[-1])} ELSE s{p}.prev_le + (s{p}.le - s{p}.prev_le) * "
             f"(({q} * total - s{p}.prev_cum) / (s{p}.cum - s{p}.prev_cum)) END")
        sel.append(f"{e} AS {p}")
    h = prefix
    return [
        LE_VALUES.replace("le AS (", f"{h}le AS (", 1),
        f"{h}s AS (SELECT model_type, {SLOT} AS slot, {BUCKET_SQL} AS bucket, count(*) AS n FROM prediction_log GROUP BY ALL)",
        f"{h}f AS (SELECT *, unnest(range(slot - 9, slot + 1)) AS st FROM {h}s)",
        f"{h}c AS (SELECT model_type, st, bucket, sum(n) AS n FROM {h}f GROUP BY ALL)",
        f"{h}k AS (SELECT DISTINCT model_type, st FROM {h}c)",
        f"{h}g AS (SELECT k.model_type, k.st, le.bucket, le.le, coalesce(c.n, 0) AS n FROM {h}k k CROSS JOIN {h}le le LEFT JOIN {h}c c ON c.model_type = k.model_type AND c.st = k.st AND c.bucket = le.bucket)",
        f"{h}g2 AS (SELECT *, sum(n) OVER (PARTITION BY model_type, st ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS cum FROM {h}g)",
        f"""{h}g3 AS (SELECT *, coalesce(lag(cum) OVER w, 0) AS prev_cum, coalesce(lag(le) OVER w, 0.0) AS prev_le,
              max(cum) OVER (PARTITION BY model_type, st) AS total FROM {h}g2 WINDOW w AS (PARTITION BY model_type, st ORDER BY bucket))""",
        f"{h}q0 AS (SELECT model_type, st, any_value(total) AS total, " + ", ".join(parts) + f" FROM {h}g3 GROUP BY ALL)",
        f"{h}q AS (SELECT model_type, st, total, " + ", ".join(sel) + f" FROM {h}q0)",
    ]


def _hq_sql() -> str:
    parts = []
    for q in (0.5, 0.95, 0.99):
        p = f"p{int(round(q * 100))}"
        parts.append(
            f"arg_min(struct_pack(le := le, prev_le := prev_le, cum := cum, prev_cum := prev_cum), bucket) FILTER (WHERE cum >= {q} * total) AS s{p}"
        )
    sel = []
    for q in (0.5, 0.95, 0.99):
        p = f"p{int(round(q * 100))}"
        e = (f"CASE WHEN total = 0 THEN NULL WHEN s{p}.le = 'inf'::DOUBLE THEN {float(B[-1])} ELSE s{p}.prev_le + (s{p}.le - s{p}.prev_le) * "
             f"(({q} * total - s{p}.prev_cum) / (s{p}.cum - s{p}.prev_cum)) END")
        sel.append(f"{r(e)} AS {p}")
    return with_(
        PREDICTION_LOG, LE_VALUES,
        f"s AS (SELECT model_type, {SLOT} AS slot, {BUCKET_SQL} AS bucket, count(*) AS n FROM prediction_log GROUP BY ALL)",
        "f AS (SELECT *, unnest(range(slot - 9, slot + 1)) AS st FROM s)",
        "c AS (SELECT model_type, st, bucket, sum(n) AS n FROM f GROUP BY ALL)",
        "k AS (SELECT DISTINCT model_type, st FROM c)",
        "g AS (SELECT k.model_type, k.st, le.bucket, le.le, coalesce(c.n, 0) AS n FROM k CROSS JOIN le LEFT JOIN c ON c.model_type = k.model_type AND c.st = k.st AND c.bucket = le.bucket)",
        "g2 AS (SELECT *, sum(n) OVER (PARTITION BY model_type, st ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS cum FROM g)",
        """g3 AS (SELECT *, coalesce(lag(cum) OVER w, 0) AS prev_cum, coalesce(lag(le) OVER w, 0.0) AS prev_le,
              max(cum) OVER (PARTITION BY model_type, st) AS total FROM g2 WINDOW w AS (PARTITION BY model_type, st ORDER BY bucket))""",
        "q AS (SELECT model_type, st, any_value(total) AS total, " + ", ".join(parts) + " FROM g3 GROUP BY ALL)",
    ) + f"SELECT model_type, {ts_sql('st * 30')} AS window_start, CAST(total AS BIGINT) AS total, " + ", ".join(sel) + " FROM q"


@register("o9_histogram_quantiles", _hq_sql())
def q_o9(spark, sf_dir):
    out = monitor.histogram_quantiles(_log(spark, sf_dir))
    return present(out.select("model_type", fmt(F.col("window_start")).alias("window_start"), F.col("total").cast("bigint"), "p50", "p95", "p99"))


def _o10_sql():
    from .q_drift import PSI_CTE

    return with_(DRIFT_LONG, *PSI_CTE) + f"SELECT {r('avg(psi)')} AS avg_psi, {r('max(psi)')} AS max_psi FROM psi"


@register("o10_drift_aggregates", _o10_sql())
def q_o10(spark, sf_dir):
    p = drift.psi(tables.drift_long(spark, sf_dir))
    return present(p.agg(F.avg("psi").alias("avg_psi"), F.max("psi").alias("max_psi")))


def _episodes_sql(cond_cte: str, hold: int) -> str:
    return f""", t AS ({cond_cte}),
i0 AS (SELECT *, lag(sec) OVER (PARTITION BY model_type ORDER BY sec) AS prev FROM t),
i AS (SELECT *, sum(CASE WHEN prev IS NULL OR sec - prev > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY model_type ORDER BY sec ROWS UNBOUNDED PRECEDING) AS island FROM i0),
j AS (SELECT *, min(sec) OVER (PARTITION BY model_type, island) AS start FROM i)
SELECT model_type, {ts_sql('min(sec)')} AS started_at, {ts_sql('max(sec)')} AS ended_at, count(*) AS evaluations,
  {ts_sql(f'min(sec) FILTER (WHERE sec - start >= {hold})')} AS fired_at, count(*) FILTER (WHERE sec - start >= {hold}) AS firing_evaluations
FROM j GROUP BY model_type, island"""


def _episodes(ev, hold):
    e = monitor.alert_episodes(ev, ["model_type"], "window_start", "cond", hold, 30)
    return e.select("model_type", fmt(F.col("started_at")).alias("started_at"), fmt(F.col("ended_at")).alias("ended_at"), "evaluations",
                    fmt(F.col("fired_at")).alias("fired_at"), "firing_evaluations")


@register(
    "o11_alert_hold_error_ratio",
    with_(PREDICTION_LOG, *ER_CTE).rstrip() + _episodes_sql("SELECT model_type, st * 30 AS sec FROM w WHERE errors / n > 0.05", 300),
)
def q_o11(spark, sf_dir):
    log = _log(spark, sf_dir)
    er = monitor.error_ratio(log).withColumn("cond", F.col("error_ratio") > monitor.ERROR_RATIO_WARNING)
    return _episodes(er, 300)


@register(
    "o12_silence_alert",
    with_(PREDICTION_LOG, *ER_CTE,
          "span AS (SELECT model_type, min(slot) - 9 AS lo, (SELECT max(slot) FROM s) AS hi FROM s GROUP BY model_type)",
          "grid AS (SELECT model_type, unnest(range(lo, hi + 1)) AS st FROM span)").rstrip()
    + _episodes_sql("SELECT grid.model_type, grid.st * 30 AS sec FROM grid LEFT JOIN w ON grid.model_type = w.model_type AND grid.st = w.st WHERE coalesce(w.n, 0) = 0", 300),
)
def q_o12(spark, sf_dir):
    log = _log(spark, sf_dir)
    grid = monitor.evaluation_grid(log, ["model_type"])
    r_ = monitor.rates(log, ["model_type"]).select("model_type", "window_start", "rate")
    ev = grid.join(r_, ["model_type", "window_start"], "left").withColumn("cond", F.coalesce(F.col("rate"), F.lit(0.0)) == 0)
    return _episodes(ev, 300)


@register(
    "o13_latency_slo",
    with_(PREDICTION_LOG, *_fan("count(*) AS n, count(*) FILTER (WHERE latency_s <= 0.5) AS fast", "model_type",
                                "CAST(sum(n) AS BIGINT) AS n, CAST(sum(fast) AS BIGINT) AS fast"))
    + f"SELECT model_type, {ts_sql('st * 30')} AS window_start, n, {r('fast / n')} AS within_share, fast / n < 0.99 AS breach FROM w",
)
def q_o13(spark, sf_dir):
    c = monitor.sliding_counts(_log(spark, sf_dir), ["model_type"], conds={"fast": F.col("latency_s") <= monitor.LATENCY_SLO_SECONDS})
    share = F.col("fast") / F.col("n")
    return present(c.select("model_type", fmt(F.col("window_start")).alias("window_start"), "n", share.alias("within_share"),
                            (share < monitor.LATENCY_SLO_SHARE).alias("breach")))


@register(
    "o14_availability_slo",
    with_(PREDICTION_LOG,
          "s AS (SELECT model_type, CAST(floor(epoch_us(ts) / 300000000) AS BIGINT) AS slot, count(*) AS n, count(*) FILTER (WHERE status = 'success') AS ok FROM prediction_log GROUP BY ALL)",
          "f AS (SELECT *, unnest(range(slot - 11, slot + 1)) AS st FROM s)",
          "w AS (SELECT model_type, st, CAST(sum(n) AS BIGINT) AS n, CAST(sum(ok) AS BIGINT) AS ok FROM f GROUP BY ALL)")
    + f"SELECT model_type, {ts_sql('st * 300')} AS window_start, n, {r('ok / n')} AS success_share, ok / n < 0.999 AS breach FROM w",
)
def q_o14(spark, sf_dir):
    c = monitor.sliding_counts(_log(spark, sf_dir), ["model_type"], width_s=3600, slide_s=300, conds={"ok": F.col("status") == "success"})
    share = F.col("ok") / F.col("n")
    return present(c.select("model_type", fmt(F.col("window_start")).alias("window_start"), "n", share.alias("success_share"),
                            (share < monitor.AVAILABILITY_SLO).alias("breach")))


@register(
    "o15_volume_scale_up",
    with_(PREDICTION_LOG, *_fan("count(*) AS n, sum(latency_s) AS lat", "model_type", "CAST(sum(n) AS BIGINT) AS n, sum(lat) AS lat"))
    + f"""SELECT model_type, {ts_sql('st * 30')} AS window_start, {r('n / 300.0', 9)} AS rate, {r('lat / n', 9)} AS mean_latency,
  n / 300.0 > 100 AS high_volume, lat / n > 0.3 AND n / 300.0 > 50 AS scale_up FROM w""",
)
def q_o15(spark, sf_dir):
    c = monitor.sliding_counts(_log(spark, sf_dir), ["model_type"], sums=["latency_s"])
    rate = F.col("n") / 300.0
    ml = F.col("sum_latency_s") / F.col("n")
    return present(c.select("model_type", fmt(F.col("window_start")).alias("window_start"), rate.alias("rate"), F.round(ml, 9).alias("mean_latency"),
                            (rate > monitor.SCALE_RATE).alias("high_volume"), ((ml > monitor.SCALE_LATENCY) & (rate > monitor.SCALE_LATENCY_RATE)).alias("scale_up")), 9)


@register("o16_w10_bottom_k_units", with_(PREDICTION_LOG, LATEST_RUL) + "SELECT unit_id, rul FROM lr ORDER BY rul, unit_id LIMIT 10")
def q_o16(spark, sf_dir):
    return windows.top_k(_latest_rul(spark, sf_dir), "rul", 10, ascending=True, tie=["unit_id"])


@register(
    "o17_request_statistics",
    PL
    + f"""SELECT model_type, count(*) AS n, {r("count(*) FILTER (WHERE status = 'success') / count(*)", 4)} AS success_rate,
  {r('avg(latency_s * 1000.0)', 4)} AS avg_ms, {r('min(latency_s * 1000.0)', 4)} AS min_ms, {r('max(latency_s * 1000.0)', 4)} AS max_ms,
  {r('quantile_cont(latency_s * 1000.0, 0.5)', 4)} AS p50_ms, {r('quantile_cont(latency_s * 1000.0, 0.95)', 4)} AS p95_ms,
  {r('quantile_cont(latency_s * 1000.0, 0.99)', 4)} AS p99_ms,
  {r('count(*) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1000000.0', 4)} AS throughput FROM prediction_log GROUP BY model_type""",
)
def q_o17(spark, sf_dir):
    l_ = _log(spark, sf_dir).withColumn("ms", F.col("latency_s") * 1000.0)
    base = l_.groupBy("model_type").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(F.col("status") == "success") / F.count(F.lit(1))).alias("success_rate"),
        F.avg("ms").alias("avg_ms"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"),
        (F.count(F.lit(1)) / (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) * 1e6).alias("throughput"),
    )
    q = exact_quantiles(l_, ["model_type"], "ms", [0.5, 0.95, 0.99], names=["p50_ms", "p95_ms", "p99_ms"]).drop("n")
    out = base.join(q, "model_type")
    return present(out.select("model_type", "n", "success_rate", "avg_ms", "min_ms", "max_ms", "p50_ms", "p95_ms", "p99_ms", "throughput"), 4)


@register(
    "o18_rul_summary",
    with_(PREDICTION_LOG, LATEST_RUL)
    + f"""SELECT count(*) AS n, {r('avg(rul)')} AS mean, {r('stddev_pop(rul)')} AS std, {r('min(rul)')} AS min, {r('max(rul)')} AS max,
  {r('count(*) FILTER (WHERE rul < 25) / count(*)')} AS critical_share FROM lr""",
)
def q_o18(spark, sf_dir):
    lr = _latest_rul(spark, sf_dir)
    return present(lr.agg(
        F.count(F.lit(1)).alias("n"), F.avg("rul").alias("mean"), F.stddev_pop("rul").alias("std"), F.min("rul").alias("min"), F.max("rul").alias("max"),
        (F.count_if(F.col("rul") < monitor.RUL_SUMMARY_CRITICAL) / F.count(F.lit(1))).alias("critical_share"),
    ))


@register(
    "o19_j3_utilisation_ratio",
    """SELECT l_suppkey AS entity, round(sum(l_extendedprice * (1 - l_discount)) / sum(l_extendedprice), 6) AS ratio,
  sum(l_extendedprice * (1 - l_discount)) / sum(l_extendedprice) > 0.9 AS over_limit,
  round(100.0 * (1 - sum(l_extendedprice * l_discount) / sum(l_extendedprice)), 4) AS utilisation_pct FROM lineitem GROUP BY l_suppkey""",
)
def q_o19(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("used"),
        F.col("l_extendedprice").alias("limit"), (F.col("l_extendedprice") * F.col("l_discount")).alias("idle"),
    )
    j = monitor.ratios_of_one(li, ["entity"], {"ratio": ("used", "limit"), "idle_share": ("idle", "limit")})
    return j.select("entity", F.round("ratio", 6).alias("ratio"), (F.col("ratio") > monitor.UTILISATION_LIMIT).alias("over_limit"),
                    F.round(F.lit(100.0) * (F.lit(1.0) - F.col("idle_share")), 4).alias("utilisation_pct"))


@register(
    "o21_liveness_state_counts",
    """SELECT state, count(*) AS entities, count(*) FILTER (WHERE state = 'error') AS down FROM
  (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state FROM events GROUP BY user_id) GROUP BY state""",
)
def q_o21(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events")
    st = monitor.latest(ev, ["user_id"], "event_type", ["ts", "event_id"]).withColumnRenamed("event_type", "state")
    return st.groupBy("state").agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("state") == "error").alias("down"))


RULES_SQL = "rules AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{m}', '{o}', CAST({t} AS DOUBLE), {h})" for n, m, o, t, h in monitor.ALERT_RULES
) + ") t(rule, metric, op, threshold, hold_s))"


@register(
    "o11_alert_rules_table",
    with_(PREDICTION_LOG, *ER_CTE, *_hq_ctes("h"), RULES_SQL,
          """m AS (SELECT model_type, st, 'error_ratio' AS metric, errors / n AS value FROM w
               UNION ALL SELECT model_type, st, 'latency_p95', p95 FROM hq WHERE p95 IS NOT NULL
               UNION ALL SELECT model_type, st, 'latency_p99', p99 FROM hq WHERE p99 IS NOT NULL)""",
          """t AS (SELECT rule, model_type, st * 30 AS sec, hold_s FROM m JOIN rules USING (metric)
               WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold ELSE value = threshold END)""",
          "i0 AS (SELECT *, lag(sec) OVER (PARTITION BY rule, model_type ORDER BY sec) AS prev FROM t)",
          "i AS (SELECT *, sum(CASE WHEN prev IS NULL OR sec - prev > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY rule, model_type ORDER BY sec ROWS UNBOUNDED PRECEDING) AS island FROM i0)",
          "j AS (SELECT *, min(sec) OVER (PARTITION BY rule, model_type, island) AS start FROM i)")
    + f"""SELECT rule, model_type, CAST(any_value(hold_s) AS INTEGER) AS hold_s, {ts_sql('min(sec)')} AS started_at, {ts_sql('max(sec)')} AS ended_at,
  count(*) AS evaluations, {ts_sql('min(sec) FILTER (WHERE sec - start >= hold_s)')} AS fired_at,
  count(*) FILTER (WHERE sec - start >= hold_s) AS firing_evaluations FROM j GROUP BY rule, model_type, island""",
)
def q_o11_rules(spark, sf_dir):
    log = _log(spark, sf_dir)
    ep = monitor.evaluate_rules(monitor.monitoring_metrics(log), monitor.rules_table(spark))
    return ep.select("rule", "model_type", "hold_s", fmt(F.col("started_at")).alias("started_at"), fmt(F.col("ended_at")).alias("ended_at"),
                     "evaluations", fmt(F.col("fired_at")).alias("fired_at"), "firing_evaluations")


ALL_RULES_SQL = "rules AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{m}', '{o}', CAST({t} AS DOUBLE), {h}, '{v}')" for n, m, o, t, h, v in alerts.RULES) + ") t(rule, metric, op, threshold, hold_s, severity))"


def _gauge_sql(metric: str, labels: str, value: str, source: str) -> str:
    return f"""SELECT '{metric}' AS metric, labels, since, until, value FROM (
  SELECT {labels} AS labels, epoch_us(ts) AS since, coalesce(lead(epoch_us(ts)) OVER (PARTITION BY {labels} ORDER BY ts, event_id), (SELECT epoch_us(max(ts)) FROM events)) AS until, CAST({value} AS DOUBLE) AS value
  FROM {source}) WHERE until > since"""


def _window_sql(metric: str, labels: str, value: str, source: str, step: int) -> str:
    return f"SELECT '{metric}' AS metric, {labels} AS labels, st * {step * 1000000} AS since, (st + 1) * {step * 1000000} AS until, CAST({value} AS DOUBLE) AS value FROM {source}"


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ALL_FAMILIES_SQL = with_(
    PREDICTION_LOG, *ER_CTE, *_hq_ctes("h"), ALL_RULES_SQL,
    "span AS (SELECT model_type, min(slot) - 9 AS lo, (SELECT max(slot) FROM s) AS hi FROM s GROUP BY model_type)",
    "grid AS (SELECT model_type, unnest(range(lo, hi + 1)) AS st FROM span)",
    f"a0 AS (SELECT {SLOT} AS slot, count(*) AS n, count(*) FILTER (WHERE latency_s <= 0.5) AS fast, sum(latency_s) AS lat FROM prediction_log GROUP BY ALL)",
    "a1 AS (SELECT *, unnest(range(slot - 9, slot + 1)) AS st FROM a0)",
    "a AS (SELECT st, sum(n) AS n, sum(fast) AS fast, sum(lat) AS lat FROM a1 GROUP BY st)",
    "h0 AS (SELECT CAST(floor(epoch_us(ts) / 300000000) AS BIGINT) AS slot, count(*) AS n, count(*) FILTER (WHERE status = 'success') AS ok FROM prediction_log GROUP BY ALL)",
    "h1 AS (SELECT *, unnest(range(slot - 11, slot + 1)) AS st FROM h0)",
    "hour AS (SELECT st, sum(n) AS n, sum(ok) AS ok FROM h1 GROUP BY st)",
    f"pods AS (SELECT *, 'pod-' || (user_id % 5) AS pod, {K_SQL} AS k FROM events)",
    "c0 AS (SELECT pod, CAST(floor(epoch_us(ts) / 30000000) AS BIGINT) AS slot, sum(value) AS used FROM pods GROUP BY ALL)",
    "c1 AS (SELECT *, unnest(range(slot - 9, slot + 1)) AS st FROM c0)",
    "cpu AS (SELECT pod, st, sum(used) AS used FROM c1 GROUP BY ALL)",
    "hooks AS (SELECT *, round(value / 100.0, 4) AS score FROM pods WHERE k % 7 <> 0)",
    "m AS (" + "\nUNION ALL ".join([
        _window_sql("error_ratio", "'model_type=' || model_type", "errors / n", "w", 30),
        _window_sql("latency_p95", "'model_type=' || model_type", "p95", "hq", 30), _window_sql("latency_p99", "'model_type=' || model_type", "p99", "hq", 30),
        _window_sql("request_rate", "'model_type=' || grid.model_type", "coalesce(w.n, 0)", "(SELECT grid.model_type, grid.st, w.n FROM grid LEFT JOIN w ON grid.model_type = w.model_type AND grid.st = w.st) grid", 30).replace("coalesce(w.n, 0)", "coalesce(n, 0)"),
        _window_sql("latency_slo_share", "''", "fast / n", "a", 30), _window_sql("total_rate", "''", "n / 300.0", "a", 30),
        _window_sql("scale_up", "''", "CASE WHEN lat / n > 0.3 AND n / 300.0 > 50 THEN 1 ELSE 0 END", "a", 30), _window_sql("success_share_1h", "''", "ok / n", "hour", 300),
        _window_sql("cpu_share", "'pod=' || pod", "used / 300.0", "cpu", 30),
        _gauge_sql("drift_psi", "'feature=' || event_type || ',model_name=rul-model'", "score", "hooks WHERE event_type = 'click'"),
        _gauge_sql("concept_drift", "'model_name=rul-model'", "CASE WHEN score >= 0.25 THEN 1 ELSE 0 END", "hooks WHERE event_type = 'error'"),
        _gauge_sql("prediction_drift", "'model_name=rul-model'", "CASE WHEN score >= 0.25 THEN 1 ELSE 0 END", "hooks WHERE event_type = 'view'"),
        _gauge_sql("rul", "'unit_id=' || user_id", "value", "pods"),
        _gauge_sql("ready", "'pod=' || pod", "CASE WHEN event_type = 'error' THEN 0 ELSE 1 END", "pods"),
        _gauge_sql("memory_share", "'pod=' || pod", "value / 100.0", "pods"),
        _gauge_sql("up", "'job=tracking'", "CASE WHEN event_type = 'error' THEN 0 ELSE 1 END", "pods WHERE k % 5 = 0"),
    ]) + ")",
    """t AS (SELECT rule, severity, hold_s, labels, since, until FROM m JOIN rules USING (metric)
        WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold ELSE value = threshold END)""",
    "i0 AS (SELECT *, lag(until) OVER (PARTITION BY rule, labels ORDER BY since) AS prev FROM t)",
    "i AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> since THEN 1 ELSE 0 END) OVER (PARTITION BY rule, labels ORDER BY since ROWS UNBOUNDED PRECEDING) AS island FROM i0)",
    "j AS (SELECT rule, severity, hold_s, labels, min(since) AS started, max(until) AS ended FROM i GROUP BY rule, severity, hold_s, labels, island)",
) + f"""SELECT rule, severity, labels, strftime(make_timestamp(started), '{TS_FMT}') AS started_at, strftime(make_timestamp(ended), '{TS_FMT}') AS ended_at,
  strftime(make_timestamp(started + hold_s * 1000000), '{TS_FMT}') AS fired_at FROM j WHERE ended > started + hold_s * 1000000"""


def alert_series(spark, sf_dir):
    """All metric families of the rules, each with its own labels, from the driver tables: latency, errors and silence by
    model; SLOs and volume without labels; CPU, memory and readiness by pod (five of them, dealt by user); the tracking
    server; drift by feature and model; RUL by unit."""
    log = _log(spark, sf_dir)
    by_model = alerts.labels_of(model_type=F.col("model_type"))
    none = F.create_map().cast("map<string,string>")
    wide = monitor.sliding_counts(log, [], sums=["latency_s"], conds={"fast": F.col("latency_s") <= monitor.LATENCY_SLO_SECONDS})
    hour = monitor.sliding_counts(log, [], width_s=3600, slide_s=300, conds={"ok": F.col("status") == "success"})
    rate, mean = F.col("n") / 300.0, F.col("sum_latency_s") / F.col("n")
    hq = monitor.histogram_quantiles(log, ["model_type"], (0.95, 0.99))
    er = monitor.error_ratio(log)
    quiet = monitor.evaluation_grid(log, ["model_type"]).join(er.select("model_type", "window_start", "n"), ["model_type", "window_start"], "left")
    ev = tables.table(spark, sf_dir, "events")
    end = F.lit(ev.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0])  # one number: all series end with the log
    pods = ev.withColumn("pod", F.concat(F.lit("pod-"), F.pmod(F.col("user_id"), F.lit(5)).cast("string"))).withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    cpu = monitor.sliding_counts(pods, ["pod"], sums=["value"])
    hooks = decide.parse_drift_events(tables.drift_webhooks(spark, sf_dir))
    hooks = cut_lineage(hooks.filter("event.drift_score IS NOT NULL").select("event_id", "ts", "event.*"))  # three gauges read the parsed bodies
    flag = F.when(F.col("drift_score") >= 0.25, 1).otherwise(0)
    state = F.when(F.col("event_type") == "error", 0).otherwise(1)
    model = alerts.labels_of(model_name=F.col("model_name"))
    feature = alerts.labels_of(feature=F.element_at("features_affected", 1), model_name=F.col("model_name"))
    pod = alerts.labels_of(pod=F.col("pod"))
    gauge = lambda df, name, labels, value: alerts.gauge_samples(df, name, labels, value, "ts", "event_id")
    windows = [
        alerts.window_series(er, "error_ratio", by_model, F.col("error_ratio"), 30),
        alerts.window_series(hq, "latency_p95", by_model, F.col("p95"), 30), alerts.window_series(hq, "latency_p99", by_model, F.col("p99"), 30),
        alerts.window_series(quiet, "request_rate", by_model, F.coalesce("n", F.lit(0)), 30),
        alerts.window_series(wide, "latency_slo_share", none, F.col("fast") / F.col("n"), 30), alerts.window_series(wide, "total_rate", none, rate, 30),
        alerts.window_series(wide, "scale_up", none, F.when((mean > monitor.SCALE_LATENCY) & (rate > monitor.SCALE_LATENCY_RATE), 1).otherwise(0), 30),
        alerts.window_series(hour, "success_share_1h", none, F.col("ok") / F.col("n"), 300),
        alerts.window_series(cpu, "cpu_share", pod, F.col("sum_value") / 300.0, 30),
    ]
    gauges = [
        gauge(hooks.filter("drift_type = 'psi'"), "drift_psi", feature, F.col("drift_score")),
        gauge(hooks.filter("drift_type = 'concept'"), "concept_drift", model, flag), gauge(hooks.filter("drift_type = 'prediction'"), "prediction_drift", model, flag),
        gauge(ev, "rul", alerts.labels_of(unit_id=F.col("user_id")), F.col("value")),
        gauge(pods, "ready", pod, state), gauge(pods, "memory_share", pod, F.col("value") / 100.0),
        gauge(pods.filter("k % 5 = 0"), "up", alerts.labels_of(job=F.lit("tracking")), state),
    ]
    return reduce(DataFrame.unionByName, [*windows, alerts.hold(reduce(DataFrame.unionByName, gauges), end)])


@register("o11_alert_rules_all_families", ALL_FAMILIES_SQL)
def q_o11_all(spark, sf_dir):
    """Every alert rule over differently keyed series through one islands plan."""
    fired = alerts.evaluate(alert_series(spark, sf_dir), alerts.rule_table(spark))
    return fired.select("rule", "severity", "labels", *[fmt(F.col(c)).alias(c) for c in ("started_at", "ended_at", "fired_at")])
