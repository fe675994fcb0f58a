"""Catalog entries: projections, validation, profiling, scaling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import labels, profiling as profile, scaling, windows
from ..schema import SENSOR_COLS, SETTING_COLS
from ..sources import tables, telemetry
from .q_features import RUL_SQL, feature_sql
from .registry import present, r, register
from .sqlviews import TELEMETRY_EVENTS, TELEMETRY_LINEITEM, with_

CH = tables.LINEITEM_CHANNELS
# Canonical channel order used for the P2 projection.
CANON = ["l_tax", "l_quantity", "l_missing_channel", "l_extendedprice", "l_discount"]


@register("p1_unit_filter", with_(TELEMETRY_EVENTS) + f"SELECT unit_id, time_cycle, {r('value')} AS value FROM telemetry_events WHERE unit_id = 7")
def q_p1(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir).select("unit_id", "time_cycle", "value")
    return present(profile.unit_rows(t, 7))


@register("p2_sensor_projection", with_(TELEMETRY_LINEITEM) + "SELECT unit_id, time_cycle, l_tax, l_quantity, l_extendedprice, l_discount FROM telemetry_lineitem")
def q_p2(spark, sf_dir):
    return profile.project_sensors(tables.telemetry_lineitem(spark, sf_dir), CANON)


@register(
    "p3_numeric_feature_selection",
    with_(TELEMETRY_LINEITEM) + f"SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM (SELECT *, {RUL_SQL} FROM telemetry_lineitem)",
)
def q_p3(spark, sf_dir):
    t = labels.add_rul(tables.telemetry_lineitem(spark, sf_dir))
    return t.select(*profile.numeric_features(t))


def _cv_sql(src: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS column_name, avg({c}) AS mean, stddev_samp({c}) AS std FROM {src}")
    return (
        "SELECT column_name, " + r("mean", 3) + " AS mean, " + r("std", 3) + " AS std, "
        + r("CASE WHEN mean <> 0 THEN std / abs(mean) END", 3) + " AS cv, "
        + "coalesce(std = 0 OR (CASE WHEN mean <> 0 THEN std / abs(mean) END) < 0.01, false) AS dropped FROM ("
        + " UNION ALL ".join(parts) + ")"
    )


@register("p4_constant_columns", with_(TELEMETRY_LINEITEM, "t AS (SELECT *, 0.5 AS flat FROM telemetry_lineitem)") + _cv_sql("t", CH + ["flat"]))
def q_p4(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir).withColumn("flat", F.lit(0.5))
    return present(profile.constant_column_table(t, CH + ["flat"]), 3)


@register(
    "p6_dataset_info",
    with_(TELEMETRY_LINEITEM, TELEMETRY_EVENTS)
    + """SELECT * FROM
 (SELECT count(*) AS train_samples, count(DISTINCT unit_id) AS train_units, max(time_cycle) AS train_max_cycle FROM telemetry_lineitem),
 (SELECT count(*) AS test_samples, count(DISTINCT unit_id) AS test_units, max(time_cycle) AS test_max_cycle FROM telemetry_events),
 (SELECT min(rul) AS rul_min, max(rul) AS rul_max, round(avg(rul), 6) AS rul_mean FROM
    (SELECT unit_id, CAST(max(time_cycle) % 50 AS INTEGER) AS rul FROM telemetry_events GROUP BY unit_id))""",
)
def q_p6(spark, sf_dir):
    tr = tables.telemetry_lineitem(spark, sf_dir)
    te = tables.telemetry_events(spark, sf_dir)
    rul = te.groupBy("unit_id").agg((F.max("time_cycle") % 50).cast("int").alias("rul"))
    return present(profile.dataset_info(tr, te, rul))


@register(
    "p7_ingest_stats",
    with_(TELEMETRY_LINEITEM)
    + f"""SELECT count(*) AS n_rows, count(DISTINCT unit_id) AS n_units, 8 AS n_columns,
 CAST(min(RUL) AS DOUBLE) AS label_min, CAST(max(RUL) AS DOUBLE) AS label_max, {r('avg(RUL)')} AS label_mean,
 {r('stddev_samp(RUL)')} AS label_std, CAST(0 AS BIGINT) AS missing_cells
FROM (SELECT *, {RUL_SQL} FROM telemetry_lineitem)""",
)
def q_p7(spark, sf_dir):
    t = labels.add_rul(tables.telemetry_lineitem(spark, sf_dir))
    return present(profile.ingest_stats(t).withColumn("n_columns", F.col("n_columns").cast("int")))


FEAT8 = windows.feature_columns(CH, [5], ["mean", "std"], [1], True)


@register(
    "p8_feature_stats",
    with_(TELEMETRY_LINEITEM, "f AS (SELECT " + ", ".join(feature_sql(CH, [5], ["mean", "std"], [1], "drop")) + " FROM telemetry_lineitem)")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT count(*) FROM f) AS n_rows, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
        f"{r(f'min({c})')} AS min, {r(f'max({c})')} AS max FROM f"
        for c in FEAT8
    ),
)
def q_p8(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir).select("unit_id", "time_cycle", *CH)
    f = _drop_feats(t)
    return present(profile.feature_stats(f, FEAT8))


def _drop_feats(t):
    # null policy "drop" without the final row drop, so missing cells are counted
    return t.select(*windows.feature_exprs(CH, [5], ["mean", "std"], [1], True, "drop"))


FITTED = ["value", "value_rolling_mean_5", "value_rolling_std_5", "value_lag_1", "value_delta", "value_rolling_max_99"]


@register(
    "p10_feature_alignment",
    with_(TELEMETRY_EVENTS)
    + "SELECT unit_id, "
    + r("value")
    + " AS value, "
    + ", ".join(feature_sql(["value"], [5], ["mean", "std"], [1]))
    + ", CAST(0 AS DOUBLE) AS value_rolling_max_99 FROM telemetry_events",
)
def q_p10(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir).select("unit_id", "time_cycle", "value")
    f = windows.add_features(t, ["value"], [5], ["mean", "std"], [1], True, "fill")
    return present(profile.align_columns(f, FITTED, keep=["unit_id"]))


@register(
    "s6_drop_all_null_columns",
    with_(TELEMETRY_EVENTS) + f"SELECT unit_id, time_cycle, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, {r('value')} AS value FROM telemetry_events",
)
def q_s6(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir)
    t = t.withColumn("value_lag_1000", F.lag("value", 1000).over(Window.partitionBy("unit_id").orderBy("time_cycle")))
    out = profile.drop_all_null_columns(t)
    return present(out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@register(
    "s8_trajectory_validation",
    with_(TELEMETRY_LINEITEM)
    + """SELECT n_rows, null_keys, nonpositive_keys, n_units, dense_units,
       n_rows > 0 AND null_keys = 0 AND nonpositive_keys = 0 AS ok FROM
 (SELECT count(*) AS n_rows,
         CAST(sum(CASE WHEN unit_id IS NULL OR time_cycle IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_keys,
         CAST(sum(CASE WHEN unit_id <= 0 OR time_cycle <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonpositive_keys
  FROM telemetry_lineitem),
 (SELECT count(*) AS n_units, CAST(sum(CASE WHEN n = nd AND mx = n AND mn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS dense_units
  FROM (SELECT unit_id, count(*) AS n, count(DISTINCT time_cycle) AS nd, max(time_cycle) AS mx, min(time_cycle) AS mn
        FROM telemetry_lineitem GROUP BY unit_id))""",
)
def q_s8(spark, sf_dir):
    return profile.trajectory_report(tables.telemetry_lineitem(spark, sf_dir))


@register(
    "s10_record_validation",
    """SELECT event_id, valid, reasons FROM (
  SELECT event_id,
    list_filter([CASE WHEN reading IS NULL THEN 'null:reading' WHEN TRY_CAST(reading AS DOUBLE) IS NULL THEN 'not_numeric:reading' END,
                 CASE WHEN k IS NULL THEN 'null:k' WHEN TRY_CAST(k AS DOUBLE) IS NULL THEN 'not_numeric:k' END,
                 'missing:sensor_99'], lambda x: x IS NOT NULL) AS arr
  FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS reading,
               json_extract_string(props, '$.k') AS k FROM events))
  , LATERAL (SELECT len(arr) = 0 AS valid, array_to_string(arr, ',') AS reasons)""",
)
def q_s10(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("reading"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    v = profile.validate_records(ev, ["reading", "k", "sensor_99"])
    return v.select("event_id", "valid", F.array_join("reasons", ",").alias("reasons"))


# A full record: the 24 settings and sensors as text; some fields of some rows are absent or no numbers.
RECORD_FIELDS = SETTING_COLS + SENSOR_COLS
_RECORD = {c: f"CAST(l_quantity + {i} AS VARCHAR)" for i, c in enumerate(RECORD_FIELDS)} | {
    "op_setting_1": "CAST(l_discount AS VARCHAR)",
    "sensor_3": "CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END",
    "sensor_9": "CASE WHEN l_linenumber <> 6 THEN CAST(l_extendedprice AS VARCHAR) END",
    "sensor_21": "CASE WHEN l_quantity < 5 THEN '' ELSE CAST(l_quantity AS VARCHAR) END",
}


@register(
    "s10_record_validation_all_fields",
    "SELECT l_orderkey, l_linenumber, reasons = '' AS valid, reasons FROM (SELECT l_orderkey, l_linenumber, concat_ws(',', "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN 'null:{c}' WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN 'not_numeric:{c}' END" for c in RECORD_FIELDS)
    + ") AS reasons FROM (SELECT l_orderkey, l_linenumber, " + ", ".join(f"{e} AS {c}" for c, e in _RECORD.items()) + " FROM lineitem))",
)
def q_s10_all(spark, sf_dir):
    rec = tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in _RECORD.items()])
    v = profile.validate_records(rec, RECORD_FIELDS)
    return v.select("l_orderkey", "l_linenumber", "valid", F.array_join("reasons", ",").alias("reasons"))


@register(
    "s11_batch_size_bound",
    "SELECT l_suppkey AS batch_id, count(*) AS n_samples, count(*) BETWEEN 1 AND 1000 AS within_bounds FROM lineitem GROUP BY l_suppkey",
)
def q_s11(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("batch_id"))
    return profile.batch_size_check(li)


@register(
    "s14_drop_non_features",
    with_(TELEMETRY_LINEITEM) + "SELECT l_quantity, l_extendedprice, l_discount, l_tax, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM telemetry_lineitem",
)
def q_s14(spark, sf_dir):
    out = profile.drop_non_features(labels.add_rul(tables.telemetry_lineitem(spark, sf_dir)))
    return out.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@register(
    "n1_scaler_fit",
    with_(TELEMETRY_LINEITEM)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg({c})', 3)} AS mean, {r(f'stddev_pop({c})', 3)} AS std FROM telemetry_lineitem" for c in CH
    ),
)
def q_n1(spark, sf_dir):
    return present(scaling.scaler_params(tables.telemetry_lineitem(spark, sf_dir), CH), 3)


def _scaled_sql(src_cte: str, src: str, cols, keys, digits: int = 6) -> str:
    sel = ", ".join(f"{r(f'({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END)', digits)} + 0.0 AS {c}" for c in cols)
    return with_(*src_cte) + f"SELECT {', '.join(keys)}, {sel} FROM {src}"


@register("n2_scaler_transform", _scaled_sql([TELEMETRY_LINEITEM], "telemetry_lineitem", CH, ["unit_id", "time_cycle"]))
def q_n2(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir).select("unit_id", "time_cycle", *CH)
    m = scaling.ScalerModel.fit(t, CH)
    return present(m.transform(t))


def _recipe_sql(spec) -> str:
    """The features of a recipe over the stand-in channels, rows with a null left out, then scaled."""
    feats = CH + windows.feature_columns(CH, spec.windows, spec.stats, spec.lags, spec.delta)
    exprs = [e.replace("round(CAST(", "(CAST(", 1).rsplit(", 6)", 1)[0] + ")" + e.rsplit(", 6)", 1)[1] for e in feature_sql(CH, spec.windows, spec.stats, spec.lags, spec.null_policy)]
    return _scaled_sql([
        TELEMETRY_LINEITEM,
        f"f0 AS (SELECT unit_id, time_cycle, {', '.join(CH)}, {RUL_SQL}, {', '.join(exprs)} FROM telemetry_lineitem)",
        "f AS MATERIALIZED (SELECT * FROM f0 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in feats) + ")",
    ], "f", feats, ["unit_id", "time_cycle", "RUL"], 4)  # four million scaled values: at six digits the order of summation shows


def _recipe(dialect: str):
    """The library's recipe of a dialect; the stand-in has four channels, all of them used."""
    spec = scaling.recipe(dialect, CH)
    feats = CH + windows.feature_columns(CH, spec.windows, spec.stats, spec.lags, spec.delta)

    def q(spark, sf_dir):
        t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).drop("l_shipdate")
        path = telemetry.scratch_path(spark, f"pipeline_{dialect}")
        scaling.TelemetryPipeline(spec).fit(t).save(path)
        loaded = scaling.TelemetryPipelineModel.load(path)
        return present(loaded.transform(t).select("unit_id", "time_cycle", "RUL", *feats), 4)

    return q, _recipe_sql(spec)


for _name, _dialect in [("n4_full_pipeline", "library"), ("n4_n3_pipeline_dialect", "pipeline")]:
    _q, _sql = _recipe(_dialect)
    register(_name, _sql)(_q)

@register("n3_scaler_save_load")
def q_n3(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir).drop("l_shipdate")
    model = scaling.TelemetryPipeline(scaling.recipe("library", CH)).fit(t)
    path = telemetry.scratch_path(spark, "pipeline_model")
    model.save(path)
    loaded = scaling.TelemetryPipelineModel.load(path)
    a = model.transform(t).select("unit_id", "time_cycle", F.col("l_quantity_rolling_mean_5").alias("a"))
    b = loaded.transform(t).select("unit_id", "time_cycle", F.col("l_quantity_rolling_mean_5").alias("b"))
    return a.join(b, ["unit_id", "time_cycle"]).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("identical"))
