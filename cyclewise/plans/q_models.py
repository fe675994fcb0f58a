"""Catalog entries: splits, models, scoring, importance, registry.

Training is not SQL-expressible, so those queries have no oracle; the pytest suite checks their values.
Every model has the library's defaults, the whole feature recipe and all channels; a fit takes every
labelled row of the training side, and predictions are made for every row of the validation side.
Queries of one application share the fitted models.
"""

from __future__ import annotations

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from ..operators import boosting, labels, models, windows
from ..schema import LIBRARY_LAGS, LIBRARY_WINDOWS, SEQUENCE_LENGTH
from ..session import cut_lineage
from ..sources import tables, telemetry
from .registry import present, register

CH = tables.LINEITEM_CHANNELS
_FITTED: dict[tuple, object] = {}


def _once(name, spark, sf_dir, make):
    """What ``make`` gives, once for each application and input."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def _drawn(t, since=1):
    """(unit_id, time_cycle, RUL) of a draw of about ``models.FIT_ROWS`` labelled rows from cycle ``since`` on, for trials:
    no query fits on it."""
    keys = t.select("unit_id", "time_cycle").filter("unit_id is not null")
    late = F.col("time_cycle") >= since
    return cut_lineage(models.bounded(labels.add_rul(keys, method="join").filter(late), ["unit_id", "time_cycle"], n=keys.filter(late).count()))


def _spread(df, keys):
    """``df`` (checkpointed), dealt evenly where it is small: a small table comes in one or two partitions."""
    n = models.fit_tasks(df.sparkSession, df.count())
    return df if n is None or df.rdd.getNumPartitions() >= n else cut_lineage(df.repartition(n, *keys).sortWithinPartitions(*keys))


def _make_frame(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).drop("l_shipdate").filter("unit_id is not null")
    feats, key = CH + windows.feature_columns(CH), ["unit_id", "time_cycle"]
    f = windows.add_features(t, CH, null_policy="fill", split_rows=windows.SPLIT_ROWS, rul=labels.rul_of())
    f = models.split(f, key, share=0.2, by="unit")
    # several fits read this frame: written once to the shared checkpoint folder
    # (no recompute of the window plan, survives executor loss)
    return _spread(cut_lineage(models.assemble(f, feats).select("unit_id", "time_cycle", "RUL", "split", "features")), key), feats


def _frame(spark, sf_dir):
    return _once("frame", spark, sf_dir, lambda: _make_frame(spark, sf_dir))


def _side(spark, sf_dir, side):
    return _frame(spark, sf_dir)[0].filter(F.col("split") == side)


def _forest(spark, sf_dir):
    return _once("forest", spark, sf_dir, lambda: models.fit_forest(models.forest(), _side(spark, sf_dir, "train")))


def _boosted(spark, sf_dir):
    return _once("boosted", spark, sf_dir, lambda: models.boosted().fit(_side(spark, sf_dir, "train")))


@register("m1_train_val_split")
def q_m1(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir).select("unit_id", "time_cycle")
    s = models.split(t, ["unit_id", "time_cycle"], share=0.1, by="row").withColumnRenamed("split", "row_split")
    s = models.split(s, ["unit_id", "time_cycle"], share=0.1, by="unit").withColumnRenamed("split", "unit_split")
    return s.groupBy("row_split", "unit_split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("unit_id").alias("units"))


@register("m2_m8_forest_batch_predict")
def q_m2(spark, sf_dir):
    p = models.predict(_forest(spark, sf_dir), _side(spark, sf_dir, "val"))
    return present(p.select("unit_id", "time_cycle", "RUL", "prediction"), 4)


@register("m3_m5_m6_boosted_learning_curve")
def q_m3(spark, sf_dir):
    """Validation error of every round until the best one is EARLY_STOPPING_ROUNDS rounds old."""
    stages = boosting.fit_stages(_side(spark, sf_dir, "train"), _side(spark, sf_dir, "val"))
    return present(stages.curve_frame(spark), 4)


@register("m4_sequence_regressor")
def q_m4(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).drop("l_shipdate")
    t = labels.add_rul(t.filter("unit_id is not null"), method="join")
    seqs = windows.add_sequences(t, CH, SEQUENCE_LENGTH, dtype="float", split_rows=windows.SPLIT_ROWS)
    seqs = models.split(seqs, ["unit_id", "end_cycle"], share=0.2, by="unit")
    # a window holds SEQUENCE_LENGTH readings: the windows are never written, the fit reads them once
    fr = models.sequence_frame(seqs).select("unit_id", "end_cycle", "RUL", "split", "features")
    m = models.sequence_regressor().fit(fr.filter("split = 'train'"))
    return present(models.predict(m, fr.filter("split = 'val'")).select("unit_id", "end_cycle", "RUL", "prediction"), 4)


@register("m7_w10_feature_importance_top")
def q_m7(spark, sf_dir):
    """Weight, gain and cover of the boosted trees, from their node table."""
    imp = boosting.importances(_boosted(spark, sf_dir), _frame(spark, sf_dir)[1])
    return present(windows.top_k(imp, "gain", 10, tie=["feature"]), 4)


def _many(spark, sf_dir):
    def make():
        est = {"forest": models.Fitted(_forest(spark, sf_dir)), "boosted": models.Fitted(_boosted(spark, sf_dir)), "broken": models.forest(features="no_such_column")}
        return models.train_many(est, _side(spark, sf_dir, "train"), _side(spark, sf_dir, "val"))

    return _once("many", spark, sf_dir, make)


@register("m9_train_many_tolerate_failure")
def q_m9(spark, sf_dir):
    return present(models.results_frame(spark, _many(spark, sf_dir)), 4)


@register("m11_model_save_load")
def q_m11(spark, sf_dir):
    m, feats = _forest(spark, sf_dir), _frame(spark, sf_dir)[1]
    path = telemetry.scratch_path(spark, "model_forest")
    models.save_model(m, path, {"type": "forest", "params": models.FOREST_PARAMS, "features": feats})
    loaded, meta = models.load_model(path, RandomForestRegressionModel)
    val = _side(spark, sf_dir, "val")
    a = models.predict(m, val).select("unit_id", "time_cycle", F.col("prediction").alias("p1"))
    b = models.predict(loaded, val).select("unit_id", "time_cycle", F.col("prediction").alias("p2"))
    j = a.join(b, ["unit_id", "time_cycle"])
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p1") == F.col("p2")).alias("identical"), F.lit(len(meta["features"])).alias("n_features"))


@register("m12_model_registry")
def q_m12(spark, sf_dir):
    res = _many(spark, sf_dir)
    reg = telemetry.scratch_path(spark, "registry")
    ok = sorted([r for r in res if r.status == "ok"], key=lambda r: r.metrics["rmse"])
    for v, r_ in enumerate(ok, start=1):
        models.register_event(spark, reg, "rul-model", v, "Staging", {"model": r_.name, "rmse": r_.metrics["rmse"]})
    models.register_event(spark, reg, "rul-model", 1, "Production", {"model": ok[0].name})
    models.register_event(spark, reg, "rul-model", 1, "Archived")
    return models.latest_by_stage(spark.read.parquet(reg))


@register(
    "m12_registry_latest_by_stage",
    """SELECT event_type AS name, stage, arg_max(version, (ts, version)) AS version FROM (
  SELECT event_type, ts, CAST(user_id AS INTEGER) AS version,
         CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 WHEN 0 THEN 'Staging' WHEN 1 THEN 'Production' ELSE 'Archived' END AS stage FROM events)
GROUP BY event_type, stage""",
)
def q_m12_stages(spark, sf_dir):
    """The registry rule over a log of stage transitions: every event puts a version (its user) of a model (its type) into a stage."""
    k = F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(3))
    log = tables.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), F.col("user_id").cast("int").alias("version"), "ts",
        F.when(k == 0, "Staging").when(k == 1, "Production").otherwise("Archived").alias("stage"))
    return models.latest_by_stage(log)
