import math

import numpy as np
import pandas as pd
import pytest

from cyclewise.operators import ensemble, evaluate, profiling, scaling


def _m(spark, y, p):
    df = spark.createDataFrame(pd.DataFrame({"y": np.asarray(y, float), "prediction": np.asarray(p, float)}))
    return evaluate.regression_metrics(df).first()


def test_metrics_hand_values(spark):
    r = _m(spark, [10, 20, 30, 40, 50], [12, 18, 32, 38, 52])
    assert r["rmse"] == pytest.approx(2.0) and r["mae"] == pytest.approx(2.0) and r["r2"] == pytest.approx(0.98)


def test_metrics_perfect(spark):
    r = _m(spark, [10, 20, 30], [10, 20, 30])
    assert (r["rmse"], r["mae"], r["r2"], r["mape"]) == (0.0, 0.0, 1.0, 0.0)


def test_mape_skips_zero_targets(spark):
    assert _m(spark, [0, 10, 20], [1, 11, 21])["mape"] == pytest.approx(7.5)
    assert math.isinf(_m(spark, [0, 0, 0], [1, 2, 3])["mape"])


def test_constant_target_r2_rule(spark):
    assert _m(spark, [5, 5, 5], [5, 5, 5])["r2"] == 1.0
    assert _m(spark, [5, 5, 5], [4, 5, 6])["r2"] == 0.0


def test_empty_input_raises(spark):
    df = spark.createDataFrame([], "y double, prediction double")
    with pytest.raises(evaluate.EvaluationError):
        evaluate.regression_metrics(df)


def test_compare_and_select_skip_failed(spark):
    long = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 2.5), ("b", 1.0, 3.0), ("b", 2.0, 0.0)], "model string, y double, prediction double")
    errs = spark.createDataFrame([("c", "boom")], "model string, error string")
    m = evaluate.compare_models(long, errors=errs)
    best = evaluate.select_best(m, "rmse").first()
    assert best["best_model"] == "a" and best["valid_models"] == 2
    failed = m.filter("model = 'c'").first()
    assert math.isinf(failed["rmse"]) and failed["r2"] == float("-inf")


def test_ensemble_kernels(spark):
    df = spark.createDataFrame([(10.0, 20.0, None), (None, None, None), (1.0, 2.0, 4.0), (-5.0, -1.0, None)], "forest double, boosted double, sequence double")
    M = {"forest": "forest", "boosted": "boosted", "sequence": "sequence"}
    w = [r["ensemble"] for r in ensemble.combine(df, M, "weighted").collect()]
    assert w[0] == pytest.approx((10 * 0.25 + 20 * 0.35) / 0.6) and w[1] is None and w[3] == 0.0
    med = [r["ensemble"] for r in ensemble.combine(df, M, "median").collect()]
    assert med[0] == 15.0 and med[2] == 2.0
    conf = [r["c"] for r in df.select(ensemble.agreement_confidence(M).alias("c")).collect()]
    assert conf[0] == pytest.approx(1 / (1 + 5 / 10)) and conf[1] == 1.0
    on = ensemble.online(df, M).collect()
    assert on[1]["model_type"] == "error" and on[1]["rul"] == -1.0 and on[1]["confidence"] == 0.0  # M14: the error row
    with pytest.raises(ValueError):
        ensemble.validate_weights({"a": 0.5, "b": 0.2})


def test_constant_columns_and_scaler(spark):
    pdf = pd.DataFrame({"unit_id": [1, 1, 1, 2, 2, 2], "time_cycle": [1, 2, 3, 1, 2, 3], "sensor_1": [100.0] * 6, "sensor_2": np.arange(1.0, 7.0)})
    df = spark.createDataFrame(pdf)
    kept, dropped = profiling.drop_constant_columns(df, ["sensor_1", "sensor_2"])
    assert dropped == ["sensor_1"] and "sensor_2" in kept.columns
    sc = scaling.ScalerModel.fit(df, ["sensor_1", "sensor_2"])
    out = sc.transform(df).toPandas()
    assert np.allclose(out["sensor_1"], 0.0)  # zero std -> divide by 1
    assert out["sensor_2"].mean() == pytest.approx(0.0) and out["sensor_2"].std(ddof=0) == pytest.approx(1.0)


def test_pipeline_fit_transform_save_load(spark, f1a, tmp_path):
    _, df = f1a
    spec = scaling.PipelineSpec(channels=["sensor_2", "sensor_3"], windows=[5], stats=["mean", "std"], lags=[1])
    model = scaling.TelemetryPipeline(spec).fit(df)
    a = model.transform(df).orderBy("unit_id", "time_cycle").toPandas()
    feats = model.scaler.features
    assert abs(a[feats].mean()).max() < 1e-9
    model.save(str(tmp_path / "pipe"))
    b = scaling.TelemetryPipelineModel.load(str(tmp_path / "pipe")).transform(df).orderBy("unit_id", "time_cycle").toPandas()
    pd.testing.assert_frame_equal(a, b[a.columns])
    with pytest.raises(scaling.NotFittedError):
        scaling.TelemetryPipelineModel(spec, [], [], None).transform(df)


def test_trajectory_validation(spark):
    bad = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (2, 0)], "unit_id int, time_cycle int")
    with pytest.raises(profiling.ValidationError):
        profiling.validate_trajectories(bad)
    with pytest.raises(profiling.ValidationError):
        profiling.validate_trajectories(bad.drop("time_cycle"))


@pytest.mark.parametrize(("dialect", "sensors", "stats"), [("library", 21, 4), ("pipeline", 14, 2)])
def test_recipes_of_21_and_14_sensors_survive_save_and_load(spark, f1a, tmp_path, dialect, sensors, stats):
    from cyclewise.schema import DROP_SENSORS, SENSOR_COLS

    _, df = f1a
    spec = scaling.recipe(dialect, df.columns)
    assert sum(c in SENSOR_COLS for c in spec.channels) == sensors and len(spec.stats) == stats
    assert dialect == "library" or not set(spec.channels) & set(DROP_SENSORS)
    spec.channels = [c for c in spec.channels if c in ("sensor_1", "sensor_2", "sensor_3", "op_setting_1")]  # the rest alike
    model = scaling.TelemetryPipeline(spec).fit(df)
    model.save(str(tmp_path / "p"))
    loaded = scaling.TelemetryPipelineModel.load(str(tmp_path / "p"))
    assert loaded.spec == spec and loaded.spec.dialect == dialect
    a, b = (m.transform(df).orderBy("unit_id", "time_cycle").toPandas() for m in (model, loaded))
    pd.testing.assert_frame_equal(a, b)
    assert not any(c.startswith("sensor_4") for c in a.columns)  # sensors outside the recipe are no features
    # 20 cycles a unit: the dropping recipe has rows from cycle 11 on, the filling one all of them
    assert len(a) == (100 if dialect == "library" else 50) and abs(a["sensor_2_rolling_mean_5"].mean()) < 1e-9


def test_a_newer_pipeline_document_is_refused(spark, f1a, tmp_path):
    _, df = f1a
    model = scaling.TelemetryPipeline(scaling.PipelineSpec(channels=["sensor_2"], windows=[5], lags=[1])).fit(df.select("unit_id", "time_cycle", "sensor_2"))
    model.save(str(tmp_path / "p"))
    text = (next((tmp_path / "p" / "metadata").glob("part-*"))).read_text().replace('"version": 2', '"version": 3')
    spark.createDataFrame([(text.strip(),)], "meta string").coalesce(1).write.mode("overwrite").text(str(tmp_path / "p" / "metadata"))
    with pytest.raises(ValueError, match="version 3"):
        scaling.TelemetryPipelineModel.load(str(tmp_path / "p"))


def test_report_document_of_valid_and_failed_models(spark, tmp_path):
    import json

    inf = float("inf")
    rows = [("forest", 12.5, 9.0, 0.7, 8.0, None), ("boosted", 11.8, 8.7, 0.8, 7.0, None), ("also", 11.8, 9.1, 0.8, 7.5, None), ("broken", inf, inf, -inf, inf, "no file"), ("empty", None, None, None, None, None)]
    m = spark.createDataFrame(rows, "model string, rmse double, mae double, r2 double, mape double, error string")
    from cyclewise.sources import telemetry

    telemetry.write_json_report(evaluate.report_document(m, "FD002", timestamp="2024-01-15T10:30:00"), str(tmp_path / "r"))
    text = [x["value"] for x in spark.read.text(str(tmp_path / "r")).collect()]
    doc = json.loads(text[0])
    assert len(text) == 1 and doc["dataset"] == "FD002" and doc["timestamp"] == "2024-01-15T10:30:00"
    assert set(doc["models"]) == {"forest", "boosted", "also", "empty"} and doc["models"]["forest"] == {"rmse": 12.5, "mae": 9.0, "r2": 0.7, "mape": 8.0}
    assert doc["best_model"] == {"name": "also", "metric": "rmse", "value": 11.8}
    assert doc["summary"] == {"total_models_evaluated": 5, "successful_evaluations": 4}
    bad = evaluate.report_document(m.filter("model = 'broken'")).first()
    assert bad["models"] == {} and bad["best_model"] is None and bad["summary"].asDict() == {"total_models_evaluated": 1, "successful_evaluations": 0}
    none = evaluate.report_document(m.filter("false")).first()
    assert none["models"] == {} and none["best_model"] is None and none["summary"]["total_models_evaluated"] == 0
