import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import labels, windows
from cyclewise.sources import tables

from .conftest import SF_SMALL

CH = ["sensor_2", "sensor_3"]


def _pandas_features(pdf, channels, wins, lags):
    out = pdf.sort_values(["unit_id", "time_cycle"]).copy()
    g = out.groupby("unit_id")
    for w in wins:
        for c in channels:
            r = g[c].rolling(window=w, min_periods=1)
            out[f"{c}_rolling_mean_{w}"] = r.mean().reset_index(level=0, drop=True)
            out[f"{c}_rolling_std_{w}"] = r.std().reset_index(level=0, drop=True).fillna(0)
            out[f"{c}_rolling_min_{w}"] = r.min().reset_index(level=0, drop=True)
            out[f"{c}_rolling_max_{w}"] = r.max().reset_index(level=0, drop=True)
    for k in lags:
        for c in channels:
            out[f"{c}_lag_{k}"] = g[c].shift(k).fillna(out[c])
    for c in channels:
        out[f"{c}_delta"] = g[c].diff().fillna(0)
    return out


def test_rolling_lag_delta_match_pandas(f1a):
    pdf, df = f1a
    got = windows.add_features(df, CH, [5, 10], windows.ROLLING_STATS, [1, 5], True, "fill").toPandas()
    exp = _pandas_features(pdf, CH, [5, 10], [1, 5])
    got = got.sort_values(["unit_id", "time_cycle"]).reset_index(drop=True)
    exp = exp.sort_values(["unit_id", "time_cycle"]).reset_index(drop=True)
    for c in windows.feature_columns(CH, [5, 10], windows.ROLLING_STATS, [1, 5], True):
        np.testing.assert_allclose(got[c].to_numpy(), exp[c].to_numpy(), rtol=1e-9, atol=1e-9, err_msg=c)


def test_feature_naming_and_counts(f1a):
    _, df = f1a
    names = windows.feature_columns([f"sensor_{i}" for i in range(1, 22)], [5, 10, 20], windows.ROLLING_STATS, [1, 5, 10], True)
    assert len(names) == 21 * 3 * 4 + 21 * 3 + 21 == 336
    assert "sensor_2_rolling_mean_5" in names and "sensor_2_lag_10" in names and "sensor_2_delta" in names


def test_null_policies(f1a):
    _, df = f1a
    drop = windows.add_features(df, CH, [5], ["mean", "std"], [10], True, "drop")
    assert drop.count() == 5 * (20 - 10)  # first max(lag)=10 rows per unit dropped
    serve = windows.add_features(df, CH, [5], ["std"], [1], True, "serve").filter("time_cycle = 1").first()
    assert serve["sensor_2_lag_1"] == 0.0 and serve["sensor_2_delta"] == 0.0 and serve["sensor_2_rolling_std_5"] == 0.0
    fill = windows.add_features(df, CH, [5], ["std"], [1], True, "fill").filter("time_cycle = 1").first()
    assert fill["sensor_2_lag_1"] == fill["sensor_2"]


@pytest.mark.parametrize("split_rows", [5, 7, 11])
def test_halo_chunks_equal_whole_trajectory(f1a, split_rows):
    _, df = f1a
    a = windows.add_features(df, CH, [5], windows.ROLLING_STATS, [1, 5], True, "fill").orderBy("unit_id", "time_cycle").toPandas()
    b = windows.add_features(df, CH, [5], windows.ROLLING_STATS, [1, 5], True, "fill", split_rows=split_rows).orderBy("unit_id", "time_cycle").toPandas()
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_sequences_count_and_boundaries(spark):
    pdf = pd.DataFrame({"unit_id": [1] * 100 + [2] * 10, "time_cycle": list(range(1, 101)) + list(range(1, 11)), "x": np.arange(110.0)})
    df = spark.createDataFrame(pdf)
    s = windows.add_sequences(df, ["x"], 20, target=None)
    assert s.count() == 81  # 100 - 20 + 1; the 10-row unit gives none
    first = s.orderBy("end_cycle").first()
    assert [v[0] for v in first["seq"]] == list(np.arange(20.0))
    chunked = windows.add_sequences(df, ["x"], 20, target=None, split_rows=30)
    assert chunked.count() == 81


def test_rul_window_equals_join(f1a):
    _, df = f1a
    a = labels.add_rul(df, clip=True, max_rul=10).select("unit_id", "time_cycle", "RUL").orderBy("unit_id", "time_cycle").toPandas()
    b = labels.add_rul(df, clip=True, max_rul=10, method="join").select("unit_id", "time_cycle", "RUL").orderBy("unit_id", "time_cycle").toPandas()
    pd.testing.assert_frame_equal(a, b)
    assert a["RUL"].max() == 10 and a["RUL"].min() == 0


def test_flagship_is_dealt_by_unit_and_chunk(spark):
    from cyclewise.plans.q_features import flagship

    plan = flagship(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    keys = [re.findall(r"(\w+)#", line.split("hashpartitioning(")[1].split(")")[0]) for line in lines if "Exchange hashpartitioning(" in line]
    assert ["unit_id", "_chunk"] in keys
    # by the unit alone go only totals of chunks and ranges
    for line, below in zip(lines, lines[1:]):
        if "Exchange hashpartitioning(" in line and re.findall(r"(\w+)#", line.split("hashpartitioning(")[1].split(")")[0]) == ["unit_id"]:
            assert "HashAggregate(keys=[unit_id" in below, below


def test_a_unit_with_a_third_of_all_rows_stays_split(spark):
    """Features and label equal the form with one window per unit, and no task holds more than a chunk and its halo."""
    r = np.random.default_rng(8)
    sizes = {1: 900, **{u: 60 for u in range(2, 32)}}
    pdf = pd.DataFrame([(u, c, *r.normal(size=2)) for u, n in sizes.items() for c in range(1, n + 1)], columns=["unit_id", "time_cycle", "x", "y"])
    df = spark.createDataFrame(pdf)
    plain = windows.add_features(df, ["x", "y"], [5, 10], windows.ROLLING_STATS, [1, 5], True, "fill", extra=[labels.rul_expr()])
    split = windows.add_features(df, ["x", "y"], [5, 10], windows.ROLLING_STATS, [1, 5], True, "fill", rul=labels.rul_of(), split_rows=64)
    a, b = (z.orderBy("unit_id", "time_cycle").toPandas() for z in (plain, split))
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, rtol=1e-12)
    per = windows.unit_chunks(df, 64, 9).groupBy("unit_id", "_chunk").count()
    assert per.agg(F.max("count")).first()[0] <= 64 + 9 and per.filter("unit_id = 1").count() == 15


def test_serving_features_gates(spark):
    pdf = pd.DataFrame({"unit_id": [1] * 15, "time_cycle": range(1, 16), "value": np.arange(15.0)})
    out = windows.serving_features(spark.createDataFrame(pdf), ["value"], windows=[5], lags=[1, 10]).first()
    assert out["time_cycle"] == 15
    assert out["value_rolling_mean_5"] == 0.0  # < 20 rows of history: gated
    assert out["value_lag_1"] == 13.0  # >= 10 rows: lags present
    assert out["value_delta"] == 1.0


def test_telemetry_view_dense_cycles(spark):
    t = tables.telemetry_lineitem(spark, SF_SMALL)
    per = t.groupBy("unit_id").agg(F.count("*").alias("n"), F.max("time_cycle").alias("mx"), F.countDistinct("time_cycle").alias("nd"))
    assert per.filter("n != mx OR n != nd").count() == 0


def test_skew_safe_cycle_numbering_equals_row_number(spark):
    a = tables.telemetry_lineitem(spark, SF_SMALL).orderBy("unit_id", "time_cycle").toPandas()
    b = tables.telemetry_lineitem(spark, SF_SMALL, skew_safe=True).orderBy("unit_id", "time_cycle").toPandas()
    pd.testing.assert_frame_equal(a, b[a.columns])
    c = tables.telemetry_events(spark, SF_SMALL).orderBy("unit_id", "time_cycle").toPandas()
    d = tables.telemetry_events(spark, SF_SMALL, skew_safe=True).orderBy("unit_id", "time_cycle").toPandas()
    pd.testing.assert_frame_equal(c, d[c.columns])


def test_library_recipe_336_features_one_exchange(f1a):
    from cyclewise.schema import SENSOR_COLS

    _, df = f1a
    out = windows.add_features(df, SENSOR_COLS, [5, 10, 20], windows.ROLLING_STATS, [1, 5, 10], True, "fill", extra=[labels.rul_expr()])
    feats = windows.feature_columns(SENSOR_COLS, [5, 10, 20], windows.ROLLING_STATS, [1, 5, 10], True)
    assert len(feats) == 336 and set(feats) <= set(out.columns)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert out.count() == 100


def test_stacked_windows_with_halo_chunks_equal_frames(spark):
    from cyclewise.schema import TELEMETRY_SCHEMA

    from .conftest import make_telemetry

    pdf = make_telemetry(units=3, cycles=80)
    df = spark.createDataFrame(pdf.astype({"unit_id": "int32", "time_cycle": "int32"}), TELEMETRY_SCHEMA)
    a = windows.add_features(df, CH, [5, 10, 20], windows.ROLLING_STATS, [1, 5], True, "fill", stack=False).orderBy("unit_id", "time_cycle").toPandas()
    b = windows.add_features(df, CH, [5, 10, 20], windows.ROLLING_STATS, [1, 5], True, "fill", split_rows=25, extra=[labels.rul_expr()]).orderBy("unit_id", "time_cycle").toPandas()
    assert list(b.columns[: len(df.columns)]) == df.columns
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, rtol=1e-12)


def test_stacked_mean_after_a_run_of_nulls(spark):
    from cyclewise.operators.windows import add_features

    df = spark.createDataFrame([(1, i, float(i) if i <= 5 else None) for i in range(1, 31)], "unit_id int, time_cycle int, x double")
    a, b = (add_features(df, ["x"], windows=(5, 10, 20), lags=(), delta=False, stack=s).orderBy("time_cycle").toPandas() for s in (True, False))
    import pandas as pd

    pd.testing.assert_frame_equal(a, b[a.columns])


def test_split_windows_are_dealt_by_chunk(f1a):
    _, df = f1a
    a = windows.add_features(df, CH, [5], ["mean", "max"], [1], True, "fill").orderBy("unit_id", "time_cycle").toPandas()
    out = windows.add_features(df, CH, [5], ["mean", "max"], [1], True, "fill", split_rows=6)
    assert "hashpartitioning(unit_id" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "_chunk" in plan.split("hashpartitioning(unit_id", 1)[1][:40]
    pd.testing.assert_frame_equal(a, out.orderBy("unit_id", "time_cycle").toPandas()[a.columns])
