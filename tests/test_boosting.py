"""Early stopping, importances from node tables, the member map."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor

from cyclewise.operators import boosting, ensemble, models
from cyclewise.schema import SEQUENCE_LENGTH


def _frame(spark, n, seed, y):
    r = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": r.uniform(0, 1, n), "b": r.uniform(0, 1, n)})
    pdf["RUL"] = y(pdf, r)
    return models.assemble(spark.createDataFrame(pdf), ["a", "b"])


def test_stops_when_the_best_round_is_patience_rounds_old(spark):
    train = _frame(spark, 200, 1, lambda p, r: 100 * p["a"])
    against = _frame(spark, 100, 2, lambda p, r: 100 - 100 * p["a"])  # every round makes it worse
    got = boosting.fit_stages(train, against, patience=3, rounds=30, depth=3)
    assert (got.best_round, got.stopped_round, len(got.trees)) == (1, 4, 4)
    assert [i for i, _ in got.curve] == [1, 2, 3, 4] and got.model().getNumTrees == 1
    alike = _frame(spark, 100, 3, lambda p, r: 100 * p["a"])
    full = boosting.fit_stages(train, alike, patience=3, rounds=12, depth=3)
    assert full.stopped_round == 12 and full.best_round == 12
    errors = [e for _, e in full.curve]
    assert errors == sorted(errors, reverse=True)
    # the curve is the error of the model it belongs to
    rows = full.predict(alike).select("RUL", "prediction").toPandas()
    assert ((rows["RUL"] - rows["prediction"]) ** 2).mean() == pytest.approx(errors[-1])
    assert models.EARLY_STOPPING_ROUNDS == 20 and boosting.fit_stages.__defaults__[2] == 20


def test_no_training_rows_is_an_error(spark):
    empty = _frame(spark, 5, 1, lambda p, r: p["a"]).limit(0)
    with pytest.raises(ValueError, match="no training rows"):
        boosting.fit_stages(empty, empty, rounds=1)


def test_importances_of_a_hand_counted_tree(spark):
    """Rows split by a at 0.5 (6 and 2 rows), then the six by b (3 and 3): gains are the falls of the variance."""
    rows = [(0.0, 0.0, 0.0)] * 3 + [(0.0, 1.0, 4.0)] * 3 + [(1.0, 0.0, 20.0)] * 2
    df = models.assemble(spark.createDataFrame(rows, "a double, b double, RUL double"), ["a", "b", "c"][:2])
    tree = DecisionTreeRegressor(labelCol="RUL", maxDepth=2).fit(df)
    y = np.array([r[2] for r in rows])
    got = {r["feature"]: r for r in boosting.importances(tree, ["a", "b"]).collect()}
    assert (got["a"]["weight"], got["a"]["cover"], got["b"]["weight"], got["b"]["cover"]) == (1, 8.0, 1, 6.0)
    assert got["a"]["gain"] == pytest.approx(y.var() - 6 / 8 * y[:6].var())
    assert got["b"]["gain"] == pytest.approx(y[:6].var())


def test_importances_of_several_trees_add_up(spark):
    df = _frame(spark, 150, 4, lambda p, r: 10 * p["a"] + r.normal(0, 0.1, len(p)))
    m = GBTRegressor(labelCol="RUL", maxIter=4, maxDepth=3, seed=1).fit(df)
    got = {r["feature"]: r for r in boosting.importances(m, ["a", "b"]).collect()}
    splits = sum(t.numNodes - (t.numNodes + 1) // 2 for t in m.trees)
    assert got["a"]["weight"] + got["b"]["weight"] == splits and got["a"]["total_gain"] > got["b"]["total_gain"]
    assert got["a"]["gain"] == pytest.approx(got["a"]["total_gain"] / got["a"]["weight"])
    assert boosting.importances(m, ["a", "b", "unused"]).filter("feature = 'unused' and weight = 0 and gain = 0").count() == 1


def test_bounded_draw_is_stable(spark):
    df = spark.createDataFrame(pd.DataFrame({"u": np.arange(5000) // 50, "c": np.arange(5000)}))
    a, b = models.bounded(df, ["u", "c"], 800), models.bounded(df.repartition(5), ["u", "c"], 800)
    assert 700 < a.count() < 900 and a.exceptAll(b).count() == 0
    assert models.bounded(df, ["u", "c"], 5000).count() == 5000 and SEQUENCE_LENGTH == 50


def test_member_map_record(spark):
    M = {"forest": "f", "boosted": "b", "sequence": "s"}
    rows = [(1, 40.0, 50.0, 60.0), (2, 40.0, None, 60.0), (3, None, None, 300.0), (4, None, None, None)]
    got = {r["i"]: r for r in ensemble.record(spark.createDataFrame(rows, "i int, f double, b double, s double"), M).collect()}
    w = ensemble.ONLINE_WEIGHTS
    assert got[1]["individual_predictions"] == {"forest": 40.0, "boosted": 50.0, "sequence": 60.0}
    assert got[2]["individual_predictions"] == {"forest": 40.0, "sequence": 60.0}
    assert got[2]["effective_weights"]["forest"] == pytest.approx(w["forest"] / (w["forest"] + w["sequence"]))
    assert sum(got[2]["contributions"].values()) == pytest.approx(got[2]["rul"], abs=0.006)
    assert (got[3]["rul"], got[3]["contributions"]) == (125.0, {"sequence": 300.0})
    assert (got[4]["individual_predictions"], got[4]["rul"], got[4]["model_type"]) == ({}, -1.0, "error")
    odd = ensemble.record(spark.createDataFrame(rows, "i int, f double, b double, s double"), M, {"other": 1.0}).filter("i = 2").first()
    assert odd["effective_weights"] == {"forest": 0.5, "sequence": 0.5}
    plan = ensemble.record(spark.createDataFrame(rows, "i int, f double, b double, s double"), M)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_filter" in plan and "transform_values" in plan
