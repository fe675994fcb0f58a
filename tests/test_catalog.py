import __spark_entry__ as E
from cyclewise.plans import catalog

from .conftest import SF_SMALL

# Queries without an SQL oracle: training, file listings, history tables, stream state.
ROWS_ONLY = {
    "m1_train_val_split", "m2_m8_forest_batch_predict", "m3_m5_m6_boosted_learning_curve", "m4_sequence_regressor",
    "m7_w10_feature_importance_top", "m9_train_many_tolerate_failure", "m11_model_save_load", "m12_model_registry",
    "d15_drift_history", "n3_scaler_save_load", "s12_json_report_sink",
    "x9_stream_features_models_ensemble",
}


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = catalog.queries()  # the training-data queries say in their own tests which of them SQL cannot express
    assert set(own) - set(o) == ROWS_ONLY


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "RUL" in df.columns


def test_cheap_queries_run_on_smoke_data(spark):
    q = E.queries()
    for name in ["p6_dataset_info", "d7_data_drift_summary", "o9_histogram_quantiles", "r7_retrain_plan", "x5_sliding_rate_stream"]:
        assert q[name](spark, SF_SMALL).count() >= 0
