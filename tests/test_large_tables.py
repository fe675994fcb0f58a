"""Steps that grow with the table: the same rows as over everything, and no more written than needed."""

import os

from pyspark.sql import functions as F

from cyclewise.operators import labels, models, scaling, windows
from cyclewise.session import ensure_checkpoint_dir


def _readings(spark, units=7, cycles=80):
    return spark.range(units * cycles).select(
        F.expr(f"id div {cycles} + 1").alias("unit_id"), F.expr(f"cast(id % {cycles} + 1 as int)").alias("time_cycle"),
        F.expr("double(hash(id) % 1000) / 7").alias("a"), F.expr("case when id % 11 = 0 then null else double(hash(id, 3) % 1000) / 3 end").alias("b"))


def _files(spark):
    root = ensure_checkpoint_dir(spark)
    return sum(len(f) for _, _, f in os.walk(root.removeprefix("file:")))


def test_features_of_a_draw_equal_those_of_all_rows(spark):
    t, key = _readings(spark), ["unit_id", "time_cycle"]
    picked = models.bounded(t, key, rows=40).select(*key)
    every = windows.add_features(t, ["a", "b"], split_rows=32)
    some = windows.add_features(windows.rows_before(t, picked, 20), ["a", "b"], split_rows=32).join(picked, key, "left_semi")
    want = every.join(picked, key, "left_semi")
    assert 10 < some.count() == want.count() < 100
    assert some.exceptAll(want).isEmpty()
    seqs = windows.add_sequences(windows.rows_before(t, picked, 29), ["a"], 30, target=None).withColumnRenamed("end_cycle", "time_cycle")
    all_seqs = windows.add_sequences(t, ["a"], 30, target=None).withColumnRenamed("end_cycle", "time_cycle")
    assert sorted(map(str, seqs.join(picked, key, "left_semi").collect())) == sorted(map(str, all_seqs.join(picked, key, "left_semi").collect()))


def test_draw_of_the_catalog_is_the_draw_over_labelled_features(spark):
    from cyclewise.plans import q_models

    t, key = _readings(spark, 90), ["unit_id", "time_cycle"]
    labelled = labels.add_rul(t.select(*key), method="join")
    want = models.bounded(labelled.join(windows.add_features(t, ["a"], split_rows=32).select(*key), key), key)
    got = q_models._drawn(t)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() < 7200


def test_fitting_a_pipeline_writes_no_features(spark):
    t = _readings(spark)
    before = _files(spark)
    model = scaling.TelemetryPipeline(scaling.PipelineSpec(channels=["a", "b"])).fit(t)
    assert _files(spark) == before and len(model.scaler.features) == 2 + len(windows.feature_columns(["a", "b"]))


def test_generated_methods_of_features_stay_short_enough_to_be_compiled(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    windows.add_features(_readings(spark), ["a"])
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "12000")
    windows.add_features(_readings(spark), ["a"])
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "12000"
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")


def test_encoding_holds_a_few_megabytes_of_text_at_a_time():
    import tracemalloc

    import pyarrow as pa

    from cyclewise.llm import rans
    from cyclewise.llm.queries import byte_tokenizer

    words = [f"w{i % 997}" for i in range(200_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(14)), pa.array([" ".join(words)] * 14)], ["id", "text"])
    run = rans._tokenise(byte_tokenizer())
    list(run(iter([batch.slice(0, 1)])))  # the library and the units
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    assert peak < 170


def test_all_null_columns_are_settled_by_the_first_rows_or_by_all(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cyclewise.operators import profiling

    df = spark.range(0, 5000, numPartitions=3).select(
        "id", F.lit(None).cast("int").alias("never"), F.when(F.col("id") == 4999, 1).alias("last"), F.when(F.col("id") == 2, 1).alias("early"))
    passes, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda d, *c: passes.append(len(c)) or agg(d, *c))
    assert profiling.drop_all_null_columns(df).columns == ["id", "last", "early"] and passes == [2]
    passes.clear()
    assert profiling.drop_all_null_columns(df.select("id", "early")).columns == ["id", "early"] and not passes
    assert profiling.drop_all_null_columns(df.filter("false")).columns == []
