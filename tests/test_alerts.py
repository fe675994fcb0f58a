"""Alert islands over series with different labels."""

import pandas as pd
from pyspark.sql import functions as F

from cyclewise.operators import alerts

S = 1_000_000


def _fired(spark, series, rules):
    got = alerts.evaluate(series, alerts.rule_table(spark, rules)).collect()
    epoch = pd.Timestamp("1970-01-01")
    sec = lambda t: int((pd.Timestamp(t) - epoch).total_seconds())
    return sorted((r["rule"], r["labels"], sec(r["started_at"]), sec(r["ended_at"]), sec(r["fired_at"])) for r in got)


def test_touching_intervals_are_one_island_of_their_labels(spark):
    rows = [("m", {"b": "2", "a": "1"}, 30 * k, 30 * (k + 1), 5.0) for k in (0, 1, 2, 3, 6, 7)]
    rows += [("m", {"a": "1"}, 30 * k, 30 * (k + 1), 5.0 if k != 2 else 0.0) for k in range(9)]
    rows += [("m", {}, 0, 1000, None), ("other", {"a": "1"}, 0, 1000, 5.0)]
    df = spark.createDataFrame([(m, k, a * S, z * S, v) for m, k, a, z, v in rows], "metric string, labels map<string,string>, since long, until long, value double").repartition(4)
    got = _fired(spark, df, [("R", "m", ">", 1.0, 60, "warning"), ("Low", "m", "<", 1.0, 10, "info"), ("Same", "other", "==", 5.0, 0, "info"), ("None", "absent", ">", 0.0, 0, "info")])
    assert got == [
        ("Low", "a=1", 60, 90, 70),
        ("R", "a=1", 90, 270, 150),  # the first island of these labels lasts 60 s, which is not more than its hold
        ("R", "a=1,b=2", 0, 120, 60),
        ("Same", "a=1", 0, 1000, 0)]


def test_a_gauge_holds_until_its_next_sample(spark):
    at = pd.Timestamp("1970-01-01")
    rows = [("u", 1, 0, 5.0), ("u", 2, 100, 4.0), ("u", 3, 100, 50.0), ("u", 4, 200, 3.0), ("v", 5, 50, 2.0), (None, 6, 0, 1.0)]
    df = spark.createDataFrame(pd.DataFrame([(u, i, at + pd.Timedelta(seconds=t), v) for u, i, t, v in rows], columns=["unit", "id", "ts", "value"])).repartition(3)
    labels = alerts.labels_of(unit_id=F.col("unit"))
    series = alerts.gauge_series(df, "rul", labels, F.col("value"), "ts", "id", F.lit(400 * S))
    got = _fired(spark, series, [("Low", "rul", "<", 10.0, 60, "critical")])
    # of the two samples at 100 the last holds; a sample without a unit is a series of its own
    assert got == [("Low", "", 0, 400, 60), ("Low", "unit_id=u", 0, 100, 60), ("Low", "unit_id=u", 200, 400, 260), ("Low", "unit_id=v", 50, 400, 110)]
    assert series.count() == 5


def test_every_rule_has_a_series(spark):
    from cyclewise.plans.q_monitor import alert_series

    from .conftest import SF_SMALL

    have = {r["metric"] for r in alert_series(spark, SF_SMALL).select("metric").distinct().collect()}
    assert {m for _, m, *_ in alerts.RULES} == have and len(alerts.RULES) == 19


def test_series_cut_into_many_ranges_give_whole_islands(spark):
    """Islands and gauges over range borders, several gauges in one scan, against a plain pass in Python."""
    import random

    r = random.Random(3)
    at = pd.Timestamp("1970-01-01")
    rows = [(r.choice(["a", "b", None]), i, at + pd.Timedelta(seconds=r.randrange(3000)), float(r.choice([1, 1, 1, 9]))) for i in range(900)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["unit", "id", "ts", "value"])).repartition(5)
    labels = alerts.labels_of(unit_id=F.col("unit"))
    gauges = [alerts.gauge_samples(df, m, labels, F.col("value") * k, "ts", "id") for m, k in (("one", 1.0), ("two", 9.0))]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges stay apart
    try:
        series = alerts.hold(gauges[0].unionByName(gauges[1]), F.lit(3000 * S))
        got = _fired(spark, series, [("Low", "one", "<", 5.0, 20, "info"), ("High", "two", ">", 10.0, 5, "info")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = []
    for unit in ("a", "b", None):
        mine = sorted((int((t - at).total_seconds()), i, v) for u, i, t, v in rows if u == unit)
        held = [(s, e, v) for (s, _, v), e in zip(mine, [x[0] for x in mine[1:]] + [3000]) if e > s]
        for rule, least, true in (("Low", 20, lambda v: v < 5), ("High", 5, lambda v: v * 9 > 10)):
            islands: list = []
            for s, e, v in held:
                if true(v) and islands and islands[-1][1] == s:
                    islands[-1][1] = e
                elif true(v):
                    islands.append([s, e])
            want += [(rule, f"unit_id={unit}" if unit else "", s, e, s + least) for s, e in islands if e - s > least]
    assert got == sorted(want) and len(got) > 20


def test_true_intervals_are_computed_once(spark):
    """A series of any cost is read once by ``evaluate``: what it calls is counted."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(50).selectExpr("'m' AS metric", "map('a', '1') AS labels", "id * 30 AS since", "id * 30 + 30 AS until", "5.0D AS value")
    series = df.mapInArrow(count, df.schema)
    assert len(_fired(spark, series, [("R", "m", ">", 1.0, 0, "warning")])) == 1
    assert seen.value == 50
