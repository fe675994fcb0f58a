"""S8 counts distinct cycles by blocks of 64."""

import random

import pytest
from pyspark.sql import functions as F

from cyclewise.operators.profiling import trajectory_report


@pytest.mark.parametrize("kind", ["int", "long", "double"])
def test_report_equals_a_plain_count(spark, kind):
    r = random.Random(8)
    rows = [(1, c) for c in range(1, 400)] + [(2, c) for c in (1, 2, 2, 4)] + [(3, c) for c in (-65, -64, -1, 0, 63, 64, 65)] + [(4, None), (None, 3), (None, None)]
    rows += [(u, c) for u in (5, 6) for c in range(1, 130)] + [(6, 130), (7, 10**6), (0, 1)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "unit_id long, time_cycle long").withColumn("time_cycle", F.col("time_cycle").cast(kind)).repartition(6)
    got = trajectory_report(df).first()
    units = {u: [c for v, c in rows if v == u] for u, _ in rows}
    dense = sum(sorted(c for c in cs if c is not None) == list(range(1, len(cs) + 1)) for cs in units.values())
    assert tuple(got) == (
        len(rows), sum(u is None or c is None for u, c in rows), sum((u is not None and u <= 0) or (c is not None and c <= 0) for u, c in rows), len(units), dense, False)


def test_empty_and_clean_tables(spark):
    none = trajectory_report(spark.createDataFrame([], "unit_id long, time_cycle int")).first()
    assert none["n_rows"] is None and none["n_units"] == 0
    assert trajectory_report(spark.range(1, 100).selectExpr("1L AS unit_id", "CAST(id AS INT) AS time_cycle")).first()["ok"]


def test_a_task_holds_blocks_and_not_cycles(spark):
    df = spark.range(0, 64_000, 1, 4).selectExpr("id % 10 + 1 AS unit_id", "CAST(id DIV 10 + 1 AS INT) AS time_cycle")
    plan = trajectory_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "bit_or" in plan and "shiftright" in plan
