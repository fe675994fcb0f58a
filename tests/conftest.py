import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cyclewise.schema import SENSOR_COLS, SETTING_COLS  # noqa: E402
from cyclewise.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8, app="cyclewise-tests")


def make_telemetry(units=5, cycles=20, seed=42, setting_scale=1.0):
    """Units x cycles, settings N(0,1)*scale, sensors N(500,10)."""
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(1, units + 1):
        for c in range(1, cycles + 1):
            rows.append([u, c, *(rng.normal(0, 1, 3) * setting_scale), *rng.normal(500, 10, 21)])
    return pd.DataFrame(rows, columns=["unit_id", "time_cycle", *SETTING_COLS, *SENSOR_COLS])


@pytest.fixture(scope="session")
def f1a(spark):
    pdf = make_telemetry()
    from cyclewise.schema import TELEMETRY_SCHEMA

    return pdf, spark.createDataFrame(pdf.astype({"unit_id": "int32", "time_cycle": "int32"}), TELEMETRY_SCHEMA)
