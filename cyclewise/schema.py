"""Column lists, types and the feature naming contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw telemetry layout (unit, cycle, 3 operating settings, 21 sensors).
KEY_COLS = ["unit_id", "time_cycle"]
SETTING_COLS = ["op_setting_1", "op_setting_2", "op_setting_3"]
SENSOR_COLS = [f"sensor_{i}" for i in range(1, 22)]
RAW_COLS = KEY_COLS + SETTING_COLS + SENSOR_COLS

# The 14-sensor set of the containerised pipeline and serving path.
PIPELINE_SENSORS = [
    "sensor_2", "sensor_3", "sensor_4", "sensor_7", "sensor_8", "sensor_9", "sensor_11",
    "sensor_12", "sensor_13", "sensor_14", "sensor_15", "sensor_17", "sensor_20", "sensor_21",
]
# Sensors known to be near-constant (drop list).
DROP_SENSORS = ["sensor_1", "sensor_5", "sensor_6", "sensor_10", "sensor_16", "sensor_18", "sensor_19"]

# Defaults of the feature recipe.
LIBRARY_WINDOWS = [5, 10, 20]
LIBRARY_LAGS = [1, 5, 10]
PIPELINE_WINDOWS = [5, 10, 20]
PIPELINE_LAGS = [1, 5, 10]
MAX_RUL = 125
SEQUENCE_LENGTH = 50

# Columns that are never features.
NON_FEATURE_COLS = ["unit_id", "time_cycle", "RUL", "max_cycle"]

TELEMETRY_SCHEMA = T.StructType(
    [T.StructField("unit_id", T.IntegerType(), False), T.StructField("time_cycle", T.IntegerType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in SETTING_COLS + SENSOR_COLS]
)

RUL_SCHEMA = T.StructType([T.StructField("unit_id", T.IntegerType(), False), T.StructField("rul", T.IntegerType(), False)])

DATASETS = ["FD001", "FD002", "FD003", "FD004"]


def rolling_name(col: str, stat: str, window: int) -> str:
    return f"{col}_rolling_{stat}_{window}"


def lag_name(col: str, k: int) -> str:
    return f"{col}_lag_{k}"


def delta_name(col: str) -> str:
    return f"{col}_delta"
