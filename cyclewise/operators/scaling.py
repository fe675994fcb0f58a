"""Scaler and the full feature pipeline.

The scaler uses the POPULATION std (ddof 0); Spark ML's StandardScaler uses the
sample std, so it is not used.  Fitted parameters are a tiny table (one row per
feature), persisted as Parquet with a JSON metadata row, and applied as a plain
projection with literals (stays in whole-stage codegen).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import (
    DROP_SENSORS, LIBRARY_LAGS, LIBRARY_WINDOWS, MAX_RUL, NON_FEATURE_COLS, PIPELINE_LAGS, PIPELINE_SENSORS, PIPELINE_WINDOWS, RAW_COLS, SENSOR_COLS, SETTING_COLS,
)
from . import labels, profiling as profile, windows
from .windows import SPLIT_ROWS


class NotFittedError(RuntimeError):
    pass


def scaler_params(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean, std) with population std, in one aggregate pass."""
    aggs = []
    for c in features:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    return wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"), F.col(f"s__{c}").alias("std"))
                    for c in features
                ]
            )
        ).alias("p")
    ).select("p.*")


@dataclass
class ScalerModel:
    features: list[str]
    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str]) -> ScalerModel:
        rows = scaler_params(df, features).collect()  # one row per feature: bounded
        return cls(list(features), {r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["std"] for r in rows})

    def exprs(self) -> list[F.Column]:
        out = []
        for c in self.features:
            s = self.std.get(c)
            m = self.mean.get(c)
            denom = 1.0 if (s is None or s == 0.0) else s
            out.append(((F.col(c) - F.lit(m if m is not None else 0.0)) / F.lit(denom)).alias(c))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - mean) / std, zero std -> divide by 1; other columns pass through."""
        scaled = {c for c in self.features}
        rest = [F.col(c) for c in df.columns if c not in scaled]
        return df.select(*rest, *self.exprs())

    def params_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(c, self.mean.get(c), self.std.get(c)) for c in self.features], "feature string, mean double, std double"
        )


@dataclass
class PipelineSpec:
    channels: list[str]
    windows: list[int] = field(default_factory=lambda: list(LIBRARY_WINDOWS))
    stats: list[str] = field(default_factory=lambda: list(windows.ROLLING_STATS))
    lags: list[int] = field(default_factory=lambda: list(LIBRARY_LAGS))
    delta: bool = True
    null_policy: str = "fill"
    create_rul: bool = True
    clip_rul: bool = True
    max_rul: int = MAX_RUL
    drop_constant: bool = True
    constant_threshold: float = 0.01
    split_rows: int | None = SPLIT_ROWS
    dialect: str = "library"


# Version of the saved pipeline document.
DOCUMENT = 2
DIALECTS = ("library", "pipeline")


def recipe(dialect: str, columns: Sequence[str]) -> PipelineSpec:
    """The two recipes of features over the columns there are.

    ``library``: all settings and 21 sensors, rolling mean / std / min / max, nulls filled, near-constant
    columns found in the data and dropped.  ``pipeline``: the 14 sensors of the fixed list, rolling mean and
    std, nulls kept and their rows dropped; the fixed drop list instead of a search for constants.  Columns
    that are no sensors or settings (other tables) are channels of both."""
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}, got {dialect!r}")
    other = [c for c in columns if c not in RAW_COLS and c not in NON_FEATURE_COLS]
    if dialect == "library":
        return PipelineSpec(channels=[c for c in columns if c in SETTING_COLS or c in SENSOR_COLS] + other)
    return PipelineSpec(channels=[c for c in PIPELINE_SENSORS if c in columns] + [c for c in other if c not in DROP_SENSORS],
                        windows=list(PIPELINE_WINDOWS), stats=["mean", "std"], lags=list(PIPELINE_LAGS), null_policy="drop", drop_constant=False, dialect="pipeline")


def _own(df: DataFrame, channels: Sequence[str]) -> list[str]:
    """Of the sensor and setting columns those of the recipe, and everything else."""
    return [c for c in df.columns if c in channels or c not in SETTING_COLS + SENSOR_COLS]


class TelemetryPipeline:
    """N4 estimator: P4 -> L1 -> W1..W6 -> P5 -> N1 (fit) / N2 (transform).

    The whole chain is one lazily built plan: one exchange on unit_id, one sort,
    one window operator, then a projection.
    """

    def __init__(self, spec: PipelineSpec):
        self.spec = spec

    def _features(self, df: DataFrame, channels: list[str]) -> DataFrame:
        s = self.spec
        label = s.create_rul and "RUL" not in df.columns
        extra = [labels.rul_expr(s.clip_rul, s.max_rul)] if label and not s.split_rows else []
        rul = labels.rul_of(s.clip_rul, s.max_rul) if label and s.split_rows else None
        out = windows.add_features(
            df, channels, s.windows, s.stats, s.lags, s.delta, s.null_policy, split_rows=s.split_rows, extra=extra, rul=rul
        )
        # the row number keeps the null filter above the feature columns: pushed below them, its one condition
        # over all columns would be rewritten once for every renaming, a number that doubles with each column
        return out.withColumn("_row", F.monotonically_increasing_id()).filter("_row >= 0").na.drop().drop("_row")

    def fit(self, df: DataFrame) -> TelemetryPipelineModel:
        s = self.spec
        channels = list(s.channels)
        dropped: list[str] = []
        if s.drop_constant:
            _, dropped = profile.drop_constant_columns(df, channels, s.constant_threshold)
            channels = [c for c in channels if c not in dropped]
        feats = self._features(df.select(*_own(df, channels)), channels)  # read once, by the scaler: the list of features is in the schema
        fcols = profile.numeric_features(feats, NON_FEATURE_COLS)
        scaler = ScalerModel.fit(feats, fcols)
        return TelemetryPipelineModel(self.spec, channels, dropped, scaler)


class TelemetryPipelineModel:
    def __init__(self, spec: PipelineSpec, channels: list[str], dropped: list[str], scaler: ScalerModel | None):
        self.spec, self.channels, self.dropped, self.scaler = spec, channels, dropped, scaler

    def transform(self, df: DataFrame) -> DataFrame:
        if self.scaler is None:
            raise NotFittedError("pipeline is not fitted")
        feats = TelemetryPipeline(self.spec)._features(df.select(*_own(df, self.channels)), self.channels)
        return self.scaler.transform(feats)

    def save(self, path: str) -> None:
        """Parameter table (Parquet) + metadata (JSON) under ``path``."""
        spark = SparkSession.getActiveSession()
        self.scaler.params_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
        meta = {"version": DOCUMENT, "spec": asdict(self.spec), "channels": self.channels, "dropped": self.dropped, "features": self.scaler.features}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> TelemetryPipelineModel:
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        if meta.get("version", 1) > DOCUMENT:
            raise ValueError(f"the pipeline document has version {meta['version']}, this library reads up to {DOCUMENT}")
        rows = spark.read.parquet(f"{path}/scaler").collect()
        mean = {r["feature"]: r["mean"] for r in rows}
        std = {r["feature"]: r["std"] for r in rows}
        scaler = ScalerModel(meta["features"], mean, std)
        return cls(PipelineSpec(**meta["spec"]), meta["channels"], meta["dropped"], scaler)
