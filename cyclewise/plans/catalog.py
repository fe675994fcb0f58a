"""queries() / oracle_sql() for the driver contract: one entry per SURVEY section-2 item."""

from __future__ import annotations

import functools
import importlib

from .registry import REGISTRY

MODULES = ["q_features", "q_profile", "q_ensemble", "q_drift", "q_monitor", "q_decide", "q_sources", "q_models", "q_streaming"]


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")


def _utc(fn):
    """Every query reads naive timestamps as UTC wall-clock time (as the oracle does)."""

    @functools.wraps(fn)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def queries():
    _load()
    return {k: _utc(v[0]) for k, v in REGISTRY.items()}


def oracle_sql():
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
