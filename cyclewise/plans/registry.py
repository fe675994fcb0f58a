"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Keys are ``<section id>_<name>`` in lower case so they map to SURVEY section 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles to ``digits`` for an exact comparison with the oracle.

    The rounding exists only to compare two engines."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r(expr: str, digits: int = 6) -> str:
    """SQL side of ``present``."""
    return f"round(CAST({expr} AS DOUBLE), {digits})"
