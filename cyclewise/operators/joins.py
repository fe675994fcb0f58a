"""Join helpers: broadcast only behind a size check, shuffle join beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str] | F.Column,
    how: str = "inner",
    known_small: bool = False,
) -> DataFrame:
    """Equi join where ``small`` is expected to be small.

    * ``known_small``: the side is bounded by construction (one row per feature x
      bin, a rule table, a fixed grid): broadcast hint.
    * otherwise: a plain join.  AQE measures the shuffled size of both sides at
      runtime and turns it into a broadcast join only below
      ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that it stays a
      sort-merge join whose skewed partitions AQE splits.
    """
    if known_small:
        return big.join(F.broadcast(small), on=on, how=how)
    return big.join(small, on=on, how=how)
