"""Distributed prefix scans: running counts / sums / minima along an order within a key.

A plain ``Window.partitionBy(key).orderBy(t)`` running aggregate puts a whole key
into one task; with one key holding a third of all rows that is one task over a
third of the data.  Here the rows are cut into ranges of (key, order), ``_bkt``
(``ranged``): Spark deals them out from a sample, so their number and size follow
the data and a large key has many:

1. inside each (key, bucket) a running window (many tasks),
2. per (key, bucket) totals by a partial aggregate,
3. exclusive prefix of the totals over buckets (keys x buckets rows: small),
4. equi join of the offsets back on (key, bucket) and combine.

The result equals the single-window running aggregate exactly for counts and
min / max, and up to float association for sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import join_small


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_bkt``, the number of the range of (keys, order) that a row lies in.

    The exchange has as many ranges as the session's shuffle partitions, and AQE joins
    those that are small.  Written to the checkpoint folder, as a second run would sample
    anew and cut elsewhere."""
    return cut_lineage(df.repartitionByRange(*keys, *order).withColumn("_bkt", F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    mins: Sequence[str] = (),
    maxs: Sequence[str] = (),
    pos: str | None = "pos",
    prefix: str = "cum_",
    keep_bucket: bool = False,
) -> DataFrame:
    """Add ``pos`` (1-based row number within key) and inclusive running
    ``cum_<c>`` sums, ``min_<c>`` minima and ``max_<c>`` maxima along ``order``.

    A scan of a scan uses the ranges that the first one kept (``keep_bucket=True``).
    """
    keys, order = list(keys), list(order)
    b = df if "_bkt" in df.columns else ranged(df, keys, order)
    local = Window.partitionBy(*keys, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rn = Window.partitionBy(*keys, "_bkt").orderBy(*order)
    cols = [F.col(c) for c in b.columns]
    if pos:
        cols.append(F.row_number().over(rn).cast("long").alias("_lpos"))
    cols += [F.sum(c).over(local).alias(f"_ls_{c}") for c in sums]
    cols += [F.min(c).over(local).alias(f"_lmin_{c}") for c in mins]
    cols += [F.max(c).over(local).alias(f"_lmax_{c}") for c in maxs]
    loc = b.select(*cols)

    tot_aggs = []
    if pos:
        tot_aggs.append(F.count(F.lit(1)).alias("_bn"))
    tot_aggs += [F.sum(c).alias(f"_bs_{c}") for c in sums]
    tot_aggs += [F.min(c).alias(f"_bmin_{c}") for c in mins]
    tot_aggs += [F.max(c).alias(f"_bmax_{c}") for c in maxs]
    totals = b.groupBy(*keys, "_bkt").agg(*tot_aggs)
    prev = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    off_cols = [F.col(k) for k in keys] + [F.col("_bkt")]
    if pos:
        off_cols.append(F.coalesce(F.sum("_bn").over(prev), F.lit(0)).alias("_on"))
    off_cols += [F.sum(f"_bs_{c}").over(prev).alias(f"_os_{c}") for c in sums]
    off_cols += [F.min(f"_bmin_{c}").over(prev).alias(f"_omin_{c}") for c in mins]
    off_cols += [F.max(f"_bmax_{c}").over(prev).alias(f"_omax_{c}") for c in maxs]
    offsets = totals.select(*off_cols)

    j = join_small(loc, offsets, on=[*keys, "_bkt"], how="inner")
    out = [F.col(c) for c in df.columns if c != "_bkt"] + ([F.col("_bkt")] if keep_bucket else [])
    if pos:
        out.append((F.col("_on") + F.col("_lpos")).alias(pos))
    out += [(F.coalesce(F.col(f"_os_{c}"), F.lit(0)) + F.col(f"_ls_{c}")).alias(f"{prefix}{c}") for c in sums]
    out += [F.least(F.col(f"_omin_{c}"), F.col(f"_lmin_{c}")).alias(f"min_{c}") for c in mins]
    out += [F.greatest(F.col(f"_omax_{c}"), F.col(f"_lmax_{c}")).alias(f"max_{c}") for c in maxs]
    return j.select(*out)


def lookback(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str], k: int, suffix: str = "_back") -> DataFrame:
    """Value of ``cols`` exactly ``k`` rows earlier within the key (null before start).

    An equi join on (key, pos - k): every row has a unique position, so the join
    is free of skew however large a key is.
    """
    back = df.select(*keys, (F.col(pos) + F.lit(k)).alias(pos), *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return df.join(back, on=[*keys, pos], how="left")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    qs: Sequence[float],
    names: Sequence[str] | None = None,
    method: str = "linear",
) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default) per key,
    or (``method="index"``) the order statistic ``sorted(values)[floor(q n)]``,
    without holding any group in one task or one buffer.

    Distinct (key, value) counts (partial aggregate; a hot value is one row),
    a running count over ranges of values, then for rank r = q (n - 1) the value
    at 0-based ranks floor(r) and ceil(r) is the smallest value whose running
    count exceeds the rank.
    """
    keys = list(keys)
    names = list(names) if names else [f"q{int(round(q * 100))}" for q in qs]
    dv = df.filter(F.col(value).isNotNull())
    if not keys:
        dv, keys = dv.withColumn("_k", F.lit(0)), ["_k"]
    dv = ranged(dv.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), keys, [value])
    cum = running(dv, keys, [value], sums=["_c"], pos=None).join(dv.groupBy(*keys).agg(F.sum("_c").alias("_n")), keys)
    aggs = []
    for q, nm in zip(qs, names):
        if method == "index":
            k = F.least(F.floor(F.lit(q) * F.col("_n")), F.col("_n") - 1)
            aggs.append(F.min(F.when(F.col("cum__c") > k, F.col(value))).alias(nm))
            continue
        r = F.lit(q) * (F.col("_n") - 1)
        lo_r, hi_r = F.floor(r), F.ceil(r)
        v_lo = F.min(F.when(F.col("cum__c") > lo_r, F.col(value)))
        v_hi = F.min(F.when(F.col("cum__c") > hi_r, F.col(value)))
        frac = F.first(r - lo_r)
        aggs.append((v_lo + (v_hi - v_lo) * frac).alias(nm))
    out = cum.groupBy(*keys).agg(*aggs, F.first("_n").alias("n"))
    return out.drop("_k") if "_k" in keys else out
