"""Array kernels over ensemble member predictions (nulls = missing members)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.isNotNull())


def arr_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def arr_mean(arr: Column) -> Column:
    p = present(arr)
    return F.when(F.size(p) > 0, arr_sum(p) / F.size(p))


def arr_std_pop(arr: Column) -> Column:
    p = present(arr)
    m = arr_mean(arr)
    var = F.aggregate(p, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / F.size(p)
    return F.when(F.size(p) > 0, F.sqrt(var))


def arr_median(arr: Column) -> Column:
    s = F.array_sort(present(arr))
    n = F.size(s)
    mid = F.floor((n - 1) / 2).cast("int") + 1  # 1-based
    lo = F.element_at(s, mid)
    hi = F.element_at(s, F.floor(n / 2).cast("int") + 1)
    return F.when(n == 0, F.lit(None)).when(n % 2 == 1, lo).otherwise((lo + hi) / 2.0)
