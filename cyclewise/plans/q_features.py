"""Catalog entries: labels and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels, windows
from ..schema import delta_name, lag_name, rolling_name
from ..sources import tables
from .registry import present, r, register
from .sqlviews import TELEMETRY_EVENTS, TELEMETRY_LINEITEM, with_

CH = tables.LINEITEM_CHANNELS
WINDOWS = [5, 10, 20]
LAGS = [1, 5, 10]
SPEC = "OVER (PARTITION BY unit_id ORDER BY time_cycle{frame})"


def _frame(w: int) -> str:
    return SPEC.format(frame=f" ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW")


def _plain() -> str:
    return SPEC.format(frame="")


def feature_sql(channels, windows_, stats, lags, policy="fill") -> list[str]:
    out = []
    for w in windows_:
        for c in channels:
            for s in stats:
                if s == "mean":
                    e = f"avg({c}) {_frame(w)}"
                elif s == "std":
                    e = f"stddev_samp({c}) {_frame(w)}"
                    e = e if policy == "drop" else f"coalesce({e}, 0)"
                else:
                    e = f"{s}({c}) {_frame(w)}"
                out.append(f"{r(e)} AS {rolling_name(c, s, w)}")
    for k in lags:
        for c in channels:
            e = f"lag({c}, {k}) {_plain()}"
            e = f"coalesce({e}, {c})" if policy == "fill" else e
            out.append(f"{r(e)} AS {lag_name(c, k)}")
    for c in channels:
        e = f"{c} - lag({c}, 1) {_plain()}"
        e = e if policy == "drop" else f"coalesce({e}, 0)"
        out.append(f"{r(e)} AS {delta_name(c)}")
    return out


RUL_SQL = "CAST(least(max(time_cycle) OVER (PARTITION BY unit_id) - time_cycle, 125) AS INTEGER) AS RUL"


def flagship(spark, sf_dir):
    """Telemetry -> RUL (clip 125) -> rolling mean/std/min/max, lags, deltas, dealt by (unit, chunk)."""
    t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).drop("l_shipdate")
    out = windows.add_features(t, CH, WINDOWS, windows.ROLLING_STATS, LAGS, True, "fill", rul=labels.rul_of(), split_rows=windows.SPLIT_ROWS)
    return present(out)


FLAGSHIP_SQL = (
    with_(TELEMETRY_LINEITEM)
    + "SELECT unit_id, time_cycle, "
    + ", ".join(r(c) + f" AS {c}" for c in CH)
    + f", {RUL_SQL}, "
    + ", ".join(feature_sql(CH, WINDOWS, windows.ROLLING_STATS, LAGS))
    + " FROM telemetry_lineitem"
)

register("l1_w1_w6_feature_build", FLAGSHIP_SQL)(flagship)


@register(
    "l1_rul_clipped",
    with_(TELEMETRY_LINEITEM) + f"SELECT unit_id, time_cycle, {RUL_SQL} FROM telemetry_lineitem",
)
def q_l1(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle")
    return labels.add_rul(t, clip=True, method="join")


@register(
    "j1_rul_unclipped_join",
    with_(TELEMETRY_EVENTS)
    + "SELECT t.unit_id, t.time_cycle, CAST(m.max_cycle - t.time_cycle AS INTEGER) AS RUL "
    "FROM telemetry_events t JOIN (SELECT unit_id, max(time_cycle) AS max_cycle FROM telemetry_events "
    "GROUP BY unit_id) m ON t.unit_id = m.unit_id",
)
def q_j1(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle")
    return labels.add_rul(t, clip=False, method="join")


def _single(stat):
    def q(spark, sf_dir):
        t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).drop("l_shipdate")
        return present(
            windows.add_features(t, CH, WINDOWS, [stat], [], False, "fill", split_rows=windows.SPLIT_ROWS).drop(*CH)
        )

    sql = (
        with_(TELEMETRY_LINEITEM)
        + "SELECT unit_id, time_cycle, "
        + ", ".join(feature_sql(CH, WINDOWS, [stat], [])[: len(CH) * len(WINDOWS)])
        + " FROM telemetry_lineitem"
    )
    return q, sql


for _id, _stat in [("w1", "mean"), ("w2", "std"), ("w3", "min"), ("w4", "max")]:
    _q, _sql = _single(_stat)
    register(f"{_id}_rolling_{_stat}", _sql)(_q)


@register(
    "w5_lag",
    with_(TELEMETRY_EVENTS)
    + "SELECT unit_id, time_cycle, "
    + ", ".join(feature_sql(["value"], [], [], LAGS)[:3])
    + " FROM telemetry_events",
)
def q_w5(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle", "value")
    return present(windows.add_features(t, ["value"], [], [], LAGS, False, "fill", split_rows=windows.SPLIT_ROWS).drop("value"))


@register(
    "w6_delta",
    with_(TELEMETRY_EVENTS)
    + "SELECT unit_id, time_cycle, "
    + ", ".join(feature_sql(["value"], [], [], [])) + " FROM telemetry_events",
)
def q_w6(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle", "value")
    return present(windows.add_features(t, ["value"], [], [], [], True, "fill", split_rows=windows.SPLIT_ROWS).drop("value"))


# Pipeline dialect: mean/std only, nulls kept, rows with any null dropped (P5).
PIPE_SQL = (
    with_(TELEMETRY_LINEITEM)
    + "SELECT * FROM (SELECT unit_id, time_cycle, "
    + ", ".join(feature_sql(CH, WINDOWS, ["mean", "std"], LAGS, "drop"))
    + " FROM telemetry_lineitem) WHERE "
    + " AND ".join(f"{n} IS NOT NULL" for n in windows.feature_columns(CH, WINDOWS, ["mean", "std"], LAGS))
)


@register("p5_w_pipeline_features_dropna", PIPE_SQL)
def q_pipe(spark, sf_dir):
    t = tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle", *CH)
    return present(windows.add_features(t, CH, WINDOWS, ["mean", "std"], LAGS, True, "drop", split_rows=windows.SPLIT_ROWS).drop(*CH))


# Sequences of 50 cycles; the arrays are built, the oracle checks derived scalars.
SEQ_L = 50


@register(
    "w7_sequences",
    with_(TELEMETRY_LINEITEM)
    + f"""SELECT unit_id, end_cycle, RUL, CAST(len(seq) AS INTEGER) AS seq_len,
       {r('seq[1][1]')} AS first_qty, {r('seq[len(seq)][2]')} AS last_price,
       {r('list_sum(list_transform(seq, lambda x: x[1]))')} AS sum_qty,
       {r('list_sum(list_transform(seq, lambda x: x[4]))', 4)} AS sum_tax
FROM (SELECT unit_id, time_cycle AS end_cycle,
        CAST(least(max(time_cycle) OVER (PARTITION BY unit_id) - time_cycle, 125) AS INTEGER) AS RUL,
        list([l_quantity, l_extendedprice, l_discount, l_tax]) OVER w AS seq,
        count(*) OVER w AS n
      FROM telemetry_lineitem
      WINDOW w AS (PARTITION BY unit_id ORDER BY time_cycle ROWS BETWEEN {SEQ_L - 1} PRECEDING AND CURRENT ROW))
WHERE n = {SEQ_L}""",
)
def q_w7(spark, sf_dir):
    t = labels.add_rul(tables.telemetry_lineitem(spark, sf_dir, skew_safe=True).drop("l_shipdate"), method="join")
    s = windows.add_sequences(t, CH, SEQ_L, target="RUL", split_rows=windows.SPLIT_ROWS)
    seq = F.col("seq")
    return s.select(
        "unit_id",
        "end_cycle",
        "RUL",
        F.size(seq).alias("seq_len"),
        F.round(seq[0][0], 6).alias("first_qty"),
        F.round(F.element_at(seq, -1)[1], 6).alias("last_price"),
        F.round(F.aggregate(seq, F.lit(0.0), lambda a, x: a + x[0]), 6).alias("sum_qty"),
        F.round(F.aggregate(seq, F.lit(0.0), lambda a, x: a + x[3]), 4).alias("sum_tax"),
    )


def _serve_sql() -> str:
    c = "value"
    parts = []
    n = "least(row_number() OVER (PARTITION BY unit_id ORDER BY time_cycle), 51)"
    for w in WINDOWS:
        m = f"avg({c}) {_frame(w)}"
        s = f"coalesce(stddev_samp({c}) {_frame(w)}, 0)"
        parts.append(f"{r(f'CASE WHEN {n} >= 20 THEN {m} ELSE 0 END')} AS {rolling_name(c, 'mean', w)}")
        parts.append(f"{r(f'CASE WHEN {n} >= 20 THEN {s} ELSE 0 END')} AS {rolling_name(c, 'std', w)}")
    for k in LAGS:
        lg = f"coalesce(lag({c}, {k}) {_plain()}, 0)"
        parts.append(f"{r(f'CASE WHEN {n} >= 10 THEN {lg} ELSE 0 END')} AS {lag_name(c, k)}")
    parts.append(f"{r(f'coalesce({c} - lag({c}, 1) {_plain()}, 0)')} AS {delta_name(c)}")
    return (
        with_(TELEMETRY_EVENTS)
        + f"SELECT * EXCLUDE (rn_desc) FROM (SELECT unit_id, time_cycle, {r(c)} AS {c}, "
        + ", ".join(parts)
        + ", row_number() OVER (PARTITION BY unit_id ORDER BY time_cycle DESC) AS rn_desc FROM telemetry_events) "
        "WHERE rn_desc = 1"
    )


@register("w9_serving_features", _serve_sql())
def q_w9(spark, sf_dir):
    t = tables.telemetry_events(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle", "value")
    return present(windows.serving_features(t, ["value"], windows=WINDOWS, lags=LAGS))


@register(
    "p9_head_per_unit",
    with_(TELEMETRY_EVENTS)
    + "SELECT unit_id, time_cycle, value FROM telemetry_events WHERE time_cycle <= 15",
)
def q_p9(spark, sf_dir):
    from ..operators import profiling as profile

    t = tables.telemetry_events(spark, sf_dir, skew_safe=True).select("unit_id", "time_cycle", "value")
    return profile.head_per_unit(t, 15)
