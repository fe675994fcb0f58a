"""Monitoring queries over a prediction-log fact table.

Fact table: (ts, model_type, status, latency_s, unit_id, rul).  Rates are exact
event counts / window seconds (no scrape, no counter reset, no extrapolation).

Sliding windows are built from tumbling SLOTS: raw rows are first counted per
(labels, slot[, latency bucket]) with map-side partial aggregation, and only
those aggregated rows are fanned out to the ``width / slide`` windows they belong
to.  Spark's ``window(ts, width, slide)`` would instead expand every raw row
``width / slide`` times before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_small

# Latency histogram upper bounds in seconds (+Inf appended).
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
# RUL alert levels.
RUL_CRITICAL = 10
RUL_WARNING = 25
RUL_SUMMARY_CRITICAL = 25
# Error-ratio, SLO and scaling thresholds.
ERROR_RATIO_WARNING = 0.05
ERROR_RATIO_CRITICAL = 0.10
LATENCY_SLO_SECONDS = 0.5
LATENCY_SLO_SHARE = 0.99
AVAILABILITY_SLO = 0.999
SCALE_RATE = 100.0
SCALE_LATENCY = 0.3
SCALE_LATENCY_RATE = 50.0
UTILISATION_LIMIT = 0.9


def epoch_s(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)


def slot_of(ts: Column, slide_s: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(slide_s * 1_000_000)).cast("long")


def counters(df: DataFrame, labels: Sequence[str] = ("model_type", "status")) -> DataFrame:
    """O1: labelled counters."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("count"))


def latency_bucket(lat: str = "latency_s", bounds: Sequence[float] = LATENCY_BOUNDS) -> Column:
    """Index of the smallest bound >= latency (len(bounds) = +Inf)."""
    whens = " ".join(f"WHEN `{lat}` <= {float(b)!r}D THEN {i}" for i, b in enumerate(bounds))
    return F.expr(f"CASE {whens} ELSE {len(bounds)} END")


def with_le_grid(keys: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Every key row fanned out to the len(bounds) + 1 buckets (fixed, small),
    with the bucket's upper bound ``le`` (+Inf last).  An explode, not a join."""
    les = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    g = keys.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(len(bounds)))))
    return g.withColumn("le", F.element_at(les, F.col("bucket") + 1))


def latency_histogram(df: DataFrame, labels: Sequence[str] = ("model_type",), bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """O2: cumulative ``le`` buckets (+Inf) with count and sum per label set,
    cumulated ONCE (rows counted per bucket, then a running sum over 12 buckets)."""
    b = df.select(*labels, latency_bucket("latency_s", bounds).alias("bucket"), "latency_s")
    per = b.groupBy(*labels, "bucket").agg(F.count(F.lit(1)).alias("n"))
    tot = b.groupBy(*labels).agg(F.count(F.lit(1)).alias("count"), F.sum("latency_s").alias("sum"))
    keys = tot.select(*labels)
    grid = with_le_grid(keys, bounds)
    g = join_small(grid, per, on=[*labels, "bucket"], how="left", known_small=False).na.fill(0, ["n"])
    w = Window.partitionBy(*labels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("cum", F.sum("n").over(w).cast("bigint"))
    return join_small(g, tot, on=list(labels), known_small=False).select(*labels, "bucket", "le", "cum", "count", "sum")


def latest(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Last value per label set (max_by over the ordering struct)."""
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*[F.col(o) for o in order])).alias(value))


def batch_latency(df: DataFrame, batch_keys: Sequence[str]) -> DataFrame:
    """Per-sample latency = batch latency / max(n, 1)."""
    return df.groupBy(*batch_keys).agg(F.sum("latency_s").alias("batch_latency"), F.count(F.lit(1)).alias("n")).withColumn(
        "per_sample_latency", F.col("batch_latency") / F.greatest(F.col("n"), F.lit(1))
    )


def rul_severity(rul: Column) -> Column:
    """< 10 critical, < 25 warning, else ok."""
    return F.when(rul < RUL_CRITICAL, F.lit("critical")).when(rul < RUL_WARNING, F.lit("warning")).otherwise(F.lit("ok"))


def sliding_counts(
    df: DataFrame,
    labels: Sequence[str],
    width_s: int = 300,
    slide_s: int = 30,
    extra_keys: Sequence[str] = (),
    sums: Sequence[str] = (),
    conds: dict[str, Column] | None = None,
) -> DataFrame:
    """Counts (and sums, conditional counts) per (labels, sliding window).

    Output: labels, extra keys, ``window_start`` (timestamp), ``n`` and the
    requested aggregates.  Windows are [start, start + width) with starts at
    multiples of ``slide`` (Spark's window alignment), only windows with rows.
    """
    if width_s % slide_s:
        raise ValueError("width must be a multiple of slide")
    k = width_s // slide_s
    conds = conds or {}
    slot = slot_of(F.col("ts"), slide_s)
    extra = list(extra_keys)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(s).alias(f"sum_{s}") for s in sums] + [F.count_if(c).alias(nm) for nm, c in conds.items()]
    per_slot = df.groupBy(*labels, *extra, slot.alias("_slot")).agg(*aggs)
    fan = per_slot.withColumn("_start", F.explode(F.sequence(F.col("_slot") - F.lit(k - 1), F.col("_slot"))))
    keys = [*labels, *extra]
    out_aggs = [F.sum("n").alias("n")] + [F.sum(f"sum_{s}").alias(f"sum_{s}") for s in sums] + [F.sum(nm).alias(nm) for nm in conds]
    w = fan.groupBy(*keys, "_start").agg(*out_aggs)
    return w.withColumn("window_start", F.timestamp_seconds(F.col("_start") * F.lit(slide_s)).cast("timestamp_ntz")).drop("_start")


def rates(df: DataFrame, labels: Sequence[str] = ("model_type", "status"), width_s: int = 300, slide_s: int = 30) -> DataFrame:
    """Events per second over sliding windows."""
    c = sliding_counts(df, labels, width_s, slide_s)
    return c.withColumn("rate", F.col("n") / F.lit(float(width_s)))


def error_ratio(df: DataFrame, labels: Sequence[str] = ("model_type",), width_s: int = 300, slide_s: int = 30) -> DataFrame:
    """Errors / total per window (J3 as one conditional aggregate), level."""
    c = sliding_counts(df, labels, width_s, slide_s, conds={"errors": F.col("status") == "error"})
    ratio = F.try_divide(F.col("errors"), F.col("n"))
    lvl = F.when(ratio > ERROR_RATIO_CRITICAL, "critical").when(ratio > ERROR_RATIO_WARNING, "warning").otherwise("ok")
    return c.withColumn("error_ratio", ratio).withColumn("level", lvl)


def histogram_quantiles(
    df: DataFrame,
    labels: Sequence[str] = ("model_type",),
    qs: Sequence[float] = (0.5, 0.95, 0.99),
    width_s: int = 300,
    slide_s: int = 30,
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """histogram_quantile per window: rank = q * total; first bucket whose
    cumulative count >= rank; linear interpolation between the previous bound
    (0 for the first) and its bound; the +Inf bucket returns the largest finite bound.

    The bucket counts of a window are columns of ONE aggregate (count per slot
    and bucket, fanned out to the windows, summed), so cumulating and
    interpolating over the 12 buckets are plain expressions: two shuffles in all.
    """
    nb = len(bounds) + 1
    b = df.withColumn("_bucket", latency_bucket("latency_s", bounds))
    c = sliding_counts(b, labels, width_s, slide_s, conds={f"_c{i}": F.col("_bucket") == i for i in range(nb)})
    cum = [" + ".join(f"_c{j}" for j in range(i + 1)) for i in range(nb)]
    c = c.select(*labels, "window_start", *[F.expr(f"{x} AS _cum{i}") for i, x in enumerate(cum)])
    les = [float(x) for x in bounds]
    total = f"_cum{nb - 1}"
    cols = [*labels, "window_start", F.col(total).cast("bigint").alias("total")]
    for q in qs:
        rank = f"({q!r}D * {total})"
        whens = []
        for i in range(nb):
            if i == nb - 1:
                val = f"{les[-1]!r}D"
            else:
                prev_cum = f"_cum{i - 1}" if i > 0 else "0"
                prev_le = f"{les[i - 1]!r}D" if i > 0 else "0D"
                val = f"{prev_le} + ({les[i]!r}D - {prev_le}) * (({rank} - {prev_cum}) / (_cum{i} - {prev_cum}))"
            whens.append(f"WHEN _cum{i} >= {rank} THEN {val}")
        cols.append(F.expr(f"CASE WHEN {total} = 0 THEN NULL {' '.join(whens)} END AS p{int(round(q * 100))}"))
    return c.select(*cols)


def alert_episodes(evals: DataFrame, keys: Sequence[str], ts: str, cond: str, hold_s: int | str, step_s: int) -> DataFrame:
    """Threshold alerts with hold time as gaps-and-islands over an
    evaluation grid.  ``evals``: one row per (keys, ts) evaluation on a
    ``step_s`` grid with a boolean ``cond``; consecutive true evaluations form an
    island; it fires once ts - island start >= hold.

    Skew-safe: an island starts where the evaluation one step earlier is not
    true (an equi anti join on (keys, ts - step)); the island start of every
    true evaluation is a running max of starts (``scan.running`` over ranges), so no
    label set is ever ordered in one task.

    ``hold_s``: seconds, or the name of a per-row hold column (rules table).

    Output per island: keys, started_at, ended_at, evaluations, fired_at (null if
    it never fired), firing_evaluations.
    """
    from .scan import running

    hold = F.col(hold_s) if isinstance(hold_s, str) else F.lit(hold_s)
    if isinstance(hold_s, str):
        keys = [*keys, hold_s]  # the hold is a property of the rule, constant per key

    sec = (F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1_000_000)).cast("long")
    t = evals.filter(F.col(cond)).select(*keys, F.col(ts), sec.alias("_sec"))
    prev = t.select(*keys, (F.col("_sec") + F.lit(step_s)).alias("_sec"))
    starts = t.join(prev, [*keys, "_sec"], "left_anti").select(*keys, "_sec", F.col("_sec").alias("_start"))
    marked = t.join(starts, [*keys, "_sec"], "left")
    r = running(marked, keys, ["_sec"], maxs=["_start"], pos=None)
    firing = (F.col("_sec") - F.col("max__start")) >= hold
    return r.groupBy(*keys, "max__start").agg(
        F.min(ts).alias("started_at"),
        F.max(ts).alias("ended_at"),
        F.count(F.lit(1)).alias("evaluations"),
        F.min(F.when(firing, F.col(ts))).alias("fired_at"),
        F.count_if(firing).alias("firing_evaluations"),
    ).drop("max__start")


# Alert rules (name, metric, comparison, threshold, hold seconds).
ALERT_RULES = [
    ("HighPredictionLatency", "latency_p95", ">", 1.0, 300),
    ("CriticalPredictionLatency", "latency_p99", ">", 2.0, 120),
    ("HighPredictionErrorRate", "error_ratio", ">", 0.05, 300),
    ("CriticalPredictionErrorRate", "error_ratio", ">", 0.10, 120),
]


def rules_table(spark, rules=ALERT_RULES) -> DataFrame:
    return spark.createDataFrame(rules, "rule string, metric string, op string, threshold double, hold_s int")


def monitoring_metrics(log: DataFrame, labels: Sequence[str] = ("model_type",)) -> DataFrame:
    """Long metric series per (labels, window_start): error_ratio, latency_p95,
    latency_p99 over sliding 5-minute windows (the rule evaluator's input)."""
    er = error_ratio(log, labels).select(*labels, "window_start", F.lit("error_ratio").alias("metric"), F.col("error_ratio").alias("value"))
    hq = histogram_quantiles(log, labels, (0.95, 0.99))
    p95 = hq.select(*labels, "window_start", F.lit("latency_p95").alias("metric"), F.col("p95").alias("value"))
    p99 = hq.select(*labels, "window_start", F.lit("latency_p99").alias("metric"), F.col("p99").alias("value"))
    return er.unionByName(p95).unionByName(p99).filter(F.col("value").isNotNull())


def evaluate_rules(metrics: DataFrame, rules: DataFrame, labels: Sequence[str] = ("model_type",), step_s: int = 30) -> DataFrame:
    """O11 with the rules as rows of a table: join each metric sample to its rules
    (the rule table is small by construction: broadcast), evaluate the
    comparison, then held-alert islands per (rule, labels)."""
    j = metrics.join(F.broadcast(rules), "metric")
    cond = (
        F.when(F.col("op") == ">", F.col("value") > F.col("threshold"))
        .when(F.col("op") == "<", F.col("value") < F.col("threshold"))
        .otherwise(F.col("value") == F.col("threshold"))
    )
    ev = j.withColumn("cond", cond)
    return alert_episodes(ev, ["rule", *labels], "window_start", "cond", "hold_s", step_s)


def evaluation_grid(df: DataFrame, labels: Sequence[str], slide_s: int = 30, width_s: int = 300) -> DataFrame:
    """Every evaluation instant (window start) from a label set's first window to the
    end of the log, including empty ones (O12: a label set that stops stays silent).
    Generated day by day (two explodes), so no single row fans out to the whole span."""
    slot = slot_of(F.col("ts"), slide_s)
    k = width_s // slide_s
    per_day = 86400 // slide_s
    end = df.agg(F.max(slot)).first()[0]  # one number: the log ends for all label sets at once
    span = df.groupBy(*labels).agg((F.min(slot) - F.lit(k - 1)).alias("_lo"), F.lit(end).cast("long").alias("_hi"))
    days = span.select(*labels, "_lo", "_hi", F.explode(F.sequence(F.floor(F.col("_lo") / per_day), F.floor(F.col("_hi") / per_day))).alias("_d"))
    days = days.repartition(*labels, "_d")
    lo = F.greatest(F.col("_lo"), F.col("_d") * per_day)
    hi = F.least(F.col("_hi"), F.col("_d") * per_day + per_day - 1)
    g = days.select(*labels, F.explode(F.sequence(lo, hi)).alias("_start"))
    return g.withColumn("window_start", F.timestamp_seconds(F.col("_start") * F.lit(slide_s)).cast("timestamp_ntz")).drop("_start")


def ratios_of_one(df: DataFrame, keys: Sequence[str], ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """J3 / O19 where both sides are columns of one table: out -> (value, limit), all as one aggregate.

    Nothing is joined; a label set without a limit (null or zero in sum) has a null ratio."""
    return df.groupBy(*keys).agg(*[F.try_divide(F.sum(v), F.sum(limit)).alias(out) for out, (v, limit) in ratios.items()])


def ratio_by_labels(a: DataFrame, b: DataFrame, keys: Sequence[str], a_val: str, b_val: str, out: str = "ratio") -> DataFrame:
    """Sum by(keys) A / sum by(keys) B, matched on the label set."""
    sa = a.groupBy(*keys).agg(F.sum(a_val).alias("_a"))
    sb = b.groupBy(*keys).agg(F.sum(b_val).alias("_b"))
    return sa.join(sb, list(keys)).select(*keys, F.try_divide(F.col("_a"), F.col("_b")).alias(out))
