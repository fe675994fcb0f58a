"""Per-unit time-series features: rolling stats, lags, deltas, sequences.

Every feature of one recipe is computed over ONE window partitioning and order
(unit, cycle), so Catalyst plans one ``Exchange hashpartitioning(unit_id)`` and
one ``Sort`` for all of them; the stacked longer windows add window operators
over the already partitioned and sorted rows, never another exchange or sort.

Scale: a hot unit (a third of all rows in one key) would put one trajectory in
one task.  ``split_rows`` cuts every trajectory into chunks of ``split_rows``
cycles and copies the last ``halo`` rows of each chunk into the next chunk
("halo rows").  All frames are bounded ROWS frames, so each original row sees
exactly the rows it would have seen in the whole trajectory; halo copies are
dropped afterwards.  The result is identical, the largest task is bounded by
``split_rows + halo`` rows, and the only cost is ``halo/split_rows`` extra rows.
Requires the contract ``time_cycle`` = 1..n dense per unit (checked by S8).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LIBRARY_LAGS, LIBRARY_WINDOWS, delta_name, lag_name, rolling_name
from ..session import short_methods

ROLLING_STATS = ("mean", "std", "min", "max")
NULL_POLICIES = ("fill", "drop", "serve")
SPLIT_ROWS = 65_536  # cycles of a unit that one task takes, besides the halo


def unit_window(unit: str = "unit_id", order: str = "time_cycle", extra_keys: Sequence[str] = ()):
    return Window.partitionBy(unit, *extra_keys).orderBy(order)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _over(unit: str, order: str, extra_keys: Sequence[str] = (), w: int | None = None) -> str:
    part = ", ".join(_q(k) for k in [unit, *extra_keys])
    frame = f" ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW" if w else ""
    return f"OVER (PARTITION BY {part} ORDER BY {_q(order)}{frame})"


def _rolling_sql(c: str, stat: str, w: int, over: str, null_policy: str) -> str:
    if stat == "mean":
        return f"avg({_q(c)}) {over}"
    if stat == "std":
        e = f"stddev_samp({_q(c)}) {over}"
        # one row in the frame: sample std is undefined -> 0 (fill / serve) or null (drop)
        return e if null_policy == "drop" else f"coalesce({e}, 0D)"
    if stat in ("min", "max"):
        return f"{stat}({_q(c)}) {over}"
    raise ValueError(f"unknown rolling stat {stat!r}")


def _lag_sql(c: str, k: int, over: str, null_policy: str) -> str:
    e = f"lag({_q(c)}, {k}) {over}"
    if null_policy == "fill":
        return f"coalesce({e}, {_q(c)})"
    if null_policy == "serve":
        return f"coalesce({e}, 0D)"
    return e


def _delta_sql(c: str, over: str, null_policy: str) -> str:
    e = f"{_q(c)} - lag({_q(c)}, 1) {over}"
    return e if null_policy == "drop" else f"coalesce({e}, 0D)"


def feature_columns(
    channels: Sequence[str],
    windows: Sequence[int] = LIBRARY_WINDOWS,
    stats: Sequence[str] = ROLLING_STATS,
    lags: Sequence[int] = LIBRARY_LAGS,
    delta: bool = True,
) -> list[str]:
    """Names of the derived columns, in output order (naming contract)."""
    names = [rolling_name(c, s, w) for w in windows for c in channels for s in stats]
    names += [lag_name(c, k) for k in lags for c in channels]
    if delta:
        names += [delta_name(c) for c in channels]
    return names


def feature_exprs(
    channels: Sequence[str],
    windows: Sequence[int] = LIBRARY_WINDOWS,
    stats: Sequence[str] = ROLLING_STATS,
    lags: Sequence[int] = LIBRARY_LAGS,
    delta: bool = True,
    null_policy: str = "fill",
    unit: str = "unit_id",
    order: str = "time_cycle",
    extra_keys: Sequence[str] = (),
) -> list[Column]:
    """The window expressions, written as SQL text (one JVM call per column
    instead of one per operator node; the plan is the same)."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    plain = _over(unit, order, extra_keys)
    out = []
    for w in windows:
        over = _over(unit, order, extra_keys, w)
        for c in channels:
            for s_ in stats:
                out.append(F.expr(f"{_rolling_sql(c, s_, w, over, null_policy)} AS {_q(rolling_name(c, s_, w))}"))
    for k in lags:
        for c in channels:
            out.append(F.expr(f"{_lag_sql(c, k, plain, null_policy)} AS {_q(lag_name(c, k))}"))
    if delta:
        for c in channels:
            out.append(F.expr(f"{_delta_sql(c, plain, null_policy)} AS {_q(delta_name(c))}"))
    return out


def stackable(windows: Sequence[int]) -> bool:
    """True when the sorted windows form a chain where each is a multiple of the previous."""
    ws = sorted(windows)
    return len(ws) > 1 and all(b % a == 0 for a, b in zip(ws, ws[1:]))


def _stacked_stages(channels, windows, stats, unit, order, extra_keys):
    """Rolling mean / min / max of the longer windows built from the shorter one
    instead of from their own sliding frames.

    A sliding frame is re-aggregated for every row (cost ~ width); here only the
    smallest window is a frame, and a window of k times that width is the
    combination of k consecutive blocks taken with ``lag`` (cost ~ k):
    min = least of block minima, max = greatest of block maxima, mean = sum of
    block sums / sum of block counts.  ``least`` / ``greatest`` skip the missing
    blocks before the trajectory start, so the ``min_periods=1`` semantics hold
    exactly; means differ from a single frame sum only by float association.
    Returns a list of stages, each a list of SQL select items (intermediate
    columns are prefixed ``__``).
    """
    ws = sorted(windows)
    plain = _over(unit, order, extra_keys)
    first = _over(unit, order, extra_keys, ws[0])
    stages = [[]]
    for c in channels:
        q = _q(c)
        stages[0] += [f"sum({q}) {first} AS `__{c}__s{ws[0]}`", f"count({q}) {first} AS `__{c}__n{ws[0]}`",
                      f"min({q}) {first} AS `__{c}__mn{ws[0]}`", f"max({q}) {first} AS `__{c}__mx{ws[0]}`"]
    for a, b in zip(ws, ws[1:]):
        k = b // a
        items = []
        for c in channels:
            blocks = lambda n: [f"`__{c}__{n}{a}`"] + [f"lag(`__{c}__{n}{a}`, {a * j}) {plain}" for j in range(1, k)]
            items += [
                " + ".join([f"coalesce({x}, 0D)" for x in blocks("s")]) + f" AS `__{c}__s{b}`",
                " + ".join([f"coalesce({x}, 0L)" for x in blocks("n")]) + f" AS `__{c}__n{b}`",
                f"least({', '.join(blocks('mn'))}) AS `__{c}__mn{b}`",
                f"greatest({', '.join(blocks('mx'))}) AS `__{c}__mx{b}`",
            ]
        stages.append(items)
    return stages


def _halo_chunks(df: DataFrame, order: str, split_rows: int, halo: int) -> DataFrame:
    if halo > split_rows:
        raise ValueError("halo must not exceed split_rows")
    pos = F.col(order) - F.lit(1)
    chunk = F.floor(pos / F.lit(split_rows)).cast("long")
    own = df.withColumn("_chunk", chunk).withColumn("_halo", F.lit(False))
    if halo == 0:
        return own
    copies = (
        df.filter(F.pmod(pos, F.lit(split_rows)) >= F.lit(split_rows - halo))
        .withColumn("_chunk", chunk + F.lit(1))
        .withColumn("_halo", F.lit(True))
    )
    return own.unionByName(copies)


def unit_chunks(df: DataFrame, split_rows: int, halo: int, unit: str = "unit_id", order: str = "time_cycle") -> DataFrame:
    """The rows with halo copies, dealt by (unit, chunk), and the unit's last cycle on each, ``_last``.

    Two passes: a maximum for every (unit, chunk) by a partial aggregate, then, over these few rows, the
    maximum over the chunks of the unit, joined back on (unit, chunk).  So the label needs no window over
    a whole unit, and rows, halo and last cycle meet in one partitioning."""
    chunk = F.floor((F.col(order) - F.lit(1)) / F.lit(split_rows)).cast("long").alias("_chunk")
    ends = df.groupBy(unit, chunk).agg(F.max(order).alias("_end"))
    lasts = ends.select(unit, "_chunk", F.max("_end").over(Window.partitionBy(unit)).alias("_last"))
    dealt = _halo_chunks(df, order, split_rows, halo).repartition(unit, "_chunk")
    return dealt.join(lasts, [unit, "_chunk"])  # halo copies beyond the last chunk have no partner and go


def add_features(
    df: DataFrame,
    channels: Sequence[str],
    windows: Sequence[int] = LIBRARY_WINDOWS,
    stats: Sequence[str] = ROLLING_STATS,
    lags: Sequence[int] = LIBRARY_LAGS,
    delta: bool = True,
    null_policy: str = "fill",
    unit: str = "unit_id",
    order: str = "time_cycle",
    split_rows: int | None = None,
    extra: Sequence[Column] = (),
    stack: bool = True,
    rul: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """All rolling / lag / delta features in one projection.

    ``null_policy``: ``fill`` (library: std 1 row -> 0, lag -> current value,
    first delta -> 0), ``drop`` (pipeline: leave nulls, then drop the rows),
    ``serve`` (serving: lag -> 0, delta -> 0, std -> 0).
    ``extra``: more window expressions over the same spec (e.g. the RUL label).
    ``split_rows``: None (one window partition per unit) or an int (halo chunks of
    that many cycles).  ``rul``: with ``split_rows``, the label as a function of the unit's
    last cycle and the row's (``labels.rul_of``); without, pass ``labels.rul_expr`` in ``extra``.
    ``stack``: when the windows form a multiple chain (5, 10, 20), longer-window
    mean / min / max are combined from the shortest window's blocks
    (``_stacked_stages``): same partitioning and order, no extra exchange or sort.
    """
    halo = max([w - 1 for w in windows] + list(lags) + [1 if delta else 0] + [0])
    short_methods(df.sparkSession)
    if split_rows:
        # dealt by (unit, chunk) even where the input is already dealt by unit
        base = _halo_chunks(df, order, split_rows, halo).repartition(unit, "_chunk") if rul is None else unit_chunks(df, split_rows, halo, unit, order)
        keys = ["_chunk"]
    else:
        base = df
        keys = []
    extra_cols = [*extra, *([rul(F.col("_last"), F.col(order))] if rul is not None and split_rows else [])]
    keep = [c for c in df.columns]
    halo_col = ["_halo"] if split_rows else []
    stacked = stack and stackable(windows) and any(st in ("mean", "min", "max") for st in stats)
    if not stacked:
        exprs = feature_exprs(channels, windows, stats, lags, delta, null_policy, unit, order, keys)
        out = base.select(*[F.col(c) for c in keep], *extra_cols, *exprs, *halo_col)
    else:
        # std / lags / deltas as before; mean / min / max of longer windows stacked from the shortest
        exprs = feature_exprs(channels, windows, [st for st in stats if st == "std"], lags, delta, null_policy, unit, order, keys)
        stages = _stacked_stages(channels, windows, stats, unit, order, keys)
        out = base.select(*[F.col(c) for c in keep], *extra_cols, *exprs, *[F.expr(x) for x in stages[0]], *halo_col, *[F.col(k) for k in keys])
        for st in stages[1:]:
            out = out.select("*", *[F.expr(x) for x in st])
        final = {}
        for w in windows:
            for c in channels:
                final[rolling_name(c, "mean", w)] = F.expr(f"`__{c}__s{w}` / nullif(`__{c}__n{w}`, 0)")
                final[rolling_name(c, "min", w)] = F.col(f"__{c}__mn{w}")
                final[rolling_name(c, "max", w)] = F.col(f"__{c}__mx{w}")
        names = feature_columns(channels, windows, stats, lags, delta)
        lead = [F.col(c) for c in keep]
        extra_names = [n for n in out.columns if n not in set(keep) | set(names) | set(halo_col) | set(keys) and not n.startswith("__")]
        out = out.select(*lead, *[F.col(n) for n in extra_names],
                         *[final[n].alias(n) if n in final else F.col(n) for n in names], *halo_col)
    if split_rows:
        out = out.filter(~F.col("_halo")).drop("_halo")
    if null_policy == "drop":
        out = out.na.drop(subset=feature_columns(channels, windows, stats, lags, delta))
    return out


def rows_before(df: DataFrame, picked: DataFrame, back: int, unit: str = "unit_id", order: str = "time_cycle") -> DataFrame:
    """The rows of ``df`` at the (unit, cycle) pairs of ``picked`` and the ``back`` cycles before each.

    What bounded frames give a picked row over these rows is what they give over all (cycles 1..n dense);
    the other rows only serve as the frames' past."""
    span = F.sequence(F.greatest(F.col(order) - F.lit(back), F.lit(1)), F.col(order))
    wanted = picked.select(unit, F.explode(span).alias(order)).distinct()
    return df.join(wanted, [unit, order], "left_semi")


def add_sequences(
    df: DataFrame,
    channels: Sequence[str],
    length: int = 50,
    target: str | None = "RUL",
    unit: str = "unit_id",
    order: str = "time_cycle",
    split_rows: int | None = None,
    dtype: str = "double",
) -> DataFrame:
    """One row per run of ``length`` consecutive cycles within a unit.

    ``seq`` is ``array<array<dtype>>`` (time-major, channels in given order),
    target = the last row's target.  Units shorter than ``length`` give no rows.
    Sequences never cross unit boundaries.  The output is ``length`` times the
    input: pass only the channels needed and ``dtype="float"`` to halve it.
    """
    if split_rows:
        base = _halo_chunks(df, order, split_rows, length - 1).repartition(unit, "_chunk")
        spec = unit_window(unit, order, extra_keys=["_chunk"])
    else:
        base = df
        spec = unit_window(unit, order)
    frame = spec.rowsBetween(-(length - 1), Window.currentRow)
    vec = F.array(*[F.col(c).cast(dtype) for c in channels])
    cols = [
        F.col(unit),
        F.col(order).alias("end_cycle"),
        F.collect_list(vec).over(frame).alias("seq"),
        F.count(F.lit(1)).over(frame).alias("_n"),
    ]
    if target:
        cols.append(F.col(target))
    if split_rows:
        cols.append(F.col("_halo"))
    out = base.select(*cols).filter(F.col("_n") == length).drop("_n")
    if split_rows:
        out = out.filter(~F.col("_halo")).drop("_halo")
    return out


def serving_features(
    df: DataFrame,
    channels: Sequence[str],
    history: int = 50,
    rolling_gate: int = 20,
    lag_gate: int = 10,
    windows: Sequence[int] = (5, 10, 20),
    lags: Sequence[int] = (1, 5, 10),
    unit: str = "unit_id",
    order: str = "time_cycle",
    last_only: bool = True,
    split_rows: int = SPLIT_ROWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Request-time features from the current row plus up to ``history`` previous rows.

    Rolling mean / std need at least ``rolling_gate`` rows of history, lags at
    least ``lag_gate``, else 0.  Lag before start -> 0, first delta -> 0, nulls -> 0.
    With ``last_only`` only the latest row per unit is returned.  Rows are dealt by (unit, chunk of
    ``split_rows`` cycles) with halo copies; a unit's cycles are 1, 2, .. or end so.  ``keep``: columns that go along.
    """
    halo = max([w - 1 for w in windows] + list(lags) + [1])
    short_methods(df.sparkSession)
    spec = unit_window(unit, order, ["_chunk"])
    n_hist = F.least(F.col(order), F.lit(history + 1))
    cols = [F.col(unit), F.col(order), *[F.col(c) for c in channels]]
    for w in windows:
        for c in channels:
            frame = spec.rowsBetween(-(w - 1), Window.currentRow)
            m = F.avg(c).over(frame)
            s = F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0))
            cols.append(F.when(n_hist >= rolling_gate, m).otherwise(F.lit(0.0)).alias(rolling_name(c, "mean", w)))
            cols.append(F.when(n_hist >= rolling_gate, s).otherwise(F.lit(0.0)).alias(rolling_name(c, "std", w)))
    for k in lags:
        for c in channels:
            lagged = F.coalesce(F.lag(c, k).over(spec), F.lit(0.0))
            cols.append(F.when(n_hist >= lag_gate, lagged).otherwise(F.lit(0.0)).alias(lag_name(c, k)))
    for c in channels:
        cols.append(F.coalesce(F.col(c) - F.lag(c, 1).over(spec), F.lit(0.0)).alias(delta_name(c)))
    out = unit_chunks(df, split_rows, halo, unit, order).select(*cols, *keep, "_halo", "_last").filter(~F.col("_halo"))
    if last_only:
        out = out.filter(F.col(order) == F.col("_last"))
    return out.drop("_halo", "_last").na.fill(0.0)


def dense_cycles(df: DataFrame, unit: str, order: Sequence[str], out: str = "time_cycle") -> DataFrame:
    """Number each unit's rows 1..n along ``order`` without putting a unit in one
    task: positions come from ``scan.running`` over ranges of (unit, order).  Written
    once, as what follows reads the rows several times (chunks, halo copies, last cycles)."""
    from ..session import cut_lineage
    from .scan import running

    return cut_lineage(running(df, [unit], order, pos=out).withColumn(out, F.col(out).cast("int")))


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """Rank by a score and keep k rows (TakeOrderedAndProject, no full sort)."""
    key = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(key, *[F.col(t).asc() for t in tie]).limit(k)
