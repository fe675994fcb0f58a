"""Operator 2: mix sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash of its id.  Sizes are summed by (source, leading hash bits);
the bucket in which a source's budget ends is found from the running sum, and only that bucket
is refined by its next bits, until one hash value is left.  The documents below a source's
threshold are taken by a plain filter: nothing is ever sorted by hash.

Results for odd input: a null or empty text has size 0 and takes no word; a null source is a
source of its own, ordered last; rows that repeat an id share its hash and are taken together;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_COPIES = 2
HASH_BITS = 60
LEVEL_BITS = 12


def id_hash(id_col: str) -> Column:
    """The leading 60 bits of md5(id as text); a null id has hash 0."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def targets(sizes: list[int], weights: list[float], budget: float = BUDGET, cap: float = MAX_COPIES) -> list[float]:
    """Shares of ``budget`` x the total by weight, none above ``cap`` x its size.

    A source whose share at the common rate is above its cap stops there; the rest share what is
    left.  Sources reach their caps in the order of cap / weight."""
    left, weight = budget * sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (cap * sizes[i] / weights[i], i)):
        share = left * weights[i] / weight
        if share <= cap * sizes[i]:
            rate = (left, weight)
            for j in range(len(sizes)):
                if cap * sizes[j] / weights[j] >= cap * sizes[i] / weights[i]:
                    out[j] = min(cap * sizes[j], rate[0] * weights[j] / rate[1])
            break
        out[i] = float(cap * sizes[i])
        left, weight = left - cap * sizes[i], weight - weights[i]
    return out


def _thresholds(rows: DataFrame, need: dict[str, float]) -> dict[str, int]:
    """For each source key the last hash value taken, so that the words up to it come nearest to ``need``.

    One histogram per level; a level reads only rows in the open buckets of the level before."""
    spark = rows.sparkSession
    done = {k: -1 for k in need}
    open_ = {k: (0, 0.0) for k, v in need.items() if v > 0}  # source -> (hash prefix so far, words before it)
    for used in range(0, HASH_BITS, LEVEL_BITS):
        if not open_:
            break
        shift = HASH_BITS - used - LEVEL_BITS
        at = spark.createDataFrame([(k, p, b, need[k]) for k, (p, b) in open_.items()], "skey string, prefix long, before double, need double")
        inside = rows.join(at, "skey").filter(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        hist = inside.groupBy("skey", "before", "need", F.shiftright("h", shift).alias("b")).agg(
            F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        # bounded: a source has at most 2^LEVEL_BITS buckets in a level
        cum = F.expr("before + sum(words) over (partition by skey order by b)")
        edge = hist.withColumn("cum", cum).filter((F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("words") < F.col("need")))
        found = {r["skey"]: r for r in edge.collect()}  # one row per source
        for k in list(open_):
            r = found.get(k)
            if r is None:  # all that is left fits
                done[k] = 1 << HASH_BITS
                del open_[k]
                continue
            start = r["cum"] - r["words"]
            if r["lo"] == r["hi"]:
                closer = r["cum"] <= need[k] or r["cum"] - need[k] < need[k] - start
                done[k] = r["lo"] if closer else r["lo"] - 1
                del open_[k]
            else:
                open_[k] = (r["b"], start)
    return done


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """(id, size, source_size, target, copies, taken): one row per input row.

    The driver holds one row per source (name, size, target), never one per document."""
    rows = materialise(df.select(
        F.col(id_col).alias("id"),
        F.when(F.col(source_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source_col).cast("string"))).alias("skey"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        id_hash(id_col).alias("h"),
    ))
    found = {r["skey"]: int(r["n"]) for r in rows.groupBy("skey").agg(F.sum("size").alias("n")).collect()}
    keys = sorted(found, key=lambda k: (k == "", k))
    sizes = [found[k] for k in keys]
    goal = dict(zip(keys, targets(sizes, [weights[i % len(weights)] for i in range(len(keys))], budget) if keys else []))
    full = {k: next((c for c in range(MAX_COPIES, 0, -1) if found[k] and goal[k] >= c * found[k]), 0) for k in keys}
    last = _thresholds(rows, {k: goal[k] - full[k] * found[k] if full[k] < MAX_COPIES else 0.0 for k in keys})
    plan = df.sparkSession.createDataFrame(
        [(k, found[k], float(goal[k]), full[k], last[k]) for k in keys],
        T.StructType.fromDDL("skey string, source_size long, target double, full int, last long"))
    copies = F.col("full") + (F.col("h") <= F.col("last")).cast("int")
    return rows.join(plan, "skey").select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))
