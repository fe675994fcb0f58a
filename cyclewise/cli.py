"""Command line: ``python -m cyclewise.cli <command>`` (or through spark-submit).

* ``list``                      catalog query names
* ``run NAME --sf DIR --out P``  run one catalog query over the tables in DIR, write P
* ``train --data-dir D --dataset FD001 --out P``  text trajectories -> features ->
  forest + boosted -> best model and metrics under P
* ``drift --reference R --current C --out P``  wide Parquet tables -> per-feature
  drift and the summary as JSON under P

The session comes from the environment (spark-submit / cluster defaults); only
``--master`` is honoured for local use.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("cyclewise")
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if master and master.startswith("local"):
        from .session import ensure_checkpoint_dir

        ensure_checkpoint_dir(spark)
    return spark


def cmd_run(spark, a) -> int:
    from .plans import catalog

    q = catalog.queries()
    if a.name not in q:
        print(f"unknown query {a.name!r}", file=sys.stderr)
        return 2
    df = q[a.name](spark, a.sf)
    df.write.mode("overwrite").format(a.format).save(a.out)
    return 0


def cmd_train(spark, a) -> int:
    from .operators import evaluate, models, scaling
    from .schema import SENSOR_COLS
    from .session import cut_lineage
    from .sources import telemetry

    train, _, _ = telemetry.load_all(spark, a.data_dir, a.dataset)
    channels = [c for c in SENSOR_COLS if c in train.columns]
    pipe = scaling.TelemetryPipeline(scaling.PipelineSpec(channels=channels)).fit(train)
    feats = pipe.transform(train)
    cols = [c for c in pipe.scaler.features]
    # every fit and every boosting round reads this frame: written once, not planned again each time
    data = cut_lineage(models.assemble(models.split(feats, ["unit_id", "time_cycle"], share=a.val_share, by="unit"), cols).select("unit_id", "time_cycle", "RUL", "split", "features"))
    est = {"forest": models.forest(numTrees=a.trees, maxDepth=a.depth), "boosted": models.boosted(maxIter=a.trees, maxDepth=min(a.depth, 6))}
    results = models.train_many(est, data.filter("split = 'train'"), data.filter("split = 'val'"))
    table = models.results_frame(spark, results)
    best = evaluate.select_best(table.withColumn("error", F.col("error")), "rmse", model="model").first()
    winner = next(r for r in results if r.name == best["best_model"])
    pipe.save(f"{a.out}/pipeline")
    models.save_model(winner.model, f"{a.out}/best_model", {"type": winner.name, "metrics": winner.metrics, "features": cols})
    table.coalesce(1).write.mode("overwrite").json(f"{a.out}/metrics")
    print(json.dumps({"best_model": winner.name, "rmse": winner.metrics.get("rmse"), "r2": winner.metrics.get("r2")}))
    return 0


def cmd_drift(spark, a) -> int:
    from .operators import drift

    ref, cur = spark.read.parquet(a.reference), spark.read.parquet(a.current)
    features = a.features.split(",") if a.features else [c for c, t in ref.dtypes if t in ("double", "float", "int", "bigint") and c in cur.columns]
    long = drift.to_long(ref, features, "ref").unionByName(drift.to_long(cur, features, "cur"))
    fd = drift.feature_drift(long)
    fd.write.mode("overwrite").json(f"{a.out}/features")
    drift.data_drift_summary(fd).write.mode("overwrite").json(f"{a.out}/summary")
    return 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cyclewise")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--sf", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    t = sub.add_parser("train")
    t.add_argument("--data-dir", required=True)
    t.add_argument("--dataset", default="FD001")
    t.add_argument("--out", required=True)
    t.add_argument("--trees", type=int, default=100)
    t.add_argument("--depth", type=int, default=10)
    t.add_argument("--val-share", type=float, default=0.1)
    d = sub.add_parser("drift")
    d.add_argument("--reference", required=True)
    d.add_argument("--current", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--features", default=None)
    a = ap.parse_args(argv)
    if a.cmd == "list":
        from .plans import catalog

        print("\n".join(catalog.queries()))
        return 0
    spark = _session(a.master)
    return {"run": cmd_run, "train": cmd_train, "drift": cmd_drift}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
