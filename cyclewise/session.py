"""Session helpers.

The library never creates its own cluster settings on a real cluster: it reads
what the session already has.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Scratch folders of local applications without a checkpoint folder of their own.
_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cyclewise", coalesce: bool = True) -> SparkSession:
    """A local[cores] session with AQE, UTC and no web UI (tests / bench).

    ``coalesce=False`` keeps every shuffle at ``shuffle_partitions`` (about two
    per core): at bench scale AQE would merge the CPU-heavy window stages into
    fewer, unbalanced tasks.  On a cluster the partition count is sized to the
    data and AQE coalescing stays on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true" if coalesce else "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's ``spark.checkpoint.dir``.

    On a cluster this is a shared folder named by the operator of the cluster
    and is only read here.  Only when it is unset on a local master a scratch
    folder is made, once for each application.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or _SCRATCH.get(spark.sparkContext.applicationId)
    if not current:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = _SCRATCH[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="cyclewise-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def short_methods(spark: SparkSession) -> None:
    """Bound the bytecode of a generated method at what the JVM compiles (8000), unless the session sets its own bound.

    A projection of some dozen window features is one method above it and would run interpreted; past
    the bound Spark evaluates it in several methods.  Rows are the same."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", None) in (None, "65535"):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Make this package importable on every Python worker, whatever folder the driver was started from.

    The package is zipped once per application and handed to ``addPyFile``."""
    import shutil

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    at = tempfile.mkdtemp(prefix="cyclewise-zip-")
    path = shutil.make_archive(os.path.join(at, "cyclewise"), "zip", os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
