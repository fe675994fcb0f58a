"""Telemetry files: readers, writers and dataset availability.

Run-to-failure files are headerless text with runs of blanks between fields
(sometimes trailing blanks).  ``read.csv(sep=' ')`` would shift columns on a
double blank, so lines are read as text and split on the regex ``\\s+`` after a
trim: one narrow projection, no Python per row.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATASETS, RAW_COLS
from ..session import ensure_checkpoint_dir

# File kinds of one dataset.
FILE_KINDS = ["train", "test", "RUL"]


def file_name(kind: str, dataset: str) -> str:
    return f"{kind}_{dataset}.txt"


def validate_dataset(dataset: str) -> None:
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}; expected one of {DATASETS}")


def parse_trajectories(lines: DataFrame, columns: list[str] = RAW_COLS, drop_empty_columns: bool = True) -> DataFrame:
    """S1 core: text lines (column ``value``) -> typed telemetry columns.

    unit_id / time_cycle int, the rest double; blank lines skipped; columns
    that are null in every row (from trailing blanks) optionally dropped."""
    v = F.trim(F.col("value"))
    parts = F.split(v, r"\s+")
    cols = []
    for i, c in enumerate(columns):
        t = "int" if c in ("unit_id", "time_cycle") else "double"
        cols.append(F.try_element_at(parts, F.lit(i + 1)).cast(t).alias(c))
    df = lines.filter(F.length(v) > 0).select(*cols)
    if drop_empty_columns:
        from ..operators.profiling import drop_all_null_columns

        df = drop_all_null_columns(df)
    return df


def read_trajectories(spark: SparkSession, path: str, drop_empty_columns: bool = True) -> DataFrame:
    """``load_train`` / ``load_test`` for a file or folder path."""
    return parse_trajectories(spark.read.text(path), drop_empty_columns=drop_empty_columns)


def load_split(spark: SparkSession, data_dir: str, kind: str, dataset: str) -> DataFrame:
    validate_dataset(dataset)
    return read_trajectories(spark, f"{data_dir.rstrip('/')}/{file_name(kind, dataset)}")


def with_line_index(lines: DataFrame, out: str = "line_no") -> DataFrame:
    """1-based position of every line of a text file or a folder of text files, in the JVM.

    ``lines``: ``spark.read.text`` with at most filters on top.  A file may be cut into many
    splits, and Spark packs splits of several files into a partition in any order; a split is
    known by its file's path and its offset in it.  Inside a split ids increase with the lines;
    one count for each split, summed over the splits before it (by path, then offset), gives its
    first number.  The running sum has one row a split and goes by ``scan.running``, so neither
    lines nor splits meet in one task; files of a folder follow each other by path."""
    from ..operators import scan

    t = lines.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_mid"))
    splits = t.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")).withColumn("_all", F.lit(0))
    places = scan.running(splits, ["_all"], ["_file", "_at"], sums=["_n"], pos=None)
    base = places.select("_file", "_at", (F.col("cum__n") - F.col("_n") - F.col("_first") + F.lit(1)).alias("_base"))
    return t.join(base, ["_file", "_at"]).select(*lines.columns, (F.col("_base") + F.col("_mid")).cast("long").alias(out))


def read_rul(spark: SparkSession, path: str) -> DataFrame:
    """One int per line; the line position (1-based) is the test unit.

    A file or a folder of files (in the order of their names); blank lines do not count."""
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    idx = with_line_index(lines)
    return idx.select(F.col("line_no").cast("int").alias("unit_id"), F.trim("value").cast("int").alias("rul"))


def write_rul(rul: DataFrame, path: str, unit: str = "unit_id", value: str = "rul") -> None:
    """One line a unit in unit order: ranges of units become files whose names keep that order."""
    rul.orderBy(unit).select(F.col(value).cast("string").alias("value")).write.mode("overwrite").text(path)


def load_all(spark: SparkSession, data_dir: str, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3: (train, test, rul)."""
    validate_dataset(dataset)
    d = data_dir.rstrip("/")
    return (
        read_trajectories(spark, f"{d}/{file_name('train', dataset)}"),
        read_trajectories(spark, f"{d}/{file_name('test', dataset)}"),
        read_rul(spark, f"{d}/{file_name('RUL', dataset)}"),
    )


def write_trajectories(df: DataFrame, path: str, columns: list[str] = RAW_COLS) -> None:
    """Text writer in the run-to-failure layout (blank separated, no header)."""
    line = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    df.select(F.concat(line, F.lit("  ")).alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Sink (Parquet by default, CSV with header on request), overwrite."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV with an explicit schema (inference only when none is given)."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """Nested report rows -> JSON documents (one per row)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def availability(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """S7 + J2: which expected files exist and are non-empty, per dataset, and
    the missing ones (left anti join of expected against the listing).

    The listing uses the ``binaryFile`` source with only path and length selected,
    so file contents are never read."""
    expected = spark.createDataFrame(
        [(ds, k, file_name(k, ds)) for ds in DATASETS for k in FILE_KINDS], "dataset string, kind string, file string"
    )
    # a file, or a folder of that name with the parts that Spark wrote
    name = f"/{re.escape(data_dir.rstrip('/').rsplit('/', 1)[-1])}/([^/]+[.]txt)(?:/[^/]+)?$"
    found = spark.createDataFrame([], "file string, length long")
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(data_dir)
        found = listed.select(F.regexp_extract("path", name, 1).alias("file"), "length").groupBy("file").agg(F.sum("length").alias("length"))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    present = expected.join(found, "file", "left").withColumn("ok", F.coalesce(F.col("length") > 0, F.lit(False)))
    per_dataset = present.groupBy("dataset").agg(F.min(F.col("ok").cast("int")).cast("boolean").alias("available"), F.count_if("ok").alias("files_present"))
    missing = expected.join(found.filter(F.col("length") > 0), "file", "left_anti")
    return per_dataset, missing


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
