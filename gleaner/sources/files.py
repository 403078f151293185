"""File scans, sinks and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session in a single process (``local[n]``) uses the machine's temporary
    folder, which all its tasks share; any other master is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(
    df: DataFrame, label: str, partition_by: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Write ``df`` once and read it back, under another ``schema`` if one is given.

    Cuts the lineage where several passes follow, survives lost executors, and lets the
    later passes prune columns and push filters into the scan.
    """
    path = scratch_dir(df.sparkSession, label)
    write_parquet(df, path, partition_by)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    null_marker: str | None = None,
) -> DataFrame:
    """Header CSV. Without ``schema`` every column is a string unless ``infer`` is set.

    ``infer`` reads the file twice; jobs declare the schema instead.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", False)
    if null_marker is not None:
        reader = reader.option("nullValue", null_marker)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Header CSV, overwritten. ``one_file`` pulls all rows through a single task: use it
    only for small reports."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("escape", '"').csv(path, header=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, column ``value``."""
    return spark.read.text(path, wholetext=True)
