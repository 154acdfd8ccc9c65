"""Table sinks: typed empty tables, overwrite, appends, one folder per code.

A table is a Parquet folder written and read by Spark itself.  Whether it
exists is asked of its file system; an error while reading it is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def _place(spark: SparkSession, path: str):
    """(file system, path) of a folder, in any file system Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there."""
    fs, where = _place(spark, path)
    return fs.exists(where)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-15: the table, or an empty frame with ``schema`` when it does not
    exist yet."""
    if table_exists(spark, path):
        return spark.read.option("mergeSchema", "true").parquet(path)
    if schema is None:
        raise FileNotFoundError(path)
    return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite.  The new table is written beside the old one and takes its
    place once it is complete, so a write that fails leaves the old table, and
    the rows may come from the table itself.  Readers should not read while it
    is replaced."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fs, where = _place(spark, path)
    _, new = _place(spark, f"{path}.{mark}.new")
    _, old = _place(spark, f"{path}.{mark}.old")
    try:
        df.write.partitionBy(*(partition_by or [])).parquet(new.toString())
    except Exception:
        fs.delete(new, True)
        raise
    if fs.exists(where) and not fs.rename(where, old):
        raise OSError(f"the table {path} cannot be replaced; its new rows are in {new}")
    if not fs.rename(new, where):
        fs.rename(old, where)
        raise OSError(f"the table {path} cannot be replaced; its new rows are in {new}")
    fs.delete(old, True)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None, batch: str | None = None) -> None:
    """UPS-12: append.  With a ``batch`` name the rows go to a partition of
    their own (column ``batch_id``, which ``df`` must not have), which a replay
    of the batch replaces, so nothing is stored twice.  Without one a replay
    appends again."""
    w = df.write.mode("append")
    if batch is not None:
        if BATCH in (c.lower() for c in df.columns):
            raise ValueError(f"the rows have a column {BATCH} of their own; rename it first")
        w = (df.withColumn(BATCH, F.lit(batch)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic"))
    w.partitionBy(*([BATCH] if batch is not None else []), *(partition_by or [])).parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-19: create-if-missing with the fixed schema."""
    if not table_exists(spark, path):
        write_table(spark.createDataFrame([], schema), path)
    return read_table(spark, path)


def write_per_key(df: DataFrame, path: str, code_col: str) -> DataFrame:
    """SRC-16: one folder per code with '/' and '\\\\' made safe; returns
    per-code row counts (the ok tally), from what was written.  Large codes
    are spread over tasks and small ones share one (Spark's rebalancing)."""
    safe = df.withColumn("safe_code", F.translate(F.col(code_col), "/\\", "__"))
    safe.hint("rebalance", F.col("safe_code")).write.mode("overwrite").partitionBy("safe_code").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return stored.groupBy(F.col("safe_code").cast("string").alias("safe_code")).count()
