"""Load progress (UPS-11): what of a stream has been stored, kept beside it.

A record is one row of a Parquet table, in a partition of its own per (stream,
batch): written after the batch was applied, read before the next one is.  A
batch with a record is not applied again, whatever replays it; one that was
applied without its record is, which the sinks take (they are idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sink import read_table

SCHEMA = "stream string, batch long, n_rows long, last_key string, total_rows long, committed_at timestamp"
QUERY_ID = "sql.streaming.queryId"


def progress(spark: SparkSession, path: str) -> DataFrame:
    """How far each stream is: stream, batches, total_rows, last_batch,
    last_key (the largest of its last batch that had rows), committed_at."""
    r = read_table(spark, path, spark.createDataFrame([], SCHEMA).schema)
    return r.groupBy(F.col("stream").cast("string").alias("stream")).agg(
        F.count("*").alias("batches"), F.sum("n_rows").alias("total_rows"), F.max("batch").cast("long").alias("last_batch"),
        F.max_by("last_key", F.when(F.col("last_key").isNotNull(), F.col("batch"))).alias("last_key"),
        F.max("committed_at").alias("committed_at"))


def with_progress(sink: Callable[[DataFrame, int], None], path: str, last_key: Column | str,
                  stream: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that applies ``sink`` to batches without a
    record under ``path`` and then writes theirs.  ``last_key``: what of a row
    says how far the load is (a series, a file, a date).  ``stream`` names the
    load; by default it is the streaming query's id, which its checkpoint keeps
    over restarts, so a load with a new checkpoint starts anew."""
    key = F.col(last_key) if isinstance(last_key, str) else last_key

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty(QUERY_ID)
        if name is None:
            raise ValueError("outside of a streaming query a load needs a stream name")
        own = read_table(spark, path, spark.createDataFrame([], SCHEMA).schema).where(F.col("stream").cast("string") == name)
        if not own.where(F.col("batch") == batch_id).isEmpty():
            return
        batch.persist()      # read by the sink and for its counts
        try:
            sink(batch, batch_id)
            found = batch.agg(F.count("*").alias("n_rows"), F.max(key.cast("string")).alias("last_key"))
            before = own.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("before"))
            record = found.crossJoin(before).select(       # one row each
                F.lit(name).alias("stream"), F.lit(batch_id).cast("long").alias("batch"), "n_rows", "last_key",
                (F.col("n_rows") + F.col("before")).alias("total_rows"), F.current_timestamp().alias("committed_at"))
            (record.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("stream", "batch").parquet(path))
        finally:
            batch.unpersist()
    return run
