"""Structured Streaming twins of the incremental loaders (ST-1 .. ST-5,
UPS-11).

Every sink is a ``foreachBatch`` whose work is idempotent for a batch id:
re-running a batch after a failure (Spark's at-least-once replay) yields
the same table.  Tables are partitioned; a batch only reads and rewrites
the partitions it touches (dynamic partition overwrite), never the whole
table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.upsert import insert_ignore, upsert
from ..session import cut_lineage, ship_package
from ..sources.index import parse_index_lines, with_year_quarter_from_path
from ..sources.sink import table_exists
from .progress import with_progress

INDEX_KEY = ["year", "quarter", "cik", "form_type", "filing_date", "filename"]


def _touched(batch: DataFrame, part_cols: list[str]) -> Column:
    """The partitions of a batch as a condition on stored rows, so that only
    these are read; nulls match nulls.  The driver holds one row per partition
    (a calendar quarter or year) of the batch."""
    held = batch.select(*part_cols).distinct().collect()
    each = [reduce(Column.__and__, [F.col(c).isNull() if r[c] is None else F.col(c) == F.lit(r[c]) for c in part_cols])
            for r in held]
    return reduce(Column.__or__, each, F.lit(False))


def merge_partitions(batch: DataFrame, path: str, part_cols: list[str], merge) -> None:
    """Read only the partitions the batch touches, merge, and overwrite just
    those partitions.  ``merge`` always gets stored rows (none at first), so
    the first batch is held to the same rules as later ones.  The merged
    slice is checkpointed first so the write never reads the folder it
    replaces; an unreadable table fails the batch.  A large partition is
    written by several tasks."""
    spark = batch.sparkSession
    if table_exists(spark, path):
        stored = spark.read.parquet(path)
        stored = stored.withColumns({c: F.col(c).cast(batch.schema[c].dataType) for c in part_cols})
        stored = stored.where(_touched(batch, part_cols))
    else:
        stored = None
    merged = cut_lineage(merge(stored, batch))
    (merged.hint("rebalance", *[F.col(c) for c in part_cols]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*part_cols).parquet(path))


# --------------------------------------------------------------------- ST-1
def index_stream(spark: SparkSession, landing_dir: str, max_files: int | None = None) -> DataFrame:
    """Arriving index files (text; '.gz' unzipped by the reader) -> parsed
    rows with year and quarter from the '<year>/QTRn...' path."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    lines = r.load(landing_dir).select("value", F.col("_metadata.file_path").alias("_path"))
    return with_year_quarter_from_path(parse_index_lines(lines, keep=["_path"])).drop("_path")


def insert_ignore_sink(table_path: str):
    """foreachBatch: new keys are appended to their (year, quarter)
    partitions; stored rows stay (idempotent on replay)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        def merge(stored, b):
            stored = b.limit(0) if stored is None else stored.select(*b.columns)
            return insert_ignore(stored, b, INDEX_KEY)
        merge_partitions(batch, table_path, ["year", "quarter"], merge)
    return run


def start_index_load(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                     available_now: bool = True, progress_path: str | None = None, stream: str | None = None):
    """``progress_path``: where a record of each batch is kept (UPS-11); the
    last filename says how far the load is."""
    sink = insert_ignore_sink(table_path)
    if progress_path:
        sink = with_progress(sink, progress_path, "filename", stream)
    q = (index_stream(spark, landing_dir).writeStream
         .foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


# --------------------------------------------------------------------- ST-3
OBS_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("value", T.DoubleType()), T.StructField("seq", T.LongType())])


def observation_upsert_sink(table_path: str, part_col: str = "year"):
    """foreachBatch: (series_id, date) upsert, incoming wins, last ``seq``
    wins inside a batch; only the touched years are rewritten."""
    def run(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn(part_col, F.year("date"))

        def merge(stored, inc):
            inc_rows = inc.select("series_id", "date", "value", part_col, "seq")
            if stored is None:
                stored = inc_rows.limit(0).drop("seq")
            return upsert(stored.select("series_id", "date", "value", part_col), inc_rows,
                          ["series_id", "date"], incoming_seq=F.col("seq"))
        merge_partitions(b, table_path, [part_col], merge)
    return run


def dedupe_arrivals(stream: DataFrame, arrival_col: str, delay: str,
                    key: list[str] = ("series_id", "date", "value")) -> DataFrame:
    """Drop re-sent copies of the same observation that arrive within
    ``delay`` of each other (state is kept only for the watermark delay)."""
    return stream.withWatermark(arrival_col, delay).dropDuplicatesWithinWatermark(list(key))


def start_observation_load(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                           arrival_col: str | None = None, dedupe_delay: str | None = None,
                           schema: T.StructType = OBS_SCHEMA, progress_path: str | None = None, stream: str | None = None):
    """``progress_path``: where a record of each batch is kept (UPS-11); the
    last series says how far the load is."""
    sink = observation_upsert_sink(table_path)
    if progress_path:
        sink = with_progress(sink, progress_path, "series_id", stream)
    src = spark.readStream.schema(schema).parquet(landing_dir)
    if arrival_col and dedupe_delay:
        src = dedupe_arrivals(src, arrival_col, dedupe_delay)
    return (src.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# --------------------------------------------------------------------- ST-4
LEDGER_OUT = ("year int, quarter string, status string, downloaded_at timestamp, failed_at timestamp, "
              "error_message string, retry_count int, last_attempt timestamp")
EXPIRED = "pending too long"
LEDGER_STATE = ("status string, downloaded_at timestamp, failed_at timestamp, error_message string, "
                "retry_count int, last_attempt timestamp")


class LedgerProcessor(StatefulProcessor):
    """One quarter's ledger row as typed state.  With ``pending_ms``, a
    quarter that stays pending so long after its last event is turned into a
    failure by an event-time timer."""

    def __init__(self, pending_ms: int | None = None):
        self.pending_ms = pending_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("ledger", LEDGER_STATE)

    def _put(self, key, status, done, failed, error, retries, last) -> Iterator[pd.DataFrame]:
        self.row.update((status, done, failed, error, int(retries), last))
        yield pd.DataFrame([{"year": key[0], "quarter": key[1], "status": status, "downloaded_at": done, "failed_at": failed,
                             "error_message": error, "retry_count": int(retries), "last_attempt": last}])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Fold the batch's new outcome events into the state: status and
        error come from the last event (an error only of a failure), the
        success and failure times from the last event of each kind, and the
        retry count is the failures after the last success (added to the
        stored count when the batch has no success)."""
        status, done, failed, error, retries, last = self.row.get() if self.row.exists() else (None,) * 4 + (0, None)
        ev = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "seq"], kind="mergesort")
        ok, bad = (ev["outcome"] == "success").to_numpy(), (ev["outcome"] == "failed").to_numpy()
        if ok.any():
            last_ok = int(np.flatnonzero(ok)[-1])
            done = ev["ts"].iloc[last_ok]
            retries = int(bad[last_ok + 1:].sum())
        else:
            retries = int(retries or 0) + int(bad.sum())
        if bad.any():
            failed = ev["ts"].iloc[int(np.flatnonzero(bad)[-1])]
        status, last = ev["outcome"].iloc[-1], ev["ts"].iloc[-1]
        error = ev["error"].iloc[-1] if bad[-1] else None
        if self.pending_ms is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if status == "pending":
                self.handle.registerTimer(int(last.timestamp() * 1000) + self.pending_ms)
        yield from self._put(key, status, done, failed, error, retries, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, done, failed, error, retries, last = self.row.get()
        if status == "pending":
            at = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
            yield from self._put(key, "failed", done, at, EXPIRED, int(retries or 0) + 1, last)

    def close(self) -> None:
        pass


def ledger_state_stream(outcomes: DataFrame, pending_after: str | None = None, lateness: str = "0 seconds") -> DataFrame:
    """UPS-9 over a stream of (year, quarter, outcome, error, ts, seq):
    keyed state per quarter, one updated ledger row per key and batch.
    Only the batch's new events of a key are held, never its history.

    ``pending_after`` (an interval such as ``2 hours``): quarters whose last
    event is pending that long behind the stream's watermark (events up to
    ``lateness`` late) fail with the message ``EXPIRED``.  Needs the session's
    state store provider of ``build_session``."""
    spark = outcomes.sparkSession
    ship_package(spark)
    if pending_after is None:
        return (outcomes.groupBy("year", "quarter")
                .transformWithStateInPandas(LedgerProcessor(), LEDGER_OUT, "Update", "None"))
    wait = spark.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {pending_after}"))).first()[0]
    return (outcomes.withWatermark("ts", lateness).groupBy("year", "quarter")
            .transformWithStateInPandas(LedgerProcessor(wait), LEDGER_OUT, "Update", "EventTime"))


# --------------------------------------------------------------------- ST-5
def retry_queue(ledger: DataFrame, calendar: DataFrame, start_year: int) -> DataFrame:
    """Stream-static join: ledger updates for quarters of the calendar that
    are pending or failed, from ``start_year`` on."""
    return (ledger.join(calendar, ["year", "quarter"], "inner")
                  .where(F.col("status").isin("pending", "failed") & (F.col("year") >= start_year)))
