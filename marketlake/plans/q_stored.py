"""Registered queries: tables and streams that store what Spark derives from
the given tables, in a folder of their own under the shared checkpoint folder,
and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import STATE_STORE, ensure_checkpoint_dir, settings
from ..sources import index as IX
from ..sources import sink as SK
from ..streaming import loaders as LD
from ..streaming.progress import progress
from .oracle import INDEX_PARSED
from .q_sources import filings
from .q_upserts import UPS_OBS_SQL
from .registry import query
from .tables import daily_series, read


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/query-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ SRC-3/4
@query(sql="WITH " + INDEX_PARSED + """
SELECT CAST(year(filing_date) AS INTEGER) AS year, 'QTR' || CAST(quarter(filing_date) AS VARCHAR) AS quarter, cik,
       CASE WHEN year(filing_date) = 1997 THEN upper(company_name) ELSE lower(company_name) END AS company_name, filename
FROM filings""")
def q_stored_quarters(spark, d):
    """SRC-4: parsed quarters in one folder each; a second write replaces
    the quarters it holds and leaves the others."""
    rows = filings(spark, d).select("year", "quarter", "cik", F.lower("company_name").alias("company_name"), "filename")
    path = _folder(spark)
    IX.write_parsed_quarters(rows, path)
    IX.write_parsed_quarters(rows.where("year = 1997").withColumn("company_name", F.upper("company_name")), path)
    return SK.read_table(spark, path).select("year", "quarter", "cik", "company_name", "filename")


# ---------------------------------------------------------- SRC-15/19, UPS-12
@query(sql="""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS batch
FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_custkey % 3 <> 0""")
def q_table_sink(spark, d):
    """SRC-15/SRC-19/UPS-12: a table made empty, two appended batches, one of
    them twice (stored once), then overwritten by a part of itself."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    empty, path = _folder(spark), _folder(spark)
    SK.ensure_table(spark, empty, o.schema)
    SK.append_table(SK.read_table(spark, empty), path, batch="none")
    for name, status in (("first", "F"), ("second", "O"), ("second", "O")):
        SK.append_table(o.where(F.col("o_orderstatus") == status), path, batch=name)
    kept = SK.read_table(spark, path).where("o_custkey % 3 <> 0")
    SK.write_table(kept.select("o_orderkey", "o_orderstatus", F.col("batch_id").alias("batch")), path)
    return SK.read_table(spark, path)


# ------------------------------------------------------------------- SRC-16
@query(sql="""
SELECT replace(p_brand || '/' || CAST(p_size % 5 AS VARCHAR), '/', '_') AS safe_code, count(*) AS count
FROM part GROUP BY 1""")
def q_per_code(spark, d):
    """SRC-16: one folder per code with its separators made safe; the counts
    of what was written."""
    p = read(spark, d, "part")
    code = F.concat("p_brand", F.lit("/"), (F.col("p_size") % 5).cast("string"))
    return SK.write_per_key(p.select(code.alias("code"), "p_partkey"), _folder(spark), "code")


# -------------------------------------------------------------- ST-3, UPS-11
def _observation_load(spark, d):
    """Stored observations, then a batch with repeated keys, both loaded by
    the stream: (table, progress records)."""
    land, table, check, log = (f"{_folder(spark)}/{x}" for x in ("land", "table", "check", "log"))
    daily = daily_series(spark, d)
    row = lambda times, seq: daily.select("series_id", "date", (F.col("value") * times).alias("value"),
                                          F.lit(seq).cast("long").alias("seq"))
    day = F.dayofmonth("date")
    for batch in (row(1, 0).where(day <= 20), row(2, 1).where(day >= 15).unionByName(row(3, 2).where(day >= 25))):
        batch.write.mode("append").parquet(land)
        LD.start_observation_load(spark, land, table, check, progress_path=log, stream="daily").awaitTermination()
    return table, log


@query(sql="WITH " + UPS_OBS_SQL + """
SELECT coalesce(nl.series_id, e.series_id) AS series_id, coalesce(nl.date, e.date) AS date,
       CASE WHEN nl.series_id IS NOT NULL THEN nl.value ELSE e.value END AS value
FROM e FULL OUTER JOIN nl ON e.series_id = nl.series_id AND e.date = nl.date""")
def q_stream_observations(spark, d):
    """ST-3: the streamed upsert of two landed batches gives what the batch
    upsert gives."""
    return SK.read_table(spark, _observation_load(spark, d)[0]).select("series_id", "date", "value")


@query(sql="WITH " + UPS_OBS_SQL + """
SELECT 'daily' AS stream, 2 AS batches, (SELECT count(*) FROM e) + (SELECT count(*) FROM n) AS total_rows, 1 AS last_batch,
       (SELECT max(series_id) FROM n) AS last_key""")
def q_load_progress(spark, d):
    """UPS-11: how far the streamed load is, from its records."""
    return progress(spark, _observation_load(spark, d)[1]).drop("committed_at")


# --------------------------------------------------------------------- ST-4
@query(sql="""
WITH x AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'QTR' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter, o_orderdate AS ts,
         o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'pending' END AS outcome
  FROM orders),
last AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY year, quarter ORDER BY ts DESC, seq DESC) = 1),
ok AS (SELECT year, quarter, ts AS ok_ts, seq AS ok_seq FROM x WHERE outcome = 'success'
       QUALIFY row_number() OVER (PARTITION BY year, quarter ORDER BY ts DESC, seq DESC) = 1),
rc AS (SELECT x.year, x.quarter, CAST(count(*) FILTER (WHERE outcome = 'failed' AND (ok_ts IS NULL OR ts > ok_ts
              OR ts = ok_ts AND seq > ok_seq)) AS INTEGER) AS retry_count
       FROM x LEFT JOIN ok ON x.year = ok.year AND x.quarter = ok.quarter GROUP BY 1, 2)
SELECT last.year, last.quarter, outcome AS status, CASE WHEN outcome = 'failed' THEN 'order ' || CAST(seq AS VARCHAR) END AS error_message,
       retry_count, ts AS last_attempt
FROM last JOIN rc ON last.year = rc.year AND last.quarter = rc.quarter""")
def q_stream_ledger(spark, d):
    """ST-4: the ledger as keyed state over two landed batches of outcomes:
    each quarter's row after its last batch."""
    land, out, check = (f"{_folder(spark)}/{x}" for x in ("land", "out", "check"))
    o = read(spark, d, "orders")
    outcome = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("pending")
    events = o.select(F.year("o_orderdate").alias("year"), F.concat(F.lit("QTR"), F.quarter("o_orderdate").cast("string")).alias("quarter"),
                      outcome.alias("outcome"), F.when(outcome == "failed", F.concat(F.lit("order "), "o_orderkey")).alias("error"),
                      F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_orderkey").alias("seq"))
    late = F.month("ts") % 3 == 0                   # the last month of a quarter lands after the others
    for batch in (events.where(~late), events.where(late)):
        batch.write.mode("append").parquet(land)
        stream = spark.readStream.schema(T.StructType(events.schema)).parquet(land)
        with settings(spark, STATE_STORE):
            (LD.ledger_state_stream(stream).writeStream.outputMode("update")
             .foreachBatch(lambda rows, i: rows.withColumn("batch", F.lit(i)).write.mode("append").parquet(out))
             .option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination())
    cols = ["status", "error_message", "retry_count", "last_attempt"]
    last = spark.read.parquet(out).groupBy("year", "quarter").agg(F.max_by(F.struct(*cols), "batch").alias("r"))
    return last.select("year", "quarter", *[F.col(f"r.{c}").cast("timestamp_ntz" if c == "last_attempt" else last.schema["r"].dataType[c].dataType)
                                            .alias(c) for c in cols])
