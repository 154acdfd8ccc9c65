"""Streaming twins equal their batch twins (availableNow triggers)."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import upsert as UP
from marketlake.streaming import loaders as LD
from marketlake.streaming.progress import progress, with_progress
from marketlake.streaming.incremental import arriving_after_high_water

HEADER = "CIK|Company Name|Form Type|Date Filed|Filename"


def _write_idx(root, year, q, rows, suffix=""):
    d = os.path.join(root, str(year))
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{q}_master{suffix}.idx"), "w") as fh:
        fh.write("\n".join([HEADER, "-" * 20] + rows))


def test_index_stream_insert_ignore(spark, tmp):
    land, table, ck = (os.path.join(tmp, x) for x in ("land", "table", "ck"))
    _write_idx(land, 2021, "QTR1", ["1|A CORP|10-K|2021-01-05|edgar/data/1/a1.txt",
                                    "2|B CORP|10-Q|20210210|edgar/data/2/b1.txt"])
    LD.start_index_load(spark, land, table, ck).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    # a new quarter, plus a re-landed file of the first quarter repeating a
    # key with another name: the stored row stays
    _write_idx(land, 2021, "QTR2", ["3|C CORP|8-K|2021-04-01|edgar/data/3/c1.txt"])
    _write_idx(land, 2021, "QTR1", ["1|A RENAMED|10-K|2021-01-05|edgar/data/1/a1.txt"], suffix="_v2")
    LD.start_index_load(spark, land, table, ck).awaitTermination()
    rows = spark.read.parquet(table).collect()
    got = {r.filename: r.company_name for r in rows}
    assert len(rows) == 3 and got["edgar/data/1/a1.txt"] == "A CORP"
    # replaying the whole landing folder with a fresh checkpoint changes nothing
    LD.start_index_load(spark, land, table, os.path.join(tmp, "ck2")).awaitTermination()
    assert spark.read.parquet(table).count() == 3


def test_observation_stream_upsert(spark, tmp):
    land, table, ck = (os.path.join(tmp, x) for x in ("obs", "t", "ck"))
    b1 = pd.DataFrame({"series_id": ["S", "S", "T"], "date": pd.to_datetime(["2020-01-01", "2020-02-01", "2021-01-01"]).date,
                       "value": [1.0, 2.0, 3.0], "seq": [1, 1, 1]})
    spark.createDataFrame(b1, LD.OBS_SCHEMA).write.mode("append").parquet(land)
    LD.start_observation_load(spark, land, table, ck).awaitTermination()
    b2 = pd.DataFrame({"series_id": ["S", "S"], "date": pd.to_datetime(["2020-02-01", "2020-02-01"]).date,
                       "value": [20.0, 21.0], "seq": [1, 2]})
    spark.createDataFrame(b2, LD.OBS_SCHEMA).write.mode("append").parquet(land)
    LD.start_observation_load(spark, land, table, ck).awaitTermination()
    got = sorted((r.series_id, str(r.date), r.value) for r in spark.read.parquet(table).collect())
    assert got == [("S", "2020-01-01", 1.0), ("S", "2020-02-01", 21.0), ("T", "2021-01-01", 3.0)]


def test_ledger_state_stream_equals_batch_fold(spark, tmp):
    land = os.path.join(tmp, "outcomes")
    schema = "year int, quarter string, outcome string, error string, ts timestamp, seq long"
    rows = [(2020, "QTR1", "failed", "e1", "2024-01-01 00:00:00", 1), (2020, "QTR1", "success", None, "2024-01-02 00:00:00", 2),
            (2020, "QTR1", "failed", "e3", "2024-01-03 00:00:00", 3), (2020, "QTR2", "failed", "x", "2024-01-01 00:00:00", 4),
            (2020, "QTR3", "pending", None, "2024-01-01 00:00:00", 5), (2020, "QTR4", "failed", "y", "2024-01-01 00:00:00", 6),
            (2020, "QTR4", "skipped", "late", "2024-01-02 00:00:00", 7)]
    df = spark.createDataFrame(rows, "year int, quarter string, outcome string, error string, ts string, seq long") \
        .withColumn("ts", F.to_timestamp("ts"))
    df.where("seq <= 2").coalesce(1).write.mode("append").parquet(land)
    df.where("seq > 2").coalesce(1).write.mode("append").parquet(land)
    # one file per micro-batch: the key's state must carry across batches
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(land)
    q = (LD.ledger_state_stream(stream).writeStream.format("memory").queryName("ledger_out2")
         .outputMode("update").option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.lastProgress is not None
    emitted = spark.sql("SELECT * FROM ledger_out2").collect()
    latest = {}
    for r in sorted(emitted, key=lambda r: r.last_attempt):
        latest[(r.year, r.quarter)] = r
    batch = {(r.year, r.quarter): r for r in UP.ledger_fold(df, ["year", "quarter"], "ts", "outcome", "error",
                                                               tiebreak="seq").collect()}
    for key, r in latest.items():
        b = batch[key]
        assert (r.status, r.retry_count, r.error_message) == (b.status, b.retry_count, b.error_message)
    assert latest[(2020, "QTR1")].retry_count == 1 and latest[(2020, "QTR1")].status == "failed"
    assert (latest[(2020, "QTR3")].status, latest[(2020, "QTR3")].retry_count) == ("pending", 0)
    assert (latest[(2020, "QTR4")].status, latest[(2020, "QTR4")].retry_count, latest[(2020, "QTR4")].error_message) == ("skipped", 1, None)
    cal = spark.createDataFrame([(2020, "QTR1"), (2020, "QTR2")], "year int, quarter string")
    assert LD.retry_queue(spark.sql("SELECT * FROM ledger_out2"), cal, 2020).count() == 2


def test_incremental_window_on_a_stream(spark, tmp):
    land = os.path.join(tmp, "arr")
    stored = spark.createDataFrame([(1, "2024-01-05 10:00:00")], "k long, ts string").withColumn("ts", F.to_timestamp("ts"))
    arr = spark.createDataFrame([(1, "2024-01-05 12:00:00"), (1, "2024-01-07 00:00:00"), (2, "2024-01-01 00:00:00"),
                                 (2, "2024-01-03 00:00:00")], "k long, ts string").withColumn("ts", F.to_timestamp("ts"))
    arr.write.parquet(land)
    stream = spark.readStream.schema("k long, ts timestamp").parquet(land)
    q = (arriving_after_high_water(stream, stored, ["k"], "ts", "2024-01-02").writeStream.format("memory")
         .queryName("inc_out").option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.k, str(r.ts)) for r in spark.sql("SELECT * FROM inc_out").collect())
    assert got == [(1, "2024-01-07 00:00:00"), (2, "2024-01-03 00:00:00")]


def test_observation_stream_with_arrival_dedupe(spark, tmp):
    from pyspark.sql import types as T
    land, table, ck = (os.path.join(tmp, x) for x in ("obs", "t", "ck"))
    schema = T.StructType(LD.OBS_SCHEMA.fields + [T.StructField("arrived", T.TimestampType())])
    # the third row re-sends the first (same observation and seq, later arrival)
    rows = pd.DataFrame({"series_id": ["S", "S", "S"], "date": pd.to_datetime(["2020-01-01"] * 3).date,
                         "value": [1.0, 2.0, 1.0], "seq": [1, 2, 1],
                         "arrived": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:05", "2024-01-01 00:06"])})
    spark.createDataFrame(rows, schema).write.mode("append").parquet(land)
    stream = spark.readStream.schema(schema).parquet(land)
    q = (LD.dedupe_arrivals(stream, "arrived", "1 hour").writeStream.format("memory").queryName("dedup_out")
         .option("checkpointLocation", os.path.join(tmp, "ck_mem")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.value for r in spark.sql("SELECT * FROM dedup_out").collect()) == [1.0, 2.0]
    LD.start_observation_load(spark, land, table, ck, arrival_col="arrived", dedupe_delay="1 hour",
                              schema=schema).awaitTermination()
    assert [(r.series_id, r.value) for r in spark.read.parquet(table).collect()] == [("S", 2.0)]


# ------------------------------------------------------- keyed sinks lose nothing
def _obs(spark, rows):
    return spark.createDataFrame(rows, LD.OBS_SCHEMA)


def test_null_dates_of_two_batches_are_kept(spark, tmp):
    path = os.path.join(tmp, "obs")
    run = LD.observation_upsert_sink(path)
    run(_obs(spark, [("A", None, 1.0, 1), ("B", None, 2.0, 2)]), 0)
    run(_obs(spark, [("C", None, 3.0, 3), ("B", None, 4.0, 4)]), 1)
    got = {r.series_id: r.value for r in spark.read.parquet(path).collect()}
    assert got == {"A": 1.0, "B": 4.0, "C": 3.0}


def _index_rows(spark, keys):
    row = [(2024, "QTR1", "0000000001", "8-K", None, f, f"n{k}") for k, f in enumerate(keys)]
    return spark.createDataFrame(row, "year int, quarter string, cik string, form_type string, filing_date date, "
                                      "filename string, company_name string")


def test_first_batch_stores_a_repeated_key_once(spark, tmp):
    path = os.path.join(tmp, "idx")
    run = LD.insert_ignore_sink(path)
    run(_index_rows(spark, ["f1", "f1", "f2"]), 0)
    assert sorted(r.filename for r in spark.read.parquet(path).collect()) == ["f1", "f2"]
    run(_index_rows(spark, ["f2", "f3"]), 1)
    run(_index_rows(spark, ["f2", "f3"]), 1)   # a replay
    assert sorted(r.filename for r in spark.read.parquet(path).collect()) == ["f1", "f2", "f3"]


def test_unreadable_table_fails_the_batch_and_keeps_its_files(spark, tmp):
    path = os.path.join(tmp, "obs")
    run = LD.observation_upsert_sink(path)
    run(_obs(spark, [("S", dt.date(2024, 1, 1), 1.0, 1)]), 0)
    folder = os.path.join(path, "year=2024")
    stored = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(os.path.join(folder, "zz.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        run(_obs(spark, [("U", dt.date(2024, 1, 2), 2.0, 2)]), 1)
    assert set(stored) <= set(os.listdir(folder))


def test_sinks_leave_the_session_as_it_was(spark, tmp):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    LD.observation_upsert_sink(os.path.join(tmp, "obs"))(_obs(spark, [("S", dt.date(2024, 1, 1), 1.0, 1)]), 0)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


# ------------------------------------------------------------- load progress
def test_restarted_load_skips_committed_batches(spark, tmp):
    land, table, ck, log = (os.path.join(tmp, x) for x in ("land", "table", "ck", "log"))
    applied, broken = [], [True]

    def sink(batch, batch_id):
        if batch_id == 1 and broken[0]:
            raise RuntimeError("killed")
        applied.append((batch_id, batch.count()))
        batch.write.mode("append").parquet(table)

    def load(checkpoint, **kw):
        src = spark.readStream.schema("id long, name string").option("maxFilesPerTrigger", 1).parquet(land)
        q = src.writeStream.foreachBatch(with_progress(sink, log, "name", **kw)).option("checkpointLocation", checkpoint)
        q = q.trigger(availableNow=True).start()
        q.awaitTermination()
    for i in range(3):
        spark.range(i * 10, i * 10 + 5 + i).selectExpr("id", "concat('s', id) name").coalesce(1).write.mode("append").parquet(land)
    with pytest.raises(Exception, match="killed"):
        load(ck)
    r = progress(spark, log).first()
    assert (r["batches"], r["total_rows"], r["last_batch"], r["last_key"]) == (1, 5, 0, "s4")
    broken[0] = False
    load(ck)
    assert applied == [(0, 5), (1, 6), (2, 7)]
    r = progress(spark, log).first()
    assert (r["batches"], r["total_rows"], r["last_batch"], r["last_key"]) == (3, 18, 2, "s26")
    assert spark.read.parquet(table).count() == 18
    # a replay of a committed batch under the same name does nothing; a new checkpoint is a load of its own
    run = with_progress(sink, log, "name", stream=r["stream"])
    run(spark.range(3).selectExpr("id", "'x' name"), 2)
    assert len(applied) == 3 and progress(spark, log).count() == 1
    load(os.path.join(tmp, "ck2"))
    assert len(applied) == 6 and progress(spark, log).count() == 2
    with pytest.raises(ValueError, match="stream name"):
        with_progress(sink, log, "name")(spark.range(1).selectExpr("id", "'x' name"), 0)


def test_pending_quarters_expire_by_timer(spark, tmp):
    land, out, ck = (os.path.join(tmp, x) for x in ("land", "out", "ck"))
    schema = "year int, quarter string, outcome string, error string, ts timestamp, seq long"

    def put(*rows):
        df = spark.createDataFrame([(y, q, o, None, t, n) for n, (y, q, o, t) in enumerate(rows)],
                                   "year int, quarter string, outcome string, error string, ts string, seq long")
        df.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(land)
        src = spark.readStream.schema(schema).parquet(land)
        (LD.ledger_state_stream(src, "2 hours").writeStream.outputMode("update")
         .foreachBatch(lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("append").parquet(out))
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    put((2020, "QTR1", "pending", "2024-01-01 00:00:00"), (2020, "QTR2", "pending", "2024-01-01 00:00:00"))
    put((2020, "QTR1", "success", "2024-01-01 01:00:00"))
    put((2020, "QTR3", "success", "2024-01-01 05:00:00"))
    put((2020, "QTR3", "success", "2024-01-01 06:00:00"))
    last = {r.quarter: r for r in spark.read.parquet(out).groupBy("quarter").agg(
        F.max_by(F.struct("status", "error_message", "retry_count", "failed_at"), F.struct("batch", "retry_count")).alias("r"))
        .select("quarter", "r.*").collect()}
    assert last["QTR1"].status == "success" and last["QTR3"].status == "success"
    assert (last["QTR2"].status, last["QTR2"].error_message, last["QTR2"].retry_count) == ("failed", LD.EXPIRED, 1)
    assert last["QTR2"].failed_at == dt.datetime(2024, 1, 1, 2, 0)
