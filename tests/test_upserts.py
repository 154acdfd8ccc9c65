"""Properties of the keyed-write operators."""

from pyspark.sql import functions as F

from marketlake.operators import upsert as UP

SCHEMA = "k long, v string, created_at string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_created_and_last_in_batch_wins(spark):
    e = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0")], SCHEMA)
    n = spark.createDataFrame([(2, "B1", "t1", 1), (2, "B2", "t1", 2), (3, "c", "t1", 1)], SCHEMA + ", seq long")
    out = UP.upsert(e, n, ["k"], incoming_seq=F.col("seq"), keep_from_existing=["created_at"])
    assert rows(out) == [(1, "a", "t0"), (2, "B2", "t0"), (3, "c", "t1")]


def test_upsert_idempotent_and_composes(spark):
    e = spark.createDataFrame([(i, f"v{i}", "t0") for i in range(10)], SCHEMA)
    n1 = spark.createDataFrame([(i, f"n1_{i}", "t1") for i in range(5, 15)], SCHEMA)
    n2 = spark.createDataFrame([(i, f"n2_{i}", "t2") for i in range(12, 20)], SCHEMA)
    once = UP.upsert(e, n1, ["k"])
    assert rows(UP.upsert(once, n1, ["k"])) == rows(once)
    both = UP.upsert(UP.upsert(e, n1, ["k"]), n2, ["k"])
    union = UP.upsert(e, n1.withColumn("s", F.lit(1)).unionByName(n2.withColumn("s", F.lit(2))), ["k"],
                      incoming_seq=F.col("s"))
    assert rows(both) == rows(union)


def test_nulls_stay_null(spark):
    e = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    n = spark.createDataFrame([(1, None, "t1")], SCHEMA)
    assert rows(UP.upsert(e, n, ["k"])) == [(1, None, "t1")]


def test_insert_ignore_and_append_new(spark):
    e = spark.createDataFrame([(1, "a", "t0")], SCHEMA)
    n = spark.createDataFrame([(1, "x", "t1", 0), (2, "b", "t1", 0), (2, "b2", "t1", 1)], SCHEMA + ", seq long")
    kept = UP.insert_ignore(e, n, ["k"], incoming_seq=F.col("seq"))
    assert rows(kept.drop("seq")) == [(1, "a", "t0"), (2, "b", "t1")]
    assert rows(UP.append_new(e, n, ["k"], incoming_seq=["seq"])) == [(1, "a", "t0"), (2, "b", "t1")]


def test_dimensional_key_ignores_map_order(spark):
    e = spark.createDataFrame([("C", "2020-01-01", {"a": "1", "b": "2"}, 1.0)],
                              "code string, date string, dimensions map<string,string>, value double")
    n = spark.createDataFrame([("C", "2020-01-01", {"b": "2", "a": "1"}, 5.0)],
                              "code string, date string, dimensions map<string,string>, value double")
    out = UP.upsert_dimensional(e, n).collect()
    assert len(out) == 1 and out[0].value == 5.0 and out[0].dim_key == '{"a":"1","b":"2"}'


def test_merge_null_fill_and_kv_seed(spark):
    e = spark.createDataFrame([(1, None, "t0")], SCHEMA)
    n = spark.createDataFrame([(1, "filled", "t9"), (2, "new", "t9")], SCHEMA)
    assert rows(UP.merge(e, n, ["k"], update_existing=True)) == [(1, "filled", "t0"), (2, "new", "t9")]
    kv_e = spark.createDataFrame([("a", "1", "t")], "key string, value string, updated_at string")
    kv_n = spark.createDataFrame([("a", "2", "u")], "key string, value string, updated_at string")
    seed = spark.createDataFrame([("a", "0", "s"), ("z", "0", "s")], "key string, value string, updated_at string")
    assert rows(UP.kv_upsert(kv_e, kv_n, seed)) == [("a", "2", "u"), ("z", "0", "s")]


def test_ledger_fold_rules(spark):
    ev = spark.createDataFrame([
        (1, 1, "failed", "e1"), (1, 2, "success", None), (1, 3, "failed", "e3"), (1, 4, "failed", "e4"),
        (2, 1, "success", None)], "key long, ts long, outcome string, err string")
    got = {r.key: r for r in UP.ledger_fold(ev, ["key"], "ts", "outcome", "err").collect()}
    assert (got[1].status, got[1].retry_count, got[1].error_message, got[1].downloaded_at, got[1].failed_at) == \
        ("failed", 2, "e4", 2, 4)
    assert (got[2].status, got[2].retry_count, got[2].error_message) == ("success", 0, None)
