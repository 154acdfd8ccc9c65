"""Landed payload scans and sinks on small invented fixtures."""

import json
import os

from pyspark.sql import functions as F

from marketlake.sources import landed as L
from marketlake.sources import sink as S


def docs(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_labour_json(spark):
    payload = {"status": "REQUEST_SUCCEEDED", "Results": {"series": [
        {"seriesID": "CUUR0000SA0", "data": [
            {"year": "2023", "period": "M05", "value": "304.1", "footnotes": [{"code": "P", "text": "preliminary"}]},
            {"year": "2023", "period": "M13", "value": "300.0", "footnotes": [{}]},
            {"year": "2023", "period": "Q05", "value": "x", "footnotes": []},
            {"year": "2023", "period": "S02", "value": "1.5", "footnotes": [{"text": "a"}, {"text": "b"}]}]}]}}
    rows = {r.period: r for r in L.parse_labour_json(docs(spark, [json.dumps(payload)])).collect()}
    assert str(rows["M05"].date) == "2023-05-01" and rows["M05"].value == 304.1
    assert rows["M05"].footnotes == "preliminary"
    assert str(rows["M13"].date) == "2023-01-01" and rows["M13"].footnotes is None
    assert rows["Q05"].date is None and rows["Q05"].value is None
    assert str(rows["S02"].date) == "2023-07-01" and rows["S02"].footnotes == "a, b"


def test_sdmx_json_decodes_index_keys(spark):
    payload = {"dataSets": [{"observations": {"0:0": ["1.5"], "0:1": ["2.5"], "1:1": [None], "1:0": ["NaN?"]}}],
               "structure": {"dimensions": {"observation": [
                   {"id": "REF_AREA", "values": [{"id": "US"}, {"id": "DE"}]},
                   {"id": "TIME_PERIOD", "values": [{"id": "2020-Q1"}, {"id": "2020-03"}]}]}}}
    out = L.parse_sdmx_json(docs(spark, [json.dumps(payload)])).collect()
    got = sorted((r.dimensions["REF_AREA"], str(r.date), r.value) for r in out)
    assert got == [("US", "2020-01-01", 1.5), ("US", "2020-03-01", 2.5)]


def test_catalogue_xml(spark, tmp):
    xml = """<?xml version="1.0"?>
<nt:catalogue xmlns:nt="urn:x">
  <nt:dataset id="A1" version="3"><nt:title>Alpha</nt:title><nt:description>first</nt:description></nt:dataset>
  <nt:dataset id="B2"><nt:description>no title</nt:description></nt:dataset>
</nt:catalogue>"""
    p = os.path.join(tmp, "cat.xml")
    with open(p, "w") as fh:
        fh.write(xml)
    got = {r.code: r for r in L.read_catalogue_xml(spark, p).collect()}
    assert got["A1"].title == "Alpha" and got["A1"].version == "3"
    assert got["B2"].title == "B2"


def test_structure_json_and_keywords(spark):
    payload = {"structure": {"dimensions": {
        "geo": {"label": {"en": "Geo", "fr": "Geo-fr"}, "values": [{"id": "DE", "label": "Germany"}]},
        "unit": {"label": "Unit", "values": [{"id": "EUR", "label": {"en": "Euro"}}]}}}}
    rows = L.parse_structure_json(docs(spark, [json.dumps(payload)]))
    got = {(r.dim, r.dim_label, r.value_id, r.value_label) for r in rows.collect()}
    assert got == {("geo", "Geo", "DE", "Germany"), ("unit", "Unit", "EUR", "Euro")}
    assert L.dimension_keywords(rows).first().keywords == "geo, unit"


def test_catalogue_json_variants(spark):
    flows = L.parse_dataflows(docs(spark, [json.dumps([{"id": "F1"}, {"dataflowid": "F2"}, {"name": "F3"}, {}])]))
    assert sorted(r.dataflow_id for r in flows.collect()) == ["", "F1", "F2", "F3"]
    ok = json.dumps({"status": "REQUEST_SUCCEEDED", "Results": {"survey": [{"survey_abbreviation": "CU"}]}})
    bad = json.dumps({"status": "REQUEST_FAILED", "Results": {"survey": [{"survey_abbreviation": "XX"}]}})
    assert [r.survey_abbreviation for r in L.parse_surveys(docs(spark, [ok, bad])).collect()] == ["CU"]
    funds = L.parse_fund_list(docs(spark, [json.dumps([{"ticker": "AAA"}]),
                                          json.dumps({"products": [{"ticker": "BBB"}], "items": [{"ticker": "C"}]})]))
    assert sorted(r.fund["ticker"] for r in funds.collect()) == ["AAA", "BBB"]


def test_company_tickers(spark):
    payload = {"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple"}, "1": {"cik_str": 42, "ticker": "X", "title": "Y"}}
    got = {r.ticker: r.cik for r in L.parse_company_tickers(docs(spark, [json.dumps(payload)])).collect()}
    assert got == {"AAPL": "0000320193", "X": "0000000042"}


def test_sheet_csv_and_widen(spark, tmp):
    from marketlake.operators.reshape import widen
    p = os.path.join(tmp, "holdings.csv")
    with open(p, "w") as fh:
        fh.write("Ticker,Name,Weight (%),Extra\nAAA,Alpha,1.5,\nBBB,Beta,NaN,x\n")
    df = L.read_sheet_csv(spark, p, "FUND", "2024-01-31", "/us/products/1", "2024-02-01T00:00:00")
    w = widen(df, ["ticker"], "fields", ["Ticker", "Weight (%)", "Extra"]).collect()
    got = {r.Ticker: (r["Weight (%)"], r.Extra) for r in w}
    assert got == {"AAA": ("1.5", None), "BBB": (None, "x")}


def test_embedded_json_block(spark):
    df = docs(spark, ['<script>{"valuationMeasures": {"pe": "12.5", "pb": "3"}}</script>', "<p>none</p>"])
    out = L.embedded_json_block(df, "value").collect()
    assert out[0].valuationMeasures == {"pe": "12.5", "pb": "3"} and out[1].valuationMeasures is None


def test_table_pairs_rows_of_one_cell_and_sections(spark):
    html = ("<div><table><thead><tr><th>Title</th></tr></thead><tr><td>Fee</td><td>1%</td></tr></table></div>"
            "<section id='facts'><table><tr><td>Size</td><td><b>5</b></td></tr></table></section>")
    pages = docs(spark, [html]).withColumn("id", F.lit(1))
    assert [(r.key, r.value) for r in L.table_pairs(pages, ["id"], "value").collect()] == [("Fee", "1%"), ("Size", "5")]
    assert [(r.key, r.value) for r in L.table_pairs(pages, ["id"], "value", section="facts").collect()] == [("Size", "5")]


def test_keywords_per_dataset_in_given_order(spark):
    body = '{"structure": {"dimensions": {"%s": {"label": "x", "values": []}, "%s": {"label": "y", "values": []}}}}'
    df = spark.createDataFrame([("A", body % ("unit", "freq")), ("B", body % ("geo", "age"))], "code string, value string")
    rows = L.parse_structure_json(df, dataset_col="code")
    assert {r.dataset: r.keywords for r in L.dimension_keywords(rows).collect()} == {"A": "unit, freq", "B": "geo, age"}


def test_table_pairs(spark):
    html = "<table><tr><th>Key</th><th>Value</th></tr><tr><td><b>Fees</b></td><td>0.03%</td></tr><tr><td></td><td>x</td></tr></table>"
    out = L.table_pairs(docs(spark, [html]).withColumn("id", F.lit(1)), ["id"], "value").collect()
    assert [(r.key, r.value) for r in out] == [("Fees", "0.03%")]


def test_table_overwrite_and_append(spark, tmp):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    path = os.path.join(tmp, "meta")
    assert S.read_table(spark, path, schema).count() == 0
    S.ensure_table(spark, path, schema)
    S.write_table(spark.createDataFrame([("a", "1")], schema), path)
    # rewriting from the table itself is safe: the rows are checkpointed first
    cur = S.read_table(spark, path)
    S.write_table(cur.withColumn("value", F.lit("2")), path)
    assert [r.value for r in S.read_table(spark, path).collect()] == ["2"]
    S.append_table(spark.createDataFrame([("b", "3")], schema), path)
    assert S.read_table(spark, path).count() == 2


def test_replayed_append_stores_rows_once(spark, tmp):
    path = os.path.join(tmp, "log")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for batch in ("load-1", "load-1", "load-2"):
        S.append_table(rows, path, batch=batch)
    assert sorted((r.k, r.batch_id) for r in S.read_table(spark, path).collect()) == [
        ("a", "load-1"), ("a", "load-2"), ("b", "load-1"), ("b", "load-2")]


def test_unreadable_table_is_an_error(spark, tmp):
    import pytest
    path = os.path.join(tmp, "broken")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    schema = spark.createDataFrame([("a",)], "k string").schema
    with pytest.raises(Exception):
        S.read_table(spark, path, schema).collect()
    with pytest.raises(Exception):
        S.ensure_table(spark, path, schema).collect()


def test_per_key_sink_and_raw_json(spark, tmp):
    df = spark.createDataFrame([("A/B", 1.0), ("C\\D", 2.0), ("A/B", 3.0)], "code string, v double")
    counts = {r.safe_code: r["count"] for r in S.write_per_key(df, os.path.join(tmp, "ind"), "code").collect()}
    assert counts == {"A_B": 2, "C_D": 1}
    L.write_raw_json(df, os.path.join(tmp, "raw"))
    assert spark.read.json(os.path.join(tmp, "raw")).count() == 3
