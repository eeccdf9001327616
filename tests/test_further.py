"""Nulls, refusals and shapes that no query reaches."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import asof, forecast, identity, plausibility, quality, upsert
from ledgerspark.sources import ingest, sinks

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_nulls_are_matched_and_kept(spark):
    a = spark.createDataFrame([(1, None, 5), (1, "n", 50), (None, "n", 5)], "k int, note string, v int")
    b = spark.createDataFrame([(1, 6), (None, 5)], "k int, w int")
    assert rows(asof.within(a, b, ["k"], F.abs(F.col("v") - F.col("w")) <= 1)) == rows(spark.createDataFrame([(1, None, 5, True), (1, "n", 50, False), (None, "n", 5, False)], "k int, note string, v int, matched boolean"))
    r = spark.createDataFrame([("a", D(2019, 5, 1)), ("a", None), ("a", D(2022, 1, 1))], "k string, d date")
    e = spark.createDataFrame([("a", D(2019, 12, 31), 2019), ("a", D(2020, 12, 31), 2020), ("a", None, 1900)], "k string, e date, y int")
    assert rows(asof.implied_period(r, e, ["k"], "d", "e", "y"), "d", "implied") == [(None, None), (D(2019, 5, 1), 2019), (D(2022, 1, 1), None)]
    old = spark.createDataFrame([(None, "x", 1), ("p", "x", 2), ("q", "y", 3), ("r", None, 4)], "k string, s string, v int")
    new = spark.createDataFrame([(None, "x", 9), ("p", "x", 8), ("z", None, 7)], "k string, s string, v int")
    assert rows(upsert.replace_keys(old, new, ["k"]), "k", "v") == [("p", 8), ("q", 3), ("r", 4), ("z", 7), (None, 9)]
    assert rows(upsert.delete_orphans(old, new, ["k"], ["s"]), "k") == [("p",), ("q",), (None,)]
    assert rows(upsert.delete_orphans(old, new, ["k"], ["s"], spared=F.col("v") == 4), "k") == [("p",), ("q",), ("r",), (None,)]


def test_refusals(spark):
    t = spark.createDataFrame([("a", D(2020, 1, 1), 1.0)], "k string, t date, price double")
    with pytest.raises(ValueError, match="price"):
        asof.asof(t, t.withColumnRenamed("t", "q"), ["k"], "t", "q", ["price"])
    money = spark.createDataFrame([(1.0, "CAD", None)], "v double, c string, r double")
    with pytest.raises(Exception, match="no rate from CAD to USD"):
        money.select(plausibility.convert(F.col("v"), F.col("c"), F.lit("USD"), F.col("r"))).collect()
    with pytest.raises(ValueError, match="scope"):
        upsert.check_scope(t, spark.createDataFrame([("b",)], "k string"), "k")
    with pytest.raises(ValueError, match="repeated"):
        identity.check_distinct(t.unionByName(t).withColumnRenamed("k", "ticker"))


def test_one_market(spark):
    data = [("A", "US", "Acme Inc", None), ("A", "CA", "ACME Corp", 1), ("B", None, "Bolt", 2), ("B", "CA", "Bolt Ltd", 2), ("C", "US", "Cone", 1), ("C", "US", "Cone", 1)]
    df = spark.createDataFrame(data, "ticker string, market string, company string, x int")
    assert rows(identity.one_market(df), "ticker", "market") == [("A", "CA"), ("B", "US"), ("C", "US"), ("C", "US")]
    with pytest.raises(ValueError, match="A: "):
        identity.one_market(df.unionByName(spark.createDataFrame([("A", "EU", "Zebra Mines", 1)], df.schema)))


def test_export_is_swapped_in(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "k int, fy int")
    path = str(tmp_path / "out")
    assert sinks.export(df, path, {"k": ["numeric"]}, period="fy") == 2
    assert sinks.export(df.limit(1), path, {"k": ["numeric"]}, period="fy") == 1
    with pytest.raises(ValueError, match="missing column z"):
        sinks.export(df, path, {"z": ["numeric"]})
    assert spark.read.parquet(f"{path}/data").count() == 1
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    assert meta["rows"] == 1 and meta["range"]["fy"][0] == meta["range"]["fy"][1]


def test_tables_of_documents(spark):
    html = "<table><tr><td>x</td></tr></table><table><tr><th>Ticker</th><th>Name</th></tr><tr><td>A</td><td>Acme <b>Inc</b></td></tr></table>"
    assert ingest.table_rows(html, ["Name", "Ticker"]) == [{"Ticker": "A", "Name": "Acme Inc"}] and ingest.table_rows(html, ["z"]) == []
    sheet = '<Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet><Table><Row><Cell><Data>a</Data></Cell><Cell ss:Index="3"><Data>c</Data></Cell></Row></Table></Worksheet></Workbook>'
    assert ingest.sheet_rows(sheet) == [["a", "", "c"]]
    facts = ingest.made_facts(spark, 3, [2020, 2021], ["Revenue"])
    assert rows(facts) == rows(ingest.made_facts(spark, 3, [2020, 2021], ["Revenue"])) and facts.count() == 6
    merged = ingest.merge_entities(facts, facts.drop("value"))
    assert merged.filter("rank = 1 AND value IS NULL").count() == 6


def test_growth_and_loss_models(spark):
    data = [(float(k % 20), None, "s" + str(k % 3), 0.05 * (k % 20) + 0.01 * (k % 7), int(k % 20 < 5)) for k in range(400)]
    panel = forecast.features(spark.createDataFrame(data, "a double, b string, sector string, log_growth double, is_loss int"), ["a", "b", "absent"], ["sector"])
    grown = forecast.fit_growth(panel, panel).select("a", "growth").collect()
    assert all(r["growth"] == sorted(r["growth"]) for r in grown)
    assert all(abs(r["growth"][2] - (0.05 * r["a"] + 0.03)) < 0.1 for r in grown)
    lost = forecast.fit_loss(panel, panel).select("a", "p_loss").collect()
    assert all((r["p_loss"] > 0.5) == (r["a"] < 5) for r in lost)
    assert forecast.fit_loss(panel.filter("is_loss = 0"), panel).filter("p_loss <> 0").count() == 0


def test_cluster_changes(spark):
    now = spark.createDataFrame([("a", 10, 1), ("b", 10, 2), ("c", 5, 1), ("d", 5, 1)], "c string, n int, severity int")
    before = spark.createDataFrame([("a", 4, 1), ("b", 10, 1), ("c", 5, 1)], "c string, n int, severity int")
    assert rows(quality.cluster_growth(now, before, ["c"]), "c", "change") == [("a", "grown"), ("b", "worse"), ("c", "steady"), ("d", "new")]
