"""Edge rows of the operators, on frames small enough to check by eye."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions import nulls
from ledgerspark.operators import asof, backtest, clean, dedup, forecast, identity, metrics, quality, reshape, screener, upsert, valuation, windows
from ledgerspark.sources import ingest, sinks

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_division_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0), (None, 2.0), (1.0, -2.0)], "a double, b double")
    assert [r[0] for r in df.select(nulls.safe_div("a", "b")).collect()] == [None, None, 2.0, None, -0.5]
    assert [r[0] for r in df.select(nulls.over_positive("a", "b")).collect()] == [None, None, 2.0, None, None]
    assert [r[0] for r in df.select(nulls.sum_unless_all_null("a", "b")).collect()] == [1.0, 1.0, 9.0, 2.0, -1.0]
    assert [r[0] for r in df.select(nulls.clamp("a", 5)).collect()] == [1.0, 1.0, None, None, 1.0]


def test_asof_edges(spark):
    t = spark.createDataFrame([(1, "a", D(2020, 1, 5)), (2, "a", D(2020, 1, 1)), (3, "b", D(2020, 1, 1)), (4, "a", None), (5, "a", D(2021, 1, 1))], "i int, k string, t date")
    q = spark.createDataFrame([("a", D(2020, 1, 5), 5.0), ("a", D(2020, 1, 3), 3.0), ("a", None, 9.0), ("a", D(2020, 1, 5), 4.0)], "k string, q date, p double")
    got = asof.asof(t, q, ["k"], "t", "q", ["p"])
    assert rows(got, "i", "p") == [(1, 5.0), (2, None), (3, None), (4, None), (5, 5.0)]
    assert rows(asof.asof(t, q, ["k"], "t", "q", ["p"], tolerance_days=100), "i", "p")[4] == (5, None)
    assert rows(asof.asof_few(t, q, ["k"], ["i"], "t", "q", ["p"]), "i", "p") == rows(got, "i", "p")


def test_split_factor_is_strictly_after(spark):
    r = spark.createDataFrame([("a", D(2020, 12, 31)), ("a", D(2021, 6, 1)), ("b", D(2020, 1, 1))], "k string, d date")
    e = spark.createDataFrame([("a", D(2020, 12, 31), 2.0), ("a", D(2021, 1, 1), 4.0), ("a", D(2022, 1, 1), 0.5), ("a", D(2023, 1, 1), -1.0)], "k string, x date, ratio double")
    got = asof.factor_after(r, e, ["k"], ["k", "d"], "d", "x", "ratio").withColumn("factor", F.round("factor", 6))
    assert rows(got, "k", "d", "factor") == [("a", D(2020, 12, 31), 2.0), ("a", D(2021, 6, 1), 0.5), ("b", D(2020, 1, 1), 1.0)]


def test_gaps_are_not_bridged_by_offsets(spark):
    df = spark.createDataFrame([("a", 2018, 1.0), ("a", 2019, 2.0), ("a", 2021, 4.0)], "k string, y int, v double")
    assert rows(asof.at_offset(df, ["k"], "y", "v", 1, "n"), "y", "n") == [(2018, 2.0), (2019, None), (2021, None)]
    assert rows(windows.yoy(df, ["k"], "y", "v"), "y", "yoy_pct") == [(2018, None), (2019, 100.0), (2021, 100.0)]
    assert rows(asof.earliest_base(df, ["k"], "y", "v"), "y", "base_year") == [(2018, None), (2019, None), (2021, 2018)]


def test_quarters(spark):
    data = [("t", "Q1", 10.0), ("t", "YTD2", 25.0), ("t", "YTD3", 45.0), ("t", "FY", 100.0), ("u", "Q1", 1.0), ("u", "Q4", 9.0), ("u", "FY", 30.0), ("n", "Q1", 5.0), ("n", "FY", 50.0), ("n", "YTD3", 40.0)]
    df = spark.createDataFrame(data, "k string, shape string, value double")
    got = {r["k"]: tuple(r)[1:] for r in clean.derive_quarters(df, ["k"], F.col("k") != "n").collect()}
    assert got == {"t": (10.0, 15.0, 20.0, 55.0), "u": (1.0, None, None, 9.0), "n": (5.0, None, None, None)}


def test_period_shape(spark):
    df = spark.createDataFrame([(None, D(2020, 1, 1)), (D(2020, 1, 1), D(2020, 3, 31)), (D(2020, 1, 1), D(2020, 12, 31)), (D(2020, 1, 1), D(2020, 1, 11))], "a date, b date")
    assert [r[0] for r in df.select(clean.period_shape(F.col("a"), F.col("b"))).collect()] == ["snapshot", "Q_standalone", "FY_or_TTM", "other_10d"]


def test_streaks_and_sustained(spark):
    df = spark.createDataFrame([("a", y, 1.0) for y in (2010, 2011, 2013, 2014, 2015)] + [("b", 2015, -1.0)], "k string, y int, v double")
    assert rows(windows.streak(df, ["k"], "y")) == [("a", 3), ("b", 1)]
    assert rows(windows.sustained(df, ["k"], "y", F.col("v") > 0, 3)) == [("a",)]


def test_implausible_neighbours(spark):
    settled = [("a", y, v) for y, v in ((1, 100.0), (2, 101.0), (3, 1e6), (4, 110.0), (5, 0.1), (6, 120.0))]
    swinging = [("s", 1, 1.0), ("s", 2, 1e6)]
    df = spark.createDataFrame([*settled, *swinging, ("b", 1, 5.0), ("b", 2, None), ("b", 3, 0.0)], "k string, y int, v double")
    assert rows(clean.implausible_neighbours(df, ["k"], "y", "v").filter("suspect"), "k", "y") == [("a", 3), ("a", 5)]


def test_choices(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, o int, v string")
    assert rows(dedup.latest(df, ["k"], ["o"])) == [("a", 2, "y"), ("b", None, "z")]
    assert rows(dedup.top_n(df, ["k"], [F.desc_nulls_last("o"), F.asc("v")])) == [("a", 2, "x"), ("b", None, "z")]
    assert rows(dedup.rejoin(df, F.col("k") == "a", ["k"], [F.asc_nulls_first("o"), F.asc("v")])) == [("a", 1, None), ("b", None, "z")]


def test_predicates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 2.0), (5.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(backtest.predicate([("a", "<", 3), ("b", "==", 2)])).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(backtest.predicate([])).collect()] == [True] * 4
    with pytest.raises(ValueError):
        backtest.predicate([("a", "~", 1)])


def test_portfolio_statistics(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, -0.5), ("a", 3, 0.2), ("b", 1, 0.1), ("c", 1, 0.05), ("c", 2, 0.05)], "k string, y int, ret double")
    got = {r["k"]: r for r in backtest.statistics(df, ["k"], "y", "ret").collect()}
    assert got["a"]["max_drawdown"] == pytest.approx(-0.5) and got["a"]["cagr"] == pytest.approx((1.1 * 0.5 * 1.2) ** (1 / 3) - 1)
    assert got["b"]["sharpe"] is None and got["c"]["sharpe"] is None and got["c"]["max_drawdown"] == 0


def test_valuation(spark):
    df = spark.createDataFrame([(100.0, None), (None, 1.0)], "f double, g double")
    lit = F.lit
    got = [r[0] for r in df.select(valuation.two_stage_dcf(F.col("f"), lit(0.0), lit(0.1), lit(0.0), 3)).collect()]
    assert got[0] == pytest.approx(100 / 1.1 + 100 / 1.21 + 100 / 1.331 + 1000 / 1.331) and got[1] is None
    assert df.select(valuation.two_stage_dcf(F.col("f"), lit(0.0), lit(0.02), lit(0.03))).first()[0] is None
    assert [r[0] for r in df.select(valuation.graham_revised(F.lit(1.0), F.col("g"), lit(8.5), lit(2.0), lit(15.0), lit(4.4))).collect()] == [None, 10.5]
    table = valuation.scenario_table(spark, overrides={"X": {"all": {"g1": 0.2}, "bear": {"g1": 0.1}}})
    assert rows(table.filter("ticker = 'X'"), "scenario", "g1") == [("bear", 0.1), ("bull", 0.2), ("mid", 0.2)]


def test_forecast_algebra(spark):
    df = spark.createDataFrame([(1, v) for v in range(1, 11)] + [(2, 1)], "g int, v int")
    assert sorted(r["decile"] for r in forecast.decile(df, ["g"], "v").filter("g = 1").collect()) == list(range(1, 11))
    assert forecast.decile(df, ["g"], "v").filter("g = 2").first()["decile"] is None
    scored = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.1), (1, 1, 0.5), (1, 0, 0.5), (2, 1, 0.5)], "g int, y int, s double")
    assert rows(forecast.auc(scored, ["g"], "y", "s")) == [(1, 0.875), (2, None)]


def test_merge_semantics(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "A"), (2, "b"), (4, "d"), (None, "N")], "k int, v string")
    assert rows(upsert.merge(old, new, ["k"])) == sorted([(1, "A"), (2, None), (3, "c"), (4, "d"), (None, "N")], key=str)
    assert (2, "b") in rows(upsert.merge(old, new, ["k"], null_safe=True))
    assert (3, "c") not in rows(upsert.merge(old, new, ["k"], delete_unmatched=F.lit(True)))
    with pytest.raises(ValueError):
        upsert.check_unique(old.union(old), ["k"])
    with pytest.raises(ValueError):
        upsert.guard(8, 10, 0.9, "coverage")


def test_screens(spark):
    df = spark.createDataFrame([("a", "s", 1.0), ("b", "s", 2.0), ("c", "s", 9.0), ("d", "t", 5.0)], "k string, g string, v double").withColumn("i", F.lit("x"))
    got = {r["k"]: (r["basis"], r["peer_median"]) for r in screener.peer_medians(df, "k", ["g", "i"], "v").collect()}
    assert got == {"a": ("g", 2.0), "b": ("g", 2.0), "c": ("g", 2.0), "d": ("i", 3.5)}
    assert rows(screener.mode(df, ["i"], "g")) == [("x", "s")]
    assert df.filter(screener.in_range("v", 2, None)).count() == 3


def test_metrics_keep_unknown(spark):
    df = spark.createDataFrame([(None, None, 5.0, None), (3.0, None, 5.0, 1.0)], "lt_debt double, st_debt double, ocf double, capex double")
    got = df.select(metrics.total_debt(), metrics.free_cash_flow(), metrics.free_cash_flow_lenient()).collect()
    assert [tuple(r) for r in got] == [(None, None, 5.0), (3.0, 4.0, 4.0)]


def test_reshape(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None)], "k string, n string, v double")
    assert rows(reshape.widen(df, ["k"], "n", "v", ["x", "y"])) == [("a", 1.0, None)]
    wide = spark.createDataFrame([("a", 1, None)], "k string, p int, q int")
    assert rows(reshape.lengthen(wide, ["k"], {"p": "P", "q": "Q"})) == [("a", "P", 1.0)]
    assert reshape.ensure_columns(wide, {"z": "double", "p": "int"}).columns == ["k", "p", "q", "z"]


def test_reconcile(spark):
    df = spark.createDataFrame([(100.0, 100.4), (100.0, -100.0), (100.0, 100000.0), (100.0, 150.0), (100.0, None), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(quality.reconcile(F.col("a"), F.col("b"))).collect()] == ["match", "sign", "scale", "mismatch", None, "match"]


def test_names(spark):
    df = spark.createDataFrame([("Acme, Inc.", "ACME CORP"), ("Acme Holding", "Acme"), ("Foo", "Bar")], "a string, b string")
    assert [r[0] for r in df.select(identity.name_match(F.col("a"), F.col("b"))).collect()] == ["same", "same", "different"]


def test_facts_json(spark, tmp_path):
    fact = {"fy": 2020, "fp": "FY", "form": "10-K", "start": "2020-01-01", "end": "2020-12-31", "val": 5, "filed": "2021-02-01", "accn": "x"}
    doc = {"entity": "E", "facts": {"us": {"Rev": {"units": {"EUR": [fact] * 2, "USD": [fact]}}, "Odd": {"units": {"pure": [fact], "acres": [fact] * 3}}}}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    got = ingest.explode_facts(ingest.read_facts(spark, str(tmp_path)))
    assert rows(got, "tag", "unit", "val") == [("Odd", "acres", 5.0)] * 3 + [("Rev", "USD", 5.0)]


def test_xml_and_classes(spark, tmp_path):
    (tmp_path / "v.xml").write_text("<all><RefData><isin>X</isin><mic>M</mic></RefData><RefData><isin>Y</isin></RefData></all>")
    assert rows(ingest.read_xml(spark, str(tmp_path / "v.xml"), "RefData", "isin string, mic string")) == [("X", "M"), ("Y", None)]
    axis = "StatementClassOfStockAxis"
    f = spark.createDataFrame([("e", D(2020, 1, 1), {axis: "A"}, 1.0), ("e", D(2021, 1, 1), {axis: "A"}, 2.0), ("e", D(2021, 1, 1), {axis: "B"}, 3.0), ("e", D(2021, 1, 1), {axis: "B", "o": "x"}, 9.0)], "entity string, instant date, dims map<string,string>, value double")
    assert rows(ingest.class_totals(f), "value") == [(5.0,)]


def test_current_facts(spark):
    base = {"concept": "c", "entity": "E", "period": "2020-01-01T00:00:00/2021-01-01T00:00:00", "unit": "u"}
    data = [("1", base), ("x", base), ("2", {**base, "extra": "m"}), ("3", {**base, "period": "2019-01-01T00:00:00/2020-01-01T00:00:00"})]
    df = spark.createDataFrame(data, "value string, dimensions map<string,string>")
    assert rows(ingest.current_facts(df, F.lit("E"), F.lit("2020-12-31").cast("date")), "value") == [(1.0,)]


def test_shapes_of_sources(spark, tmp_path):
    wide = spark.createDataFrame([(D(2020, 1, 1), 1.0, None, 5.0)], "date date, `close|A` double, `close|B` double, `volume|A` double")
    assert rows(ingest.tidy_prices(wide, ["date"], ["close", "volume"]), "ticker", "close", "volume") == [("A", 1.0, 5.0)]
    f = spark.createDataFrame([("k", ["10-K", "8-K", "10-K"], ["2020", "2021", "2022"])], "k string, form array<string>, filing_date array<string>")
    assert rows(ingest.filing_rows(f, "k", ["form", "filing_date"], ["10-K"], 1)) == [("k", "10-K", "2022")]
    (tmp_path / "b.csv").write_text("banner\nTicker,Name\nA,Alpha\nB,Beta\nfooter\n")
    assert rows(ingest.read_banner_csv(spark, str(tmp_path / "b.csv"), "Ticker")) == [("A", "Alpha"), ("B", "Beta")]
    assert ingest.read_jsonc('// note\n{"a": 1, "_b": 2, "c": [{"_d": 1}]}') == {"a": 1, "c": [{}]}
    tree = ingest.flatten_tree({"IS": {"Top": {"Sub": ["x"]}, "Other": ["y"]}})
    assert [(r["concept"], r["section"], r["group"], r["sort_order"]) for r in tree] == [("x", "Top", "Sub", 1), ("y", "Other", None, 2)]


def test_writes_are_safe(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    sinks.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]
    df = spark.createDataFrame([(1, "a")], "v int, p string")
    assert sinks.export(df, str(tmp_path / "x"), {"v": ["numeric"], "p": ["string"]}) == 1
    with pytest.raises(ValueError):
        sinks.export(df, str(tmp_path / "y"), {"v": ["string"], "q": ["bool"]})
