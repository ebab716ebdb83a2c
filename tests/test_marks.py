import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kvarto.operators.axes import Box, assemble_measured, column_axis, lay_out
from kvarto.operators.marks import healed_seams, infer_italics, italic_spans, marked, phrases
from kvarto.operators.splits import agreement, break_rows, split_elements, suffix
from kvarto.operators.state import drift, enqueue, freeze, publish_text, stamped


def box(text, x, y, w=0.06):
    return Box(text, x, y, w, 0.014)


def test_axis():
    headers = [box("Ras", 0.1, 0.8), box("i BP", 0.3, 0.8), box("Kostnad", 0.3, 0.82), box("Skada", 0.5, 0.8), box("Vikt", 0.7, 0.8), box("Värden", 0.5, 0.82, 0.26), box("Not", 0.9, 0.82)]
    axis = column_axis(headers)
    assert [t for t, _ in axis.columns] == ["Ras", "Kostnad i BP", "Skada", "Vikt", "Not"] and axis.spans == [("Värden", [2, 3])]
    cells = [box("Alv", 0.1, 0.7), box("25", 0.3, 0.701), box("1T6", 0.5, 0.7), box("Anka", 0.1, 0.67), box("2", 0.7, 0.67)]
    assert lay_out(headers, cells)[1] == [["Alv", "25", "1T6", None, None], ["Anka", None, None, "2", None]]
    assert "outside" in lay_out(headers, [*cells, box("x", -0.05, 0.6)])[2] and "two cells" in lay_out(headers, [*cells, box("y", 0.11, 0.67)])[2]
    assert lay_out([], cells)[1:] == (None, "no headers")


def test_assembled_tables(spark):
    rows = [("b", 1, "table_header", "A", 0.1, 0.8), ("b", 1, "table_header", "B", 0.4, 0.8), ("b", 1, "table_cell", "1", 0.1, 0.7), ("b", 1, "table_cell", None, 0.4, 0.7), ("b", 2, "table_cell", "x", None, 0.1), ("b", 3, "paragraph", "x", 0.1, 0.1)]
    df = spark.createDataFrame(rows, "book string, page int, kind string, text string, x double, y double").withColumns({"w": F.lit(0.05), "h": F.lit(0.01)})
    got = {r["page"]: r for r in assemble_measured(df).collect()}
    assert set(got) == {1, 2} and got[1]["headers"] == ["A", "B"] and got[1]["rows"] == [["1", ""]] and got[2]["reason"] == "unmeasured"
    assert assemble_measured(df.limit(0)).count() == 0


def test_italics(spark):
    stream, flags = "Den gamla boken om drakar", [False] * 4 + [True] * 11 + [False] * 10
    assert italic_spans("Den gamla boken om drakar", stream, flags) == ("spans", [(4, 15)])
    assert italic_spans("Den garnla boken om drakar", stream, flags) == ("spans", [(4, 16)])
    assert italic_spans(stream, stream, [True] * 25)[0] == "whole" and italic_spans(stream, stream, [False] * 25) == ("plain", [])
    assert italic_spans("helt annat 123", stream, flags)[0] == "weak" and italic_spans("om", "om", [True] * 2) == ("plain", [])
    df = spark.createDataFrame([(1, stream, stream, flags), (2, None, "x", [True]), (3, "x", "x", None)], "element_key long, text string, stream string, flags array<boolean>")
    got = infer_italics(df)
    assert {r["element_key"]: r["style"] for r in got.collect()} == {1: "spans", 2: "weak", 3: "weak"}
    assert got.join(df, "element_key").filter("element_key = 1").select(marked(F.col("text"), F.col("spans"))).first()[0] == "Den *gamla boken* om drakar"
    assert spark.range(1).select(healed_seams(F.lit("*dra-* *kar* *och*"))).first()[0] == "*drakar och*"
    spans = F.array(F.struct(F.lit(0).alias("begin"), F.lit(2).alias("end")), F.struct(F.lit(1).alias("begin"), F.lit(3).alias("end")), F.struct(F.lit(5).alias("begin"), F.lit(99).alias("end")))
    assert spark.range(1).select(marked(F.lit("abcd"), spans)).first()[0] == "*ab*cd"


def test_phrases():
    aliases = {("tala", "språk"): "Språk", ("tala", "språk", "väl"): "Vältalighet", ("väl",): "x"}
    assert phrases("Att Tala språk väl, tala  språk", aliases, str.lower) == [(4, 18, "Vältalighet"), (20, 31, "Språk")]
    assert phrases("", aliases, str.lower) == []


def test_splits(spark):
    rows = [(1, "p1_e1", i, t, x, w) for i, (t, x, w) in enumerate([("Första raden är full", 0.1, 0.4), ("och slutar.", 0.1, 0.2), ("Andra stycket är", 0.12, 0.38), ("fullt.", 0.1, 0.1), ("av-", 0.1, 0.3), ("brott", 0.12, 0.38)])]
    rows += [(2, "p1_e2", i, t, x, 0.4) for i, (t, x) in enumerate([("Punkt:", 0.1), ("hängande.", 0.12), ("Rader.", 0.12)])] + [(3, "p1_e3", 0, "Ensam", 0.1, 0.2)]
    df = spark.createDataFrame(rows, "k long, id string, place int, text string, x double, w double")
    breaks = break_rows(df, "k")
    assert [tuple(r) for r in breaks.collect()] == [(1, 2)]
    parts = sorted((r["new_id"], r["text"]) for r in split_elements(df, breaks, "k", "id").collect())
    assert [p[0] for p in parts] == ["p1_e1a", "p1_e1b", "p1_e2", "p1_e3"] and parts[0][1] == "Första raden är full\noch slutar."
    assert [r[0] for r in spark.range(1).select(F.explode(F.array(*[suffix(F.lit(n)) for n in (0, 25, 26, 53)]))).collect()] == ["a", "z", "aa", "bb"]
    assert tuple(agreement(breaks, spark.createDataFrame([(1, 2), (2, 1)], "k long, place int"), ["k", "place"]).first()) == (1, 0, 1)


def test_state(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("b", "ett ord till")], "book string, text string")
    freeze(df, path, "1")
    freeze(df.withColumn("text", F.lit("ett annat ord ord")), path, "2")
    with pytest.raises(AnalysisException):
        freeze(df, path, "1")
    assert {(r["word"], r["lost"], r["gained"]) for r in drift(spark, path, "1", "2", ["book"], "text").collect()} == {("till", 1, 0), ("annat", 0, 1), ("ord", 0, 1)}
    queue = spark.createDataFrame([("Är det så?", "beslut")], "text string, class string")
    new = spark.createDataFrame([("ar det SÅ?", "beslut"), ("Ny fråga", "verktyg"), ("ny  fråga", "beslut"), (None, "x")], "text string, class string")
    added = enqueue(queue, new)
    assert [r["text"] for r in added.collect()] == ["Ny fråga"] and enqueue(queue.union(added), new).count() == 0
    assert stamped(df, "r1", 2, F.timestamp_seconds(F.lit(0))).first()["made_by"]["at"] == "1970-01-01T00:00:00Z"
    publish_text(df, str(tmp_path / "t"), ["book"], "text")
    assert spark.read.text(str(tmp_path / "t")).first()["value"] == "ett ord till"
