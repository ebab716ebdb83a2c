import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kvarto.operators.alignment import EMPTY_ROW, NO_ROW, bind, bind_pages, width_cost
from kvarto.operators.corrections import apply_records, violations, with_defaults
from kvarto.operators.dice import repair
from kvarto.operators.grids import grid_blocks, table_blocks
from kvarto.operators.images import ink_share, measure, measure_images, true_runs
from kvarto.operators.regions import column_count, column_references, normalised
from kvarto.sources.files import queue_items, read_pages, verified
from kvarto.streaming.ingest import ingest, sessions, windowed_counts


def test_dice(spark):
    expected = {"1T6": "ok", "ITG": "1T6", "2I6": "2T6", "SIG": "skip", "SIG+2": "ambiguous", "1984": "skip", "3T7": "invalid", "1t10": "1T10", "4TB": "ambiguous", "4T2Q+3": "4T20+3", None: "skip", "": "skip"}
    df = spark.createDataFrame([(t,) for t in expected], "t string")
    got = {r["t"]: r["repaired"] or r["status"] for r in repair(df, "t").collect()}
    assert got == expected
    assert repair(df.filter("t = 'ITG'"), "t").first()["confidence"] == pytest.approx(0.94)


def test_folding_records(spark):
    e = spark.createDataFrame([(1, "Slå ITG mot éITG och ITG."), (2, None), (3, "a (b) $x")], "k long, text string")
    rows = [(1, 1, "ITG", "1T6", None, 0.95), (2, 1, "1T6", "2T6", None, 0.91), (3, 1, "mot", "för", None, 0.5), (4, 2, "a", "b", True, 0.1), (5, 3, "a", r"c\1$2", True, 1.0), (6, 3, "", "zz", True, 1.0), (7, 3, "(b", "[", True, 1.0)]
    c = spark.createDataFrame(rows, "id long, k long, original string, corrected string, applied boolean, confidence double").withColumn("kind", F.lit(None).cast("string"))
    got = {r["k"]: r["text"] for r in apply_records(e, c, "k", "id").collect()}
    assert got == {1: "Slå 2T6 mot éITG och 2T6.", 2: None, 3: r"c\1$2 [) $x"}
    full = with_defaults(c).withColumn("verdict", F.when(F.col("id") == 1, "avvisad").when(F.col("id") == 2, "x"))
    assert {(r["id"], r["problem"]) for r in violations(full, "id").collect()} == {(1, "applied but rejected"), (2, "unknown verdict")}


def test_regions(spark):
    names = {"Kolumn 2": "c2", "vänsterkolumn": "c1", "högerkolumn": "c2", "sidfot höger": "sidfot", "helbredd": "helbredd", "vänsterkolumn, fortsätter i högerkolumn": None, "okänt": None, "kolumn 3": None, "mittkolumn": None, None: None}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    columns = F.array(F.lit("c1"), F.lit("c2"))
    assert {r["n"]: r["m"] for r in df.select("n", normalised(F.col("n"), columns, F.lit(2)).alias("m")).collect()} == names
    assert {r["m"] for r in df.select(normalised(F.col("n"), columns, F.lit(3)).alias("m")).collect()} == {None, "sidfot", "helbredd"}
    counts = df.filter("n LIKE '%kolumn'").groupBy().agg(F.flatten(F.collect_list(column_references(F.col("n")))).alias("r")).select(column_count(F.col("r"))).first()[0]
    assert counts == 3


def brute_bind(texts, widths, scale):
    m, k = len(texts), len(widths)
    best = np.inf
    for fates in itertools.product([None, *[(a, n) for a in range(k) for n in range(1, k - a + 1)]], repeat=m):
        at, cost, ok = 0, 0.0, True
        for i, fate in enumerate(fates):
            if fate is None:
                cost += NO_ROW
                if i and texts[i - 1].endswith("-") and fates[i - 1] is not None:
                    ok = False
            else:
                a, n = fate
                if a < at or (i and texts[i - 1].endswith("-") and (fates[i - 1] is None or a != at)):
                    ok = False
                cost += EMPTY_ROW * max(0, a - at) + width_cost(len(texts[i]), widths[a : a + n], scale)
                at = a + n
        if ok:
            best = min(best, cost + EMPTY_ROW * (k - at))
    return best


@pytest.mark.parametrize("seed", range(12))
def test_binding_is_cheapest(seed):
    r = random.Random(seed)
    texts = ["x" * r.randint(5, 60) + r.choice(["", "", "-"]) for _ in range(3)]
    widths = [r.choice([0.2, 0.4, 0.41]) for _ in range(4)]
    cost, bound = bind(texts, widths, 100.0)
    assert cost == pytest.approx(brute_bind(texts, widths, 100.0))
    assert all(margin >= -1e-9 for *_, margin in bound)
    rows = [(j, j + n) for _, j, n, _ in bound]
    assert rows == sorted(rows) and all(a[1] <= b[0] for a, b in zip(rows, rows[1:]))


def test_binding_of_pages(spark):
    t = spark.createDataFrame([("b", 1, i, i, "x" * n) for i, n in enumerate([40, 20, 40])] + [("b", 1, 9, 9, None), ("b", 2, 0, 7, "abc")], "book string, page int, idx int, id long, text string")
    rows = spark.createDataFrame([("b", 1, 0.9 - i / 10, w) for i, w in enumerate([0.4, 0.2, 0.4])], "book string, page int, y double, w double")
    got = sorted((r["id"], r["first"], r["rows"]) for r in bind_pages(t, rows, ["book", "page"], 100.0).collect())
    assert got == [(0, 0, 1), (1, 1, 1), (2, 2, 1)]


def test_grids(spark):
    x = np.array([0.1, 0.4, 0.101, 0.4, 0.1, 0.41, 0.7])
    y = np.array([0.9, 0.9, 0.87, 0.871, 0.84, 0.84, 0.5])
    (block,) = grid_blocks(x, y, np.full(7, 0.014))
    assert sorted(block) == [(0, 0, 0), (1, 0, 1), (2, 1, 0), (3, 1, 1), (4, 2, 0), (5, 2, 1)]
    rows = [("b", 1, i, "paragraph", f"c{i}", "k", float(a), float(b), 0.014, None) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "book string, page int, element_key long, type string, text string, region string, x double, y double, h double, removed boolean")
    assert table_blocks(df).count() == 6 and table_blocks(df.limit(0)).count() == 0


def page(rows, columns=((60, 280), (320, 540)), height=800, width=600):
    dark = np.zeros((height, width), np.uint8)
    for left, right in columns:
        for i in range(rows):
            dark[60 + 24 * i : 70 + 24 * i, left:right:2] = 255
    return dark


def test_image_measurement(spark):
    two = measure(page(20))
    assert len(two) == 40 and {b["region"] for b in two} == {"kolumn 1", "kolumn 2"}
    assert two[0]["x"] == pytest.approx(0.1, abs=0.005) and two[0]["w"] == pytest.approx(220 / 600, abs=0.01) and two[0]["y"] == pytest.approx(1 - 70 / 800, abs=0.003)
    one = measure(page(10, columns=((60, 540),)))
    assert len(one) == 10 and {b["region"] for b in one} == {"helbredd"}
    assert measure(np.zeros((100, 80), np.uint8)) == [] and true_runs(np.array([1, 1, 0, 1], bool)) == [(0, 2), (3, 4)] and 0 < ink_share(page(5)) < 0.2
    df = spark.createDataFrame([("b", 1, 800, 600, bytearray(page(4).tobytes())), ("b", 2, 5, 5, bytearray(b"x")), ("b", 3, 5, 5, None)], "book string, page int, height int, width int, pixels binary")
    assert measure_images(df).count() == 8


def test_ingest_with_quarantine(spark, tmp_path):
    source, good, bad, state = (tmp_path / n for n in ("in", "good", "bad", "state"))
    source.mkdir()
    ok = {"page": 1, "elements": [{"id": "a", "type": "paragraph", "text": "hej"}, {"id": "b", "type": "table"}]}
    (source / "a.json").write_text("﻿" + json.dumps(ok))
    (source / "b.json").write_text("{")
    (source / "c.json").write_text(json.dumps({"page": 2, "elements": []}))
    (source / "d.json").write_text(json.dumps({"page": 2, "elements": [], "skipped": {"reason": "illustration_only"}}))
    (source / "e.json").write_text(json.dumps({"page": 3, "elements": [{"type": "heading", "text": " "}]}))
    (source / "f.json").write_text(json.dumps({"page": 3, "elements": [{"type": "poem"}]}))
    for _ in range(2):
        ingest(spark, str(source), str(good), str(bad), str(state)).awaitTermination()
    assert spark.read.parquet(str(good)).count() == 2
    assert {r["file"]: r["error"] for r in spark.read.parquet(str(bad)).collect()} == {"b.json": "not JSON", "c.json": "empty without a reason", "e.json": "element without text", "f.json": "unknown type"}
    assert read_pages(spark, str(source)).filter("error IS NULL").count() == 2
    (source / "g.json").write_text(json.dumps({"elements": []}))
    ingest(spark, str(source), str(good), str(bad), str(state)).awaitTermination()
    assert spark.read.parquet(str(bad)).count() == 5


def test_streams_equal_tables(spark, tmp_path):
    rows = [(u, 1_700_000_000 + 3600 * h, float(h)) for u in (1, 2) for h in (0, 1, 9, 10, 40)]
    df = spark.createDataFrame(rows, "user_id long, s long, value double").withColumn("ts", F.timestamp_seconds("s")).withColumn("event_type", F.lit("x")).drop("s")
    df.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    q = sessions(stream).writeStream.outputMode("complete").format("memory").queryName("kept_sessions").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda d: sorted((r["user_id"], r["n"], r["value"]) for r in d.collect())
    assert key(spark.table("kept_sessions")) == key(sessions(df)) == sorted((u, n, v) for u in (1, 2) for n, v in ((2, 1.0), (2, 19.0), (1, 40.0)))
    assert windowed_counts(df).agg(F.sum("n")).first()[0] == 10


def test_files(spark, tmp_path):
    (tmp_path / "x.json").write_bytes(b"abc")
    (tmp_path / "y.json").write_bytes(b"q")
    sums = spark.createDataFrame([("x.json", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"), ("y.json", "00"), ("z.json", "11")], "file string, sha256 string")
    assert {r["file"]: r["ok"] for r in verified(spark, str(tmp_path), sums).collect()} == {"x.json": True, "y.json": False, "z.json": False}
    text = ["# A", "- [ ] Q-1 fel", "## Öppna frågor", "- [ ] Q-2 första", "  fortsätter", "- [x] Q-3 klar", "  rest", "- [ ] Q-4 sista", "# B", "- [ ] Q-5 nej"]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line int, text string")
    assert sorted((r["item"], r["text"]) for r in queue_items(lines, "Öppna frågor").collect()) == [("Q-2", "första fortsätter"), ("Q-4", "sista")]
