import pytest
from pyspark.sql import functions as F

from kvarto.operators.drift import ceased_types, interleaved, retyped_furniture
from kvarto.operators.grids import header_rows, proposals, table_blocks
from kvarto.operators.lookups import range_lookup
from kvarto.operators.reflow import begins_paragraph, folded_lines, local_columns
from kvarto.operators.render import marked_pages
from kvarto.operators.sequences import embedded_rows
from kvarto.operators.splits import suffix
from kvarto.operators.validation import bonus, row_shapes, typical_value, uneven_rows
from kvarto.plans.inventory import page_set
from kvarto.sources.files import adapters, item_class, with_measured_rows


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    "lines, text",
    [
        (["den ring-", "en"], "den ringen"), (["PSY-", "poäng"], "PSY-poäng"), (["mynt-", "och silver"], "mynt- och silver"), (["VARSEBLIV-", "NING"], "VARSEBLIVNING"), (["(liten/medelstor/", "stor)"], "(liten/medelstor/stor)"),
        (["Teknik /", "Grund"], "Teknik / Grund"), (["a --", "b"], "a -- b"), (["Svärd-", "Karl"], "Svärd- Karl"), (["a ", " b"], "a b"), (["", "b", ""], "b"), ([], ""),
    ],
)
def test_lines_are_joined(spark, lines, text):
    assert values(spark, folded_lines(F.col("t")), [(lines,)], "t array<string>") == [text]


def test_paragraph_starts(spark):
    # text, before, x, before_x, before_w, after_x, column_x, before_column_w, prose_w
    cases = [
        (("Pris: 3", "a", 0.1, 0.1, 0.4, 0.1, 0.1, 0.4, 0.4), True), (("a", None, 0.1, None, None, 0.1, 0.1, None, 0.4), True), (("ting", "levan-", None, None, None, None, None, None, None), False), (("a", "b", None, 0.1, 0.4, 0.1, 0.1, 0.4, 0.4), True),
        (("a", "b", 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.4), True), (("a", "b", 0.1, 0.1, 0.3, 0.1, 0.1, 0.4, 0.4), True), (("a", "b", 0.1, 0.1, 0.4, 0.1, 0.1, 0.4, 0.4), False), (("a", "b", 0.13, 0.1, 0.4, 0.1, 0.1, 0.4, 0.4), True),
        (("a", "b", 0.13, 0.1, 0.4, 0.13, 0.1, 0.4, 0.4), False), (("a", "b", 0.13, 0.13, 0.4, 0.1, 0.1, 0.4, 0.4), False), (("a", "b", 0.13, 0.1, 0.4, None, 0.1, 0.4, 0.4), True),
    ]
    names = ["text", "before", "x", "bx", "bw", "ax", "cx", "bc", "prose"]
    got = values(spark, begins_paragraph(*map(F.col, names)), [c for c, _ in cases], "text string, before string, " + ", ".join(f"{n} double" for n in names[2:]))
    assert got == [want for _, want in cases]


def test_local_columns(spark):
    rows = [(1, i, x, w) for i, (x, w) in enumerate([(0.1, 0.4), (0.1, 0.38), (0.12, 0.36), (0.6, 0.2), (0.11, None)])] + [(2, 9, 0.3, 0.1)]
    got = {r["k"]: (r["column_x"], r["column_w"]) for r in local_columns(spark.createDataFrame(rows, "page int, k int, x double, w double"), ["page"], "k").collect()}
    assert got == {0: (0.1, 0.38), 1: (0.1, 0.38), 2: (0.1, 0.38), 3: (0.6, 0.2), 4: (0.1, 0.38), 9: (0.3, 0.1)}


def test_validation(spark):
    assert values(spark, typical_value(F.col("t")), [("2T6+1",), ("3t4 - 2",), ("1T8",), ("T6",), (None,)], "t string") == [8, 6, 5, None, None]
    assert values(spark, bonus(F.col("t")), [("+1t4",), (" – ",), ("",), ("0",), ("+ 2",)], "t string") == ["1T4", "0", "0", "0", "2"]
    tables = [(["a", "b"], [["1", "2"], ["1"]]), (["a"], [["1", "2"], ["3", "4"]]), (None, [["1"]]), (["a"], None), (["a"], [None, ["1"]])]
    assert values(spark, uneven_rows(F.col("h"), F.col("r")), tables, "h array<string>, r array<array<string>>") == [[2], [], [], [], [1]]
    assert values(spark, row_shapes(F.col("r")), [([["1"], ["1", "2"], ["3", "4"], ["5", "6", "7"]],), ([],)], "r array<array<string>>") == [["short", "full", "full", "long"], []]


def test_numbers_of_parts_are_unbounded(spark):
    assert values(spark, suffix(F.col("n")), [(0,), (25,), (26,), (701,), (702,), (18277,), (18278,)], "n long") == ["a", "z", "aa", "zz", "aaa", "zzz", "aaaa"]
    assert page_set("3,5-7, 9-8,") == [3, 5, 6, 7]


def test_many_bands_are_joined_by_buckets(spark):
    bands = spark.createDataFrame([(i * 10, i * 10 + 8, f"b{i}") for i in range(50)] + [(1000, 5000, "wide")], "low int, high int, name string")
    df = spark.createDataFrame([(v,) for v in (0, 8, 9, 495, 1000, 4999, 6000, -1, None)], "v int").withColumn("at__x", F.lit(1))
    few, many = (sorted((str(r["v"]), r["name"]) for r in range_lookup(df, F.col("v"), bands, "low", "high", ["name"], n).collect()) for n in (100, 3))
    assert few == many and ("4999", "wide") in many and ("9", None) in many
    plan = range_lookup(df, F.col("v"), bands, "low", "high", ["name"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_drift_with_the_inventorys_counts(spark):
    rows = [("b", p, "paragraph") for p in range(1, 21)] + [("b", p, "list") for p in range(1, 7)] + [("b", p, "table") for p in (1, 2, 3)] + [("b", p, "heading") for p in range(6, 15)]
    got = ceased_types(spark.createDataFrame(rows, "book string, page int, type string"), 5, 8).collect()
    assert [(r["type"], r["pages"], r["last"], r["silent"]) for r in got] == [("list", 6, 6, 14)]
    tops = [("b", p, i, "HÄXAN" if i == 0 else f"text {p} {i}", ("page_artifact" if p < 3 else "heading") if i == 0 else "paragraph", 0.9 - i / 10) for p in (1, 2, 3) for i in range(5)]
    e = spark.createDataFrame(tops, "book string, page int, idx int, text string, type string, y double")
    assert [(r["text"], r["pages"], r["types"]) for r in retyped_furniture(e).collect()] == [("HÄXAN", 3, ["heading", "page_artifact"])]
    assert retyped_furniture(e.filter("idx < 4")).count() == 0
    order = [2, 1, 1, 1, 1, 1, 2, 2, 2, 2]
    columns = spark.createDataFrame([("b", 1, i, i, f"kolumn {c}") for i, c in enumerate(order)], "book string, page int, idx int, element_key int, region string")
    assert [r["element_key"] for r in interleaved(columns).collect()] == [0] and interleaved(columns.filter("idx < 9")).count() == 0


def test_rows_read_from_an_embedded_layer(spark):
    rows = [(i, t, m) for i, (t, m) in enumerate([("a\nb", "embedded"), ("c\nd", "embedded"), ("e\nf\ng", "embedded"), ("a\nb", "vision"), ("a\n" + "b" * 29, "embedded"), ("x\ny", "embedded"), (None, "embedded"), ("z\nw", "embedded")])]
    e = spark.createDataFrame([("b", 1, i, i, t, m) for i, t, m in rows], "book string, page int, idx int, element_key int, text string, method string")
    assert sorted((r["cells"], r["n"]) for r in embedded_rows(e).collect()) == [(2, 2), (2, 2)]


def test_adapters_and_measured_rows(spark, tmp_path):
    for name, files in {"dod": {"system": "{}", "dice": "{}"}, "_draft": {"system": "{}"}, "empty": {"dice": "{}"}}.items():
        (tmp_path / name).mkdir()
        for part, text in files.items():
            (tmp_path / name / f"{part}.json").write_text("\ufeff" + text, encoding="utf-8")
    assert sorted((r["adapter"], r["part"], r["json"]) for r in adapters(spark, str(tmp_path)).collect()) == [("dod", "dice", "{}"), ("dod", "system", "{}")]
    e = spark.createDataFrame([("b", 1, 7), ("b", 2, 8)], "book string, page int, element_key int")
    bands = spark.createDataFrame([("b", 1, 1, 0.1, 0.2, 0.3, 0.4), ("b", 1, 0, 0.1, 0.1, 0.3, 0.4)], "book string, page int, row_idx int, x double, y double, w double, h double")
    got = {r["element_key"]: r["measured"] and [m["row_idx"] for m in r["measured"]] for r in with_measured_rows(e, bands).collect()}
    assert got == {7: [0, 1], 8: None}
    assert values(spark, item_class(F.col("t")), [("[verktyg] x",), ("[beslut] y",), ("z",), (None,)], "t string") == ["verktyg", "beslut", "beslut", "beslut"]


def test_grids_become_tables(spark):
    def grid(page, texts, skip=()):
        return [("b", page, "r", 100 * page + 10 * i + j, "paragraph", t, 0.1 + 0.3 * j, 0.8 - 0.03 * i, 0.2, 0.02, 0.5 + i / 10, False) for i, row in enumerate(texts) for j, t in enumerate(row) if (i, j) not in skip]

    rows = grid(1, [["Namn", "Bv"], ["a", "1"], ["b", "2"], ["c", "3"]]) + grid(2, [["a", "1", "x"], ["b", "2", "y"], ["c", "3", "z"]], {(1, 2)})
    rows = [r[:4] + ("heading",) + r[5:] if r[5] in ("Namn", "Bv") else r for r in rows]
    e = spark.createDataFrame(rows, "book string, page int, region string, element_key long, type string, text string, x double, y double, w double, h double, confidence double, removed boolean")
    blocks = table_blocks(e)
    got = {r["page"]: r for r in proposals(blocks, e).collect()}
    assert got[1]["shape"] == "rectangle" and got[1]["rows"] == [["a", "1"], ["b", "2"], ["c", "3"]] and (got[1]["x"], got[1]["columns"], got[1]["confidence"]) == (0.1, 2, 0.6)
    assert [(r["page"], r["headers"]) for r in header_rows(blocks, e).collect()] == [(1, ["Namn", "Bv"])]
    assert proposals(blocks.limit(0), e).count() == 0
    doubled = blocks.filter("page = 1").withColumn("col", F.when(F.col("element_key") == 111, 0).otherwise(F.col("col")))
    assert [(r["shape"], r["rows"][0]) for r in proposals(doubled, e).collect()] == [("uneven", [None])]


def test_marked_pages(spark):
    text = "förord\n<!-- sida 1 -->\n\na\n\nb\n<!-- sida 12 -->\n"
    assert [tuple(p) for p in values(spark, marked_pages(F.col("t")), [(text,)], "t string")[0]] == [(None, "förord"), (1, "a\n\nb"), (12, "")]
