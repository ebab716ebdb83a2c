import random


from pyspark.sql import functions as F

from kvarto.functions.ranks import floor_rank, nearest_rank, upper_median
from kvarto.functions.text import as_int, core, leading_int, name_key, normalise, slug
from kvarto.operators.bags import bag_difference, unexplained, word_bag
from kvarto.operators.lookups import range_lookup, single_match
from kvarto.operators.boxes import dropped_overlaps
from kvarto.operators.regions import column_starts
from kvarto.operators.render import filled_columns, page_blocks, statblock_markdown, unwrapped
from kvarto.operators.rules import scan
from kvarto.operators.sequences import anchor_bands, gap_clusters, runs
from kvarto.operators.statistics import floored, nearest, order_statistics
from kvarto.operators.tables import assemble, continued_blocks, csv_lines, markdown, stitch, with_list
from kvarto.operators.versions import MERGE_ORDER, best_stage, newest

ELEMENT = "element_key long, book string, page int, idx int, type string, level int, text string, headers array<string>, rows array<array<string>>, items array<string>, removed boolean, bands array<int>, x double, y double, w double, h double, id string, confidence double, needs_review boolean"


def element(spark, *given):
    names = [f.split()[0] for f in ELEMENT.split(", ")]
    rows = [tuple({"element_key": i, "book": "b", "page": 1, "idx": i, "type": "paragraph", **g}.get(n) for n in names) for i, g in enumerate(given)]
    return spark.createDataFrame(rows, ELEMENT)


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


def test_text_keys(spark):
    assert one(spark, "  Ånger  ÖGA é – ", normalise) == "anger oga e"
    assert one(spark, "Kort-svärd, (lång)!", name_key) == "kort svard lang"
    assert one(spark, "Den Höga!", slug) == "den-hoga" and one(spark, "!!", slug) == "bok"
    assert one(spark, "(Ord,", core) == "ord" and one(spark, "...", core) == "..."
    assert [one(spark, v, as_int) for v in ("12 %", "-3", "1T6", "", None)] == [12, -3, None, None, None]
    assert [one(spark, v, leading_int) for v in ("12 m", "-3", "1T6", "x", None)] == [12, -3, None, None, None]


def test_order_statistics(spark):
    df = spark.createDataFrame([(float(i),) for i in (4, 1, 3, 2)], "v double")
    row = df.agg(nearest_rank(F.col("v"), 0.5), nearest_rank(F.col("v"), 0.9), floor_rank(F.col("v"), 0.75), upper_median(F.col("v"))).first()
    assert tuple(row) == (3.0, 4.0, 4.0, 3.0)  # 1.5 rounds to the even 2, 2.7 to 3
    assert df.limit(0).agg(nearest_rank(F.col("v"), 0.5)).first()[0] is None


def test_order_statistics_of_counts(spark):
    r = random.Random(2)
    values = [("a", float(r.randint(1, 9))) for _ in range(50)] + [("b", 3.0)] + [("c", None)]
    df = spark.createDataFrame(values, "g string, v double")
    got = {x["g"]: tuple(x)[1:] for x in order_statistics(df, ["g"], "v", {"p": nearest(0.9), "q": floored(0.75), "m": floored(0.5)}).collect()}
    s = sorted(v for g, v in values if g == "a")
    assert got == {"a": (50, s[round(0.9 * 49)], s[37], s[25]), "b": (1, 3.0, 3.0, 3.0)}


def test_versions(spark):
    rows = [(1, 1, "final", 1), (1, 2, "embedded", 9), (2, 3, "validated", None), (2, 4, "validated", 2), (3, 5, "other", 1), (2, 6, "validated", 2)]
    df = spark.createDataFrame(rows, "k long, row_id long, stage string, s long").withColumn("at", F.timestamp_seconds("s"))
    assert {r["k"]: r["row_id"] for r in newest(df, ["k"], "at", "row_id").collect()} == {1: 2, 2: 4, 3: 5}
    assert {r["k"]: r["row_id"] for r in best_stage(df, ["k"], MERGE_ORDER, "at", "row_id").collect()} == {1: 1, 2: 4}


def test_gap_clusters_and_runs(spark):
    df = spark.createDataFrame([("a", x, i) for i, x in enumerate([0.0, 0.02, 0.04, 0.2, 0.21])] + [("b", 0.5, 9)], "g string, x double, i int")
    assert [r["cluster"] for r in gap_clusters(df, ["g"], "x", 0.03, ["i"]).orderBy("g", "i").collect()] == [1, 1, 1, 2, 2, 1]
    df = spark.createDataFrame([(i, f) for i, f in enumerate([True, True, None, None, False, True])], "i int, f boolean").withColumn("g", F.lit(1))
    assert [r["run"] for r in runs(df, ["g"], ["i"], F.col("f")).orderBy("i").collect()] == [1, 1, 2, 2, 3, 4]


def test_anchor_bands_differ_from_single_link(spark):
    r = random.Random(1)
    ys = [round(r.random(), 3) for _ in range(60)]
    df = spark.createDataFrame([("p", y, i) for i, y in enumerate(ys)], "p string, y double, i int")
    bands, anchor, expected = 0, None, {}
    for y, i in sorted(((y, i) for i, y in enumerate(ys)), key=lambda t: (-t[0], t[1])):
        if anchor is None or anchor - y > 0.02:
            bands, anchor = bands + 1, y
        expected[i] = bands
    assert {x["i"]: x["band"] for x in anchor_bands(df, ["p"], "y", 0.02, ["i"]).collect()} == expected


def test_bags(spark):
    df = spark.createDataFrame([("a b - • b",), (None,), ("",)], "t string")
    bag = word_bag(df, F.col("t"))
    assert {r["word"]: r["n"] for r in bag.collect()} == {"a": 1, "b": 2}
    other = spark.createDataFrame([("b", 3), ("c", 1), ("a", 1)], "word string, n long")
    diff = bag_difference(bag, other, ["word"])
    assert {(r["word"], r["lost"], r["gained"]) for r in diff.collect()} == {("b", 0, 1), ("c", 0, 1)}
    credit = spark.createDataFrame([("c", 0, 5)], "word string, lost long, gained long")
    assert [tuple(r) for r in unexplained(diff, credit, ["word"]).collect()] == [("b", 0, 1)]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    ref = spark.createDataFrame([("x", 10), ("y", 1), ("y", 2)], "k string, v int")
    assert {r["id"]: r["v"] for r in single_match(df, ref, "k", ["v"]).collect()} == {1: 10, 2: None, 3: None}
    bands = spark.createDataFrame([(0, 1, "low"), (2, 5, "high")], "a int, b int, name string")
    assert {r["id"]: r["name"] for r in range_lookup(df, F.col("id") * 2, bands, "a", "b", ["name"]).collect()} == {1: "high", 2: "high", 3: None}


def test_rules_fire_and_hold_back(spark):
    e = element(
        spark,
        {"type": "heading", "text": "- LYSSNA", "x": 0.1},
        {"type": "heading", "text": "- alver, dvärgar", "x": 0.1},
        {"type": "table", "rows": [["10"], ["±3"], ["t0"], None], "headers": ["A....", None]},
        {"type": "paragraph", "text": 'Han sa "nej"', "x": 0.1},
        {"type": "paragraph", "text": "• punkt", "removed": True},
        {"type": "illustration", "text": "'"},
        {"type": "heading", "text": "UTAN RUTA"},
        {"type": "list", "items": ["a'b", None], "x": 0.2},
    )
    got = {(r["element_key"], r["rule"], r["place"], r["proposal"]) for r in scan(e).collect()}
    assert got == {
        (0, "heading-dash", "element", "LYSSNA"), (2, "plus-minus-ambiguous", "cell 0.0", ""), (2, "plus-minus-signed", "cell 1.0", "+3"), (2, "plus-minus", "cell 2.0", "±0"),
        (2, "dot-leaders", "header 0", ""), (2, "column-collapse", "element", ""), (3, "straight-quotes", "text", "Han sa ”nej”"), (6, "box-miscoupling", "element", ""), (7, "straight-quotes", "item 0", "a’b"),
    }


def test_tables(spark):
    loose = spark.createDataFrame([("p", i, t) for i, t in enumerate("abcde")], "g string, i int, text string")
    got = assemble(loose.filter("i < 4"), ["g"], ["i"], F.lit(2)).first()
    assert got["rows"] == [["a", "b"], ["c", "d"]] and got["short"] == 0
    assert tuple(assemble(loose, ["g"], ["i"], F.lit(2)).first())[2:] == (None, 1)
    rows = [(1, "b", 1, 9, ["H"], [["x"]]), (2, "b", 2, 0, ["H"], [["y"]]), (3, "b", 2, 1, ["H"], [["z"]]), (4, "b", 4, 0, [], [["q"]])]
    t = spark.createDataFrame(rows, "k long, book string, page int, idx int, headers array<string>, rows array<array<string>>")
    assert {r["head"]: r["rows"] for r in stitch(t, "k").collect()} == {1: [["x"], ["y"]], 3: [["z"]], 4: [["q"]]}
    md = t.select("k", markdown(F.col("headers"), F.array(F.array(F.lit("a|b"), F.lit(None).cast("string"))))).collect()
    assert md[0][1] == "| H |\n| --- |\n| a\\|b |  |" and md[3][1] == "- a|b — "
    quoted = spark.createDataFrame([(1, ["a,b"], [['x"y', None]])], "k long, headers array<string>, rows array<array<string>>")
    assert [r["text"] for r in csv_lines(quoted, "k").orderBy("line").collect()] == ['"a,b"', '"x""y",']


def test_render(spark):
    assert one(spark, "en kråks-\npejare\nhär\n\nny SL-\nPerson", unwrapped) == "en kråkspejare här\n\nny SL- Person"
    e = element(spark, {"type": "heading", "level": 9, "text": "H"}, {"text": "a\nb", "idx": 2}, {"type": "page_artifact", "text": "7", "idx": 1}, {"type": "list", "items": ["x"], "idx": 3}, {"text": "bort", "removed": True})
    rendered = lambda e: page_blocks(e.withColumn("flow", F.lit(1))).first()["markdown"]
    assert rendered(e) == "<!-- sida 1 -->\n\n###### H\n\na b\n\n- x"
    parts = element(spark, {"text": "den ring-"}, {"text": "en lurar", "idx": 1}, {"type": "heading", "level": 1, "text": "H", "idx": 2}, {"text": "sist", "idx": 3}, {"type": "boxed_text", "text": "en\nruta", "idx": 4})
    assert rendered(parts) == "<!-- sida 1 -->\n\nden ringen lurar\n\n## H\n\nsist\n\n> en ruta"


def test_statblocks_and_gear(spark):
    fields = F.expr("array(named_struct('label', 'STY', 'value', '6'), named_struct('label', 'FYS', 'value', '7'))")
    got = spark.range(1).select(statblock_markdown(F.lit("Orm"), F.lit("Hot"), fields), statblock_markdown(F.lit("Orm"), F.lit("Orm"), fields), statblock_markdown(F.lit("Orm"), F.lit(None), F.slice(fields, 1, 0))).first()
    assert tuple(got) == ("**Orm**\n\n| STY | FYS |\n| --- | --- |\n| 6 | 7 |", "| STY | FYS |\n| --- | --- |\n| 6 | 7 |", "**Orm**")
    gear = spark.createDataFrame([([("Yxa", "1T8", None), ("Dolk", None, None)],)], "l array<struct<name:string,damage:string,reach:string>>")
    assert gear.select(filled_columns(F.col("l"), ["name", "damage", "reach"])).first()[0] == "| name | damage |\n| --- | --- |\n| Yxa | 1T8 |\n| Dolk | — |"


def test_column_starts(spark):
    df = spark.createDataFrame([([10, 60, 115, 200, 230],), ([],), ([5],)], "x array<int>")
    assert [r[0] for r in df.select(column_starts(F.col("x"), 100)).collect()] == [[10, 115, 230], [], [5]]


def test_overlaps_of_a_second_sweep(spark):
    r = random.Random(4)
    rows = [(p, k + 100 * p, r.random() < 0.4, r.choice([0.1, 0.5]), round(r.random(), 2), 0.3, r.choice([0.02, 0.05])) for p in range(3) for k in range(40)]
    df = spark.createDataFrame(rows, "page int, k int, first boolean, x double, y double, w double, h double")
    got = {x["k"]: x["kept"] for x in dropped_overlaps(df, ["page"], "k", F.col("first")).collect()}
    want = {}
    for page in range(3):
        kept = []
        for _, k, first, x, y, w, h in sorted((a for a in rows if a[0] == page), key=lambda a: (not a[2], a[4], a[1])):
            hit = any(round(min(x + w, a + c) - max(x, a), 9) > 0 and round(min(y + h, b + e) - max(y, b) - 0.5 * min(h, e), 9) > 0 for a, b, c, e in kept)
            want[k] = first or not hit
            if want[k]:
                kept.append((x, y, w, h))
    assert got == want and 10 < sum(want.values()) < 110


def test_lists_and_blocks_that_go_on(spark):
    cases = [([["a", "b"]], ["c — d", "e — f — g"], [["a", "b"], ["c", "d"], ["e", "f — g"]]), ([["a", "b"]], ["och mer", "c — d"], [["a", "b och mer"], ["c", "d"]]), ([["a", "b"]], ["slut"], [["a", "b slut"]]),
             ([["a", "b"]], ["Nej"], None), ([["a"]], ["c — d"], None), ([], ["c — d"], None), ([["a", "b"]], [], [["a", "b"]]), ([["a", "b"]], ["c — d", None], None)]
    df = spark.createDataFrame([(i, r, t) for i, (r, t, _) in enumerate(cases)], "i int, rows array<array<string>>, items array<string>")
    assert [x[1] for x in sorted(df.select("i", with_list(F.col("rows"), F.col("items"))).collect())] == [c[2] for c in cases]
    e = element(spark, {"type": "statblock", "text": "Moror, varg", "page": 1}, {"type": "page_artifact", "text": "1", "page": 1, "idx": 9}, {"type": "statblock", "text": "STY 6  STO 5", "page": 2}, {"type": "statblock", "text": "Osil\nSTY 3", "page": 2, "idx": 8}, {"type": "statblock", "text": "STY 3", "page": 3})
    assert [tuple(r) for r in continued_blocks(e).collect()] == [(0, 2)]
