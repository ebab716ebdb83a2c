import json
import random

from pyspark.sql import functions as F

from kvarto.operators.nested import damaged, flat_table, label, labelled_nodes, linked_nodes, parse_json, BOOK_KINDS


def found(spark, payloads):
    df = spark.createDataFrame(list(enumerate(payloads)), "raw_id long, payload string").withColumn("kind", F.lit("clash"))
    nodes = linked_nodes(labelled_nodes(df, "raw_id", "payload"))
    return sorted(((r["id"], r["kind"], r["page_pos"], r["element_pos"], r["pos"]) for r in nodes.collect()), key=str)


def brute(payloads):
    out = []
    entries = lambda v: list(enumerate(v)) if isinstance(v, list) else [(0, v)]

    def inside(v, field):
        if isinstance(v, dict):
            for k, x in v.items():
                if k == field and isinstance(x, (dict, list)):
                    yield from entries(x)
                else:
                    yield from inside(x, field)
        elif isinstance(v, list):
            for x in v:
                yield from inside(x, field)

    for i, p in enumerate(payloads):
        try:
            doc = parse_json(p)
        except ValueError:
            continue
        for a, page in inside(doc, "pages"):
            if not isinstance(page, dict):
                continue
            out.append((i, "page", None, None, a))
            for b, el in inside(page, "elements"):
                if not isinstance(el, dict):
                    continue
                out.append((i, "element", a, None, b))
                for field, kind, types in (("corrections", "correction", dict), ("rows", "row", (dict, list))):
                    out += [(i, kind, a, b, c) for c, x in inside({k: v for k, v in el.items()}, field) if isinstance(x, types)]
    return sorted(out, key=str)


def test_layouts_and_odd_values(spark):
    el = {"id": "a", "corrections": [{"original": "x"}, None, {"original": "y"}], "data": {"rows": [["a"], [], None, {"k": 1}]}}
    payloads = [
        json.dumps({"pages": [{"page": 1, "elements": [el, None, {"id": "b", "corrections": {"original": "z"}, "rows": [["q"]]}]}, None, {"elements": None}]}),
        json.dumps({"bok": {"pages": [{"elements": {"id": "lone", "data": {"table": {"rows": {"k": "v"}}}}}]}}),
        None, "", "{", '{"a": NaN}', "[]", "3", '{"pages": "none"}', "[" * 50_000, json.dumps({"pages": [{"elements": [{"corrections": "text", "rows": [1, "a"]}]}]}),
    ]
    assert found(spark, payloads) == brute(payloads)


def test_random_documents(spark):
    r = random.Random(3)

    def value(depth):
        x = r.random()
        if depth > 4 or x < 0.2:
            return r.choice([None, 1, "t", True])
        if x < 0.6:
            return [value(depth + 1) for _ in range(r.randint(0, 3))]
        return {r.choice(["data", "x", "y"]): value(depth + 1) for _ in range(r.randint(0, 3))}

    def an_element():
        return r.choice([value(3), {"corrections": value(1), "data": {"rows": value(1)}}, {"data": [{"rows": value(1)}, 3], "rows": value(1)}])

    documents = [json.dumps({r.choice(["pages", "bok"]): r.choice([{"pages": [{"elements": [an_element() for _ in range(3)]}, value(3)]}, [{"elements": an_element()}]])}) for _ in range(60)]
    assert found(spark, documents) == brute(documents)


def test_intervals_nest():
    rows = list(label({"pages": [{"elements": [{"rows": [[1], [2]]}]}]}, BOOK_KINDS, False))
    by = {k: [(pre, post) for kind, _, pre, post, _, _ in rows if kind == k] for k in BOOK_KINDS}
    (page,), (element,) = by["page"], by["element"]
    assert page[0] < element[0] and element[1] < page[1]
    assert all(element[0] < pre and post < element[1] for pre, post in by["row"])


def test_tables_and_damage(spark):
    df = spark.createDataFrame([(1, json.dumps({"pages": [{"elements": [{"id": "é", "text": "a"}, {"id": 5}]}]})), (1, "{"), (2, None)], "raw_id long, payload string")
    nodes = labelled_nodes(df, "raw_id", "payload", with_body=True)
    got = flat_table(nodes, "element", {"element_id": "$.id", "text": "$.text"}).orderBy("element_position").collect()
    assert [(r["element_id"], r["text"]) for r in got] == [("é", "a"), ("5", None)] and got[0]["page_key"] == got[1]["page_key"]
    assert sorted((r["id"], r["reason"]) for r in damaged(df, "raw_id", "payload").collect()) == [(1, "not JSON"), (2, "null")]
    assert labelled_nodes(df.limit(0), "raw_id", "payload").count() == 0
