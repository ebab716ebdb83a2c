import random

import pytest

from kvarto.operators.diff import compare_copies, difference_values, mismatched_leaves

SCHEMA = "k long, v int, text string, level int, conf double"


def brute(left, right):
    def newest(rows):
        out = {}
        for r in rows:
            key = (r[1] is not None, r[1] if r[1] is not None else 0)
            if r[0] not in out or key > out[r[0]][0]:
                out[r[0]] = (key, r)
        return {k: r for k, (_, r) in out.items()}

    a, b = newest(left), newest(right)
    out = [(k, "only_left") for k in a if k not in b] + [(k, "only_right") for k in b if k not in a]
    for k in a:
        if k in b:
            out += [(k, f) for i, f in ((2, "text"), (3, "level"), (4, "conf")) if a[k][i] != b[k][i]]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    left = [(k, 1, f"t{k}", k % 3 or None, k / 7) for k in r.sample(range(-50, 5000), 300)] + [(None, 1, "x", 1, 0.5)]
    right = [x for x in left if r.random() > 0.1]
    right = [(k, v, t if r.random() > 0.1 else None, lv if r.random() > 0.1 else 9, c) for k, v, t, lv, c in right] + [(9000 + i, 1, None, None, None) for i in range(5)]
    left += [(k, 0, "old", 5, 1.0) for k, *_ in left[:40]] + left[:20]
    got = compare_copies(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).selectExpr("*", "1 AS side", "2 AS digest"), ["k"], ["text", "level", "conf"], "v", per_range=64)
    assert sorted(((x["k"], x["diff"]) for x in got.collect()), key=str) == brute(left, right)


def test_swapped_nulls_are_seen(spark):
    left = spark.createDataFrame([(1, 1, "a", None, 1.0)], SCHEMA)
    right = spark.createDataFrame([(1, 1, None, 1, 1.0)], SCHEMA)
    assert {r["diff"] for r in compare_copies(left, right, ["k"], ["text", "level", "conf"], "v", per_range=64).collect()} == {"text", "level"}


def test_empty_sides_and_text_keys(spark):
    left = spark.createDataFrame([("a", "b", "x")], "p string, q string, text string")
    none = left.limit(0)
    assert [tuple(r) for r in compare_copies(left, none, ["p", "q"], ["text"], per_range=16).collect()] == [("a", "b", "only_left")]
    assert compare_copies(none, none, ["p", "q"], ["text"], per_range=16).count() == 0
    assert compare_copies(left, left, ["p", "q"], ["text"], per_range=16).count() == 0


def test_values(spark):
    left = spark.createDataFrame([(1, 1, "a", 1, 1.0), (1, 0, "old", 1, 1.0), (2, 1, "b", 1, 1.0)], SCHEMA)
    right = spark.createDataFrame([(1, 5, "c", None, 1.0)], SCHEMA)
    got = {(r["diff"], r["left_value"], r["right_value"]) for r in difference_values(left, right, "k", ["text", "level", "conf"], "v").collect()}
    assert {g[:1] for g in got} == {("text",), ("level",), ("only_left",)} and ("text", "a", "c") in got and ("level", "1", None) in got


@pytest.mark.parametrize("key", ["k", "concat('key ', k)", "k * 1000003"])
def test_few_keys_are_compared(spark, key):
    """One exchange moves all rows; of 20,000 keys with 100 differences only those of some hundred leaves meet."""
    left = spark.range(20_000).selectExpr("id AS k", "id % 7 AS v").selectExpr(f"{key} AS key", "v")
    right = spark.range(20_000).selectExpr("id AS k", "CASE WHEN id % 200 = 3 THEN -1 ELSE id % 7 END AS v").selectExpr(f"{key} AS key", "v")
    leaves = mismatched_leaves(left, right, ["key"], ["v"], per_range=256)
    plan = leaves._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert 100 <= leaves.count() < 1200 and leaves.filter("NOT (l.f0 <=> r.f0)").count() == 100


def test_a_hot_key_is_reduced_before_it_is_moved(spark):
    rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS k", "id AS v", "CAST(id % 2 AS STRING) AS text")
    other = spark.createDataFrame([(5, 29_997, "1"), (7, 7, "1")], "k long, v long, text string")
    leaves = mismatched_leaves(rows, other, ["k"], ["text"], "v", per_range=64)
    assert leaves._jdf.queryExecution().executedPlan().toString().count("partial_max(digest") == 2
    got = compare_copies(rows, other, ["k"], ["text"], "v", per_range=64).groupBy("diff").count().collect()
    assert {r["diff"]: r["count"] for r in got} == {"only_left": 19_998}
