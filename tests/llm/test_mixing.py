from collections import Counter

from kvarto.llm.mixing import horizon, mix, mix_report, supply_report


def test_shares_caps_and_report(spark):
    docs = [(i, "a", 10) for i in range(100)] + [(1000 + i, "b", 5) for i in range(20)] + [(2000, None, 50), (3000, "x", 10), (4000, "b", None)]
    df = spark.createDataFrame(docs, "id long, source string, tokens long").selectExpr("*", "1 AS share", "2 AS use", "3 AS hash", "4 AS finish")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 2), ("c", 0.2, 3), ("d", 0.0, 3)], "source string, target_share double, max_uses int")
    mixed = mix(df, targets, bucket_rows=7).collect()
    # 1,100 tokens in targeted sources: b can give 200 of its 330, c nothing
    assert sum(r["tokens"] for r in mixed) <= 1100 < sum(r["tokens"] for r in mixed) + 11
    uses = Counter(r["id"] for r in mixed)
    assert max(uses.values()) <= 2 and all(r["source"] in "ab" for r in mixed)
    assert sum(r["tokens"] for r in mixed if r["source"] == "b") == 200
    short = {r["source"]: r["short"] for r in supply_report(df, targets).collect()}
    assert short == {"a": False, "b": True, "c": True, "d": False}
    report = {r["source"]: r for r in mix_report(df, targets).collect()}
    assert report["c"]["uses"] == 0 and abs(sum(r["actual_share"] for r in report.values()) - 1) < 1e-9


def test_every_prefix_keeps_the_shares(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], 1 + i % 5) for i in range(2000)], "id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.75, 5), ("b", 0.25, 5)], "source string, target_share double, max_uses int")
    rows = sorted(mix(df, targets, budget=4000, bucket_rows=1500).collect(), key=lambda r: (r["finish"], r["id"], r["use"]))
    for cut in (200, 500, len(rows)):
        held = Counter()
        for r in rows[:cut]:
            held[r["source"]] += r["tokens"]
        assert abs(held["a"] / sum(held.values()) - 0.75) < 0.02
    again = sorted(mix(df, targets, budget=4000, bucket_rows=600).collect(), key=lambda r: (r["finish"], r["id"], r["use"]))
    assert [(r["id"], r["use"]) for r in rows] == [(r["id"], r["use"]) for r in again]


def test_empty(spark):
    df = spark.createDataFrame([], "id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_uses int")
    assert mix(df, targets).count() == 0
    assert [r["source"] for r in supply_report(df, targets).filter("short").collect()] == []


def test_horizon_follows_from_totals():
    assert horizon([(0.5, 2, 100), (0.5, 2, 100)], 100) == 100
    # b gives its 20 tokens by time 40, then a alone has to give the other 80
    assert horizon([(0.5, 9, 100), (0.5, 1, 20)], 100) == 160
    assert horizon([(0.5, 1, 10)], 100) == 20 and horizon([], 5) == 0 and horizon([(0.0, 1, 10)], 5) == 0
