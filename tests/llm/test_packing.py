import random
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from kvarto.llm.packing import filling, pack, pack_histogram, slots


def brute(items, capacity):
    best = len(items)
    for order in set(permutations(items)):
        bins, room = 0, 0
        for x in order:
            if x > room:
                bins, room = bins + 1, capacity
            room -= x
        best = min(best, bins)
    return best


def lower_bound(counts, capacity):
    """The bound L2: large items need a sequence each, and what their room can't take of the others needs more."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(n for s, n in counts.items() if s > capacity - k)
        large = [(s, n) for s, n in counts.items() if capacity / 2 < s <= capacity - k]
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity / 2)
        room = sum((capacity - s) * n for s, n in large)
        best = max(best, alone + sum(n for _, n in large) + max(0, -(-(small - room) // capacity)))
    return best


@pytest.mark.parametrize("seed", range(30))
def test_histogram_keeps_items_and_is_near_the_optimum(seed):
    r = random.Random(seed)
    items = [r.randint(1, 10) for _ in range(7)]
    patterns = pack_histogram(Counter(items), 10)
    assert Counter(s for p, n in patterns for s in p for _ in range(n)) == Counter(items)
    assert all(sum(p) <= 10 for p, _ in patterns)
    assert sum(n for _, n in patterns) <= brute(items, 10) + 1


@pytest.mark.parametrize("seed", range(5))
def test_large_histograms(seed):
    r = random.Random(seed)
    counts = {s: r.randint(1, 40) for s in r.sample(range(1, 513), 300)}
    patterns = pack_histogram(counts, 512)
    held = Counter()
    for p, n in patterns:
        assert sum(p) <= 512
        for s in p:
            held[s] += n
    assert held == Counter(counts)
    least = lower_bound(counts, 512)
    assert sum(n for _, n in patterns) <= 1.02 * least + 1


def test_slots_give_each_rank_one_place():
    patterns = [((6, 4), 3), ((5, 5), 2), ((4,), 1)]
    seen = Counter()
    for size, first, last, sequence, offset in slots(patterns):
        for rank in range(first, last + 1):
            seen[size, rank] += 1
    assert seen == Counter([(6, r) for r in range(3)] + [(4, r) for r in range(4)] + [(5, r) for r in range(4)])


def test_pack_documents(spark):
    rows = [(i, t) for i, t in enumerate([7, 3, 10, 0, 25, 4, 6, None, 3])]
    df = spark.createDataFrame(rows + [(0, 7)], "id long, tokens long").withColumn("sequence", F.lit("clash"))
    got = pack(df, 10).collect()
    sizes = Counter()
    held = Counter()
    for r in got:
        held[r["id"]] += r["size"]
        if r["size"]:
            sizes[r["sequence"]] += r["size"]
        else:
            assert r["sequence"] is None
    assert held == Counter({0: 14, 1: 3, 2: 10, 4: 25, 5: 4, 6: 6, 8: 3, 3: 0, 7: 0})
    assert max(sizes.values()) <= 10 and set(sizes) == set(range(len(sizes)))
    assert [r["piece"] for r in got if r["id"] == 4 and r["size"]].__len__() == 3
    places = sorted((r["sequence"], r["place"], r["size"]) for r in got if r["size"])
    for (s1, p1, n1), (s2, p2, _) in zip(places, places[1:]):
        assert s1 != s2 or p1 + n1 <= p2
    assert filling(pack(df, 10), 10).first()["unused"] == len(sizes) * 10 - 65


def test_empty(spark):
    empty = spark.createDataFrame([], "id long, tokens long")
    assert pack(empty, 8).count() == 0
    assert filling(pack(empty, 8), 8).first()["sequences"] == 0
