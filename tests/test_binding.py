import itertools
import random

import numpy as np
import pytest

from kvarto.operators.binding import NO_ROW, Rows, bind_elements, bind_page, costs, page_columns, page_samples, region_of, solve

WIDTHS = [0.4, 0.2, 0.4, 0.1, 0.3]


def el(i, chars, type="paragraph", region="vänsterkolumn", w=None, h=0.01, removed=False, small=False, hyphen=False, x=0.1):
    return {"idx": i, "id": i, "type": type, "region": region, "x": x, "y": 0.9 - 0.02 * i, "w": w, "h": h, "chars": chars, "hyphen": hyphen, "small": small, "bands": 1, "removed": removed}


def page():
    return [el(i, round(100 * w), w=w) for i, w in enumerate(WIDTHS)] + [el(9, 40, region="högerkolumn", w=0.4, x=0.6)]


def bound(els, many=False):
    return {(i, a, n) for _, i, a, n, _ in bind_page(els, 100.0, many)}


def test_each_row_finds_its_text():
    assert bound(page()) == {(i, i, 1) for i in range(5)} | {(9, 0, 1)}


def test_removed_illustrations_and_two_columns_take_no_rows():
    for extra in ({"removed": True}, {"type": "illustration"}, {"region": "vänster-/högerkolumn"}):
        els = page()
        els.insert(1, el(20, 20) | extra)
        got = bound(els)
        assert all(i != 20 for i, *_ in got), extra
        if "region" not in extra:
            assert got == bound(page()), extra


def test_what_a_shift_leaves_as_cheap_is_refused():
    same = [el(i, 40, w=0.4 if i else None) for i in range(6)]  # six texts, five equal rows: nothing says which lacks its row
    assert bound([*same, el(9, 40, region="högerkolumn", w=0.4)]) <= {(9, 0, 1)}


def test_regime_without_ragged_rows_binds_nothing():
    full = [el(i, 80, w=0.4) for i in range(6)]
    assert bound(full, many=True) == set()


def test_penalties():
    boxes = [(0.1 + (0.02 if i == 1 else 0), 0.9 - 0.02 * i, w, 0.014 if i == 3 else 0.01) for i, w in enumerate([0.4, 0.38, 0.2, 0.4, 0.4])]
    rows = Rows(boxes, True)
    price = lambda kind="paragraph", chars=60, **k: costs(rows, kind, chars, 100.0, **k)
    assert price(small=True)[1, 3] == pytest.approx(price()[1, 3] + 0.8)  # a small letter can't begin an indented row
    assert rows.inside[0, 3] == 0.8 and rows.inside[1, 3] == 0  # an indent inside a span
    assert rows.heads[2, 4] == 0.8 and rows.heads[0, 3] == 0  # a row of a heading's height
    assert rows.ragged[2, 4] == pytest.approx(1.6) and rows.ragged[0, 2] == pytest.approx(0.8) and rows.ragged[1, 3] == 0
    dark = Rows(boxes, False, [0.9, 0.1, None, 0.1, 0.1], [True, False, False, False])
    assert costs(dark, "paragraph", 40, 100.0)[0, 1] == 2.0 and costs(dark, "heading", 25, 100.0)[0, 1] == 0 and costs(dark, "list", 40, 100.0)[0, 1] == 2.0
    assert Rows(boxes, True, None, [True, False, False, False]).gaps[0, 2] == 1.0 and dark.skip[0] == 0.05 and dark.skip[1] == 0.6
    assert np.isinf(costs(dark, "paragraph", 80, 100.0)[0, 2]) and np.isfinite(costs(dark, "list", 80, 100.0)[0, 2])


@pytest.mark.parametrize("seed", range(20))
def test_assignment_is_cheapest(seed):
    r = random.Random(seed)
    m, k, many = 3, 4, seed % 2 == 0
    rows = Rows([(0.1, 0.9 - 0.02 * i, r.choice([0.2, 0.4, 0.41]), 0.01) for i in range(k)], many)
    prices = [costs(rows, r.choice(["paragraph", "heading", "list", "toc_entry"]), r.randint(5, 90), 100.0) for _ in range(m)]
    forced = [False] + [r.random() < 0.3 for _ in range(m - 1)]

    def total(fates):
        at, cost = 0, 0.0
        for i, f in enumerate(fates):
            if f is None:
                if forced[i] and i and fates[i - 1] is not None and at < k:
                    return np.inf
                cost += NO_ROW
            else:
                if f[0] < at or (forced[i] and i and fates[i - 1] is not None and f[0] != at):
                    return np.inf
                cost += rows.skip[at : f[0]].sum() + prices[i][f]
                at = f[1]
        return cost + rows.skip[at:].sum()

    spans = [(a, b) for a in range(k) for b in range(a + 1, k + 1)]
    every = {f: total(f) for f in itertools.product([None, *spans], repeat=m)}
    best, found = solve(prices, rows.skip, forced)
    assert best == pytest.approx(min(every.values()))
    fates = [None] * m
    for i, a, b, margin in found:
        fates[i] = (a, b)
        assert margin >= -1e-9
    if not any(forced):
        assert total(tuple(fates)) == pytest.approx(best)
        for i, a, b, margin in found:
            assert margin == pytest.approx(min(c for f, c in every.items() if f[i] != (a, b)) - best)


def test_regions():
    assert page_columns(["vänsterkolumn", "kolumn 2"]) == 2 and page_columns(["mittkolumn", "vänsterkolumn", "högerkolumn"]) == 3
    assert region_of("Kolumn 1", 2) == ("vänsterkolumn", ()) and region_of("högerkolumn, spelartext", 2) == ("högerkolumn", ())
    assert region_of("vänster-/mittkolumn", 3)[1] == ("vänsterkolumn", "mittkolumn") and region_of("sidfot", 0) == ("sidfot", ())


def test_scale_of_each_book(spark):
    rows = []
    for book, scale in (("a", 100), ("b", 50)):
        for p in range(8):
            rows += [(book, p, i, 100 * p + i, "paragraph", "vänsterkolumn", 0.1, 0.9 - 0.02 * i, w, 0.01, round(scale * w), False, False, 1, False) for i, w in enumerate(WIDTHS)]
    df = spark.createDataFrame(rows, "book string, page int, idx int, id long, type string, region string, x double, y double, w double, h double, chars int, hyphen boolean, small boolean, bands int, removed boolean")
    got = bind_elements(df).collect()
    assert len(got) == 80 and all(r["id"] % 100 == r["first"] and r["rows"] == 1 for r in got)
    assert [v for k, v in page_samples([el(i, 40, w=0.4) for i in range(4)]) if k == "region"] == [pytest.approx(100)]
