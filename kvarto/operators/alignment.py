"""Binding of texts to measured rows of a page: the cheapest assignment that keeps the order, with a margin for each binding.

The states (texts done, rows done, bound to the row before) form a graph without cycles; steps leave a row empty, leave a text
without rows, or bind a text to the next few rows. Shortest distances from the start and to the end give, for each text,
the cheapest solution in which it fares differently: how sure its binding is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

NO_ROW = 1.0  # a text without rows
EMPTY_ROW = 0.6  # a row without text
#: a continued word must go on in the very next row
_HYPHENS = "-¬"


def width_cost(chars: int, widths: Sequence[float], scale: float, tolerance: float = 0.05) -> float:
    """How far the width that a text needs is from that of the rows, as a share of it, within 0 and 2."""
    have = float(sum(widths))
    return min(2.0, max(0.0, abs(chars / scale - have) / max(have, 1e-9) - tolerance))


def bind(texts: Sequence[str], widths: Sequence[float], scale: float, span: int = 8, cost: Callable = width_cost) -> tuple[float, list[tuple[int, int, int, float]]]:
    """(total cost, [(text, first row, number of rows, margin)]) of the cheapest assignment.

    A text after one that ends in a hyphen is bound to the row that follows, or neither may be unbound between them.
    """
    m, k = len(texts), len(widths)
    forced = [i > 0 and texts[i - 1].rstrip()[-1:] in _HYPHENS and bool(texts[i - 1].strip()) for i in range(m)]
    steps: dict[tuple[int, int, int], list[tuple[float, tuple[int, int, int], int]]] = {}
    for i in range(m + 1):
        for j in range(k + 1):
            for f in (0, 1):
                out = []
                if j < k and not (f and i < m and forced[i]):
                    out.append((EMPTY_ROW, (i, j + 1, 0), 0))
                if i < m and not forced[i]:
                    out.append((NO_ROW, (i + 1, j, 0), -1))
                if i < m and forced[i] and not f:
                    out.append((NO_ROW, (i + 1, j, 0), -1))  # the word before has no row either
                if i < m and (f or not forced[i]):
                    out += [(cost(len(texts[i]), widths[j : j + n], scale), (i + 1, j + n, 1), n) for n in range(1, min(span, k - j) + 1)]
                steps[i, j, f] = out
    ahead = {s: np.inf for s in steps}
    ahead[m, k, 0] = ahead[m, k, 1] = 0.0
    order = sorted(steps)
    for s in reversed(order):
        for c, to, _ in steps[s]:
            ahead[s] = min(ahead[s], c + ahead[to])
    behind = {s: np.inf for s in steps}
    behind[0, 0, 0] = 0.0
    for s in order:
        for c, to, _ in steps[s]:
            behind[to] = min(behind[to], behind[s] + c)
    best = ahead[0, 0, 0]
    fates: list[list[tuple[float, tuple[int, int]]]] = [[] for _ in range(m)]
    for s in order:
        for c, to, n in steps[s]:
            if n:
                fates[s[0]].append((behind[s] + c + ahead[to], (s[1], n) if n > 0 else (-1, -1)))
    out, s = [], (0, 0, 0)
    while s[:2] != (m, k):
        c, to, n = min(steps[s], key=lambda x: (x[0] + ahead[x[1]], -x[2]))
        if n > 0:
            other = min((t for t, fate in fates[s[0]] if fate != (s[1], n)), default=np.inf)
            out.append((s[0], s[1], n, float(other - best)))
        s = to
    return float(best), out


def bind_pages(texts: DataFrame, rows: DataFrame, groups: Sequence[str], scale: float) -> DataFrame:
    """(groups.., id, first, rows, margin) for texts (groups.., idx, id, text) and measured rows (groups.., y, w), a page's part at a time.

    Groups without rows or without texts bind nothing; null texts need no row. Rows go from the top (greatest y) down.
    """
    names = ", ".join(f"{g} {texts.schema[g].dataType.simpleString()}" for g in groups)
    schema = f"{names}, id {texts.schema['id'].dataType.simpleString()}, first int, rows int, margin double"

    def solve(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left[left["text"].notna()].sort_values(["idx", "id"])
        right = right[right["w"].notna()].sort_values(["y", "w"], ascending=False)
        found = bind(left["text"].tolist(), right["w"].tolist(), scale)[1] if len(left) and len(right) else []
        ids = left["id"].tolist()
        return pd.DataFrame([(*key, ids[i], j, n, margin) for i, j, n, margin in found], columns=[*groups, "id", "first", "rows", "margin"])

    return texts.groupBy(*groups).cogroup(rows.groupBy(*groups)).applyInPandas(solve, schema)
