"""Binding of a page's elements to its measured rows, with the penalties of the print and only what is proved accepted.

Regions are brought to the page's columns first; elements that name two columns only hold their place there. Each region is an
assignment that keeps the order: `costs` prices an element over every span of rows, `solve` finds the cheapest assignment and
each binding's margin, `accepted` keeps bindings of runs that a shift by one row would make dearer, or that proved runs and edges
wedge in. The scale (letters for a unit of width) and whether an element is a row or a paragraph are measured for each book.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTAINERS = ("list", "table", "statblock")
RAGGED_TYPES = ("paragraph", "boxed_text", "list_item")
#: letters for a unit of width against a paragraph's, and the spread that costs nothing; other types have no width evidence
TYPE_SCALE = {
    "paragraph": (1.0, 0.15), "boxed_text": (1.017, 0.14), "list_item": (1.123, 0.15), "list": (1.123, 0.3), "table_note": (1.112, 0.45),
    "table_caption": (1.05, 0.45), "heading": (0.625, 0.55), "statblock": (0.552, 0.4), "table": (0.523, 0.8),
}
EMPTY_TEXT_ROW, EMPTY_GRAPHIC_ROW, NO_ROW, MOST = 0.6, 0.05, 1.0, 6.0
TEXT_HEIGHTS, PITCH_SLACK, DARK, DARK_COST, GAP_COST = (0.55, 1.7), 0.28, 0.6, 2.0, 1.0
INDENT, INDENT_COST, HEADING_HEIGHT, HEADING_COST, CLIPPED = (0.01, 0.045), 0.8, 1.25, 0.8, 0.02
RAGGED_SHARE, RAGGED_COST, LEAST_RAGGED = 0.92, 0.8, 0.1
MARGIN, SHIFT, LONGEST = 0.15, 0.5, 80

_COLUMNS = {2: ("vänsterkolumn", "högerkolumn"), 3: ("vänsterkolumn", "mittkolumn", "högerkolumn")}


@lru_cache(maxsize=10_000)
def references(name: str) -> tuple[str, ...]:
    """The distinct columns that a region's name points out."""
    numbered = [f"nr{n}" for n in re.findall(r"(?:kolumn|spalt)\s*(\d{1,9})", name)]
    named = [n for p, n in (("vänster", "vänster"), (r"mitt(en|ersta)?( ?kolumn| ?spalt)", "mitt"), ("höger", "höger")) if re.search(p, name)]
    return tuple(dict.fromkeys(numbered + named))


@lru_cache(maxsize=10_000)
def region_of(name: str | None, count: int) -> tuple[str | None, tuple[str, ...]]:
    """(region, columns held): a free name in terms of a page's `count` columns; a name of two columns or more is in none and holds all."""
    columns = _COLUMNS.get(count, ())
    washed = re.sub(r"\s+", " ", (name or "").lower()).strip()
    for r in dict.fromkeys((washed, washed.split(",", 1)[0].strip())):
        for furniture in ("sidhuvud", "sidfot", "marginal"):
            if r.startswith(furniture):
                return furniture, ()
        refs = references(r)
        if len(refs) > 1:
            held = [c for c, word in zip(columns, ("vänster", "mitt", "höger") if count == 3 else ("vänster", "höger")) if word in r]
            return name, tuple(held) if len(held) > 1 else ()
        if re.search("helbredd|hela sidan|full bredd", r):
            return "helbredd", ()
        if refs and columns:
            ref = refs[0]
            i = int(ref[2:]) - 1 if ref.startswith("nr") else {"vänster": 0, "höger": count - 1}.get(ref, 1 if count == 3 else -1)
            if 0 <= i < count:
                return columns[i], ()
    return name, ()


def page_columns(names: Sequence[str | None]) -> int:
    refs = {r for n in set(names) if n for r in references(re.sub(r"\s+", " ", n.lower()).strip())}
    named = (3 if "mitt" in refs else 2) if {"vänster", "höger"} <= refs else 0
    return max([named, *[int(r[2:]) for r in refs if r.startswith("nr")]])


class Rows:
    """Measured rows (x, y, w, h) of a region from the top down, with what the prices need of them."""

    def __init__(self, boxes: Sequence[tuple], many: bool, dark: Sequence[float | None] | None = None, gaps: Sequence[bool] | None = None):
        b = np.array(boxes, float).reshape(-1, 4)
        x, y, w, h = b.T
        k = self.k = len(b)
        black = np.array([d is not None and d >= DARK for d in dark], bool) if dark else np.zeros(k, bool)
        sums = lambda v: np.concatenate([[0.0], np.cumsum(v)])
        span = lambda s: s[None, :] - s[:, None]
        self.n = span(np.arange(k + 1))
        trusted, indented, headings = np.ones(k, bool), np.zeros(k, bool), np.zeros(k, bool)
        self.full = full = float(np.sort(w)[min(int(0.85 * k), k - 1)]) or None if many else None
        if many:
            edge, height = median(x.tolist()), median(h.tolist())
            indented = (x - edge >= INDENT[0]) & (x - edge <= INDENT[1])
            trusted = x - edge <= INDENT[1]
            if full:
                trusted &= x + w <= edge + full + CLIPPED
            if height > 0:
                headings = h / height >= HEADING_HEIGHT
        self.trusted, self.indented, self.many = trusted, indented, many
        self.spans = {longest: (self.n >= 1) & (self.n <= longest) for longest in (1, LONGEST)}
        self.width, self.known = span(sums(w * trusted)), span(sums(trusted))
        self.some, self.void = self.known > 0, (self.known > 0) & (self.width <= 0)
        self.share, self.divisor = self.known / np.maximum(self.n, 1), np.maximum(self.known, 1)
        self.black = DARK_COST * span(sums(black))
        self.gaps = np.zeros((k + 1, k + 1))
        if gaps and k > 1:
            g = sums([*gaps, False])
            self.gaps[:, 1:] = np.where(self.n[:, 1:] > 1, GAP_COST * (g[None, :k] - g[:k + 1, None]), 0)
        self.skip = self._skips(y, h, black)
        self.extra = np.zeros((k + 1, k + 1))
        for a in range(k):
            most = np.maximum.accumulate(self.skip[a:])
            self.extra[a, a + 1 :] = np.cumsum(self.skip[a:]) - most
        self.short = (w < RAGGED_SHARE * full).sum() if full else 0
        self.ragged, self.inside, self.heads = np.zeros((k + 1, k + 1)), np.zeros((k + 1, k + 1)), np.zeros((k + 1, k + 1))
        if many:
            self.heads = HEADING_COST * span(sums(headings))
            i = sums(indented)
            later = np.append(i[1:], i[-1])
            self.inside = np.where(self.n > 1, INDENT_COST * (i[None, :] - later[:, None]), 0)
        if full:
            brief = trusted & (w < RAGGED_SHARE * full)
            s = sums(brief)
            inner = np.zeros((k + 1, k + 1))
            inner[:, 1:] = s[None, :k] - s[:, None]
            inner[:k] -= (brief & indented)[:, None]
            last = trusted & (w >= RAGGED_SHARE * full) & ~np.append(indented[1:], False)
            inner[:, 1:] += last[None, :]
            self.ragged = np.where(self.n > 1, np.minimum(RAGGED_COST * inner, MOST), 0)

    @staticmethod
    def _skips(y: np.ndarray, h: np.ndarray, black: np.ndarray) -> np.ndarray:
        """The price of leaving each row empty: dear where it looks like a row of text in height, pitch and ink."""
        middle = median(h.tolist())
        if middle <= 0:
            return np.full(len(y), EMPTY_TEXT_ROW)
        steps = y[:-1] - y[1:]
        down = steps[steps > 0]
        pitch = median(down.tolist()) if len(down) else 0.0
        even = np.ones(len(y), bool)
        if pitch > 0:
            ok = (steps > 0) & (np.abs(steps - pitch) / pitch <= PITCH_SLACK)
            even = np.append(ok, False) | np.insert(ok, 0, False)
        text = (h / middle >= TEXT_HEIGHTS[0]) & (h / middle <= TEXT_HEIGHTS[1]) & even & ~black
        return np.where(text, EMPTY_TEXT_ROW, EMPTY_GRAPHIC_ROW)


def costs(rows: Rows, kind: str, chars: int, scale: float, small: bool = False, holder: bool = False) -> np.ndarray:
    """[first row, row after the last] -> price of binding an element there; `small`: its text begins with a small letter."""
    factor, slack = TYPE_SCALE.get(kind, (None, None))
    gaps = rows.gaps if kind not in CONTAINERS else 0
    if factor is None or holder:
        out = rows.black + rows.extra + gaps
    else:
        more = (rows.black if kind != "heading" else 0) + gaps
        ragged = 0.0
        if rows.many and kind in RAGGED_TYPES:
            more = more + rows.inside + rows.heads
            if small:
                more = more + INDENT_COST * np.append(rows.indented, False)[:, None]
            ragged = rows.ragged
        if chars:
            need, have = chars * rows.share, scale * factor * rows.width
            off = np.abs(need - have) / np.maximum(1e-9, np.minimum(need, have))
            tolerance = slack / rows.divisor if rows.many else slack
            priced = np.minimum(np.maximum(off - tolerance, 0), MOST) + more + ragged
            out = np.where(rows.some, priced, more + ragged)
        else:
            out = np.where(rows.some, more + 0.0 * rows.n, more + ragged)
        out = np.where(rows.void, np.inf, out)
    return np.where(rows.spans[LONGEST if rows.many or kind in CONTAINERS else 1], out, np.inf)


def solve(prices: Sequence[np.ndarray], skip: np.ndarray, forced: Sequence[bool]) -> tuple[float, list[tuple[int, int, int, float]]]:
    """(total, [(element, first row, row after the last, margin)]) of the cheapest assignment in order.

    A forced element (one that ends the word begun before) is bound to the row after its neighbour, if that is bound.
    """
    m, k = len(prices), len(skip)
    tail = np.concatenate([np.cumsum(skip[::-1])[::-1], [0.0]])
    ahead = np.full((m + 1, 2, k + 1), np.inf)
    ahead[m] = tail
    choice: list[list] = [[] for _ in range(m)]
    follow = lambda i: ahead[i + 1][1 if i + 1 < m and forced[i + 1] else 0]
    for i in range(m - 1, -1, -1):
        total = prices[i] + follow(i)[None, :]
        ends = total.argmin(axis=1).tolist()
        bound = total.min(axis=1)
        bound[k] = NO_ROW * (m - i)
        ahead[i][1] = bound
        free, unbound = bound.tolist(), ahead[i + 1][0].tolist()
        steps: list = [None] * (k + 1)
        for j in range(k - 1, -1, -1):
            best, step = free[j + 1] + skip[j], -1
            if NO_ROW + unbound[j] < best:
                best, step = NO_ROW + unbound[j], -2
            if free[j] < best:
                best, step = free[j], ends[j]
            free[j], steps[j] = best, step
        ahead[i][0] = free
        choice[i] = [steps, ends]
    best = float(ahead[0][0][0])
    if not np.isfinite(best):
        return best, []
    tied, open_ = np.full((m + 1, k + 1), np.inf), np.full((m + 1, k + 1), np.inf)
    open_[0] = tail[0] - tail
    start = lambda i: tied[i] if forced[i] else open_[i]
    for i in range(1, m + 1):
        tied[i] = (start(i - 1)[:, None] + prices[i - 1]).min(axis=0)
        now, before = tied[i].tolist(), open_[i - 1].tolist()
        free_to = not forced[i - 1]
        now[0] = before[0] + NO_ROW if free_to else np.inf
        for j in range(1, k + 1):
            now[j] = min(now[j], now[j - 1] + skip[j - 1], before[j] + NO_ROW if free_to else np.inf)
        open_[i] = now
    out, i, j, f = [], 0, 0, 0
    while i < m and j < k:
        step = choice[i][1][j] if f else choice[i][0][j]
        if f and not np.isfinite(ahead[i][1][j]):
            break
        if step == -1:
            j += 1
        elif step == -2:
            i, f = i + 1, 0
        else:
            others = start(i)[:, None] + prices[i] + follow(i)[None, :]
            others[j, step] = np.inf
            other = float(others[:k].min())
            if not forced[i] and not (i + 1 < m and forced[i + 1]):
                other = min(other, float((open_[i] + NO_ROW + ahead[i + 1][0]).min()))
            out.append((i, j, step, other - best))
            i, j = i + 1, step
            f = 1 if i < m and forced[i] else 0
    return best, out


def accepted(found: list[tuple[int, int, int, float]], prices: Sequence[np.ndarray], rows: Rows, holders: set[int]) -> list[tuple[int, int, int, float]]:
    """The bindings that are measured and not merely likely."""
    k = rows.k
    runs: list[list[tuple[int, int, int, float]]] = []
    for b in found:
        if runs and runs[-1][-1][2] == b[1]:
            runs[-1].append(b)
        else:
            runs.append([b])
    even = len(found) == len(prices) and sum(b - a for _, a, b, _ in found) == k

    def proof(run: list[tuple[int, int, int, float]]) -> float:
        base = sum(prices[i][a, b] for i, a, b, _ in run)
        shifts = [sum(prices[i][a + s, b + s] for i, a, b, _ in run) - base for s in (-1, 1) if run[0][1] + s >= 0 and run[-1][2] + s <= k]
        least = min((float(c) for c in shifts if np.isfinite(c)), default=np.inf)
        return least if np.isfinite(least) or even else 0.0

    sure = [proof(r) >= SHIFT for r in runs]
    changed = True
    while changed:
        changed = False
        for q, run in enumerate(runs):
            if sure[q]:
                continue
            left = run[0][1] == 0 or (q > 0 and sure[q - 1] and runs[q - 1][-1][2] == run[0][1])
            right = run[-1][2] == k or (q + 1 < len(runs) and sure[q + 1] and runs[q + 1][0][1] == run[-1][2])
            if left and right:
                sure[q] = changed = True
    return [b for q, run in enumerate(runs) if sure[q] for b in run if b[3] >= MARGIN and b[0] not in holders and rows.trusted[b[1] : b[2]].any() and prices[b[0]][b[1], b[2]] < NO_ROW]


def bind_page(els: Sequence[dict], scale: float, many: bool) -> list[tuple[str, int, int, int, float]]:
    """(region, id, first row, number of rows, margin) of a page's accepted bindings.

    Elements have id, type, region, chars, hyphen, small, removed in order; measured rows are the elements' boxes.
    """
    count = page_columns([e["region"] for e in els])
    places = [region_of(e["region"], count) for e in els]
    boxes: dict[str | None, list[tuple]] = {}
    for e, (region, _) in zip(els, places):
        if None not in (e["x"], e["y"], e["w"], e["h"]):
            boxes.setdefault(region, []).append((e["x"], e["y"], e["w"], e["h"]))
    out = []
    for region, measured in boxes.items():
        part = [(e, region in held) for e, (r, held) in zip(els, places) if (r == region or region in held) and not e["removed"] and e["type"] != "illustration"]
        if region is None or not part:
            continue
        rows = Rows(sorted(measured, key=lambda b: (-b[1], -b[2])), many)
        if many and any(e["type"] in RAGGED_TYPES for e, _ in part) and rows.short < LEAST_RAGGED * rows.k:
            continue
        prices = [costs(rows, e["type"], e["chars"], scale, e["small"], holder) for e, holder in part]
        forced = [i > 0 and part[i - 1][0]["hyphen"] for i in range(len(part))]
        found = accepted(solve(prices, rows.skip, forced)[1], prices, rows, {i for i, (_, h) in enumerate(part) if h})
        out += [(region, part[i][0]["id"], a, b - a, margin) for i, a, b, margin in found]
    return out


def page_samples(els: Sequence[dict]) -> list[tuple[str, float]]:
    """What a page adds to its book's scale and regime: ('single' | 'region' | 'length' | 'width', value)."""
    count = page_columns([e["region"] for e in els])
    regions: dict[str | None, list[dict]] = {}
    out: list[tuple[str, float]] = []
    for e in els:
        regions.setdefault(region_of(e["region"], count)[0], []).append(e)
        boxed = None not in (e["x"], e["y"], e["w"], e["h"])
        if e["type"] == "paragraph" and e["bands"] == 1 and boxed and e["w"] > 0.05:
            out.append(("single", e["chars"] / e["w"]))
        if e["type"] == "paragraph" and not e["removed"] and e["chars"]:
            out.append(("length", float(e["chars"])))
        if boxed and e["w"] > 0.05:
            out.append(("width", e["w"]))
    for region, part in regions.items():
        rows = [e for e in part if None not in (e["x"], e["y"], e["w"], e["h"])]
        if region in (None, "sidhuvud", "sidfot") or not rows:
            continue
        middle = median(e["h"] for e in rows)
        width = sum(e["w"] for e in rows if middle > 0 and TEXT_HEIGHTS[0] <= e["h"] / middle <= TEXT_HEIGHTS[1])
        texts = [e["chars"] / TYPE_SCALE[e["type"]][0] for e in part if not e["removed"] and e["chars"] and e["type"] in TYPE_SCALE]
        if width > 0 and len(texts) >= 4:
            out.append(("region", sum(texts) / width))
    return out


def bind_elements(elements: DataFrame) -> DataFrame:
    """(book, page, region, id, first, rows, margin) of all accepted bindings.

    Needs book, page, idx, id, type, region, x, y, w, h, chars, hyphen, small, bands (their number), removed. A book's scale is the
    median of its single-row paragraphs if there are 30, else of its regions; a book without either binds nothing.
    """
    item = F.struct("idx", "id", "type", "region", "x", "y", "w", "h", "chars", "hyphen", "small", "bands", "removed")
    pages = elements.groupBy("book", "page").agg(F.collect_list(item).alias("els"))
    kind = elements.schema["id"].dataType.simpleString()

    def read(batch: pa.RecordBatch) -> Iterator[tuple[int, list[dict]]]:
        """Each row's number and elements, converted by fields."""
        lists = batch.column(batch.schema.get_field_index("els"))
        flat = lists.flatten()
        names = [f.name for f in flat.type]
        all_ = [dict(zip(names, v)) for v in zip(*[flat.field(n).to_pylist() for n in names])]
        at = 0
        for i, n in enumerate(lists.value_lengths().to_pylist()):
            yield i, all_[at : at + n]
            at += n

    def ordered(els: list[dict]) -> list[dict]:
        return sorted(els, key=lambda e: (e["idx"] is None, e["idx"] or 0, e["id"]))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            books = batch.column("book").to_pylist()
            out = [(books[i], *s) for i, els in read(batch) for s in page_samples(els)]
            yield pa.RecordBatch.from_pydict({"book": pa.array([o[0] for o in out], pa.string()), "kind": pa.array([o[1] for o in out], pa.string()), "value": pa.array([o[2] for o in out], pa.float64())})

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            book, page, scale, many_rows = (batch.column(n).to_pylist() for n in ("book", "page", "scale", "many"))
            out = [(book[i], page[i], *b) for i, els in read(batch) for b in bind_page(ordered(els), scale[i], many_rows[i])]
            types = (pa.string(), pa.int32(), pa.string(), pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string(), pa.int32(), pa.int32(), pa.float64())
            names = ("book", "page", "region", "id", "first", "rows", "margin")
            yield pa.RecordBatch.from_pydict({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate(zip(names, types))})

    of = lambda name: F.when(F.col("kind") == name, F.col("value"))
    figures = pages.mapInArrow(sampled, "book string, kind string, value double").groupBy("book").agg(
        *[F.median(of(n)).alias(n) for n in ("single", "region", "length", "width")], F.count(of("single")).alias("singles"), F.count(of("length")).alias("lengths")
    )
    scales = figures.withColumn("scale", F.when(F.col("singles") >= 30, F.col("single")).otherwise(F.col("region"))).filter("scale > 0")
    many = F.coalesce((F.col("lengths") >= 10) & (F.col("length") > 1.5 * F.col("scale") * F.col("width")), F.lit(False))
    return pages.join(scales.select("book", "scale", many.alias("many")), "book").mapInArrow(bound, f"book string, page int, region string, id {kind}, first int, rows int, margin double")
