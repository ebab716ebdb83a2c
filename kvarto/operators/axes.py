"""Tables from measured cells: the column axis that headers set up, and cells laid onto it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

ROW_SHARE, COLUMN_SHARE = 0.6, 0.5


@dataclass
class Box:
    text: str
    x: float
    y: float
    w: float
    h: float

    @property
    def middle(self) -> float:
        return self.x + self.w / 2


@dataclass
class Axis:
    """Columns from left to right (label, middle) and headings that span several of them (label, column numbers)."""

    columns: list[tuple[str, float]] = field(default_factory=list)
    spans: list[tuple[str, list[int]]] = field(default_factory=list)


def printed_rows(boxes: Sequence[Box], reach: float | None = None) -> list[list[Box]]:
    """Boxes by printed row from the top, each row from the left; a row takes what is near its topmost box."""
    if not boxes:
        return []
    reach = ROW_SHARE * sorted(b.h for b in boxes)[len(boxes) // 2] if reach is None else reach
    rows: list[list[Box]] = []
    for b in sorted(boxes, key=lambda b: (-b.y, b.x)):
        if rows and rows[-1][0].y - b.y <= reach:
            rows[-1].append(b)
        else:
            rows.append([b])
    return [sorted(r, key=lambda b: b.x) for r in rows]


def column_axis(headers: Sequence[Box]) -> Axis:
    """The lowest row of headers names the columns. A header above two or more of them spans these, above one it opens that label, above none it is a column itself."""
    rows = printed_rows(headers)
    if not rows:
        return Axis()
    labels = [[b.text, b.middle, b.x, b.x + b.w] for b in rows[-1]]
    spans = []
    for row in reversed(rows[:-1]):
        for b in row:
            under = [c for c in labels if min(c[3], b.x + b.w) - max(c[2], b.x) > 0]
            if len(under) > 1:
                spans.append((b.text, under))
            elif under:
                under[0][0] = f"{b.text} {under[0][0]}"
            else:
                labels.append([b.text, b.middle, b.x, b.x + b.w])
    labels.sort(key=lambda c: c[1])
    return Axis([(c[0], c[1]) for c in labels], [(text, [i for i, c in enumerate(labels) if any(c is u for u in under)]) for text, under in spans])


def lay_out(headers: Sequence[Box], cells: Sequence[Box]) -> tuple[Axis, list[list[str | None]] | None, str | None]:
    """(axis, rows, reason): each cell in its nearest column. Two cells in one place, or one too far from all columns, refuse the whole table."""
    axis = column_axis(headers)
    if not axis.columns:
        return axis, None, "no headers"
    middles = [m for _, m in axis.columns]
    pitch = min((b - a for a, b in zip(middles, middles[1:])), default=1.0)
    out: list[list[str | None]] = []
    for row in printed_rows(cells):
        line: list[str | None] = [None] * len(middles)
        for b in row:
            at = min(range(len(middles)), key=lambda i: abs(middles[i] - b.middle))
            if len(middles) > 1 and abs(middles[at] - b.middle) > COLUMN_SHARE * pitch:
                return axis, None, f"outside all columns: {b.text}"
            if line[at] is not None:
                return axis, None, f"two cells in one place: {b.text}"
            line[at] = b.text
        out.append(line)
    return axis, out, None


def assemble_measured(cells: DataFrame) -> DataFrame:
    """(book, page, headers, spans, rows, reason) of each page's loose cells (book, page, kind, text, x, y, w, h).

    kind is table_header or table_cell. Unmeasured cells refuse the table (reason `unmeasured`); null texts are empty cells.
    """

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        columns = ["book", "page", "headers", "spans", "rows", "reason"]
        if part[["x", "y", "w", "h"]].isna().any().any():
            return pd.DataFrame([(*key, None, None, None, "unmeasured")], columns=columns)
        part = part.sort_values(["y", "x", "text"], ascending=[False, True, True])
        boxes = {k: [Box(t or "", x, y, w, h) for t, x, y, w, h in zip(g["text"], g["x"], g["y"], g["w"], g["h"])] for k, g in part.groupby("kind")}
        axis, rows, reason = lay_out(boxes.get("table_header", []), boxes.get("table_cell", []))
        spans = [{"label": t, "columns": c} for t, c in axis.spans]
        return pd.DataFrame([(*key, [t for t, _ in axis.columns], spans, rows, reason)], columns=columns)

    kept = cells.filter("kind IN ('table_header', 'table_cell')").select("book", "page", "kind", "text", "x", "y", "w", "h")
    return kept.groupBy("book", "page").applyInPandas(build, "book string, page int, headers array<string>, spans array<struct<label: string, columns: array<int>>>, rows array<array<string>>, reason string")
