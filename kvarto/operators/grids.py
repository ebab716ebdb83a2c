"""Tables that stand as loose short texts: grids of texts in rows and recurring columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvarto.operators.boxes import union_box

LONGEST_CELL, COLUMN_GAP, ROW_SHARE, RUN_GAP, LEAST_ROWS, LEAST_COLUMNS = 40, 0.03, 0.6, 3.0, 3, 2


def grid_blocks(x: np.ndarray, y: np.ndarray, h: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Blocks of (item, row, column): runs of rows that pair at least two columns which recur in at least three rows."""
    if len(x) < LEAST_ROWS * LEAST_COLUMNS:
        return []
    by_x = np.argsort(x, kind="stable")
    column = np.empty(len(x), int)
    column[by_x] = np.concatenate([[0], np.cumsum(np.diff(x[by_x]) > COLUMN_GAP)])
    height = float(np.median(h))
    reach = max(ROW_SHARE * height, 0.004)
    row, top, number = np.empty(len(x), int), None, -1
    for i in np.lexsort((x, -y)):
        if top is None or top - y[i] > reach:
            top, number = y[i], number + 1
        row[i] = number
    recurring = [c for c in np.unique(column) if len(np.unique(row[column == c])) >= LEAST_ROWS]
    keep = np.isin(column, recurring)
    paired = [r for r in range(number + 1) if len(set(column[keep & (row == r)])) >= LEAST_COLUMNS]
    blocks: list[list[int]] = []
    last = None
    for r in paired:
        at = y[row == r].max()
        if last is None or last - at > max(RUN_GAP * height, 0.02):
            blocks.append([])
        blocks[-1].append(r)
        last = at
    return [[(int(i), n, int(column[i])) for n, r in enumerate(b) for i in np.flatnonzero(keep & (row == r))] for b in blocks if len(b) >= LEAST_ROWS]


def table_blocks(elements: DataFrame) -> DataFrame:
    """(book, page, region, block, row, col, element_key) of short paragraphs that form grids; boxes and texts must be known."""
    short = elements.filter(f"type IN ('paragraph', 'boxed_text') AND x IS NOT NULL AND y IS NOT NULL AND h IS NOT NULL AND length(trim(text)) BETWEEN 1 AND {LONGEST_CELL} AND NOT coalesce(removed, false)")
    short = short.selectExpr("book", "page", "coalesce(region, '') AS region", "element_key", "x", "y", "h")

    def find(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("element_key").reset_index(drop=True)
        blocks = grid_blocks(part["x"].to_numpy(), part["y"].to_numpy(), part["h"].to_numpy())
        rows = [(*key, b, r, sorted({c for _, _, c in block}).index(c), part["element_key"][i]) for b, block in enumerate(blocks) for i, r, c in block]
        return pd.DataFrame(rows, columns=["book", "page", "region", "block", "row", "col", "element_key"])

    return short.groupBy("book", "page", "region").applyInPandas(find, "book string, page int, region string, block int, row int, col int, element_key long")


def proposals(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(book, page, region, block, shape, columns, rows, x, y, w, h, confidence): what each grid would be as a table.

    A block is a `rectangle` if all its rows have the same columns and no slot holds two cells, else `uneven`; a slot with two
    cells is null. Its box is that of all cells, its confidence the least. elements: element_key, text, x, y, w, h, confidence.
    """
    block = ["book", "page", "region", "block"]
    cells = blocks.join(elements.select("element_key", "text", "x", "y", "w", "h", "confidence"), "element_key")
    slots = cells.groupBy(*block, "row", "col").agg(F.count("*").alias("n"), F.min("text").alias("text"))
    rows = slots.groupBy(*block, "row").agg(F.array_sort(F.collect_list(F.struct("col", F.when(F.col("n") == 1, F.col("text")).alias("text")))).alias("cells"), F.max("n").alias("most"))
    columns = F.array_distinct(F.transform("rows", lambda r: F.transform(r["cells"], lambda c: c["col"])))
    whole = rows.groupBy(*block).agg(F.array_sort(F.collect_list(F.struct("row", "cells"))).alias("rows"), F.max("most").alias("most"))
    shape = F.when((F.size(columns) == 1) & (F.col("most") == 1), "rectangle").otherwise("uneven")
    texts = F.transform("rows", lambda r: F.transform(r["cells"], lambda c: c["text"]))
    grids = whole.select(*block, shape.alias("shape"), F.array_max(F.transform(columns, lambda c: F.size(c))).alias("columns"), texts.alias("rows"))
    boxes = cells.groupBy(*block).agg(*union_box(F.col("x"), F.col("y"), F.col("w"), F.col("h")), F.min("confidence").alias("confidence"))
    return grids.join(boxes, block)


def header_rows(blocks: DataFrame, elements: DataFrame, reach: float = 3.0) -> DataFrame:
    """(book, page, region, block, headers): the row right above a grid, if it has one text over each of its columns.

    A text belongs to the column whose cells' left edge it shares within the column gap, and stands at most `reach` cell
    heights above the grid. elements: book, page, region, element_key, text, x, y, h; pairs are bounded by a page's region.
    """
    block = ["book", "page", "region", "block"]
    cells = blocks.join(elements.select("element_key", "x", "y", "h"), "element_key")
    edges = cells.groupBy(*block, "col").agg(F.min("x").alias("col_x"))
    tops = cells.groupBy(*block).agg(F.max("y").alias("top"), F.max("h").alias("height"), F.count_distinct("col").alias("cols"))
    above = elements.withColumn("region", F.coalesce("region", F.lit(""))).select("book", "page", "region", F.col("element_key").alias("head"), "text", "x", "y").join(blocks.select(F.col("element_key").alias("head")), "head", "left_anti")
    near = above.join(tops, ["book", "page", "region"]).filter((F.col("y") > F.col("top")) & (F.col("y") - F.col("top") <= reach * F.col("height")))
    first = near.groupBy(*block).agg(F.min("y").alias("line"))
    line = near.join(first, block).filter(F.abs(F.col("y") - F.col("line")) <= ROW_SHARE * F.col("height"))
    placed = line.join(edges, block).filter(F.abs(F.col("x") - F.col("col_x")) <= COLUMN_GAP)
    one_each = placed.groupBy(*block, "cols", "col").agg(F.count("*").alias("n"), F.min("text").alias("text")).groupBy(*block, "cols").agg(F.array_sort(F.collect_list(F.struct("col", "text"))).alias("h"), F.max("n").alias("most"))
    counts = line.groupBy(*block).agg(F.count("*").alias("texts"))
    return one_each.join(counts, block).filter("most = 1 AND size(h) = cols AND texts = cols").select(*block, F.transform("h", lambda c: c["text"]).alias("headers"))
