"""Boxes of elements: unions, overlaps, conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_box(x: Column, y: Column, w: Column, h: Column) -> list[Column]:
    """Aggregates for the box around all boxes of a group."""
    return [F.round(F.min(x), 5).alias("x"), F.round(F.min(y), 5).alias("y"), F.round(F.max(x + w) - F.min(x), 5).alias("w"), F.round(F.max(y + h) - F.min(y), 5).alias("h")]


def boxes_of_bands(elements: DataFrame, bands: DataFrame, key: str) -> DataFrame:
    """(key, x, y, w, h, missing): the box around the measured rows that each element names, and how many of them don't exist.

    elements: (book, page, key, bands ARRAY<INT>); bands: (book, page, row_idx, x, y, w, h).
    """
    named = elements.select("book", "page", key, F.explode("bands").alias("row_idx"))
    found = named.join(bands.select("book", "page", "row_idx", "x", "y", "w", "h"), ["book", "page", "row_idx"], "left")
    return found.groupBy(key).agg(*union_box(F.col("x"), F.col("y"), F.col("w"), F.col("h")), F.count_if(F.col("x").isNull()).alias("missing"))


def overlapping(boxes: DataFrame, groups: list[str], key: str, share: float = 0.5) -> DataFrame:
    """(key) of boxes that another one of the group covers by more than `share` of the lower one's height, at any common width.

    A group is a part of a page: only boxes of one page are compared.
    """
    a = boxes.select(*groups, F.col(key).alias("key"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("w").alias("aw"), F.col("h").alias("ah"))
    b = boxes.select(*groups, F.col(key).alias("other"), "x", "y", "w", "h")
    common_y = F.least(F.col("ay") + F.col("ah"), F.col("y") + F.col("h")) - F.greatest("ay", "y")
    common_x = F.least(F.col("ax") + F.col("aw"), F.col("x") + F.col("w")) - F.greatest("ax", "x")
    hit = a.join(b, groups).filter((F.col("key") != F.col("other")) & (F.round(common_x, 9) > 0) & (F.round(common_y - share * F.least("ah", "h"), 9) > 0))
    return hit.select(F.col("key").alias(key)).distinct()


def normalised_box(box: Column, width: Column, height: Column) -> Column:
    """[x0, y0, x1, y1] in points from the top as [x, y, w, h] in shares of the page, y from the bottom, six places."""
    x0, y0, x1, y1 = (F.get(box, F.lit(i)) for i in range(4))
    return F.array(*[F.round(c, 6) for c in (x0 / width, 1 - y1 / height, (x1 - x0) / width, (y1 - y0) / height)])


def dropped_overlaps(boxes: DataFrame, groups: list[str], key: str, first: Column, share: float = 0.5) -> DataFrame:
    """(key, kept): boxes of the first sweep are kept; one of the second is kept if it overlaps no kept box by more than `share` of either height.

    Kept boxes of the second sweep join the comparison in the order of their heights on the page, so this is a fold over the
    boxes of one page, whose number the page bounds.
    """
    item = F.struct((~F.coalesce(first, F.lit(False))).alias("second"), F.col("y"), F.col(key).alias("key"), "x", "w", "h")
    listed = boxes.groupBy(*groups).agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = dict(listed.dtypes)["items"]

    def hits(a: Column, b: Column) -> Column:
        common_y = F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"])
        common_x = F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"])
        return (F.round(common_x, 9) > 0) & (F.round(common_y - share * F.least(a["h"], b["h"]), 9) > 0)

    kept = F.aggregate("items", F.array().cast(kind), lambda acc, x: F.when(~x["second"] | ~F.exists(acc, lambda k: hits(k, x)), F.array_append(acc, x)).otherwise(acc))
    named = listed.select(F.transform("items", lambda x: x["key"]).alias("all"), F.transform(kept, lambda x: x["key"]).alias("kept"))
    return named.select(F.explode("all").alias(key), "kept").select(key, F.array_contains("kept", F.col(key)).alias("kept"))
