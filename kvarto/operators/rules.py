"""Screening of elements: a registry of rules and one pass that applies them all.

A rule looks at one element together with figures of its page and says nothing or gives a finding. Page figures are windows
over (book, page), whose size a page bounds, so all rules run in one stage after one shuffle; findings are rows, never changes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """`finding` is null or the proposed text ('' where only a flag is meant); `carriers`: the rule looks at every text an element carries."""

    name: str
    kind: str
    finding: Callable[[Column], Column]
    carriers: bool = False


RULES: list[Rule] = []


def rule(name: str, kind: str, carriers: bool = False):
    def add(f: Callable[[Column], Column]):
        RULES.append(Rule(name, kind, f, carriers))
        return f

    return add


def carriers() -> Column:
    """Every text of an element with its place: its own, headers, cells, list items."""
    own = F.array(F.struct(F.lit("text").alias("place"), F.col("text").alias("text")))
    listed = lambda c, name: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x, i: F.struct(F.concat(F.lit(f"{name} "), i.cast("string")).alias("place"), x.alias("text")))
    rows = F.coalesce(F.col("rows"), F.array().cast("array<array<string>>"))
    cells = F.flatten(F.transform(rows, lambda r, i: F.transform(F.coalesce(r, F.array().cast("array<string>")), lambda x, j: F.struct(F.concat(F.lit("cell "), i.cast("string"), F.lit("."), j.cast("string")).alias("place"), x.alias("text")))))
    return F.filter(F.concat(own, listed(F.col("headers"), "header"), cells, listed(F.col("items"), "item")), lambda c: c["text"].isNotNull())


@rule("heading-dash", "proposal")
def heading_dash(_: Column) -> Column:
    """A heading in capitals with a rule mark before or after it."""
    bare = F.regexp_replace("text", r"^[-–—•]\s+|\s+[-–—•]$", "")
    return F.when((F.col("type") == "heading") & (bare != F.col("text")) & bare.rlike(r"^[\p{Lu}\s]{3,}$"), bare)


@rule("straight-quotes", "proposal", carriers=True)
def straight_quotes(text: Column) -> Column:
    return F.when((F.col("type") != "illustration") & text.rlike("['\"]"), F.translate(text, "'\"", "’”"))


#: fixed values: what recognition makes of ±0
PLUS_MINUS_ZERO = ("t0", "T0", "I0", "i0", "l0", "*0", "+0", "|0", "±O", "±o")


@rule("plus-minus", "proposal", carriers=True)
def plus_minus(text: Column) -> Column:
    """What recognition makes of ±0."""
    return F.when(text.isin(*PLUS_MINUS_ZERO), "±0")


@rule("plus-minus-ambiguous", "flag", carriers=True)
def plus_minus_ambiguous(text: Column) -> Column:
    return F.when(text == "10", "")


@rule("plus-minus-signed", "proposal", carriers=True)
def plus_minus_signed(text: Column) -> Column:
    return F.when(text.rlike(r"^±[1-9]\d*$"), F.regexp_replace(text, "^±", "+"))


@rule("dot-leaders", "flag", carriers=True)
def dot_leaders(text: Column) -> Column:
    return F.when(text.rlike(r"\.{4,}"), "")


@rule("column-collapse", "flag")
def column_collapse(_: Column) -> Column:
    """A table of three rows or more that has a single column."""
    return F.when((F.col("type") == "table") & (F.size("rows") >= 3) & (F.array_max(F.transform("rows", lambda r: F.size(r))) <= 1), "")


@rule("column-merge", "flag")
def column_merge(_: Column) -> Column:
    """A text much wider than nearly all boxes of its page."""
    return F.when((F.col("page_boxes") >= 5) & (F.col("w") > 1.4 * F.col("page_p90")) & (F.length("text") >= 40), "")


@rule("box-miscoupling", "flag")
def box_miscoupling(_: Column) -> Column:
    """A heading or caption without a box on a page where most elements have one."""
    return F.when(F.col("type").isin("heading", "table_caption") & F.col("x").isNull() & (F.col("page_measured") >= 0.5), "")


@rule("shifted-chain", "flag")
def shifted_chain(_: Column) -> Column:
    """A paragraph whose width for a character is off its page's middle by a factor of two or more."""
    ratio = F.greatest(F.col("char_width") / F.col("page_char_width"), F.col("page_char_width") / F.col("char_width"))
    return F.when((F.col("page_paragraphs") >= 8) & (ratio >= 2), "")


@rule("bullet-paragraph", "proposal")
def bullet_paragraph(_: Column) -> Column:
    return F.when((F.col("type") == "paragraph") & F.col("text").rlike(r"^[•▪·*]\s"), F.regexp_replace("text", r"^[•▪·*]\s+", ""))


def _finder(r: Rule) -> Callable[[Column], Column]:
    return lambda c: F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), c["place"].alias("place"), r.finding(c["text"]).alias("proposal"))


def scan(elements: DataFrame, chosen: list[Rule] | None = None) -> DataFrame:
    """(element_key, rule, kind, place, proposal) of all findings; removed elements are passed over."""
    page = Window.partitionBy("book", "page")
    e = elements.filter(~F.coalesce("removed", F.lit(False)))
    e = e.withColumn("char_width", F.when((F.col("type") == "paragraph") & (F.col("w") > 0) & (F.length("text") > 0) & F.col("bands").isNotNull(), F.col("w") * F.greatest(F.size("bands"), F.lit(1)) / F.length("text")))
    widths = F.array_sort(F.collect_list("w").over(page))
    e = e.withColumns({"widths__": widths, "page_measured": F.avg(F.col("x").isNotNull().cast("int")).over(page), "page_char_width": F.median("char_width").over(page), "page_paragraphs": F.count("char_width").over(page)})
    e = e.withColumns({"page_boxes": F.size("widths__"), "page_p90": F.get("widths__", F.bround(F.lit(0.9) * (F.size("widths__") - 1)).cast("int"))}).drop("widths__")
    found: list[Column] = []
    for r in chosen or RULES:
        if r.carriers:
            each = F.transform(F.col("carriers__"), _finder(r))
        else:
            each = F.array(F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit("element").alias("place"), r.finding(F.col("text")).alias("proposal")))
        found.append(F.filter(each, lambda f: f["proposal"].isNotNull()))
    listed = e.withColumn("carriers__", carriers()).select("element_key", F.explode(F.concat(*found)).alias("f"))
    return listed.select("element_key", "f.*")
