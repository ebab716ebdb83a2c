"""Tables of elements: cells, assembly, stitching across pages, rendering."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_VALUES = re.compile(r"\b[A-ZÅÄÖ]{3}\s+\d")
_FIELD = re.compile(r"^([^:\n]{2,40}):\s*(.+)$")
#: labels that any book's statblocks may use
_LABELS = ("Färdigheter", "Färdigheter & Förmågor")


def cells(tables: DataFrame, key: str) -> DataFrame:
    """(key, row, col, header, text) of every cell; ragged rows give what they hold, a missing header is null."""
    rows = tables.select(key, "headers", F.posexplode("rows").alias("row", "cells"))
    each = rows.select(key, "headers", "row", F.posexplode("cells").alias("col", "text"))
    return each.select(key, "row", "col", F.try_element_at("headers", F.col("col") + 1).alias("header"), "text")


def assemble(loose: DataFrame, groups: list[str], order: list[str], columns: Column) -> DataFrame:
    """(groups.., columns, rows, short): loose cells in reading order laid into rows of `columns` cells.

    Cells that don't fill whole rows are refused: rows is null and `short` says how many are missing.
    """
    listed = loose.groupBy(*groups).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda c: c["text"]).alias("cells"), F.max(columns).alias("columns"))
    whole = (F.col("columns") > 0) & (F.size("cells") % F.col("columns") == 0)
    rows = F.transform(F.sequence(F.lit(0), F.floor(F.size("cells") / F.col("columns")).cast("int") - 1), lambda i: F.slice("cells", i * F.col("columns") + 1, F.col("columns")))
    return listed.select(*groups, "columns", F.when(whole, rows).alias("rows"), F.when(whole, 0).otherwise(F.col("columns") - F.size("cells") % F.col("columns")).alias("short"))


def stitch(tables: DataFrame, key: str) -> DataFrame:
    """(head, parts, rows): tables with the same headers, not empty, that follow each other across a page break in a book are one.

    Needs book, page, idx, headers, rows; `head` is the key of the first part. Only the last table of a page can go on, and
    only in the first of the next: chains are found among the tables of a book with the same headers, no window spans a book.
    """
    page = Window.partitionBy("book", "page").orderBy("idx", key)
    w = Window.partitionBy("book", "headers").orderBy("page", "idx", key)
    narrow = tables.select("book", "page", "idx", key, "headers").withColumns({"first__": F.lag(key).over(page).isNull(), "last__": F.lead(key).over(page).isNull()}).filter(F.size("headers") > 0)
    same = F.col("first__") & F.lag("last__").over(w) & (F.col("page") == F.lag("page").over(w) + 1)
    chains = narrow.withColumn("new__", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("chain__", F.sum("new__").over(w))
    heads = chains.select(F.col(key).alias("key__"), F.first(key).over(Window.partitionBy("book", "headers", "chain__").orderBy("page", "idx", key)).alias("head__"))
    part = F.struct("page", "idx", F.col(key).alias("key"), "rows")
    joined = tables.join(heads, F.col(key) == F.col("key__"), "left").groupBy(F.coalesce("head__", key).alias("chain__")).agg(F.array_sort(F.collect_list(part)).alias("p"))
    return joined.select(F.col("p")[0]["key"].alias("head"), F.size("p").alias("parts"), F.flatten(F.transform("p", lambda x: F.coalesce(x["rows"], F.array().cast("array<array<string>>")))).alias("rows"))


def with_list(rows: Column, items: Column) -> Column:
    """Rows of a two-column table with a list after it folded in; null if anything doesn't fit.

    Each item is `key — value`; a first item that begins with a small letter continues the last cell. Empty lists change nothing.
    """
    items = F.coalesce(items, F.array().cast("array<string>"))
    first, last = F.get(items, F.lit(0)), F.get(rows, F.size(rows) - 1)
    goes_on = F.coalesce(first.rlike(r"^\p{Ll}") & ~F.contains(first, F.lit(" — ")), F.lit(False))
    rest = F.when(goes_on, F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(1)))).otherwise(items)
    pairs = F.transform(rest, lambda x: F.split(x, " — ", 2))
    fits = (F.size(rows) > 0) & F.forall(rows, lambda r: F.size(r) == 2) & F.coalesce(F.forall(pairs, lambda p: F.size(p) == 2), F.lit(False))
    longer = F.array(F.get(last, F.lit(0)), F.concat_ws(" ", F.get(last, F.lit(1)), first))
    head = F.when(goes_on, F.concat(F.slice(rows, 1, F.size(rows) - 1), F.array(longer))).otherwise(rows)
    return F.when(fits, F.concat(head, pairs))


def continued_blocks(elements: DataFrame) -> DataFrame:
    """(head, tail) of statblocks cut by a page break: the last element of a page has a name but no values, the first of the next begins with values.

    Needs book, page, idx, element_key, type, text; page artifacts and removed elements are passed over.
    """
    kept = elements.filter("type <> 'page_artifact' AND NOT coalesce(removed, false)")
    at = F.struct("idx", "element_key")
    what = F.struct("element_key", "type", "text")
    pages = kept.groupBy("book", "page").agg(F.max_by(what, at).alias("last"), F.min_by(what, at).alias("first"))
    w = Window.partitionBy("book").orderBy("page")
    joined = pages.withColumns({"next_page": F.lead("page").over(w), "next": F.lead("first").over(w)}).filter("next_page = page + 1")
    values = r"\b\p{Lu}{3}\s+\d"
    cut = (F.col("last.type") == "statblock") & ~F.col("last.text").rlike(values) & (F.col("next.type") == "statblock") & F.col("next.text").rlike("^" + values)
    return joined.filter(cut).select(F.col("last.element_key").alias("head"), F.col("next.element_key").alias("tail"))


def _bare(name: str) -> str:
    return re.sub(r"[ .,:;!?—–-]", "", name.casefold())


def join_block(head: str, after: list[tuple[str, str | None]], labels: set[str]) -> tuple[str, int, str] | None:
    """(kind, number of elements taken, text) of a statblock with what goes on with it among (type, text) of the next page's beginning.

    'values': a block without values and one with them and the same name or none; its name isn't repeated. 'fields': paragraphs
    of lines `label: value` with the book's labels; a line without a label goes on with the value before it. A paragraph with
    anything else, or with a field that the block has, ends it.
    """
    if after and after[0][0] == "statblock" and not _VALUES.search(head) and _VALUES.search(after[0][1] or ""):
        name, _, rest = after[0][1].strip().partition("\n")
        if _VALUES.match(name):
            return "values", 1, head + "\n" + after[0][1].strip()
        return ("values", 1, head + "\n" + rest.strip()) if _bare(name) == _bare(head.strip().split("\n")[0]) else None
    have = {m[1].strip() for m in map(_FIELD.match, head.split("\n")) if m}
    taken, out = 0, head
    for kind, text in after:
        fields: list[list[str]] = []
        lines = [t.strip() for t in (text or "").split("\n") if t.strip()] if kind == "paragraph" else []
        for line in lines:
            m = _FIELD.match(line)
            label = m[1].strip() if m else None
            if label in labels and label not in have:
                have.add(label)
                fields.append([label, m[2].strip()])
            elif label in labels or not fields:
                fields = []
                break
            else:
                fields[-1][1] += " " + line
        if not fields:
            break
        taken += 1
        out += "".join(f"\n{label}: {value}" for label, value in fields)
    return ("fields", taken, out) if taken else None


def stitched_blocks(elements: DataFrame) -> DataFrame:
    """(head, kind, tails, text) of statblocks that go on over a page break, with what follows joined in (see `join_block`).

    Needs what `continued_blocks` does. A block's elements are the end of one page and the beginning of the next, so a page bounds them.
    """
    kept = elements.filter("type <> 'page_artifact' AND NOT coalesce(removed, false)").select("book", "page", "idx", "element_key", "type", "text")
    last = kept.groupBy("book", "page").agg(F.max_by(F.struct("element_key", "type", "text"), F.struct("idx", "element_key")).alias("last")).filter("last.type = 'statblock' AND last.text IS NOT NULL")
    heads = last.select("book", (F.col("page") + 1).cast("int").alias("page"), F.col("last.element_key").alias("head"), F.col("last.text").alias("head_text"))
    after = kept.join(heads, ["book", "page"]).groupBy("book", "head", "head_text").agg(F.array_sort(F.collect_list(F.struct("idx", "element_key", "type", "text"))).alias("after"))
    lines = kept.filter("type = 'statblock'").select("book", F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^([^:\n]{2,40}):[ \t]*\S"), 1)).alias("label"))
    labels = lines.groupBy("book").agg(F.collect_set(F.trim("label")).alias("labels"))
    key = elements.schema["element_key"].dataType.simpleString()

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for head, text, following, known in zip(batch["head"], batch["head_text"], batch["after"], batch["labels"]):
                found = join_block(text, [(e["type"], e["text"]) for e in following], {*_LABELS, *(known if known is not None else ())})
                if found:
                    rows.append((head, found[0], [e["element_key"] for e in following[: found[1]]], found[2]))
            yield pd.DataFrame(rows, columns=["head", "kind", "tails", "text"])

    joined = after.join(labels, "book", "left").select("head", "head_text", "after", "labels").mapInPandas(join, f"head {key}, kind string, tails array<{key}>, text string")
    taken = joined.filter("kind = 'values'").select(F.explode("tails").alias("head"))
    return joined.join(taken, "head", "left_anti")


def markdown(headers: Column, rows: Column) -> Column:
    """A table as markdown; pipes are escaped, null cells are empty; without headers each row is a list item."""
    cell = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|"))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, cell), " | "), F.lit(" |"))
    head = F.array(line(headers), F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(headers))))
    body = F.transform(rows, line)
    bullets = F.transform(rows, lambda r: F.concat(F.lit("- "), F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), " — ")))
    return F.when(F.size(headers) > 0, F.array_join(F.concat(head, body), "\n")).otherwise(F.array_join(bullets, "\n"))


def csv_lines(tables: DataFrame, key: str) -> DataFrame:
    """(key, line, text) of a CSV file for each table: the headers as line 0, then the rows; quotes where a cell needs them."""
    quote = lambda c: F.when(c.rlike("[\",\r\n]"), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit("")))
    line = lambda r: F.array_join(F.transform(r, quote), ",")
    first = F.when(F.size("headers") > 0, F.array(F.struct(F.lit(0).alias("line"), line(F.col("headers")).alias("text")))).otherwise(F.array().cast("array<struct<line:int,text:string>>"))
    rest = F.transform("rows", lambda r, i: F.struct((i + 1).cast("int").alias("line"), line(r).alias("text")))
    return tables.select(key, F.explode(F.concat(first, rest)).alias("l")).select(key, "l.*")
