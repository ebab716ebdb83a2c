"""Readable output: folded prose, markdown of elements and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvarto.operators.reflow import folded_lines
from kvarto.operators.tables import markdown


def unwrapped(text: Column) -> Column:
    """Printed lines as paragraphs: hyphens before a small letter at a line's end are closed up, blank lines part paragraphs."""
    healed = F.regexp_replace(text, r"(\p{L})-[ \t]*\r?\n[ \t]*(\p{Ll})", "$1$2")
    marked = F.regexp_replace(healed, r"[ \t]*\r?\n[ \t]*\r?\n\s*", "\u0001")
    return F.replace(F.regexp_replace(marked, r"[ \t]*\r?\n[ \t]*", " "), F.lit("\u0001"), F.lit("\n\n"))


def element_markdown() -> Column:
    """Markdown of one element by its type; null for what isn't rendered."""
    t = F.col("type")
    text = F.col("text")
    level = F.least(F.coalesce("level", F.lit(1)) + 1, F.lit(6))
    return (
        F.when(t.isin("page_artifact", "illustration"), F.lit(None).cast("string"))
        .when(t == "heading", F.concat(F.repeat(F.lit("#"), level), F.lit(" "), text))
        .when(t == "table", markdown(F.col("headers"), F.col("rows")))
        .when(t == "list", F.array_join(F.transform("items", lambda x: F.concat(F.lit("- "), F.coalesce(x, F.lit("")))), "\n"))
        .when(t == "list_item", F.concat(F.lit("- "), F.regexp_replace(text, r"^[-•*]\s+", "")))
        .when(t == "boxed_text", F.concat(F.lit("> "), folded_lines(F.split("text", r"\r?\n"))))
        .when(t == "table_caption", F.concat(F.lit("*"), text, F.lit("*")))
        .otherwise(text)
    )


def page_blocks(elements: DataFrame) -> DataFrame:
    """(book, page, markdown): the rendered elements of each page in reading order, with a page mark; removed ones are left out.

    `flow` numbers the flows of paragraphs of a page: those of one flow that nothing else parts are one block.
    """
    kept = elements.filter(~F.coalesce("removed", F.lit(False)) & ~F.col("type").isin("page_artifact", "illustration"))
    run = F.sum(F.when(F.col("type") == "paragraph", 0).otherwise(1)).over(Window.partitionBy("book", "page").orderBy("idx", "element_key"))
    kept = kept.withColumn("run", run)
    prose = kept.filter("type = 'paragraph' AND text IS NOT NULL").groupBy("book", "page", "run", "flow").agg(F.array_sort(F.collect_list(F.struct("idx", "element_key", F.split("text", r"\r?\n").alias("lines")))).alias("l"))
    prose = prose.select("book", "page", F.struct(F.col("l")[0]["idx"].alias("idx"), F.col("l")[0]["element_key"].alias("element_key")).alias("place"), folded_lines(F.flatten(F.transform("l", lambda x: x["lines"]))).alias("md"))
    rest = kept.filter("type <> 'paragraph'").select("book", "page", F.struct("idx", "element_key").alias("place"), element_markdown().alias("md"))
    pages = prose.unionByName(rest).filter("md IS NOT NULL AND md <> ''").groupBy("book", "page").agg(F.array_sort(F.collect_list(F.struct("place", "md"))).alias("parts"))
    body = F.array_join(F.transform("parts", lambda p: p["md"]), "\n\n")
    return pages.select("book", "page", F.concat(F.lit("<!-- sida "), F.col("page").cast("string"), F.lit(" -->\n\n"), body).alias("markdown"))


def _grid(heads: Column, rows: Column) -> Column:
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    return F.concat(line(heads), F.lit("\n|"), F.repeat(F.lit(" --- |"), F.size(heads)), F.lit("\n"), F.array_join(F.transform(rows, line), "\n"))


def statblock_markdown(name: Column, heading: Column, fields: Column) -> Column:
    """A statblock: its name, unless the heading before says it, and its fields (label, value) as a table of one row."""
    title = F.when(~name.eqNullSafe(heading), F.concat(F.lit("**"), name, F.lit("**")))
    stats = F.when(F.size(fields) > 0, _grid(F.transform(fields, lambda f: f["label"]), F.array(F.transform(fields, lambda f: f["value"]))))
    return F.array_join(F.array_compact(F.array(title, stats)), "\n\n")


def filled_columns(items: Column, names: list[str]) -> Column:
    """Structs as a table of the columns that at least one of them fills; what is missing is a dash."""
    fills = {name: F.size(F.array_compact(items[name])) > 0 for name in names}
    used = F.filter(F.array(*map(F.lit, names)), lambda n: F.coalesce(*[F.when(n == name, fills[name]) for name in names]))
    cell = lambda x, n: F.coalesce(*[F.when(n == name, x[name]) for name in names], F.lit("—"))
    return _grid(used, F.transform(items, lambda x: F.transform(used, lambda n: cell(x, n))))


def marked_pages(markdown: Column) -> Column:
    """The pages (page, text) of a text with page marks; what stands before the first mark has no page."""
    parts = F.split(markdown, r"(?=<!-- sida \d+ -->)")
    page = lambda p: F.regexp_extract(p, r"^<!-- sida (\d+) -->", 1).try_cast("int")
    return F.filter(F.transform(parts, lambda p: F.struct(page(p).alias("page"), F.trim(F.regexp_replace(F.regexp_replace(p, r"^<!-- sida \d+ -->", ""), r"^\n+|\n+\z", "")).alias("text"))), lambda p: (p["text"] != "") | p["page"].isNotNull())


def canonical_pages(elements: DataFrame) -> DataFrame:
    """(book, page, n, needs_review, json): each page's elements as a JSON array in reading order."""
    item = F.struct("idx", "element_key", F.struct("id", "type", "level", "text", "confidence").alias("e"))
    pages = elements.groupBy("book", "page").agg(F.array_sort(F.collect_list(item)).alias("parts"), F.count_if("needs_review").alias("needs_review"))
    return pages.select("book", "page", F.size("parts").alias("n"), "needs_review", F.to_json(F.transform("parts", lambda p: p["e"])).alias("json"))
