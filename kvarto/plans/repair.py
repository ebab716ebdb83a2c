"""Queries: corrections, dice codes, regions, bindings, grids, payload checks, streams as tables."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.operators import corrections as records
from kvarto.operators.bags import word_bag
from kvarto.operators.binding import bind_elements
from kvarto.operators.dice import repair, shape as dice_shape
from kvarto.operators.grids import table_blocks
from kvarto.operators.images import measure_images
from kvarto.operators.regions import column_count, column_references, normalised
from kvarto.operators.statistics import floored, order_statistics
from kvarto.operators.versions import newest
from kvarto.plans import query
from kvarto.plans.elements import CURRENT, current
from kvarto.plans.screening import _REAL, _TOKENS
from kvarto.sources.tables import table
from kvarto.streaming.ingest import sessions, windowed_counts


@query(
    "f20_record_problems",
    "WITH c AS (SELECT correction_id, original, corrected, verdict, coalesce(applied, confidence >= 0.9, false) AS applied, coalesce(kind, 'ocr') AS kind, round(confidence, 3) AS confidence FROM corrections) "
    "SELECT correction_id, 'confidence out of range' AS problem FROM c WHERE NOT confidence BETWEEN 0 AND 1 UNION ALL SELECT correction_id, 'unknown kind' FROM c WHERE kind NOT IN ('ocr', 'emendering') UNION ALL SELECT correction_id, 'unknown verdict' FROM c WHERE verdict NOT IN ('applicerad', 'avvisad') "
    "UNION ALL SELECT correction_id, 'applied without text' FROM c WHERE applied AND corrected IS NULL UNION ALL SELECT correction_id, 'applied but rejected' FROM c WHERE applied AND verdict = 'avvisad' UNION ALL SELECT correction_id, 'changes nothing' FROM c WHERE original = corrected",
)
def record_problems(spark: SparkSession, d: str) -> DataFrame:
    return records.violations(records.with_defaults(table(spark, d, "corrections")), "correction_id")


@query("f19_folded_texts")
def folded_texts(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "text")
    c = table(spark, d, "corrections").select("correction_id", "element_key", "original", "corrected", "applied", "confidence", "kind")
    return records.apply_records(e, c, "element_key", "correction_id").filter("text <> before").select("element_key", "before", "text")


@query("b07_change_coverage", "SELECT element_key, original, corrected, count(*) AS records FROM corrections WHERE applied AND element_key IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) <> 1")
def change_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Changes that more than one applied record claims."""
    return table(spark, d, "corrections").filter("applied AND element_key IS NOT NULL").groupBy("element_key", "original", "corrected").agg(F.count("*").alias("records")).filter("records <> 1")


@query("a25_max_merge", "SELECT element_key, max(confidence) AS kept, count(*) AS merged, list_sort(list(confidence)) AS all_of_them FROM corrections WHERE confidence IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def max_merge(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corrections").filter("confidence IS NOT NULL")
    return c.groupBy("element_key").agg(F.max("confidence").alias("kept"), F.count("*").alias("merged"), F.array_sort(F.collect_list("confidence")).alias("all_of_them")).filter("merged > 1")


@query(
    "b04_shared_out",
    f"WITH w AS (SELECT book, stage, word, lower(word) AS core FROM (SELECT book, stage, {_TOKENS.format('text')} AS word FROM bok WHERE stage IN ('embedded', 'final')) WHERE {_REAL}), b AS (SELECT book, core, word, count(*) AS n FROM w WHERE stage = 'embedded' GROUP BY 1, 2, 3), a AS (SELECT book, core, count(*) AS n FROM w WHERE stage = 'final' GROUP BY 1, 2), "
    "r AS (SELECT b.book, b.core, sum(b.n) - coalesce(max(a.n), 0) AS residual FROM b LEFT JOIN a ON a.book = b.book AND a.core = b.core GROUP BY 1, 2 HAVING sum(b.n) > coalesce(max(a.n), 0)), "
    "s AS (SELECT b.book, b.word, b.n, r.residual, coalesce(sum(b.n) OVER (PARTITION BY b.book, b.core ORDER BY b.word ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM b JOIN r ON r.book = b.book AND r.core = b.core) SELECT book, word, least(n, residual - earlier)::BIGINT AS lost FROM s WHERE residual > earlier",
)
def shared_out(spark: SparkSession, d: str) -> DataFrame:
    """What a word's core has lost from the first stage to the last, given to its spellings in order."""
    bok = table(spark, d, "bok")
    before = word_bag(bok.filter("stage = 'embedded'"), F.col("text"), ["book"]).withColumn("core", F.lower("word"))
    after = word_bag(bok.filter("stage = 'final'"), F.col("text"), ["book"]).groupBy("book", F.lower("word").alias("core")).agg(F.sum("n").alias("after"))
    core = Window.partitionBy("book", "core")
    s = before.withColumns({"all": F.sum("n").over(core), "earlier": F.coalesce(F.sum("n").over(core.orderBy("word").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    residual = F.col("all") - F.coalesce("after", F.lit(0))
    return s.join(after, ["book", "core"], "left").filter(residual > F.col("earlier")).select("book", "word", F.least(F.col("n"), residual - F.col("earlier")).alias("lost"))


@query("f14_dice_repairs")
def dice_repairs(spark: SparkSession, d: str) -> DataFrame:
    """Status of every distinct token of the corrections that looks like a dice code, with its count."""
    words = word_bag(table(spark, d, "corrections"), F.regexp_replace("original", r"[.,:;()\"]+(\s|$)", " ")).filter(F.col("word").rlike(dice_shape()))
    return repair(words, "word").select("word", "n", "status", "repaired", "changes", "confidence")


@query(
    "j13_column_count",
    f"WITH {CURRENT}, r AS (SELECT book, page, lower(region) AS region FROM e WHERE region IS NOT NULL), c AS (SELECT book, page, coalesce(max(TRY_CAST(nullif(regexp_extract(region, 'kolumn\\s*(\\d+)', 1), '') AS INT)), 0) AS highest, bool_or(contains(region, 'vänster')) AS l, bool_or(contains(region, 'höger')) AS h FROM r GROUP BY 1, 2) "
    "SELECT book, page, nullif(greatest(highest, CASE WHEN l AND h THEN 2 ELSE 0 END), 0) AS columns FROM c",
)
def page_columns(spark: SparkSession, d: str) -> DataFrame:
    r = current(spark, d, "book", "page", "region").filter("region IS NOT NULL").groupBy("book", "page").agg(F.collect_set("region").alias("names"))
    return r.select("book", "page", column_count(F.array_distinct(F.flatten(F.transform("names", column_references)))).alias("columns"))


@query(
    "j13_regions",
    f"WITH {CURRENT} SELECT region, CASE WHEN region LIKE 'sidhuvud%' THEN 'sidhuvud' WHEN region LIKE 'sidfot%' THEN 'sidfot' WHEN region = 'helbredd' THEN 'helbredd' WHEN region IN ('kolumn 1', 'vänsterkolumn') THEN 'vänster' WHEN region IN ('kolumn 2', 'högerkolumn') THEN 'höger' END AS measured, count(*) AS n FROM e WHERE region IS NOT NULL GROUP BY 1, 2",
)
def measured_regions(spark: SparkSession, d: str) -> DataFrame:
    columns = F.array(F.lit("vänster"), F.lit("höger"))
    return current(spark, d, "region").filter("region IS NOT NULL").groupBy("region", normalised(F.col("region"), columns, F.lit(None).cast("int")).alias("measured")).agg(F.count("*").alias("n"))


@query(
    "j14_enclosing_box",
    f"WITH {CURRENT}, b AS (SELECT book, page, element_key, x, y, w, h FROM e WHERE x IS NOT NULL) SELECT a.element_key, min(b.element_key) AS inside FROM b a JOIN b ON a.book = b.book AND a.page = b.page AND a.element_key <> b.element_key AND a.x + a.w / 2 BETWEEN b.x AND b.x + b.w AND a.y + a.h / 2 BETWEEN b.y AND b.y + b.h GROUP BY 1 HAVING count(*) = 1",
)
def enclosing_box(spark: SparkSession, d: str) -> DataFrame:
    """Elements whose middle lies in exactly one other box of the page; pages bound the pairs that are compared."""
    b = current(spark, d, "book", "page", "x", "y", "w", "h").filter("x IS NOT NULL")
    middle = b.select("book", "page", "element_key", (F.col("x") + F.col("w") / 2).alias("mx"), (F.col("y") + F.col("h") / 2).alias("my"))
    other = b.select("book", "page", F.col("element_key").alias("other"), "x", "y", "w", "h")
    hit = middle.join(other, ["book", "page"]).filter((F.col("element_key") != F.col("other")) & F.col("mx").between(F.col("x"), F.col("x") + F.col("w")) & F.col("my").between(F.col("y"), F.col("y") + F.col("h")))
    return hit.groupBy("element_key").agg(F.min("other").alias("inside"), F.count("*").alias("n")).filter("n = 1").select("element_key", "inside")


@query("t07_next_id", "SELECT book, page, 'p' || lpad(page::VARCHAR, 3, '0') || '_e' || lpad((coalesce(max(TRY_CAST(nullif(regexp_extract(id, '_e(\\d+)$', 1), '') AS INT)), 0) + 1)::VARCHAR, 2, '0') AS next_id FROM bok GROUP BY 1, 2")
def next_id(spark: SparkSession, d: str) -> DataFrame:
    highest = F.coalesce(F.max(F.nullif(F.regexp_extract("id", r"_e(\d+)$", 1), F.lit("")).try_cast("int")), F.lit(0)) + 1
    pages = table(spark, d, "bok").groupBy("book", "page").agg(highest.alias("n"))
    wide = lambda c, k: F.when(F.length(c.cast("string")) >= k, F.substring(c.cast("string"), 1, k)).otherwise(F.lpad(c.cast("string"), k, "0"))
    return pages.select("book", "page", F.concat(F.lit("p"), wide(F.col("page"), 3), F.lit("_e"), wide(F.col("n"), 2)).alias("next_id"))


@query(
    "w27_indent_levels",
    f"WITH {CURRENT}, b AS (SELECT book, region, min(x) AS base FROM e WHERE x IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2) SELECT element_key, least(greatest(round_even((x - base) / 0.1, 0) + 1, 1), 3)::INT AS level FROM e JOIN b USING (book, region) WHERE type = 'heading' AND x IS NOT NULL",
)
def indent_levels(spark: SparkSession, d: str) -> DataFrame:
    """Heading levels 1 to 3 by steps of a tenth of the width from the region's left edge."""
    e = current(spark, d, "book", "region", "type", "x").filter("x IS NOT NULL AND region IS NOT NULL")
    base = e.groupBy("book", "region").agg(F.min("x").alias("base"))
    level = F.least(F.greatest(F.bround((F.col("x") - F.col("base")) / 0.1, 0) + 1, F.lit(1)), F.lit(3)).cast("int")
    return e.filter("type = 'heading'").join(base, ["book", "region"]).select("element_key", level.alias("level"))


@query(
    "w10_reflow",
    f"WITH {CURRENT}, c AS (SELECT book, region, list_sort(list(w)) AS v FROM e WHERE type = 'paragraph' AND w IS NOT NULL AND region IS NOT NULL AND NOT coalesce(removed, false) GROUP BY 1, 2), n AS (SELECT e.*, lag(e.type) OVER k AS pt, lag(e.text) OVER k AS ptext, lag(e.w) OVER k AS pw, lag(e.x) OVER k AS px, v[least(floor(0.75 * len(v)) + 1, len(v))::INT] AS full_width FROM e LEFT JOIN c ON c.book = e.book AND c.region = e.region WHERE NOT coalesce(removed, false) WINDOW k AS (PARTITION BY e.book, e.page ORDER BY idx, element_key)), "
    "m AS (SELECT *, CASE WHEN type = 'paragraph' AND pt = 'paragraph' AND (right(ptext, 1) = '-' OR (round(pw - 0.92 * full_width, 9) >= 0 AND round(x - px - 0.018, 9) < 0)) THEN 0 ELSE 1 END AS new FROM n), r AS (SELECT *, sum(new) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS flow FROM m) "
    "SELECT book, page, flow::BIGINT AS flow, count(*) AS parts, string_agg(text, ' ' ORDER BY idx, element_key) AS text FROM r WHERE type = 'paragraph' AND text IS NOT NULL GROUP BY 1, 2, 3",
)
def reflow(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs that go on: after a hyphen, or after a full line without a new indent."""
    e = current(spark, d, "book", "page", "idx", "type", "text", "region", "x", "w", "removed").filter("NOT coalesce(removed, false)")
    full = e.filter("type = 'paragraph' AND w IS NOT NULL AND region IS NOT NULL")
    full = order_statistics(full, ["book", "region"], "w", {"full_width": floored(0.75)}).drop("n")
    k = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    n = e.join(full, ["book", "region"], "left").withColumns({f"p_{c}": F.lag(c).over(k) for c in ("type", "text", "w", "x")})
    goes_on = (F.col("type") == "paragraph") & (F.col("p_type") == "paragraph") & (F.coalesce(F.col("p_text").endswith("-"), F.lit(False)) | ((F.round(F.col("p_w") - 0.92 * F.col("full_width"), 9) >= 0) & (F.round(F.col("x") - F.col("p_x") - 0.018, 9) < 0)))
    r = n.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("flow", F.sum("new").over(k))
    parts = r.filter("type = 'paragraph' AND text IS NOT NULL").groupBy("book", "page", "flow").agg(F.array_sort(F.collect_list(F.struct("idx", "element_key", "text"))).alias("p"))
    return parts.select("book", "page", "flow", F.size("p").cast("long").alias("parts"), F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"))


@query("s20_reading_stream", f"WITH {CURRENT} SELECT element_key, row_number() OVER (PARTITION BY book ORDER BY page, idx, element_key) AS place FROM e WHERE NOT coalesce(removed, false) AND type <> 'page_artifact'")
def reading_stream(spark: SparkSession, d: str) -> DataFrame:
    """Each element's place in its book. Pages are counted first, so no window spans more than a page's elements or a book's pages."""
    e = current(spark, d, "book", "page", "idx", "type", "removed").filter("NOT coalesce(removed, false) AND type <> 'page_artifact'")
    pages = e.groupBy("book", "page").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("book").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = e.withColumn("at", F.row_number().over(Window.partitionBy("book", "page").orderBy("idx", "element_key")))
    return placed.join(pages.withColumn("before", before), ["book", "page"]).select("element_key", (F.col("before") + F.col("at")).alias("place"))


@query(
    "a33_page_completeness",
    f"WITH w AS (SELECT book, page, word, CASE stage WHEN 'embedded' THEN 1 ELSE -1 END AS d FROM (SELECT book, page, stage, {_TOKENS.format('text')} AS word FROM bok WHERE stage IN ('embedded', 'transcript')) WHERE {_REAL}), n AS (SELECT book, page, word, sum(d) AS d FROM w GROUP BY 1, 2, 3) "
    "SELECT book, page, sum(greatest(d, 0))::BIGINT AS only_embedded, sum(greatest(-d, 0))::BIGINT AS only_transcript FROM n GROUP BY 1, 2",
)
def page_completeness(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok").filter("stage IN ('embedded', 'transcript')")
    bag = word_bag(bok, F.col("text"), ["book", "page", "stage"])
    n = bag.groupBy("book", "page", "word").agg(F.sum(F.when(F.col("stage") == "embedded", F.col("n")).otherwise(-F.col("n"))).alias("d"))
    return n.groupBy("book", "page").agg(F.sum(F.greatest("d", F.lit(0))).alias("only_embedded"), F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("only_transcript"))


_ATTRIBUTES = ("STY", "STO", "FYS", "SMI", "INT", "PSY", "KAR")


@query(
    "r25_statblock_checks",
    "WITH s AS (SELECT row_id, unnest(['STY', 'STO', 'FYS', 'SMI', 'INT', 'PSY', 'KAR']) AS attribute, text FROM bok WHERE type = 'statblock' AND text IS NOT NULL), v AS (SELECT row_id, attribute, TRY_CAST(nullif(regexp_extract(text, attribute || '\\s+(\\d+)', 1), '') AS INT) AS value FROM s) "
    "SELECT attribute, count(*) FILTER (value IS NULL) AS missing, count(*) FILTER (value NOT BETWEEN 3 AND 18) AS out_of_range, min(value) AS low, max(value) AS high FROM v GROUP BY 1",
)
def statblock_checks(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "bok").filter("type = 'statblock' AND text IS NOT NULL")
    found = F.array(*[F.struct(F.lit(a).alias("attribute"), F.nullif(F.regexp_extract("text", a + r"\s+(\d+)", 1), F.lit("")).try_cast("int").alias("value")) for a in _ATTRIBUTES])
    v = s.select(F.explode(found).alias("v")).select("v.*")
    return v.groupBy("attribute").agg(F.count_if(F.col("value").isNull()).alias("missing"), F.count_if(~F.col("value").between(3, 18)).alias("out_of_range"), F.min("value").alias("low"), F.max("value").alias("high"))


@query(
    "s05_payload_status",
    "SELECT CASE WHEN payload IS NULL THEN 'null' WHEN NOT json_valid(payload) THEN 'not JSON' WHEN json_type(payload, '$.pages') = 'ARRAY' THEN 'flat' WHEN json_type(payload, '$.bok.pages') = 'ARRAY' THEN 'wrapped' ELSE 'no pages' END AS status, count(*) AS n, count(book) AS with_book FROM bok_raw GROUP BY 1",
)
def payload_status(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("payload")
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    status = F.when(F.col("payload").isNull(), "null").when(v.isNull(), "not JSON").when(kind("$.pages").startswith("ARRAY"), "flat").when(kind("$.bok.pages").startswith("ARRAY"), "wrapped").otherwise("no pages")
    return table(spark, d, "bok_raw").groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.count("book").alias("with_book"))


@query("d01_bound_texts")
def bound_texts(spark: SparkSession, d: str) -> DataFrame:
    """Elements of each page bound to its boxes as rows, with the book's own scale; only what is proved, and how sure it is.

    Texts are reduced to their lengths and marks before anything is shuffled; what has no text counts its nested data.
    """
    box = lambda i: F.try_element_at("source.bbox", F.lit(i))
    inner = lambda c, key: F.when(F.col(c).isNotNull(), F.aggregate(F.col(c), F.lit(len(key)), lambda n, x: n + F.coalesce(F.length(x), F.lit(0)))).otherwise(0)
    cells = F.when(F.col("rows").isNotNull(), F.aggregate(F.flatten(F.filter("rows", lambda r: r.isNotNull())), F.lit(4), lambda n, x: n + F.coalesce(F.length(x), F.lit(0)))).otherwise(0)
    chars = F.when(F.length("text") > 0, F.length("text")).otherwise(inner("headers", "headers") + cells + inner("items", "items"))
    hyphen = F.coalesce(F.col("text").endswith("-") & ~F.col("text").endswith("--"), F.lit(False))
    bok = table(spark, d, "bok").select(
        "row_id", "element_key", "updated_at", "book", "page", "idx", "type", F.col("source.region").alias("region"), *[box(i).alias(c) for i, c in enumerate("xywh", 1)], chars.alias("chars"), hyphen.alias("hyphen"),
        F.coalesce(F.col("text").rlike(r"^\s*\p{Ll}"), F.lit(False)).alias("small"), F.coalesce(F.size("source.rader"), F.lit(0)).alias("bands"), F.coalesce("removed", F.lit(False)).alias("removed"),
    )
    return bind_elements(newest(bok, ["element_key"], "updated_at", "row_id").withColumnRenamed("element_key", "id"))


@query("w05_table_blocks")
def loose_tables(spark: SparkSession, d: str) -> DataFrame:
    return table_blocks(current(spark, d, "book", "page", "type", "text", "region", "x", "y", "h", "removed"))


@query("m02_measured_rows")
def measured_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows measured on page images that are drawn from the boxes of the elements."""
    boxes = current(spark, d, "book", "page", "x", "y", "w", "h").filter("x IS NOT NULL AND y BETWEEN 0 AND 1 AND x BETWEEN 0 AND 1")

    def draw(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        height, width = 800, 600
        dark = np.zeros((height, width), dtype=np.uint8)
        for x, y, w in zip(part["x"], part["y"], part["w"]):
            top = int((1 - y) * (height - 12))
            left, right = int(x * width), min(width, int((x + max(w, 0.02)) * width))
            dark[top : top + 10, left:right:2] = 255
        return pd.DataFrame([(*key, height, width, dark.tobytes())], columns=["book", "page", "height", "width", "pixels"])

    images = boxes.groupBy("book", "page").applyInPandas(draw, "book string, page int, height int, width int, pixels binary")
    return measure_images(images)


@query("st_session_windows", "WITH n AS (SELECT *, coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER w >= 21600000000)::INT, 1) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM n) SELECT user_id, count(*) AS n, round(sum(value), 4) AS value FROM k GROUP BY user_id, s")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e).select("user_id", "n", F.round("value", 4).alias("value"))


@query("st_daily_counts", "SELECT date_trunc('day', ts) AS begin, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return windowed_counts(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))


@query(
    "k13_report",
    f"WITH {CURRENT} SELECT 'elements' AS section, type AS item, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'open flags', f, count(*) FROM (SELECT unnest(review_reasons) AS f FROM e) GROUP BY 2 UNION ALL SELECT 'corrections', coalesce(kind, '-'), count(*) FROM corrections GROUP BY 2 UNION ALL SELECT 'applied', coalesce(source, '-'), count(*) FROM corrections WHERE applied GROUP BY 2 UNION ALL SELECT 'added', added_by, count(*) FROM e WHERE added_by IS NOT NULL GROUP BY 2 UNION ALL SELECT 'stages', stage, count(*) FROM e GROUP BY 2",
)
def report(spark: SparkSession, d: str) -> DataFrame:
    """Counts for a review report; the element table is read and reduced to current versions once for all its sections."""
    e = current(spark, d, "type", "review_reasons", "added_by", "stage")
    item = lambda s, c: F.struct(F.lit(s).alias("section"), c.alias("item"))
    items = F.concat(F.array(item("elements", F.col("type")), item("stages", F.col("stage"))), F.transform(F.coalesce("review_reasons", F.array().cast("array<string>")), lambda r: item("open flags", r)), F.when(F.col("added_by").isNotNull(), F.array(item("added", F.col("added_by")))).otherwise(F.array().cast("array<struct<section:string,item:string>>")))
    c = table(spark, d, "corrections")
    more = c.select(F.explode(F.array_compact(F.array(item("corrections", F.coalesce("kind", F.lit("-"))), F.when(F.col("applied"), item("applied", F.coalesce("source", F.lit("-"))))))).alias("i"))
    return e.select(F.explode(items).alias("i")).unionByName(more).groupBy("i.section", "i.item").agg(F.count("*").alias("n"))
