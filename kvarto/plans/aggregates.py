"""Queries: aggregations over elements, pages and books."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.functions.text import artifact_key
from kvarto.operators import drift
from kvarto.operators.statistics import floored, nearest, order_statistics
from kvarto.plans import query
from kvarto.plans.elements import CURRENT, current
from kvarto.sources.tables import table


@query("a01_boilerplate", "WITH p AS (SELECT book, count(DISTINCT page) AS pages FROM bok GROUP BY 1), s AS (SELECT book, substring(text, 1, 100) AS sample, count(DISTINCT page) AS on_pages FROM bok WHERE text IS NOT NULL GROUP BY 1, 2) SELECT book, sample, on_pages FROM s JOIN p USING (book) WHERE on_pages >= 2 AND on_pages > 0.2 * pages")
def boilerplate(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok").select("book", "page", F.substring("text", 1, 100).alias("sample"))
    pages = bok.groupBy("book").agg(F.count_distinct("page").alias("pages"))
    repeated = bok.filter("sample IS NOT NULL").distinct().groupBy("book", "sample").agg(F.count("*").alias("on_pages")).filter("on_pages >= 2")
    return repeated.join(pages, "book").filter(F.col("on_pages") > 0.2 * F.col("pages")).select("book", "sample", "on_pages")


@query(
    "a02_edge_artifacts",
    f"WITH {CURRENT}, k AS (SELECT book, page, substring(regexp_replace(lower(trim(text)), '\\d+', '#', 'g'), 1, 60) AS key, CASE WHEN y > 0.5 THEN 'top' ELSE 'bottom' END AS zone FROM e WHERE text IS NOT NULL AND (y >= 0.92 OR y <= 0.08)), "
    "p AS (SELECT book, count(DISTINCT page) AS pages FROM bok GROUP BY 1) SELECT book, key, zone, count(*) AS n FROM k JOIN p USING (book) GROUP BY book, key, zone, pages HAVING count(*) >= greatest(2, floor(0.05 * pages))",
)
def edge_artifacts(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "text", "y").filter("text IS NOT NULL AND (y >= 0.92 OR y <= 0.08)")
    pages = table(spark, d, "bok").groupBy("book").agg(F.count_distinct("page").alias("pages"))
    keyed = e.groupBy("book", artifact_key(F.col("text")).alias("key"), F.when(F.col("y") > 0.5, "top").otherwise("bottom").alias("zone")).agg(F.count("*").alias("n")).filter("n >= 2")
    return keyed.join(pages, "book").filter(F.col("n") >= F.floor(0.05 * F.col("pages"))).select("book", "key", "zone", "n")


@query("a03_stage_summary", "SELECT stage, count(*) AS n, count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (text IS NULL) AS without_text FROM bok GROUP BY 1")
def stage_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").groupBy("stage").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("needs_review"), F.count_if(F.col("text").isNull()).alias("without_text"))


@query("a04_review_flags", f"WITH {CURRENT} SELECT book, page, sum(len(review_reasons))::BIGINT AS flags, count(*) FILTER (needs_review) AS elements FROM e GROUP BY 1, 2 HAVING sum(len(review_reasons)) > 0")
def review_flags(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "review_reasons", "needs_review")
    return e.groupBy("book", "page").agg(F.sum(F.size("review_reasons")).alias("flags"), F.count_if("needs_review").alias("elements")).filter("flags > 0")


@query("a05_weighted_median", f"WITH {CURRENT}, r AS (SELECT book, h FROM e, range(length(text)) WHERE text IS NOT NULL AND h IS NOT NULL) SELECT book, round(median(h), 6) AS height FROM r GROUP BY 1")
def weighted_median(spark: SparkSession, d: str) -> DataFrame:
    """The height of a book's boxes at the middle of its characters."""
    e = current(spark, d, "book", "text", "h").filter("text IS NOT NULL AND h IS NOT NULL AND length(text) > 0")
    return e.groupBy("book").agg(F.round(F.percentile("h", 0.5, F.length("text")), 6).alias("height"))


@query(
    "a07_order_statistics",
    f"WITH {CURRENT}, s AS (SELECT book, list_sort(list(w)) AS v, median(w) AS median FROM e WHERE w IS NOT NULL GROUP BY 1) SELECT book, round(median, 6) AS median, v[(round_even(0.9 * (len(v) - 1), 0) + 1)::INT] AS p90, v[least(floor(0.75 * len(v)) + 1, len(v))::INT] AS q75, v[(len(v) // 2 + 1)::INT] AS upper_median, len(v) AS n FROM s",
)
def widths_in_order(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "w").filter("w IS NOT NULL")
    ranks = order_statistics(e, ["book"], "w", {"p90": nearest(0.9), "q75": floored(0.75), "upper_median": floored(0.5)})
    return ranks.join(e.groupBy("book").agg(F.round(F.median("w"), 6).alias("median")), "book").select("book", "median", "p90", "q75", "upper_median", "n")


@query(
    "a13_modal_bucket",
    f"WITH {CURRENT}, b AS (SELECT book, region, CAST(floor(x / 0.005) AS INT) AS bucket, w FROM e WHERE x IS NOT NULL AND region IS NOT NULL AND w >= 0.15), c AS (SELECT book, region, bucket, count(*) AS n, median(w) AS width FROM b GROUP BY 1, 2, 3) "
    "SELECT book, region, bucket, n, round(width, 6) AS width FROM c QUALIFY row_number() OVER (PARTITION BY book, region ORDER BY n DESC, bucket) = 1",
)
def modal_bucket(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent left edge (ties: the leftmost) of each region, and the middle width there."""
    e = current(spark, d, "book", "region", "x", "w").filter("x IS NOT NULL AND region IS NOT NULL AND w >= 0.15")
    counted = e.groupBy("book", "region", F.floor(F.col("x") / 0.005).cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.round(F.median("w"), 6).alias("width"))
    best = counted.groupBy("book", "region").agg(F.min_by(F.struct("bucket", "n", "width"), F.struct(-F.col("n"), F.col("bucket"))).alias("m"))
    return best.select("book", "region", "m.*")


@query("a15_type_scale", f"WITH {CURRENT} SELECT book, CASE WHEN count(*) >= 30 THEN round(median(length(text) / w), 4) END AS scale, count(*) AS n FROM e WHERE type = 'paragraph' AND text IS NOT NULL AND NOT contains(text, chr(10)) AND w > 0 GROUP BY 1")
def type_scale(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "type", "text", "w").filter("type = 'paragraph' AND w > 0").filter(~F.contains("text", F.lit("\n")))
    return e.groupBy("book").agg(F.when(F.count("*") >= 30, F.round(F.median(F.length("text") / F.col("w")), 4)).alias("scale"), F.count("*").alias("n"))


@query("a18_category_rollup", "SELECT kind, reason, count(*) AS n, count(*) FILTER (applied) AS applied, grouping(kind)::INT + grouping(reason)::INT AS level FROM corrections GROUP BY ROLLUP (kind, reason)")
def category_rollup(spark: SparkSession, d: str) -> DataFrame:
    rolled = table(spark, d, "corrections").rollup("kind", "reason").agg(F.count("*").alias("n"), F.count_if("applied").alias("applied"), (F.grouping("kind") + F.grouping("reason")).cast("int").alias("level"))
    return rolled.select("kind", "reason", "n", "applied", "level")


@query(
    "a19_ceased_types",
    f"WITH {CURRENT}, t AS (SELECT book, type, count(DISTINCT page) AS pages, max(page) AS last FROM e GROUP BY 1, 2), p AS (SELECT DISTINCT book, page FROM e WHERE type = 'paragraph') "
    "SELECT t.book, t.type, t.pages, t.last, count(p.page) AS silent FROM t JOIN p ON p.book = t.book AND p.page > t.last WHERE t.pages >= 3 GROUP BY 1, 2, 3, 4 HAVING count(p.page) >= 1",
)
def ceased_types(spark: SparkSession, d: str) -> DataFrame:
    """With counts for the test data's short books; the operator's own are 5 pages and 8 silent ones."""
    return drift.ceased_types(current(spark, d, "book", "page", "type"), least=3, silent=1)


@query(
    "a20_retyped_furniture",
    f"WITH {CURRENT}, b AS (SELECT *, count(*) OVER (PARTITION BY book, page) AS size FROM e WHERE y IS NOT NULL), t AS (SELECT book, page, text, type FROM b WHERE size >= 5 AND text IS NOT NULL AND length(text) <= 60 QUALIFY row_number() OVER (PARTITION BY book, page ORDER BY y DESC, idx) = 1) "
    "SELECT book, text, count(*) AS pages, list_sort(list(DISTINCT type)) AS types FROM t GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT type) >= 2",
)
def retyped_furniture(spark: SparkSession, d: str) -> DataFrame:
    """With a count for the test data's short books; the operator's own is 3 pages."""
    return drift.retyped_furniture(current(spark, d, "book", "page", "idx", "text", "type", "y"), least=2)


@query("a21_unmeasured_pages", f"WITH {CURRENT} SELECT book, page, round(avg((x IS NULL)::INT), 6) AS share FROM e WHERE type <> 'page_artifact' GROUP BY 1, 2 HAVING avg((x IS NULL)::INT) >= 0.5")
def unmeasured_pages(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "type", "x").filter("type <> 'page_artifact'")
    return e.groupBy("book", "page").agg(F.round(F.avg(F.col("x").isNull().cast("int")), 6).alias("share")).filter("share >= 0.5")


@query(
    "a22_mid_line_words",
    f"WITH {CURRENT}, l AS (SELECT book, string_split(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' ') AS t FROM (SELECT book, unnest(string_split(text, chr(10))) AS line FROM e WHERE text IS NOT NULL)), "
    "w AS (SELECT DISTINCT book, regexp_replace(lower(unnest(t[1:len(t) - 1])), '[^\\p{L}\\p{N}_]', '', 'g') AS word FROM l WHERE len(t) > 1) SELECT book, word FROM w WHERE word <> ''",
)
def mid_line_words(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words that occur before the end of a line: those aren't halves of broken words."""
    lines = current(spark, d, "book", "text").select("book", F.explode(F.split("text", "\n")).alias("line"))
    parts = lines.select("book", F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " ").alias("t")).filter(F.size("t") > 1)
    words = parts.select("book", F.explode(F.slice("t", 1, F.size("t") - 1)).alias("t")).select("book", F.regexp_replace(F.lower("t"), r"[^\p{L}\p{N}_]", "").alias("word"))
    return words.filter("word <> ''").distinct()


_VALUE = r"^[\d %–+.,-]+$|^\d+T\d+([+-]\d+)?$"


@query(
    "a23_column_shapes",
    f"WITH {CURRENT}, r AS (SELECT element_key, unnest(rows) AS row FROM e WHERE type = 'table' AND rows IS NOT NULL), c AS (SELECT element_key, unnest(row) AS cell, generate_subscripts(row, 1) - 1 AS col FROM r WHERE row IS NOT NULL) "
    f"SELECT element_key, col::INT AS col, CASE WHEN count(*) FILTER (regexp_matches(cell, '{_VALUE}')) > count(*) FILTER (NOT regexp_matches(cell, '{_VALUE}')) THEN 'numeric' ELSE 'text' END AS shape FROM c WHERE cell IS NOT NULL AND cell <> '' GROUP BY 1, 2",
)
def column_shapes(spark: SparkSession, d: str) -> DataFrame:
    rows = current(spark, d, "type", "rows").filter("type = 'table'").select("element_key", F.explode("rows").alias("row"))
    cells = rows.select("element_key", F.posexplode("row").alias("col", "cell")).filter("cell <> ''")
    numeric = F.col("cell").rlike(_VALUE)
    shape = F.when(F.count_if(numeric) > F.count_if(~numeric), "numeric").otherwise("text")
    return cells.groupBy("element_key", "col").agg(shape.alias("shape"))


@query("a26_empty_payloads", f"WITH {CURRENT} SELECT type, count(*) AS n FROM e WHERE (type = 'table' AND coalesce(len(rows), 0) = 0) OR (type = 'list' AND coalesce(len(items), 0) = 0) GROUP BY 1")
def empty_payloads(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "type", "rows", "items")
    empty = (F.col("type") == "table") & (F.coalesce(F.size("rows"), F.lit(0)) <= 0) | (F.col("type") == "list") & (F.coalesce(F.size("items"), F.lit(0)) <= 0)
    return e.filter(empty).groupBy("type").agg(F.count("*").alias("n"))


@query("a27_type_pages", f"WITH {CURRENT} SELECT type, type IN ('heading', 'paragraph', 'list', 'list_item', 'table', 'statblock') AS rendered, count(*) AS n, count(DISTINCT (book, page)) AS pages FROM e GROUP BY 1, 2")
def type_pages(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "type")
    return e.groupBy("type", F.col("type").isin("heading", "paragraph", "list", "list_item", "table", "statblock").alias("rendered")).agg(F.count("*").alias("n"), F.count_distinct("book", "page").alias("pages"))


@query("a28_uncorrected_pages", "SELECT DISTINCT book, page FROM bok WHERE type <> 'illustration' EXCEPT SELECT book, page FROM bok WHERE stage = 'final'")
def uncorrected_pages(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok")
    return bok.filter("type <> 'illustration'").select("book", "page").distinct().join(bok.filter("stage = 'final'").select("book", "page").distinct(), ["book", "page"], "left_anti")


@query("a29_readiness", f"WITH {CURRENT} SELECT 'open flag' AS blocker, count(*) AS n FROM e WHERE len(review_reasons) > 0 UNION ALL SELECT 'no text', count(*) FROM e WHERE text IS NULL AND type IN ('heading', 'paragraph', 'boxed_text') UNION ALL SELECT 'no box', count(*) FROM e WHERE x IS NULL UNION ALL SELECT 'no place', count(*) FROM e WHERE region IS NULL")
def readiness(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "type", "text", "region", "x", "review_reasons")
    blockers = {"open flag": F.size("review_reasons") > 0, "no text": F.col("text").isNull() & F.col("type").isin("heading", "paragraph", "boxed_text"), "no box": F.col("x").isNull(), "no place": F.col("region").isNull()}
    wide = e.agg(*[F.count_if(c).alias(k) for k, c in blockers.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("blocker"), F.col(f"`{k}`").alias("n")) for k in blockers])).alias("b")).select("b.*")


@query("a30_measured", f"WITH {CURRENT} SELECT bbox_source, count(*) AS n, count(x) AS measured FROM e GROUP BY 1")
def measured(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "bbox_source", "x").groupBy("bbox_source").agg(F.count("*").alias("n"), F.count("x").alias("measured"))


@query("s16_documents_by_source", "SELECT source, lang, count(*) AS n, sum(n_chars)::BIGINT AS characters, max(n_chars) AS longest FROM documents GROUP BY 1, 2")
def documents_by_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("characters"), F.max("n_chars").alias("longest"))
