"""Queries: boxes, bands, fields and keys of elements."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.functions.ranks import nearest_rank
from kvarto.functions.text import name_key, normalise, tokens
from kvarto.operators.bags import bag_difference, word_bag
from kvarto.operators.boxes import overlapping, union_box
from kvarto.operators.formulas import compile_formula
from kvarto.operators.lookups import term_index
from kvarto.operators.sequences import gap_clusters
from kvarto.operators.statistics import floored, order_statistics
from kvarto.plans import query
from kvarto.plans.choices import _FOLD, _NAME
from kvarto.plans.elements import CURRENT, current
from kvarto.plans.screening import _REAL, _TOKENS
from kvarto.sources.tables import table

_ATTRIBUTES = ("STY", "STO", "FYS", "SMI", "INT", "PSY", "KAR")


@query("f07_derived_values", "WITH v AS (SELECT row_id, TRY_CAST(nullif(regexp_extract(text, 'FYS\\s+(\\d+)', 1), '') AS INT) AS fys, TRY_CAST(nullif(regexp_extract(text, 'STO\\s+(\\d+)', 1), '') AS INT) AS sto FROM bok WHERE type = 'statblock') SELECT row_id, ceil((fys + sto) / 2)::DOUBLE AS half, floor((fys * 2 - 1) / nullif(sto, 0))::DOUBLE AS quotient FROM v")
def derived_values(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "bok").filter("type = 'statblock'")
    values = {a: F.nullif(F.regexp_extract("text", a + r"\s+(\d+)", 1), F.lit("")).try_cast("int") for a in ("FYS", "STO")}
    return s.select("row_id", compile_formula("ceil((FYS + STO) / 2)", values).alias("half"), compile_formula("(FYS * 2 - 1) // STO", values).alias("quotient"))


@query(
    "f12_stat_keys",
    "WITH k AS (SELECT unnest(regexp_extract_all(text, '([A-ZÅÄÖ0-9]{3})\\s+\\d', 1)) AS key FROM bok WHERE type = 'statblock'), a AS (SELECT unnest(['STY', 'STO', 'FYS', 'SMI', 'INT', 'PSY', 'KAR']) AS name), n AS (SELECT key, count(*) AS n FROM k GROUP BY 1), "
    "c AS (SELECT key, n, list(name) FILTER (key = name) AS same, list(name) FILTER (hamming(key, name) = 1) AS near FROM n, a GROUP BY 1, 2) SELECT key, n, coalesce(same[1], CASE WHEN len(near) = 1 THEN near[1] END) AS canonical FROM c",
)
def stat_keys(spark: SparkSession, d: str) -> DataFrame:
    """Attribute labels as they stand, and the attribute meant: itself, or the only one that differs in one letter."""
    k = table(spark, d, "bok").filter("type = 'statblock'").select(F.explode(F.regexp_extract_all("text", F.lit(r"([A-ZÅÄÖ0-9]{3})\s+\d"), 1)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    differ = lambda a: sum((F.substring("key", i + 1, 1) != F.lit(c)).cast("int") for i, c in enumerate(a))
    near = F.array_compact(F.array(*[F.when(differ(a) == 1, F.lit(a)) for a in _ATTRIBUTES]))
    return k.select("key", "n", F.when(F.col("key").isin(*_ATTRIBUTES), F.col("key")).when(F.size(near) == 1, F.get(near, F.lit(0))).alias("canonical"))


@query(
    "f16_word_proposals",
    f"WITH w AS (SELECT word, {_FOLD.format('word')} AS key, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(original, '\\p{{L}}+'))) AS word FROM corrections) GROUP BY 1, 2), l AS (SELECT {_FOLD.format('term')} AS key, list_sort(list(DISTINCT lower(term))) AS forms FROM lexicon WHERE term IS NOT NULL GROUP BY 1) "
    "SELECT word, n, CASE WHEN len(forms) = 1 THEN forms[1] END AS proposal, len(forms) > 1 AS ambiguous FROM w JOIN l ON l.key = w.key WHERE NOT list_contains(forms, word)",
)
def word_proposals(spark: SparkSession, d: str) -> DataFrame:
    """Words that equal a lexicon form but for accents; proposals, never applied by themselves."""
    words = table(spark, d, "corrections").select(F.explode(F.regexp_extract_all("original", F.lit(r"\p{L}+"), 0)).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n")).withColumn("key", normalise(F.col("word")))
    forms = term_index(table(spark, d, "lexicon"), normalise(F.col("term")), F.lower("term"))
    hit = words.join(forms, "key").filter(~F.array_contains("forms", F.col("word")))
    return hit.select("word", "n", F.when(F.size("forms") == 1, F.get("forms", F.lit(0))).alias("proposal"), (F.size("forms") > 1).alias("ambiguous"))


@query("f21_closed_reasons", f"WITH {CURRENT}, c AS (SELECT element_key, list_filter(review_reasons, lambda r: r <> 'oklar spalt') AS still_open, list_contains(review_reasons, 'oklar spalt') AS closed FROM e) SELECT element_key, still_open, len(still_open) > 0 AS needs_review FROM c WHERE closed")
def closed_reasons(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "review_reasons").filter(F.array_contains("review_reasons", "oklar spalt"))
    still = F.filter("review_reasons", lambda r: r != "oklar spalt")
    return e.select("element_key", still.alias("still_open"), (F.size(still) > 0).alias("needs_review"))


@query("f27_same_names", f"WITH {CURRENT}, h AS (SELECT book, {_NAME.format('text')} AS key, count(*) AS n FROM e WHERE type IN ('heading', 'page_artifact') AND text IS NOT NULL GROUP BY 1, 2) SELECT b.book, h.n FROM books b JOIN h ON h.book = b.book AND h.key = {_NAME.format('b.title')} WHERE h.key <> ''")
def same_names(spark: SparkSession, d: str) -> DataFrame:
    """How often a book's title stands as a heading or at a page's edge, case and marks aside."""
    h = current(spark, d, "book", "type", "text").filter("type IN ('heading', 'page_artifact') AND text IS NOT NULL").groupBy("book", name_key(F.col("text")).alias("key")).agg(F.count("*").alias("n"))
    b = table(spark, d, "books").select("book", name_key(F.col("title")).alias("key")).filter("key <> ''")
    return b.join(h, ["book", "key"]).select("book", "n")


@query("f31_absolute_boxes", "SELECT source.method AS method, count(*) FILTER (list_max(source.bbox) > 1.5) AS absolute, count(source.bbox) AS boxes FROM bok GROUP BY 1")
def absolute_boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").groupBy(F.col("source.method").alias("method")).agg(F.count_if(F.array_max("source.bbox") > 1.5).alias("absolute"), F.count("source.bbox").alias("boxes"))


@query("f35_deep_lengths", f"WITH {CURRENT} SELECT element_key, coalesce(length(text), 0) + coalesce(list_sum(list_transform(items, lambda i: coalesce(length(i), 0))), 0)::BIGINT + coalesce(list_sum(list_transform(flatten(list_filter(rows, lambda r: r IS NOT NULL)), lambda c: coalesce(length(c), 0))), 0)::BIGINT AS characters FROM e")
def deep_lengths(spark: SparkSession, d: str) -> DataFrame:
    total = lambda a: F.aggregate(F.coalesce(a, F.array().cast("array<string>")), F.lit(0).cast("long"), lambda n, x: n + F.coalesce(F.length(x), F.lit(0)))
    cells = F.flatten(F.filter("rows", lambda r: r.isNotNull()))
    return current(spark, d, "text", "items", "rows").select("element_key", (F.coalesce(F.length("text"), F.lit(0)) + total(F.col("items")) + total(cells)).alias("characters"))


@query("f41_book_keys", "SELECT book, sha256(concat_ws(':', book, system, doc_type)) AS key FROM books")
def book_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("book", F.sha2(F.concat_ws(":", "book", "system", "doc_type"), 256).alias("key"))


@query("f47_list_items", f"WITH {CURRENT} SELECT element_key, (generate_subscripts(items, 1) - 1)::INT AS place, unnest(items) AS text FROM e WHERE items IS NOT NULL")
def list_items(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "items").select("element_key", F.posexplode("items").alias("place", "text"))


@query("j18_field_labels", "SELECT label, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '([A-ZÅÄÖ]{3})\\s+\\d', 1)) AS label FROM bok WHERE type = 'statblock') GROUP BY 1")
def field_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").filter("type = 'statblock'").select(F.explode(F.regexp_extract_all("text", F.lit(r"([A-ZÅÄÖ]{3})\s+\d"), 1)).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query(
    "j22_overlapping_boxes",
    f"WITH {CURRENT}, b AS (SELECT book, page, region, element_key, x, y, w, h FROM e WHERE x IS NOT NULL AND region IS NOT NULL) SELECT DISTINCT a.element_key FROM b a JOIN b ON a.book = b.book AND a.page = b.page AND a.region = b.region AND a.element_key <> b.element_key "
    "WHERE round(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 9) > 0 AND round(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y) - 0.5 * least(a.h, b.h), 9) > 0",
)
def overlapping_boxes(spark: SparkSession, d: str) -> DataFrame:
    return overlapping(current(spark, d, "book", "page", "region", "x", "y", "w", "h").filter("x IS NOT NULL AND region IS NOT NULL"), ["book", "page", "region"], "element_key")


@query("j24_column_bounds", f"WITH {CURRENT} SELECT book, page, CASE WHEN count(*) FILTER (x < 1 / 3) >= 2 AND count(*) FILTER (x >= 1 / 3 AND x < 2 / 3) >= 2 AND count(*) FILTER (x >= 2 / 3) >= 2 THEN 3 ELSE 2 END AS columns, count(*) AS n FROM e WHERE w < 0.35 GROUP BY 1, 2")
def column_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Three columns where narrow boxes begin in every third of a page, else two."""
    e = current(spark, d, "book", "page", "x", "w").filter("w < 0.35")
    thirds = [F.count_if(F.col("x") < 1 / 3) >= 2, F.count_if((F.col("x") >= 1 / 3) & (F.col("x") < 2 / 3)) >= 2, F.count_if(F.col("x") >= 2 / 3) >= 2]
    return e.groupBy("book", "page").agg(F.when(thirds[0] & thirds[1] & thirds[2], 3).otherwise(2).alias("columns"), F.count("*").alias("n"))


@query(
    "pf09_row_prose",
    f"WITH {CURRENT}, s AS (SELECT book, page, list_sort(list(w)) AS v, median(w) AS middle FROM e WHERE w IS NOT NULL AND type NOT IN ('page_artifact', 'illustration') GROUP BY 1, 2) SELECT book, page, round(middle - 0.7 * v[(round_even(0.9 * (len(v) - 1), 0) + 1)::INT], 9) >= 0 AS row_prose FROM s",
)
def row_prose(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "type", "w").filter("w IS NOT NULL AND type NOT IN ('page_artifact', 'illustration')")
    return e.groupBy("book", "page").agg((F.round(F.median("w") - 0.7 * nearest_rank(F.col("w"), 0.9), 9) >= 0).alias("row_prose"))


@query(
    "pf20_band_flags",
    f"WITH {CURRENT}, m AS (SELECT *, median(x) OVER r AS left_edge, median(h) OVER r AS height FROM e WHERE x IS NOT NULL AND region IS NOT NULL WINDOW r AS (PARTITION BY book, page, region)), f AS (SELECT book, page, region, list_sort(list(w)) AS v FROM e WHERE x IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2, 3) "
    "SELECT element_key, round(x - left_edge - 0.045, 9) <= 0 AND round(x + w - left_edge - v[least(floor(0.85 * len(v)) + 1, len(v))::INT] - 0.02, 9) <= 0 AS trusted, round(x - left_edge, 9) BETWEEN 0.010 AND 0.045 AS indented, round(h - 1.25 * height, 9) >= 0 AS heading FROM m JOIN f USING (book, page, region)",
)
def band_flags(spark: SparkSession, d: str) -> DataFrame:
    """Whether a box's width can be trusted, it is indented, or as high as a heading, against the middle of its region."""
    e = current(spark, d, "book", "page", "region", "x", "w", "h").filter("x IS NOT NULL AND region IS NOT NULL")
    r = Window.partitionBy("book", "page", "region")
    full = F.array_sort(F.collect_list("w").over(r))
    m = e.withColumns({"left": F.median("x").over(r), "height": F.median("h").over(r), "v": full})
    width = F.get("v", F.least(F.floor(F.lit(0.85) * F.size("v")), F.size("v") - 1).cast("int"))
    trusted = (F.round(F.col("x") - F.col("left") - 0.045, 9) <= 0) & (F.round(F.col("x") + F.col("w") - F.col("left") - width - 0.02, 9) <= 0)
    return m.select("element_key", trusted.alias("trusted"), F.round(F.col("x") - F.col("left"), 9).between(0.010, 0.045).alias("indented"), (F.round(F.col("h") - 1.25 * F.col("height"), 9) >= 0).alias("heading"))


@query("a14_full_widths", f"WITH {CURRENT}, s AS (SELECT book, region, list_sort(list(w)) AS v FROM e WHERE w >= 0.15 AND region IS NOT NULL GROUP BY 1, 2) SELECT book, region, v[least(floor(0.85 * len(v)) + 1, len(v))::INT] AS width FROM s")
def full_widths(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "region", "w").filter("w >= 0.15 AND region IS NOT NULL")
    return order_statistics(e, ["book", "region"], "w", {"width": floored(0.85)}).select("book", "region", "width")


@query(
    "a16_conserved_scale",
    f"WITH {CURRENT}, r AS (SELECT book, page, region, sum(length(text)) / sum(w) AS scale FROM e WHERE type = 'paragraph' AND w > 0 AND length(text) > 0 AND region IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 3) SELECT book, round(median(scale), 4) AS scale, count(*) AS regions FROM r GROUP BY 1",
)
def conserved_scale(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "region", "type", "text", "w").filter("type = 'paragraph' AND w > 0 AND length(text) > 0 AND region IS NOT NULL")
    r = e.groupBy("book", "page", "region").agg((F.sum(F.length("text")) / F.sum("w")).alias("scale"), F.count("*").alias("n")).filter("n >= 3")
    return r.groupBy("book").agg(F.round(F.median("scale"), 4).alias("scale"), F.count("*").alias("regions"))


@query("a17_paragraph_regime", f"WITH {CURRENT} SELECT book, median(length(text)) > 1.5 * 120 * median(w) AS many_rows, count(*) AS n FROM e WHERE type = 'paragraph' AND text IS NOT NULL AND w IS NOT NULL GROUP BY 1")
def paragraph_regime(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "type", "text", "w").filter("type = 'paragraph' AND text IS NOT NULL AND w IS NOT NULL")
    return e.groupBy("book").agg((F.median(F.length("text")) > 1.5 * 120 * F.median("w")).alias("many_rows"), F.count("*").alias("n"))


@query(
    "a31_skip_costs",
    f"WITH {CURRENT}, b AS (SELECT *, median(h) OVER (PARTITION BY book, page, region) AS mh FROM e WHERE x IS NOT NULL AND region IS NOT NULL), p AS (SELECT *, abs(lag(y) OVER k - y) AS up, abs(y - lead(y) OVER k) AS down FROM b WINDOW k AS (PARTITION BY book, page, region ORDER BY y DESC, element_key)) "
    "SELECT element_key, CASE WHEN round(h - 0.55 * mh, 9) >= 0 AND round(h - 1.70 * mh, 9) <= 0 AND (up IS NULL OR down IS NULL OR round(abs(up - down) - 0.28 * greatest(up, down), 9) <= 0) THEN 0.60 ELSE 0.05 END::DOUBLE AS cost FROM p",
)
def skip_costs(spark: SparkSession, d: str) -> DataFrame:
    """What leaving a row without text costs: much for one as high as its neighbours and evenly spaced."""
    e = current(spark, d, "book", "page", "region", "x", "y", "h").filter("x IS NOT NULL AND region IS NOT NULL")
    r = Window.partitionBy("book", "page", "region")
    k = r.orderBy(F.desc("y"), "element_key")
    p = e.withColumns({"mh": F.median("h").over(r), "up": F.abs(F.lag("y").over(k) - F.col("y")), "down": F.abs(F.col("y") - F.lead("y").over(k))})
    even = F.col("up").isNull() | F.col("down").isNull() | (F.round(F.abs(F.col("up") - F.col("down")) - 0.28 * F.greatest("up", "down"), 9) <= 0)
    like = (F.round(F.col("h") - 0.55 * F.col("mh"), 9) >= 0) & (F.round(F.col("h") - 1.70 * F.col("mh"), 9) <= 0)
    return p.select("element_key", F.when(like & even, 0.60).otherwise(0.05).alias("cost"))


@query("b05_equal_bags", f"WITH w AS (SELECT book, word, CASE stage WHEN 'transcript' THEN 1 ELSE -1 END AS d FROM (SELECT book, stage, {_TOKENS.format('text')} AS word FROM bok WHERE stage IN ('transcript', 'final')) WHERE {_REAL}), n AS (SELECT book, word, sum(d) AS d FROM w GROUP BY 1, 2) SELECT book, bool_and(d = 0) AS equal, count(*) FILTER (d <> 0) AS words FROM n GROUP BY 1")
def equal_bags(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok")
    bag = lambda s: word_bag(bok.filter(F.col("stage") == s), F.col("text"), ["book"])
    differ = bag_difference(bag("transcript"), bag("final"), ["book", "word"]).groupBy("book").agg(F.count("*").alias("words"))
    books = bok.filter("stage IN ('transcript', 'final')").filter(F.size(F.coalesce(tokens(F.col("text")), F.array().cast("array<string>"))) > 0).select("book").distinct()
    return books.join(differ, "book", "left").select("book", F.col("words").isNull().alias("equal"), F.coalesce("words", F.lit(0)).alias("words"))


@query("w26_band_runs", f"WITH {CURRENT}, b AS (SELECT element_key, unnest(bands) AS band FROM e), n AS (SELECT element_key, band, band - row_number() OVER (PARTITION BY element_key ORDER BY band) AS island FROM (SELECT DISTINCT * FROM b)) SELECT element_key, min(band) AS first_band, max(band) AS last_band, count(*) AS n FROM n GROUP BY element_key, island")
def band_runs(spark: SparkSession, d: str) -> DataFrame:
    b = current(spark, d, "bands").select("element_key", F.explode("bands").alias("band")).distinct()
    n = b.withColumn("island", F.col("band") - F.row_number().over(Window.partitionBy("element_key").orderBy("band")))
    return n.groupBy("element_key", "island").agg(F.min("band").alias("first_band"), F.max("band").alias("last_band"), F.count("*").alias("n")).drop("island")


@query(
    "w29_page_segments",
    f"WITH {CURRENT}, n AS (SELECT book, page, y, element_key, coalesce((y - lag(y) OVER k > 0.05)::INT, 1) AS new FROM e WHERE y IS NOT NULL WINDOW k AS (PARTITION BY book, page ORDER BY y, element_key)), s AS (SELECT *, sum(new) OVER (PARTITION BY book, page ORDER BY y, element_key) AS segment FROM n) SELECT book, page, segment::BIGINT AS segment, count(*) AS n, min(y) AS low, max(y) AS high FROM s GROUP BY 1, 2, 3",
)
def page_segments(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "y").filter("y IS NOT NULL")
    return gap_clusters(e, ["book", "page"], "y", 0.05, ["element_key"], "segment").groupBy("book", "page", "segment").agg(F.count("*").alias("n"), F.min("y").alias("low"), F.max("y").alias("high"))


@query("w31_rectangles", f"WITH {CURRENT} SELECT element_key, len(list_distinct(list_transform(rows, lambda r: len(r)))) <= 1 AS rectangle, list_max(list_transform(rows, lambda r: len(r))) AS columns FROM e WHERE type = 'table' AND len(rows) > 0")
def rectangles(spark: SparkSession, d: str) -> DataFrame:
    sizes = F.transform("rows", lambda r: F.size(r))
    return current(spark, d, "type", "rows").filter("type = 'table' AND size(rows) > 0").select("element_key", (F.size(F.array_distinct(sizes)) <= 1).alias("rectangle"), F.array_max(sizes).alias("columns"))


@query("w39_page_boxes", f"WITH {CURRENT} SELECT book, page, round(min(x), 5) AS x, round(min(y), 5) AS y, round(max(x + w) - min(x), 5) AS w, round(max(y + h) - min(y), 5) AS h, min(confidence) AS confidence FROM e WHERE x IS NOT NULL GROUP BY 1, 2")
def page_boxes(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "x", "y", "w", "h", "confidence").filter("x IS NOT NULL")
    return e.groupBy("book", "page").agg(*union_box(F.col("x"), F.col("y"), F.col("w"), F.col("h")), F.min("confidence").alias("confidence"))


@query("s17_sample_texts", f"WITH {CURRENT}, p AS (SELECT book, page, dense_rank() OVER (PARTITION BY book ORDER BY page) AS place FROM (SELECT DISTINCT book, page FROM e)), t AS (SELECT book, page, idx, element_key, text FROM e JOIN p USING (book, page) WHERE place <= 15 AND text IS NOT NULL) SELECT book, substring(string_agg(text, chr(10) ORDER BY page, idx, element_key), 1, 40000) AS sample FROM t GROUP BY 1")
def sample_texts(spark: SparkSession, d: str) -> DataFrame:
    """The texts of a book's first fifteen pages, at most 40,000 characters: what a system is recognised by (a bound of the feature)."""
    e = current(spark, d, "book", "page", "idx", "text")
    pages = e.select("book", "page").distinct().withColumn("place", F.row_number().over(Window.partitionBy("book").orderBy("page"))).filter("place <= 15").select("book", "page")
    t = e.filter("text IS NOT NULL").join(pages, ["book", "page"]).groupBy("book").agg(F.array_sort(F.collect_list(F.struct("page", "idx", "element_key", "text"))).alias("t"))
    return t.select("book", F.substring(F.array_join(F.transform("t", lambda x: x["text"]), "\n"), 1, 40_000).alias("sample"))


@query("t05_longest_terms", "SELECT term, length(term) AS size FROM lexicon WHERE term IS NOT NULL")
def longest_terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lexicon").filter("term IS NOT NULL").select("term", F.length("term").cast("long").alias("size")).orderBy(F.desc("size"), "term")


@query("r30_text_gaps", f"WITH {CURRENT} SELECT type, count(*) AS n, count(*) FILTER (text IS NULL) AS without_text, count(*) FILTER (contains(text, chr(10))) AS several_lines, count(*) FILTER (regexp_matches(text, '\\s$|^\\s')) AS untrimmed FROM e GROUP BY 1")
def text_gaps(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "type", "text")
    return e.groupBy("type").agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("without_text"), F.count_if(F.contains("text", F.lit("\n"))).alias("several_lines"), F.count_if(F.col("text").rlike(r"\s\z|^\s")).alias("untrimmed"))
