"""Queries: page measures and classes, keyed lookups, reflow, validation, sweeps over records, credit for changes."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.functions.text import as_int, name_key, normalise
from kvarto.operators.lookups import range_lookup
from kvarto.operators.reflow import begins_paragraph, folded_lines, local_columns
from kvarto.operators.validation import FORMULA, bonus, row_shapes, typical_value, uneven_rows
from kvarto.plans import query
from kvarto.plans.elements import CURRENT, current
from kvarto.plans.screening import _FOLD, _NAME, _REAL, _TOKENS
from kvarto.operators.bags import word_bag
from kvarto.session import broadcast_checked
from kvarto.sources.tables import table

_MEASURES = f"""{CURRENT}, m AS (SELECT book, page, coalesce(sum(length(text)), 0)::BIGINT AS chars, coalesce(sum(len(regexp_extract_all(text, '\\S+'))), 0)::BIGINT AS words,
least(coalesce(sum(round(w * 1000)::BIGINT * round(h * 1000)::BIGINT) FILTER (text IS NOT NULL), 0), 1000000)::BIGINT / 1000000 AS text_coverage, least(coalesce(sum(round(w * 1000)::BIGINT * round(h * 1000)::BIGINT) FILTER (type = 'illustration'), 0), 1000000)::BIGINT / 1000000 AS image_coverage,
substring(string_agg(text, ' ' ORDER BY idx, element_key), 1, 100) AS sample FROM e WHERE NOT coalesce(removed, false) GROUP BY 1, 2)"""


def _measures(spark: SparkSession, d: str) -> DataFrame:
    """Characters, words, share of the page under text and under images, first 100 characters of every page."""
    e = current(spark, d, "book", "page", "idx", "type", "text", "w", "h", "removed").filter("NOT coalesce(removed, false)")
    # boxes have three decimals: their areas are summed as whole numbers
    millionths = F.round(F.col("w") * 1000).cast("long") * F.round(F.col("h") * 1000).cast("long")
    area = lambda on: F.least(F.coalesce(F.sum(F.when(on, millionths)), F.lit(0)), F.lit(1_000_000)) / 1_000_000
    texts = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("idx", "element_key", "text"))))
    m = e.groupBy("book", "page").agg(
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.coalesce(F.sum(F.regexp_count("text", F.lit(r"\S+"))), F.lit(0)).alias("words"),
        area(F.col("text").isNotNull()).alias("text_coverage"), area(F.col("type") == "illustration").alias("image_coverage"), texts.alias("t"),
    )
    sample = F.when(F.size("t") > 0, F.substring(F.array_join(F.transform("t", lambda x: x["text"]), " "), 1, 100))
    return m.withColumn("sample", sample).drop("t")


@query("s01_page_measures", f"WITH {_MEASURES} SELECT * FROM m")
def page_measures(spark: SparkSession, d: str) -> DataFrame:
    return _measures(spark, d)


@query("pf01_page_class", f"WITH {_MEASURES} SELECT book, page, CASE WHEN chars < 20 AND image_coverage > 0 THEN 'image_only' WHEN chars < 20 THEN 'empty' WHEN text_coverage < 0.02 AND image_coverage > 0.5 THEN 'stub' WHEN image_coverage > 0.5 THEN 'ocr_layer' ELSE 'digital_text' END AS class FROM m")
def page_class(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.expr("chars < 20 AND image_coverage > 0"), "image_only").when(F.col("chars") < 20, "empty").when(F.expr("text_coverage < 0.02 AND image_coverage > 0.5"), "stub").when(F.col("image_coverage") > 0.5, "ocr_layer").otherwise("digital_text")
    return _measures(spark, d).select("book", "page", kind.alias("class"))


def page_set(spec: str) -> list[int]:
    """The pages of a list like `3,5-9`; an empty part names none, a range that runs down is empty."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        first, _, last = part.partition("-")
        out.update(range(int(first), int(last or first) + 1))
    return sorted(out)


@query("pf02_page_range", "SELECT book, page, count(*) AS rows FROM bok WHERE page = 3 OR page BETWEEN 5 AND 9 GROUP BY 1, 2")
def page_range(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").filter(F.col("page").isin(page_set("3,5-9"))).groupBy("book", "page").agg(F.count("*").alias("rows"))


@query("pf06_rendered", f"WITH {CURRENT} SELECT type, count(*) FILTER (NOT coalesce(removed, false) AND (coalesce(text, '') <> '' OR coalesce(len(rows), 0) > 0 OR coalesce(len(items), 0) > 0)) AS rendered, count(*) FILTER (method = 'embedded') AS embedded, count(*) AS n FROM e GROUP BY 1")
def rendered(spark: SparkSession, d: str) -> DataFrame:
    """Elements of each type that an export shows, and those read from an embedded text layer."""
    e = current(spark, d, "type", "text", "rows", "items", "removed", "method")
    shows = ~F.coalesce("removed", F.lit(False)) & ((F.coalesce("text", F.lit("")) != "") | (F.coalesce(F.size("rows"), F.lit(0)) > 0) | (F.coalesce(F.size("items"), F.lit(0)) > 0))
    return e.groupBy("type").agg(F.count_if(shows).alias("rendered"), F.count_if(F.col("method") == "embedded").alias("embedded"), F.count("*").alias("n"))


@query("pf10_page_summary", f"WITH {CURRENT}, p AS (SELECT book, page, count(*) FILTER (type <> 'illustration') AS rows, count(*) FILTER (type = 'illustration') AS graphics, count(*) FILTER (type = 'illustration' OR region = 'helbredd') AS wide, count(*) AS n FROM e WHERE x IS NOT NULL GROUP BY 1, 2) SELECT book, page, rows, graphics, wide * 2 > n AS graphic FROM p")
def page_summary(spark: SparkSession, d: str) -> DataFrame:
    """Rows and graphics of every page; a page is graphic where most of what was measured is graphic or as wide as the page."""
    e = current(spark, d, "book", "page", "type", "region", "x").filter("x IS NOT NULL")
    p = e.groupBy("book", "page").agg(F.count_if(F.col("type") != "illustration").alias("rows"), F.count_if(F.col("type") == "illustration").alias("graphics"), F.count_if(F.expr("type = 'illustration' OR region = 'helbredd'")).alias("wide"), F.count("*").alias("n"))
    return p.select("book", "page", "rows", "graphics", (F.col("wide") * 2 > F.col("n")).alias("graphic"))


@query("pf11_structural_records", "SELECT correction_id, CASE WHEN starts_with(original, 'type: ') THEN 'field' WHEN json_valid(original) AND regexp_matches(original, '^\\s*[\\[{]') THEN 'json' WHEN regexp_matches(original, '\"\\w+\"\\s*:') THEN 'fragment' ELSE 'text' END AS form FROM corrections WHERE original IS NOT NULL")
def structural_records(spark: SparkSession, d: str) -> DataFrame:
    """Whether a record changes the structure of an element or its text."""
    form = F.when(F.startswith("original", F.lit("type: ")), "field").when(F.expr("try_parse_json(original) IS NOT NULL") & F.col("original").rlike(r"^\s*[\[{]"), "json").when(F.col("original").rlike(r'"\w+"\s*:'), "fragment").otherwise("text")
    return table(spark, d, "corrections").filter("original IS NOT NULL").select("correction_id", form.alias("form"))


@query("pf18_standard_names", "SELECT book, regexp_matches(book, '^[A-Z0-9]{2,4}-[A-Z]{3}-[a-z0-9]+(-[a-z0-9]+)*$') AS standard, split_part(book, '-', 2) IS NOT DISTINCT FROM doc_type AS type_agrees FROM books")
def standard_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("book", F.col("book").rlike(r"^[A-Z0-9]{2,4}-[A-Z]{3}-[a-z0-9]+(-[a-z0-9]+)*$").alias("standard"), F.split_part("book", F.lit("-"), F.lit(2)).eqNullSafe(F.col("doc_type")).alias("type_agrees"))


#: the bonus that the sum of two values brings, by bands
BONUS_BANDS = [(2, 12, "-1T4"), (13, 24, "0"), (25, 32, "+1T4"), (33, 40, "+1T6"), (41, 60, "+2T6")]
_STAT = r"\b{0} (\d{{1,2}})\b"
_STATS = f"{CURRENT}, s AS (SELECT element_key, TRY_CAST(nullif(regexp_extract(text, '{_STAT.format('STY')}', 1), '') AS INT) + TRY_CAST(nullif(regexp_extract(text, '{_STAT.format('STO')}', 1), '') AS INT) AS total FROM e WHERE type = 'statblock' AND text IS NOT NULL)"


@query("j06_bonus_lookup", f"WITH {_STATS}, b AS (SELECT * FROM (VALUES {', '.join(map(str, BONUS_BANDS))}) v(low, high, bonus)) SELECT element_key, total, bonus FROM s LEFT JOIN b ON total BETWEEN low AND high WHERE total IS NOT NULL")
def bonus_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The bonus of every statblock by the sum of its strength and size."""
    value = lambda name: F.regexp_extract("text", _STAT.format(name), 1).try_cast("int")
    s = current(spark, d, "type", "text").filter("type = 'statblock' AND text IS NOT NULL").select("element_key", (value("STY") + value("STO")).alias("total")).filter("total IS NOT NULL")
    return range_lookup(s, F.col("total"), spark.createDataFrame(BONUS_BANDS, "low int, high int, bonus string"), "low", "high", ["bonus"])


def _gear_sql(slot: str, reference: str, ident: str, extra: str) -> str:
    return f"WITH l AS (SELECT row_id, {_NAME.format('substring(text, ' + str(len(slot) + 2) + ')')} AS key FROM bok WHERE type = 'list_item' AND starts_with(text, '{slot}:')), r AS (SELECT {_NAME.format('name')} AS key, min({ident}) AS item, min({extra}) AS found FROM {reference} GROUP BY 1 HAVING count(*) = 1) SELECT row_id, item, found FROM l JOIN r USING (key)"


def _gear(spark: SparkSession, d: str, slot: str, reference: str, ident: str, extra: str) -> DataFrame:
    """Gear lines whose normalised name is exactly that of one entry."""
    lines = table(spark, d, "bok").filter((F.col("type") == "list_item") & F.startswith("text", F.lit(slot + ":"))).select("row_id", name_key(F.expr(f"substring(text, {len(slot) + 2})")).alias("key"))
    entries = table(spark, d, reference).groupBy(name_key(F.col("name")).alias("key")).agg(F.min(ident).alias("item"), F.min(extra).alias("found"), F.count("*").alias("n")).filter("n = 1").drop("n")
    return lines.join(broadcast_checked(entries, 10_000), "key").select("row_id", "item", "found")


@query("j25_weapon_lookup", _gear_sql("Vapen", "weapons", "weapon_id", "weaponGroup"))
def weapon_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _gear(spark, d, "Vapen", "weapons", "weapon_id", "weaponGroup")


@query("j26_armour_lookup", _gear_sql("Rustning", "armor", "armor_id", "bodyPart"))
def armour_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _gear(spark, d, "Rustning", "armor", "armor_id", "bodyPart")


@query("j08_term_lookup", f"WITH i AS (SELECT element_key, list_position(items, item) AS place, item FROM (SELECT element_key, items, unnest(items) AS item FROM (SELECT * FROM bok QUALIFY row_number() OVER (PARTITION BY element_key ORDER BY updated_at DESC NULLS LAST, row_id) = 1) WHERE type = 'list')), k AS (SELECT DISTINCT element_key, {_NAME.format('item')} AS key FROM i WHERE item IS NOT NULL), t AS (SELECT {_NAME.format('term')} AS key, min(kind) AS kind FROM lexicon WHERE term IS NOT NULL GROUP BY 1) SELECT element_key, key, kind FROM k JOIN t USING (key)")
def term_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Items of lists that are terms of the lexicon by their normalised form."""
    items = current(spark, d, "type", "items").filter("type = 'list'").select("element_key", F.explode("items").alias("item")).filter("item IS NOT NULL").select("element_key", name_key(F.col("item")).alias("key")).distinct()
    terms = table(spark, d, "lexicon").filter("term IS NOT NULL").groupBy(name_key(F.col("term")).alias("key")).agg(F.min("kind").alias("kind"))
    return items.join(broadcast_checked(terms, 200_000), "key").select("element_key", "key", "kind")


@query("j11_fallback_chain", f"WITH w AS (SELECT DISTINCT lower(word) AS word FROM (SELECT {_TOKENS.format('original')} AS word FROM corrections WHERE original IS NOT NULL) WHERE {_REAL}), l AS (SELECT lower(term) AS word, min(coalesce(category, kind)) AS category FROM lexicon WHERE term IS NOT NULL GROUP BY 1), c AS (SELECT lower(word) AS word, min(lang) AS lang FROM common_words WHERE word IS NOT NULL GROUP BY 1), g AS (SELECT lower(name) AS word, min(weaponGroup) AS grp FROM weapons GROUP BY 1) SELECT word, coalesce(l.category, CASE WHEN regexp_matches(word, 'språk|tal$') THEN 'språk' END, g.grp, c.lang) AS target FROM w LEFT JOIN l USING (word) LEFT JOIN g USING (word) LEFT JOIN c USING (word) WHERE coalesce(l.category, CASE WHEN regexp_matches(word, 'språk|tal$') THEN 'språk' END, g.grp, c.lang) IS NOT NULL")
def fallback_chain(spark: SparkSession, d: str) -> DataFrame:
    """What a word is: by the lexicon, else a language by its form, else the group of a weapon, else the language it is common in."""
    words = word_bag(table(spark, d, "corrections"), F.col("original")).select(F.lower("word").alias("word")).distinct()
    dim = lambda df, key, value, name: broadcast_checked(df.filter(F.col(key).isNotNull()).groupBy(F.lower(key).alias("word")).agg(F.min(value).alias(name)), 200_000)
    w = words.join(dim(table(spark, d, "lexicon"), "term", F.coalesce("category", "kind"), "category"), "word", "left").join(dim(table(spark, d, "weapons"), "name", "weaponGroup", "grp"), "word", "left").join(dim(table(spark, d, "common_words"), "word", "lang", "lang"), "word", "left")
    return w.select("word", F.coalesce("category", F.when(F.col("word").rlike("språk|tal$"), "språk"), "grp", "lang").alias("target")).filter("target IS NOT NULL")


@query("j05_system_ids", "WITH a AS (SELECT upper(system) AS id, count(*) AS books FROM books WHERE system IS NOT NULL GROUP BY 1) SELECT b.book, a.id AS system, a.books FROM books b LEFT JOIN a ON a.id = upper(split_part(b.book, '-', 1))")
def system_ids(spark: SparkSession, d: str) -> DataFrame:
    """The system that a book's name begins with, found whatever its case, with the number of its books; null if there is none."""
    books = table(spark, d, "books")
    a = books.filter("system IS NOT NULL").groupBy(F.upper("system").alias("system")).agg(F.count("*").alias("books"))
    return books.select("book", F.upper(F.split_part("book", F.lit("-"), F.lit(1))).alias("key")).join(a, F.col("key") == F.col("system"), "left").select("book", "system", "books")


_LEADERS = "regexp_replace(trim(regexp_replace(upper({0}), '\\.{{2,}}.*$', '')), '[:.\\s]+$', '')"


@query("j21_heading_levels", f"WITH {CURRENT}, p AS (SELECT book, min(page) AS toc FROM e WHERE type = 'toc_entry' GROUP BY 1), t AS (SELECT DISTINCT book, {_LEADERS.format('text')} AS title FROM e WHERE type = 'toc_entry' AND text IS NOT NULL) "
       f"SELECT e.element_key, CASE WHEN style IS NOT NULL OR toc IS NULL OR page < toc THEN level WHEN page = toc THEN 1 WHEN t.title IS NOT NULL THEN 2 ELSE least(level + 1, 3) END::INT AS planned FROM e LEFT JOIN p ON p.book = e.book LEFT JOIN t ON t.book = e.book AND t.title = {_LEADERS.format('e.text')} WHERE e.type = 'heading'")
def heading_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels of headings by the table of contents: what is stamped or stands before it keeps its own, its own page has 1, its titles 2, the rest one more, 3 at most."""
    e = current(spark, d, "book", "page", "type", "level", "text", "style")
    key = F.regexp_replace(F.trim(F.regexp_replace(F.upper("text"), r"\.{2,}.*$", "")), r"[:.\s]+$", "")
    toc = e.filter("type = 'toc_entry'")
    first, titles = toc.groupBy("book").agg(F.min("page").alias("toc")), toc.filter("text IS NOT NULL").select("book", key.alias("title")).distinct().withColumn("listed", F.lit(True))
    h = e.filter("type = 'heading'").withColumn("title", key).join(first, "book", "left").join(titles, ["book", "title"], "left")
    level = F.when(F.expr("style IS NOT NULL OR toc IS NULL OR page < toc"), F.col("level")).when(F.col("page") == F.col("toc"), 1).when(F.col("listed"), 2).otherwise(F.least(F.col("level") + 1, F.lit(3)))
    return h.select("element_key", level.cast("int").alias("planned"))


_SPANS = f"{CURRENT}, r AS (SELECT element_key, book, page, idx, len(string_split(text, chr(10))) AS lines, len(bands) AS n, CASE WHEN len(bands) = 1 OR len(bands) >= 2 AND len(bands) = len(string_split(text, chr(10))) THEN bands END AS own FROM e WHERE text IS NOT NULL AND bands IS NOT NULL AND len(bands) > 0)"


def _spans(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "idx", "text", "bands").filter("text IS NOT NULL AND size(bands) > 0")
    lines = F.size(F.split("text", "\n"))
    return e.select("element_key", "book", "page", "idx", F.when((F.size("bands") == 1) | (F.size("bands") == lines), F.col("bands")).alias("own"))


@query("j27_row_spans", f"WITH {_SPANS} SELECT element_key, own[1] AS first_row, own[len(own)] AS last_row FROM r")
def row_spans(spark: SparkSession, d: str) -> DataFrame:
    """First and last measured row of an element; null where it has several and not one for each of its lines."""
    return _spans(spark, d).select("element_key", F.try_element_at("own", F.lit(1)).alias("first_row"), F.try_element_at("own", F.lit(-1)).alias("last_row"))


@query("j28_next_rows", f"WITH {_SPANS} SELECT element_key, CASE WHEN len(own) >= 2 THEN own[2] ELSE lead(own[1]) OVER (PARTITION BY book, page ORDER BY idx, element_key) END AS next_row FROM r")
def next_rows(spark: SparkSession, d: str) -> DataFrame:
    """The row after an element's first: its own second, else the first of the next element of the page."""
    w = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    return _spans(spark, d).select("element_key", F.when(F.size("own") >= 2, F.try_element_at("own", F.lit(2))).otherwise(F.lead(F.try_element_at("own", F.lit(1))).over(w)).alias("next_row"))


_COLUMNS = f"""{CURRENT}, b AS (SELECT book, page, idx, element_key, text, x, w FROM e WHERE type = 'paragraph' AND text IS NOT NULL AND NOT coalesce(removed, false)),
n AS (SELECT a.element_key, round(b.x / 0.005) AS bucket, b.w FROM b a JOIN b ON a.book = b.book AND a.page = b.page AND round(abs(a.x - b.x), 6) <= 0.04),
k AS (SELECT element_key, bucket, count(*) AS c FROM n GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY element_key ORDER BY count(*) DESC, bucket) = 1),
l AS (SELECT k.element_key, round(bucket * 0.005, 6) AS column_x, round((SELECT median(w) FROM n WHERE n.element_key = k.element_key), 6) AS column_w FROM k)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "book", "page", "idx", "type", "text", "x", "w", "removed").filter("type = 'paragraph' AND text IS NOT NULL AND NOT coalesce(removed, false)")


@query("a12_local_columns", f"WITH {_COLUMNS} SELECT * FROM l")
def columns_of_lines(spark: SparkSession, d: str) -> DataFrame:
    return local_columns(_lines(spark, d).filter("x IS NOT NULL"), ["book", "page"], "element_key")


_STARTS = f"""{_COLUMNS}, q AS (SELECT book, page, median(w) AS prose FROM b WHERE w IS NOT NULL GROUP BY 1, 2), o AS (SELECT b.*, column_x, prose, lag(text) OVER k AS pt, lag(x) OVER k AS px, lag(b.w) OVER k AS pw, lag(column_w) OVER k AS pc, lead(x) OVER k AS nx FROM b LEFT JOIN l USING (element_key) LEFT JOIN q USING (book, page) WINDOW k AS (PARTITION BY book, page ORDER BY idx, element_key)),
z AS (SELECT *, CASE WHEN regexp_matches(text, '^\\p{{Lu}}[\\p{{L}} ]{{0,24}}: ') OR pt IS NULL THEN true WHEN regexp_matches(rtrim(pt), '-$') AND NOT regexp_matches(rtrim(pt), '( -|--)$') THEN false WHEN x IS NULL OR px IS NULL THEN true
WHEN round(pw - 0.5 * prose, 6) < 0 OR round(pw - 0.92 * pc, 6) < 0 THEN true WHEN round(x - column_x - 0.018, 6) < 0 THEN false WHEN round(abs(x - px) - 0.018, 6) < 0 OR round(abs(nx - x) - 0.018, 6) < 0 THEN false ELSE true END AS begins FROM o)"""


def _starts(spark: SparkSession, d: str) -> DataFrame:
    b = _lines(spark, d)
    columns = local_columns(b.filter("x IS NOT NULL"), ["book", "page"], "element_key")
    prose = b.filter("w IS NOT NULL").groupBy("book", "page").agg(F.median("w").alias("prose"))  # a page's lines
    k = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    o = b.join(columns, "element_key", "left").join(prose, ["book", "page"], "left").withColumns({"pt": F.lag("text").over(k), "px": F.lag("x").over(k), "pw": F.lag("w").over(k), "pc": F.lag("column_w").over(k), "nx": F.lead("x").over(k)})
    return o.withColumn("begins", begins_paragraph(*[F.col(c) for c in ("text", "pt", "x", "px", "pw", "nx", "column_x", "pc", "prose")]))


@query("w09_paragraph_starts", f"WITH {_STARTS} SELECT element_key, begins FROM z")
def paragraph_starts(spark: SparkSession, d: str) -> DataFrame:
    return _starts(spark, d).select("element_key", "begins")


_JOIN = (
    "CASE WHEN rtrim(a) = '' THEN ltrim(b) WHEN ltrim(b) = '' THEN rtrim(a) WHEN regexp_matches(rtrim(a), '-$') AND NOT regexp_matches(rtrim(a), '( -|--)$') THEN "
    "CASE WHEN regexp_matches(ltrim(b), '^(-|(och|eller|samt|respektive)\\b)') THEN rtrim(a) || ' ' || ltrim(b) WHEN regexp_matches(ltrim(b), '^\\p{Ll}') AND regexp_matches(rtrim(a), '\\p{Lu}{2,}-$') THEN rtrim(a) || ltrim(b) "
    "WHEN regexp_matches(ltrim(b), '^\\p{Ll}') OR regexp_matches(rtrim(a), '\\p{Lu}{2,}-$') AND regexp_matches(ltrim(b), '^\\p{Lu}{2,}') THEN left(rtrim(a), length(rtrim(a)) - 1) || ltrim(b) ELSE rtrim(a) || ' ' || ltrim(b) END "
    "WHEN regexp_matches(rtrim(a), '/$') AND NOT regexp_matches(rtrim(a), '( /|//)$') THEN rtrim(a) || ltrim(b) ELSE rtrim(a) || ' ' || ltrim(b) END"
)


@query("f22_joined_lines", f"SELECT row_id, list_reduce(string_split_regex(text, '\r?\n'), lambda a, b: {_JOIN}, '') AS joined FROM bok WHERE type IN ('paragraph', 'boxed_text') AND text IS NOT NULL AND contains(text, chr(10))")
def joined_lines(spark: SparkSession, d: str) -> DataFrame:
    """Texts of several printed lines as one line each."""
    t = table(spark, d, "bok").filter(F.col("type").isin("paragraph", "boxed_text") & F.contains("text", F.lit("\n")))
    return t.select("row_id", folded_lines(F.split("text", r"\r?\n")).alias("joined"))


@query("w10_joined_paragraphs", f"WITH {_STARTS}, f AS (SELECT *, sum(begins::INT) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS flow FROM z) SELECT book, page, flow::BIGINT AS flow, count(*) AS parts, list_reduce(list(text ORDER BY idx, element_key), lambda a, b: {_JOIN}, '') AS text FROM f GROUP BY 1, 2, 3")
def joined_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraph elements of a page that go on, as one text each."""
    k = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    f = _starts(spark, d).withColumn("flow", F.sum(F.col("begins").cast("int")).over(k))
    g = f.groupBy("book", "page", "flow").agg(F.count("*").alias("parts"), F.array_sort(F.collect_list(F.struct("idx", "element_key", "text"))).alias("t"))
    return g.select("book", "page", "flow", "parts", folded_lines(F.transform("t", lambda x: x["text"])).alias("text"))


@query("w35_row_diagnosis", f"WITH {CURRENT}, s AS (SELECT element_key, list_transform(rows, lambda r: coalesce(len(r), 0)) AS sizes FROM e WHERE type = 'table' AND len(rows) > 0), u AS (SELECT element_key, generate_subscripts(sizes, 1) AS place, unnest(sizes) AS cells FROM s), m AS (SELECT element_key, cells AS often FROM u GROUP BY element_key, cells QUALIFY row_number() OVER (PARTITION BY element_key ORDER BY count(*) DESC, cells DESC) = 1) SELECT element_key, place::INT AS place, cells::INT AS cells, CASE WHEN cells < often THEN 'short' ELSE 'long' END AS shape FROM u JOIN m USING (element_key) WHERE cells <> often")
def row_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    """Table rows that are shorter or longer than most of their table."""
    t = current(spark, d, "type", "rows").filter("type = 'table' AND size(rows) > 0")
    u = t.select("element_key", F.posexplode(F.arrays_zip(F.transform("rows", lambda r: F.coalesce(F.size(r), F.lit(0))).alias("cells"), row_shapes(F.col("rows")).alias("shape"))).alias("at", "r"))
    return u.filter("r.shape <> 'full'").select("element_key", (F.col("at") + 1).alias("place"), "r.cells", "r.shape")


@query("r26_uneven_rows", f"WITH {CURRENT}, t AS (SELECT element_key, len(headers) AS n, rows FROM e WHERE type = 'table' AND len(headers) > 0 AND len(rows) > 0), u AS (SELECT element_key, n, generate_subscripts(rows, 1) AS place, coalesce(len(unnest(rows)), 0) AS cells FROM t) SELECT element_key, place::INT AS place FROM u WHERE cells <> n AND element_key NOT IN (SELECT element_key FROM u GROUP BY 1 HAVING bool_and(cells = n + 1))")
def table_rows_uneven(spark: SparkSession, d: str) -> DataFrame:
    t = current(spark, d, "type", "headers", "rows").filter("type = 'table'")
    return t.select("element_key", F.explode(uneven_rows(F.col("headers"), F.col("rows"))).alias("place"))


_CELLS = f"{CURRENT}, c AS (SELECT element_key, trim(cell) AS cell FROM (SELECT element_key, unnest(flatten(list_filter(rows, lambda r: r IS NOT NULL))) AS cell FROM e WHERE type = 'table') WHERE cell IS NOT NULL)"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    t = current(spark, d, "type", "rows").filter("type = 'table'")
    return t.select("element_key", F.explode(F.flatten(F.filter("rows", lambda r: r.isNotNull()))).alias("cell")).filter("cell IS NOT NULL").withColumn("cell", F.trim("cell"))


@query("f10_typical_values", f"WITH {_CELLS}, p AS (SELECT cell, count(*) AS n FROM c WHERE regexp_matches(cell, '{FORMULA}') GROUP BY 1) SELECT cell, n, floor(regexp_extract(cell, '{FORMULA}', 1)::INT * (regexp_extract(cell, '{FORMULA}', 2)::INT + 1) / 2 + coalesce(TRY_CAST(nullif(replace(regexp_extract(cell, '{FORMULA}', 3), ' ', ''), '') AS INT), 0) + 0.5)::INT AS typical FROM p")
def typical_values(spark: SparkSession, d: str) -> DataFrame:
    """The typical value of every dice formula in table cells."""
    return _cells(spark, d).filter(F.col("cell").rlike(FORMULA)).groupBy("cell").agg(F.count("*").alias("n")).withColumn("typical", typical_value(F.col("cell")))


@query("f11_bonus_forms", f"WITH {_CELLS} SELECT CASE WHEN replace(cell, ' ', '') IN ('—', '–', '-', '0', '') THEN '0' ELSE upper(regexp_replace(replace(cell, ' ', ''), '^\\++', '')) END AS bonus, count(*) AS n FROM c WHERE length(cell) <= 6 GROUP BY 1")
def bonus_forms(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).filter("length(cell) <= 6").groupBy(bonus(F.col("cell")).alias("bonus")).agg(F.count("*").alias("n"))


@query("f42_cell_integers", f"WITH {_CELLS} SELECT cell, count(*) AS n, regexp_extract(cell, '^(\\d{{1,3}})\\s*%?$', 1)::INT AS value FROM c WHERE regexp_matches(cell, '^\\d{{1,3}}\\s*%?$') GROUP BY 1")
def cell_integers(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).filter(F.col("cell").rlike(r"^\d{1,3}\s*%?$")).groupBy("cell").agg(F.count("*").alias("n")).withColumn("value", as_int(F.col("cell")))


@query("r28_table_stats", f"WITH {CURRENT}, u AS (SELECT element_key, generate_subscripts(rows, 1) AS place, unnest(rows) AS r FROM e WHERE type = 'table') SELECT element_key, place::INT AS place, trim(r[1]) AS label, trim(r[2]) AS formula, list_filter(list_transform(r[2:], lambda c: trim(c)), lambda c: c <> '')[-1] AS value FROM u WHERE len(r) >= 3 AND trim(r[1]) <> '' AND regexp_matches(trim(r[2]), '{FORMULA}')")
def table_stats(spark: SparkSession, d: str) -> DataFrame:
    """Rows of tables that give a label, a formula and a value."""
    u = current(spark, d, "type", "rows").filter("type = 'table'").select("element_key", F.posexplode("rows").alias("at", "r"))
    cell = lambda i: F.trim(F.try_element_at("r", F.lit(i)))
    values = F.filter(F.transform(F.expr("slice(r, 2, size(r))"), lambda c: F.trim(c)), lambda c: c != "")
    return u.filter((F.size("r") >= 3) & (cell(1) != "") & cell(2).rlike(FORMULA)).select("element_key", (F.col("at") + 1).alias("place"), cell(1).alias("label"), cell(2).alias("formula"), F.try_element_at(values, F.lit(-1)).alias("value"))


@query("r27_page_validation", f"WITH {CURRENT} SELECT book, page, count(*) AS elements, count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (type IN ('heading', 'paragraph', 'boxed_text') AND coalesce(trim(text), '') = '') AS without_text, count(*) FILTER (type = 'table' AND coalesce(len(rows), 0) = 0) AS empty_tables, count(*) FILTER (type = 'list' AND coalesce(len(items), 0) = 0) AS empty_lists FROM e GROUP BY 1, 2")
def page_validation(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "type", "text", "rows", "items", "needs_review")
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    return e.groupBy("book", "page").agg(
        F.count("*").alias("elements"), F.count_if("needs_review").alias("needs_review"), F.count_if(F.col("type").isin("heading", "paragraph", "boxed_text") & blank).alias("without_text"),
        F.count_if((F.col("type") == "table") & none("rows")).alias("empty_tables"), F.count_if((F.col("type") == "list") & none("items")).alias("empty_lists"),
    )


@query("r20_emptied_artifacts", f"WITH {CURRENT} SELECT element_key, confidence AS before, 1.0::DOUBLE AS confidence, 'emptied artifact' AS reason FROM e WHERE type = 'page_artifact' AND coalesce(trim(text), '') = '' AND confidence < 1")
def emptied_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Artifacts whose text was emptied are certain; each change with its record."""
    e = current(spark, d, "type", "text", "confidence").filter("type = 'page_artifact' AND coalesce(trim(text), '') = '' AND confidence < 1")
    return e.select("element_key", F.col("confidence").alias("before"), F.lit(1.0).alias("confidence"), F.lit("emptied artifact").alias("reason"))


@query("r21_filled_kinds", "SELECT correction_id, CASE WHEN starts_with(source, 'anvandare:boknivabeslut') THEN 'emendering' ELSE 'ocr' END AS kind FROM corrections WHERE kind IS NULL")
def filled_kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corrections").filter("kind IS NULL").select("correction_id", F.when(F.startswith("source", F.lit("anvandare:boknivabeslut")), "emendering").otherwise("ocr").alias("kind"))


@query("r22_filled_verdicts", "SELECT correction_id, CASE WHEN applied THEN 'applicerad' WHEN confidence < 0.5 OR regexp_matches(lower(coalesce(reason, '')), 'avvis|osäker') THEN 'avvisad' END AS verdict FROM corrections WHERE verdict IS NULL AND (applied OR confidence < 0.5 OR regexp_matches(lower(coalesce(reason, '')), 'avvis|osäker'))")
def filled_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts that a record's other fields already tell."""
    c = table(spark, d, "corrections").filter("verdict IS NULL")
    verdict = F.when(F.col("applied"), "applicerad").when((F.col("confidence") < 0.5) | F.lower(F.coalesce("reason", F.lit(""))).rlike("avvis|osäker"), "avvisad")
    return c.select("correction_id", verdict.alias("verdict")).filter("verdict IS NOT NULL")


@query("r32_open_questions", "SELECT book, coalesce(kind, 'none') AS kind, count(*) AS open, min(correction_id) AS first FROM corrections WHERE verdict IS NULL AND NOT coalesce(applied, false) GROUP BY 1, 2")
def open_questions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corrections").filter("verdict IS NULL AND NOT coalesce(applied, false)")
    return c.groupBy("book", F.coalesce("kind", F.lit("none")).alias("kind")).agg(F.count("*").alias("open"), F.min("correction_id").alias("first"))


_WORDS = lambda field, where: f"SELECT book, word, count(*) AS n FROM (SELECT book, {_TOKENS.format(field)} AS word FROM {where}) WHERE {_REAL} GROUP BY 1, 2"
_CREDIT = f"""WITH a AS ({_WORDS('text', "bok WHERE stage = 'embedded'")}), z AS ({_WORDS('text', "bok WHERE stage = 'final'")}), c AS ({_WORDS('original', 'corrections WHERE applied')}), g AS ({_WORDS('text', "bok WHERE added_by IS NOT NULL")}),
l AS (SELECT a.book, a.word, a.n - coalesce(z.n, 0) AS lost FROM a LEFT JOIN z USING (book, word) WHERE a.n > coalesce(z.n, 0)), r AS (SELECT l.book, l.word, lost, least(lost, coalesce(c.n, 0)) AS by_record, least(greatest(lost - coalesce(c.n, 0), 0), coalesce(g.n, 0)) AS by_added FROM l LEFT JOIN c USING (book, word) LEFT JOIN g USING (book, word))"""


def _credit(spark: SparkSession, d: str) -> DataFrame:
    """Words that the last stage lacks, credited to applied records first, then to elements that an agent added."""
    bok, c = table(spark, d, "bok"), table(spark, d, "corrections").filter("applied")
    bag = lambda df, field, n: word_bag(df, F.col(field), ["book"]).withColumnRenamed("n", n)
    keys, zero = ["book", "word"], lambda n: F.coalesce(n, F.lit(0))
    a = bag(bok.filter("stage = 'embedded'"), "text", "a").join(bag(bok.filter("stage = 'final'"), "text", "z"), keys, "left").filter(F.col("a") > zero("z"))
    lost = a.withColumn("lost", F.col("a") - zero("z")).join(bag(c, "original", "c"), keys, "left").join(bag(bok.filter("added_by IS NOT NULL"), "text", "g"), keys, "left")
    return lost.select("book", "word", "lost", F.least(F.col("lost"), zero("c")).alias("by_record"), F.least(F.greatest(F.col("lost") - zero("c"), F.lit(0)), zero("g")).alias("by_added"))


@query("j19_credited_changes", _CREDIT + " SELECT * FROM r")
def credited_changes(spark: SparkSession, d: str) -> DataFrame:
    return _credit(spark, d)


@query("b06_publishable", _CREDIT + ", u AS (SELECT book, sum(lost - by_record - by_added) AS open FROM r GROUP BY 1) SELECT b.book, coalesce(u.open, 0)::BIGINT AS unexplained, coalesce(u.open, 0) = 0 AS publishable FROM books b LEFT JOIN u USING (book)")
def publishable(spark: SparkSession, d: str) -> DataFrame:
    """Books that lost no word without an account of it."""
    u = _credit(spark, d).groupBy("book").agg(F.sum(F.col("lost") - F.col("by_record") - F.col("by_added")).alias("open"))
    b = table(spark, d, "books").select("book").join(u, "book", "left")
    return b.select("book", F.coalesce("open", F.lit(0)).alias("unexplained"), (F.coalesce("open", F.lit(0)) == 0).alias("publishable"))


@query("b08_merge_violations", "SELECT element_key, max(confidence) AS expected, arg_max(confidence, (created_at, correction_id)) AS got FROM corrections WHERE confidence IS NOT NULL AND created_at IS NOT NULL AND element_key IS NOT NULL GROUP BY 1 HAVING max(confidence) <> arg_max(confidence, (created_at, correction_id))")
def merge_violations(spark: SparkSession, d: str) -> DataFrame:
    """Elements whose latest record isn't as sure as the surest that any contributed."""
    g = table(spark, d, "corrections").filter("confidence IS NOT NULL AND created_at IS NOT NULL AND element_key IS NOT NULL").groupBy("element_key").agg(F.max("confidence").alias("expected"), F.max_by("confidence", F.struct("created_at", "correction_id")).alias("got"))
    return g.filter("expected <> got")


@query("t06_phrases", "SELECT term, len(string_split(trim(term), ' '))::INT AS words FROM lexicon WHERE contains(trim(term), ' ') UNION ALL SELECT name, len(string_split(trim(name), ' '))::INT FROM weapons WHERE contains(trim(name), ' ') UNION ALL SELECT name, len(string_split(trim(name), ' '))::INT FROM armor WHERE contains(trim(name), ' ')")
def phrases(spark: SparkSession, d: str) -> DataFrame:
    """Terms of several words, those of most words first: a longer phrase is looked for before a shorter one."""
    names = table(spark, d, "lexicon").select("term").unionByName(table(spark, d, "weapons").select(F.col("name").alias("term"))).unionByName(table(spark, d, "armor").select(F.col("name").alias("term")))
    return names.filter("contains(trim(term), ' ')").select("term", F.size(F.split(F.trim("term"), " ")).alias("words")).orderBy(F.desc("words"), "term")


@query("f04_candidate_names", "SELECT regexp_replace(lower(trim(title)), '\\s+', ' ', 'g') AS candidate, count(*) AS n FROM documents WHERE title IS NOT NULL GROUP BY 1")
def candidate_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("title IS NOT NULL").groupBy(F.regexp_replace(F.lower(F.trim("title")), r"\s+", " ").alias("candidate")).agg(F.count("*").alias("n"))


@query("f28_field_values", f"WITH {CURRENT} SELECT element_key, array_to_string(list_transform(items, lambda i: coalesce(i, '')), ', ') AS value FROM e WHERE type = 'list' AND items IS NOT NULL")
def field_values(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "type", "items").filter("type = 'list' AND items IS NOT NULL")
    return e.select("element_key", F.array_join(F.transform("items", lambda i: F.coalesce(i, F.lit(""))), ", ").alias("value"))


@query("f33_measured_columns", f"WITH {CURRENT}, r AS (SELECT book, page, region, min(x) AS x FROM e WHERE region IS NOT NULL AND x IS NOT NULL AND regexp_matches(region, 'kolumn') GROUP BY 1, 2, 3) SELECT book, page, list(region ORDER BY x, region) AS columns FROM r GROUP BY 1, 2")
def measured_column_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of a page's measured columns from left to right."""
    e = current(spark, d, "book", "page", "region", "x").filter("region IS NOT NULL AND x IS NOT NULL AND region LIKE '%kolumn%'")
    r = e.groupBy("book", "page", "region").agg(F.min("x").alias("x"))
    return r.groupBy("book", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("x", "region"))), lambda c: c["region"]).alias("columns"))


@query("f38_all_strings", f"WITH {CURRENT} SELECT element_key, array_to_string(list_filter(list_concat([text], coalesce(headers, []), coalesce(flatten(list_filter(rows, lambda r: r IS NOT NULL)), []), coalesce(items, [])), lambda s: coalesce(trim(s), '') <> ''), ' ') AS text FROM e")
def all_strings(spark: SparkSession, d: str) -> DataFrame:
    """All text under an element, wherever it holds it."""
    e = current(spark, d, "text", "headers", "rows", "items")
    none = F.array().cast("array<string>")
    parts = F.concat(F.array("text"), F.coalesce("headers", none), F.coalesce(F.flatten(F.filter("rows", lambda r: r.isNotNull())), none), F.coalesce("items", none))
    return e.select("element_key", F.array_join(F.filter(parts, lambda s: F.coalesce(F.trim(s), F.lit("")) != ""), " ").alias("text"))


@query("f46_statblock_fields", f"WITH {CURRENT}, f AS (SELECT element_key, unnest(regexp_extract_all(text, '\\p{{Lu}}{{2,4}} \\d+')) AS field FROM e WHERE type = 'statblock' AND text IS NOT NULL) SELECT element_key, string_split(field, ' ')[1] AS label, string_split(field, ' ')[2] AS value FROM f")
def statblock_fields(spark: SparkSession, d: str) -> DataFrame:
    """The values that statblocks give, each with its label."""
    f = current(spark, d, "type", "text").filter("type = 'statblock' AND text IS NOT NULL").select("element_key", F.explode(F.regexp_extract_all("text", F.lit(r"\p{Lu}{2,4} \d+"), F.lit(0))).alias("field"))
    return f.select("element_key", F.split_part("field", F.lit(" "), F.lit(1)).alias("label"), F.split_part("field", F.lit(" "), F.lit(2)).alias("value"))


@query("f48_styled_texts", f"WITH {CURRENT} SELECT element_key, CASE style WHEN 'italic' THEN '*' || text || '*' WHEN 'kursiv' THEN '*' || text || '*' WHEN 'bold' THEN '**' || text || '**' WHEN 'fet' THEN '**' || text || '**' ELSE text END AS styled FROM e WHERE style IS NOT NULL AND text IS NOT NULL")
def styled_texts(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "style", "text").filter("style IS NOT NULL AND text IS NOT NULL")
    mark = F.when(F.col("style").isin("italic", "kursiv"), "*").when(F.col("style").isin("bold", "fet"), "**").otherwise("")
    return e.select("element_key", F.concat(mark, "text", mark).alias("styled"))


@query("f49_notes", f"WITH {CURRENT}, n AS (SELECT element_key, unnest(review_reasons) AS note, generate_subscripts(review_reasons, 1) AS place FROM e), k AS (SELECT element_key, trim(note) AS note, min(place) AS place FROM n WHERE trim(note) <> '' GROUP BY 1, 2) SELECT element_key, list(note ORDER BY place) AS notes FROM k GROUP BY 1")
def notes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct notes of an element that aren't blank, in order."""
    e = current(spark, d, "review_reasons").filter("size(review_reasons) > 0")
    return e.select("element_key", F.array_distinct(F.filter(F.transform("review_reasons", lambda s: F.trim(s)), lambda s: s != "")).alias("notes")).filter("size(notes) > 0")


@query("k11_plain_markdown", f"WITH {CURRENT}, m AS (SELECT book, page, idx, element_key, CASE WHEN type = 'heading' THEN repeat('#', least(coalesce(level, 1) + 1, 6)::INT) || ' ' || text WHEN type = 'boxed_text' THEN '> ' || replace(text, chr(10), chr(10) || '> ') WHEN type = 'list_item' THEN '- ' || text ELSE text END AS block FROM e WHERE type <> 'page_artifact' AND text IS NOT NULL AND NOT coalesce(removed, false)) SELECT book, page, string_agg(block, chr(10) || chr(10) ORDER BY idx, element_key) AS markdown FROM m GROUP BY 1, 2")
def plain_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Each page's elements as markdown, one block each, without reflow."""
    e = current(spark, d, "book", "page", "idx", "type", "level", "text", "removed").filter("type <> 'page_artifact' AND text IS NOT NULL AND NOT coalesce(removed, false)")
    marks = F.repeat(F.lit("#"), F.least(F.coalesce("level", F.lit(1)) + 1, F.lit(6)).cast("int"))
    block = F.when(F.col("type") == "heading", F.concat(marks, F.lit(" "), "text")).when(F.col("type") == "boxed_text", F.concat(F.lit("> "), F.replace("text", F.lit("\n"), F.lit("\n> ")))).when(F.col("type") == "list_item", F.concat(F.lit("- "), "text")).otherwise(F.col("text"))
    g = e.withColumn("block", block).groupBy("book", "page").agg(F.array_sort(F.collect_list(F.struct("idx", "element_key", "block"))).alias("b"))
    return g.select("book", "page", F.array_join(F.transform("b", lambda x: x["block"]), "\n\n").alias("markdown"))


@query("s07_load_violations", "SELECT raw_id, CASE WHEN payload IS NULL THEN 'no payload' WHEN NOT json_valid(payload) THEN 'not JSON' WHEN coalesce(CAST(payload AS JSON)->'$.pages', CAST(payload AS JSON)->'$.bok.pages') IS NULL THEN 'no pages' WHEN book IS NULL THEN 'no book' END AS problem FROM bok_raw WHERE payload IS NULL OR NOT json_valid(payload) OR book IS NULL OR coalesce(CAST(CASE WHEN json_valid(payload) THEN payload END AS JSON)->'$.pages', CAST(CASE WHEN json_valid(payload) THEN payload END AS JSON)->'$.bok.pages') IS NULL")
def load_violations(spark: SparkSession, d: str) -> DataFrame:
    """The first reason for which a delivery can't be loaded strictly."""
    pages = F.coalesce(F.get_json_object("payload", "$.pages"), F.get_json_object("payload", "$.bok.pages"))
    problem = F.when(F.col("payload").isNull(), "no payload").when(F.expr("try_parse_json(payload) IS NULL"), "not JSON").when(pages.isNull(), "no pages").when(F.col("book").isNull(), "no book")
    return table(spark, d, "bok_raw").select("raw_id", problem.alias("problem")).filter("problem IS NOT NULL")


@query("s21_first_names", "SELECT id, name, row_number() OVER (ORDER BY first)::INT AS place FROM (SELECT min(weapon_id) AS id, split_part(name, ',', 1) AS name, min(weapon_id) AS first FROM weapons GROUP BY 2)")
def first_names(spark: SparkSession, d: str) -> DataFrame:
    """Distinct base names of the reference list in the order of their first entry (a list of fixed size)."""
    n = table(spark, d, "weapons").groupBy(F.split_part("name", F.lit(","), F.lit(1)).alias("name")).agg(F.min("weapon_id").alias("id"))
    return n.select("id", "name", F.row_number().over(Window.orderBy("id")).alias("place"))


@query("f44_system_scores", f"WITH s AS (SELECT DISTINCT lower(system) AS system FROM books WHERE system IS NOT NULL), d AS (SELECT doc_id, lower(coalesce(book, '')) AS file, {_FOLD.format('coalesce(title, ' + repr('') + ')')} AS title FROM documents) SELECT doc_id, system, (CASE WHEN starts_with(file, system || '-') THEN 3 ELSE 0 END + CASE WHEN contains(title, system) THEN 2 ELSE 0 END)::INT AS score FROM d JOIN s ON starts_with(file, system || '-') OR contains(title, system)")
def system_scores(spark: SparkSession, d: str) -> DataFrame:
    """How well a document's file name and title point to a system; the systems are a small checked list."""
    systems = broadcast_checked(table(spark, d, "books").filter("system IS NOT NULL").select(F.lower("system").alias("system")).distinct(), 1_000)
    docs = table(spark, d, "documents").select("doc_id", F.lower(F.coalesce("book", F.lit(""))).alias("file"), normalise(F.coalesce("title", F.lit(""))).alias("title"))
    named, titled = F.startswith("file", F.concat("system", F.lit("-"))), F.contains("title", "system")
    return docs.join(systems, named | titled).select("doc_id", "system", (F.when(named, 3).otherwise(0) + F.when(titled, 2).otherwise(0)).alias("score"))
