"""Queries: pages as flowing markdown, statblocks and gear tables, column starts, drift, scans for codes and words, region maps."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.functions.text import tokens
from kvarto.operators.boxes import dropped_overlaps
from kvarto.operators.dice import CODE, MISREAD
from kvarto.operators.reflow import folded_lines
from kvarto.operators.regions import column_starts
from kvarto.operators.render import filled_columns, page_blocks, statblock_markdown
from kvarto.plans import SQL, query
from kvarto.plans.aggregates import ceased_types, retyped_furniture
from kvarto.plans.elements import CURRENT, current
from kvarto.plans.inventory import _JOIN, _STARTS, _starts
from kvarto.plans.order import carried_headers
from kvarto.plans.screening import _REAL, _TOKENS, TABLE_SQL
from kvarto.session import broadcast_checked
from kvarto.sources.tables import table



def _folded(lines: str) -> str:
    """SQL: an array of lines as one text."""
    return f"list_reduce({lines}, lambda a, b: {_JOIN}, '')"


_ONE = _folded("string_split_regex(text, '\\r?\\n')")


@query(
    "k04_page_markdown",
    f"""WITH {_STARTS}, f AS (SELECT element_key, sum(begins::INT) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS flow FROM z), v AS (SELECT book, page, idx, e.element_key, type, level, text, headers, rows, items, flow, sum(CASE WHEN type = 'paragraph' THEN 0 ELSE 1 END) OVER (PARTITION BY book, page ORDER BY idx, e.element_key) AS run FROM e LEFT JOIN f USING (element_key) WHERE NOT coalesce(removed, false) AND type NOT IN ('page_artifact', 'illustration')),
g AS (SELECT book, page, min((idx, element_key)) AS place, {_folded("flatten(list(string_split_regex(text, '\\r?\\n') ORDER BY idx, element_key))")} AS md FROM v WHERE type = 'paragraph' AND text IS NOT NULL GROUP BY book, page, run, flow UNION ALL
SELECT book, page, (idx, element_key), CASE type WHEN 'heading' THEN repeat('#', least(coalesce(level, 1) + 1, 6)::INT) || ' ' || text WHEN 'table' THEN {TABLE_SQL} WHEN 'list' THEN array_to_string(list_transform(items, lambda i: '- ' || coalesce(i, '')), chr(10)) WHEN 'list_item' THEN '- ' || regexp_replace(text, '^[-•*]\\s+', '')
WHEN 'boxed_text' THEN '> ' || {_ONE} WHEN 'table_caption' THEN '*' || text || '*' ELSE text END FROM v WHERE type <> 'paragraph')
SELECT book, page, '<!-- sida ' || page || ' -->' || chr(10) || chr(10) || string_agg(md, chr(10) || chr(10) ORDER BY place) AS markdown FROM g WHERE md <> '' GROUP BY 1, 2""",
)
def pages_as_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Each page as markdown: prose flows on over elements as its lines and indents tell, with words at line ends made whole."""
    k = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    flows = _starts(spark, d).select("element_key", F.sum(F.col("begins").cast("int")).over(k).alias("flow"))
    return page_blocks(current(spark, d).join(flows, "element_key", "left"))


_STATBLOCK = r"\p{Lu}{2,4} \d+"


@query("k07_statblock_markdown", f"WITH {CURRENT}, p AS (SELECT *, lag(CASE WHEN type = 'heading' THEN text END) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS before FROM e), s AS (SELECT element_key, before, trim(string_split(text, chr(10))[1]) AS name, list_transform(regexp_extract_all(text, '{_STATBLOCK}'), lambda f: string_split(f, ' ')) AS stats FROM p WHERE type = 'statblock' AND text IS NOT NULL) "
       "SELECT element_key, array_to_string(list_filter([CASE WHEN name IS DISTINCT FROM before THEN '**' || name || '**' END, CASE WHEN len(stats) > 0 THEN '| ' || array_to_string(list_transform(stats, lambda f: f[1]), ' | ') || ' |' || chr(10) || '|' || repeat(' --- |', len(stats)) || chr(10) || '| ' || array_to_string(list_transform(stats, lambda f: f[2]), ' | ') || ' |' END], lambda b: b IS NOT NULL), chr(10) || chr(10)) AS markdown FROM s")
def statblocks_as_markdown(spark: SparkSession, d: str) -> DataFrame:
    k = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    e = current(spark, d, "book", "page", "idx", "type", "text").withColumn("before", F.lag(F.when(F.col("type") == "heading", F.col("text"))).over(k))
    s = e.filter("type = 'statblock' AND text IS NOT NULL")
    fields = F.transform(F.regexp_extract_all("text", F.lit(_STATBLOCK), F.lit(0)), lambda f: F.struct(F.split_part(f, F.lit(" "), F.lit(1)).alias("label"), F.split_part(f, F.lit(" "), F.lit(2)).alias("value")))
    return s.select("element_key", statblock_markdown(F.trim(F.split("text", "\n")[0]), F.col("before"), fields).alias("markdown"))


@query("k08_gear_tables", """WITH w AS (SELECT weaponGroup, list({'id': weapon_id, 'name': name, 'damage': damage, 'range': CAST("range" AS VARCHAR), 'hands': CASE WHEN twoHanded THEN '2' END} ORDER BY weapon_id) AS l FROM weapons GROUP BY 1),
c AS (SELECT weaponGroup, l, list_filter([{'h': 'name', 'v': list_transform(l, lambda x: x.name)}, {'h': 'damage', 'v': list_transform(l, lambda x: x.damage)}, {'h': 'range', 'v': list_transform(l, lambda x: x.range)}, {'h': 'hands', 'v': list_transform(l, lambda x: x.hands)}], lambda k: len(list_filter(k.v, lambda y: y IS NOT NULL)) > 0) AS ks FROM w)
SELECT weaponGroup, '| ' || array_to_string(list_transform(ks, lambda k: k.h), ' | ') || ' |' || chr(10) || '|' || repeat(' --- |', len(ks)) || chr(10) || array_to_string(list_transform(range(1, len(l) + 1), lambda i: '| ' || array_to_string(list_transform(ks, lambda k: coalesce(k.v[i], '—')), ' | ') || ' |'), chr(10)) AS markdown FROM c""")
def gear_tables(spark: SparkSession, d: str) -> DataFrame:
    """One table for each group of weapons (a list of fixed size), only with columns that some row fills."""
    w = table(spark, d, "weapons").groupBy("weaponGroup").agg(F.array_sort(F.collect_list(F.struct("weapon_id", "name", "damage", F.col("range").cast("string").alias("range"), F.when(F.col("twoHanded"), "2").alias("hands")))).alias("l"))
    return w.select("weaponGroup", filled_columns(F.col("l"), ["name", "damage", "range", "hands"]).alias("markdown"))


@query("w28_column_starts", f"WITH {CURRENT}, l AS (SELECT book, page, list(round(x * 1000)::INT ORDER BY x) AS xs FROM e WHERE x IS NOT NULL GROUP BY 1, 2) SELECT book, page, list_reduce(list_transform(xs, lambda x: [x]), lambda a, b: CASE WHEN b[1] - a[-1] > 100 THEN list_append(a, b[1]) ELSE a END) AS starts FROM l")
def starts_of_columns(spark: SparkSession, d: str) -> DataFrame:
    """Left edges (in thousandths) at which columns of a page start: a new one begins more than a tenth of the width after the last start."""
    e = current(spark, d, "book", "page", "x").filter("x IS NOT NULL")
    l = e.groupBy("book", "page").agg(F.array_sort(F.collect_list(F.round(F.col("x") * 1000).cast("int"))).alias("xs"))  # noqa: E741
    return l.select("book", "page", column_starts(F.col("xs"), 100).alias("starts"))


@query("r18_drift", f"WITH a AS ({SQL['a19_ceased_types']}), b AS ({SQL['a20_retyped_furniture']}), {CURRENT}, c AS (SELECT book, type, count(DISTINCT style) AS styles FROM e WHERE style IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT style) > 1) SELECT book, 'ceased type' AS rule, type AS what FROM a UNION ALL SELECT book, 'retyped line', text FROM b UNION ALL SELECT book, 'several styles', type FROM c")
def drift(spark: SparkSession, d: str) -> DataFrame:
    """What changes in the course of a book: types that cease, page furniture under several types, types set in several styles."""
    styles = current(spark, d, "book", "type", "style").filter("style IS NOT NULL").groupBy("book", "type").agg(F.count_distinct("style").alias("n")).filter("n > 1")
    row = lambda df, rule, what: df.select("book", F.lit(rule).alias("rule"), F.col(what).alias("what"))
    return row(ceased_types(spark, d), "ceased type", "type").unionByName(row(retyped_furniture(spark, d), "retyped line", "text")).unionByName(row(styles, "several styles", "type"))


@query("r31_inherited_headers", f"WITH w AS ({SQL['w20_carried_headers']}), {CURRENT} SELECT e.book, e.page, w.element_key, array_to_string(w.used, ' | ') AS headers FROM w JOIN e ON e.element_key = w.element_key WHERE w.inherited AND w.used IS NOT NULL")
def inherited_headers(spark: SparkSession, d: str) -> DataFrame:
    """Tables that take the headers of an earlier one, with those headers."""
    w = carried_headers(spark, d).filter("inherited AND used IS NOT NULL").select("element_key", F.array_join("used", " | ").alias("headers"))
    return current(spark, d, "book", "page").select("book", "page", "element_key").join(w, "element_key").select("book", "page", "element_key", "headers")


_CODE_CHARS = "".join(dict.fromkeys([*"0123456789", *(c for c in MISREAD if c.isalpha())]))
_CODE_LIKE = rf"[{_CODE_CHARS}]{{1,2}}[TtDd][{_CODE_CHARS}]{{1,3}}"


@query("f15_dice_scan", f"WITH t AS (SELECT row_id, unnest(string_split_regex(text, '[\\s.,:;()\"]+')) AS token FROM bok WHERE text IS NOT NULL), l AS (SELECT DISTINCT lower(term) AS term FROM lexicon WHERE term IS NOT NULL) SELECT row_id, token, count(*) AS n FROM t WHERE regexp_full_match(token, '{_CODE_LIKE}') AND regexp_matches(token, '\\d') AND NOT regexp_matches(token, '^\\d+T\\d+$') AND lower(token) NOT IN (SELECT term FROM l) GROUP BY 1, 2")
def dice_scan(spark: SparkSession, d: str) -> DataFrame:
    """Tokens that look like dice codes, hold a figure and aren't one as they stand, unless the lexicon has them as words."""
    t = table(spark, d, "bok").filter("text IS NOT NULL").select("row_id", F.explode(F.split("text", r'[\s.,:;()"]+')).alias("token"))
    t = t.filter(F.col("token").rlike(f"^{_CODE_LIKE}$") & F.col("token").rlike(r"\d") & ~F.col("token").rlike(CODE))
    lexicon = table(spark, d, "lexicon").filter("term IS NOT NULL").select(F.lower("term").alias("term")).distinct()
    return t.join(broadcast_checked(lexicon, 200_000), F.lower("token") == F.col("term"), "left_anti").groupBy("row_id", "token").agg(F.count("*").alias("n"))


@query("f18_word_scan", f"WITH k AS (SELECT lower(original) AS word, min(lower(corrected)) AS proposal FROM corrections WHERE kind = 'ocr' AND original IS NOT NULL AND corrected IS NOT NULL AND regexp_full_match(original, '\\p{{L}}{{3,}}') AND regexp_full_match(corrected, '\\p{{L}}{{3,}}') GROUP BY 1 HAVING count(DISTINCT lower(corrected)) = 1 AND min(lower(corrected)) <> lower(original)), t AS (SELECT row_id, lower(word) AS word FROM (SELECT row_id, {_TOKENS.format('text')} AS word FROM bok WHERE text IS NOT NULL) WHERE {_REAL}) SELECT row_id, word, proposal, count(*) AS n FROM t JOIN k USING (word) GROUP BY 1, 2, 3")
def word_scan(spark: SparkSession, d: str) -> DataFrame:
    """Words of the texts that records have corrected in one way only, with the proposal."""
    c = table(spark, d, "corrections").filter("kind = 'ocr' AND original IS NOT NULL AND corrected IS NOT NULL").filter(F.col("original").rlike(r"^\p{L}{3,}$") & F.col("corrected").rlike(r"^\p{L}{3,}$"))
    known = c.groupBy(F.lower("original").alias("word")).agg(F.min(F.lower("corrected")).alias("proposal"), F.count_distinct(F.lower("corrected")).alias("ways")).filter("ways = 1 AND proposal <> word").drop("ways")
    from kvarto.functions.text import tokens

    t = table(spark, d, "bok").filter("text IS NOT NULL").select("row_id", F.explode(tokens(F.col("text"))).alias("w")).select("row_id", F.lower("w").alias("word"))
    return t.join(broadcast_checked(known, 200_000), "word").groupBy("row_id", "word", "proposal").agg(F.count("*").alias("n"))


@query("f39_iso_times", "SELECT book, strftime(generated AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' AS generated FROM books WHERE generated IS NOT NULL")
def iso_times(spark: SparkSession, d: str) -> DataFrame:
    """Times as ISO texts in UTC, to the second."""
    utc = F.to_utc_timestamp("generated", F.expr("current_timezone()"))
    return table(spark, d, "books").filter("generated IS NOT NULL").select("book", F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("generated"))


@query("j20_region_map", f"WITH {CURRENT} SELECT DISTINCT book, page, region, CASE WHEN region LIKE 'sidhuvud%' THEN 'sidhuvud' WHEN region LIKE 'sidfot%' THEN 'sidfot' WHEN region = 'helbredd' THEN 'helbredd' WHEN region IN ('kolumn 1', 'vänsterkolumn') THEN 'vänster' WHEN region IN ('kolumn 2', 'högerkolumn') THEN 'höger' WHEN contains(region, ',') THEN trim(split_part(region, ',', 1)) ELSE 'untranslated' END AS measured FROM e WHERE region IS NOT NULL")
def region_map(spark: SparkSession, d: str) -> DataFrame:
    """For each page, what its regions are called among measured rows: by name, else what stands before a comma, else untranslated."""
    r = F.col("region")
    name = F.when(r.startswith("sidhuvud"), "sidhuvud").when(r.startswith("sidfot"), "sidfot").when(r == "helbredd", "helbredd").when(r.isin("kolumn 1", "vänsterkolumn"), "vänster").when(r.isin("kolumn 2", "högerkolumn"), "höger").when(F.contains(r, F.lit(",")), F.trim(F.split_part(r, F.lit(","), F.lit(1)))).otherwise("untranslated")
    return current(spark, d, "book", "page", "region").filter("region IS NOT NULL").select("book", "page", "region", name.alias("measured")).distinct()


@query("pf25_column_of", f"WITH {CURRENT}, b AS (SELECT book, page, region, min(x) AS lo, max(x + w) AS hi FROM e WHERE x IS NOT NULL AND regexp_matches(region, 'kolumn') GROUP BY 1, 2, 3), c AS (SELECT e.element_key, b.region FROM e JOIN b ON b.book = e.book AND b.page = e.page AND round(e.x + e.w / 2 - b.lo, 6) >= 0 AND round(e.x + e.w / 2 - b.hi, 6) <= 0 AND round(e.w - 1.4 * (b.hi - b.lo), 6) <= 0) SELECT element_key, min(region) AS column_name FROM c GROUP BY 1 HAVING count(*) = 1")
def column_of(spark: SparkSession, d: str) -> DataFrame:
    """The column whose bounds alone hold an element's middle; none for an element much wider than it."""
    e = current(spark, d, "book", "page", "region", "x", "w").filter("x IS NOT NULL")
    b = e.filter("region LIKE '%kolumn%'").groupBy("book", "page", F.col("region").alias("column_name")).agg(F.min("x").alias("lo"), F.max(F.col("x") + F.col("w")).alias("hi"))
    middle = F.col("x") + F.col("w") / 2
    c = e.join(b, ["book", "page"]).filter((F.round(middle - F.col("lo"), 6) >= 0) & (F.round(middle - F.col("hi"), 6) <= 0) & (F.round(F.col("w") - 1.4 * (F.col("hi") - F.col("lo")), 6) <= 0))
    return c.groupBy("element_key").agg(F.min("column_name").alias("column_name"), F.count("*").alias("n")).filter("n = 1").drop("n")


@query("j23_second_sweep")
def second_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of a page's first sweep (measured with an embedded box) and those of a second one that overlap none accepted so far."""
    e = current(spark, d, "book", "page", "idx", "bbox_source", "x", "y", "w", "h").filter("x IS NOT NULL")
    return dropped_overlaps(e, ["book", "page"], "element_key", F.col("bbox_source") == "embedded")
