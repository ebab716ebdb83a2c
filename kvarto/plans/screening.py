"""Queries: screening rules, words and bags, tables, rendering."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvarto.functions.text import artifact_key, as_int, core, leading_int, name_key, normalise, slug, tokens, without_leaders
from kvarto.operators.bags import bag_difference, unexplained, word_bag
from kvarto.operators.pages import page_findings
from kvarto.operators.regions import column_starts
from kvarto.operators.render import canonical_pages, unwrapped
from kvarto.operators.rules import RULES, scan
from kvarto.operators.tables import assemble, cells, csv_lines, markdown, stitch
from kvarto.plans import query
from kvarto.plans.choices import _FOLD, _NAME
from kvarto.plans.elements import CURRENT, current
from kvarto.session import broadcast_checked
from kvarto.sources.tables import table

_SCAN_SQL = f"""WITH {CURRENT}, k AS (SELECT *, CASE WHEN type = 'paragraph' AND w > 0 AND length(text) > 0 AND bands IS NOT NULL THEN w * greatest(len(bands), 1) / length(text) END AS cw FROM e WHERE NOT coalesce(removed, false)),
g AS (SELECT *, list_sort(list(w) FILTER (w IS NOT NULL) OVER (PARTITION BY book, page)) AS ws, avg((x IS NOT NULL)::INT) OVER (PARTITION BY book, page) AS measured, median(cw) OVER (PARTITION BY book, page) AS pcw, count(cw) OVER (PARTITION BY book, page) AS np FROM k),
c AS (SELECT element_key, type, 'text' AS place, text AS t FROM g WHERE text IS NOT NULL
UNION ALL SELECT element_key, type, 'header ' || (generate_subscripts(headers, 1) - 1), unnest(headers) FROM g WHERE headers IS NOT NULL
UNION ALL SELECT element_key, type, 'item ' || (generate_subscripts(items, 1) - 1), unnest(items) FROM g WHERE items IS NOT NULL
UNION ALL SELECT element_key, type, 'cell ' || i || '.' || (generate_subscripts(r, 1) - 1), unnest(r) FROM (SELECT element_key, type, unnest(rows) AS r, generate_subscripts(rows, 1) - 1 AS i FROM g WHERE rows IS NOT NULL) WHERE r IS NOT NULL),
f AS (SELECT element_key, 'heading-dash' AS rule, 'proposal' AS kind, 'element' AS place, regexp_replace(text, '^[-–—•]\\s+|\\s+[-–—•]$', '', 'g') AS proposal FROM g WHERE type = 'heading' AND regexp_replace(text, '^[-–—•]\\s+|\\s+[-–—•]$', '', 'g') <> text AND regexp_matches(regexp_replace(text, '^[-–—•]\\s+|\\s+[-–—•]$', '', 'g'), '^[\\p{{Lu}}\\s]{{3,}}$')
UNION ALL SELECT element_key, 'straight-quotes', 'proposal', place, translate(t, '''"', '’”') FROM c WHERE type <> 'illustration' AND regexp_matches(t, '[''"]')
UNION ALL SELECT element_key, 'plus-minus', 'proposal', place, '±0' FROM c WHERE t IN ('t0', 'T0', 'I0', 'i0', 'l0', '*0', '+0', '|0', '±O', '±o')
UNION ALL SELECT element_key, 'plus-minus-ambiguous', 'flag', place, '' FROM c WHERE t = '10'
UNION ALL SELECT element_key, 'plus-minus-signed', 'proposal', place, regexp_replace(t, '^±', '+') FROM c WHERE regexp_matches(t, '^±[1-9]\\d*$')
UNION ALL SELECT element_key, 'dot-leaders', 'flag', place, '' FROM c WHERE regexp_matches(t, '\\.{{4,}}')
UNION ALL SELECT element_key, 'column-collapse', 'flag', 'element', '' FROM g WHERE type = 'table' AND len(rows) >= 3 AND list_max(list_transform(rows, lambda r: len(r))) <= 1
UNION ALL SELECT element_key, 'column-merge', 'flag', 'element', '' FROM g WHERE len(ws) >= 5 AND w > 1.4 * ws[(round_even(0.9 * (len(ws) - 1), 0) + 1)::INT] AND length(text) >= 40
UNION ALL SELECT element_key, 'box-miscoupling', 'flag', 'element', '' FROM g WHERE type IN ('heading', 'table_caption') AND x IS NULL AND measured >= 0.5
UNION ALL SELECT element_key, 'shifted-chain', 'flag', 'element', '' FROM g WHERE np >= 8 AND greatest(cw / pcw, pcw / cw) >= 2
UNION ALL SELECT element_key, 'bullet-paragraph', 'proposal', 'element', regexp_replace(text, '^[•▪·*]\\s+', '') FROM g WHERE type = 'paragraph' AND regexp_matches(text, '^[•▪·*]\\s'))
"""


@query("r16_findings", _SCAN_SQL + "SELECT * FROM f")
def findings(spark: SparkSession, d: str) -> DataFrame:
    return scan(current(spark, d))


@query("r17_rule_counts", _SCAN_SQL + "SELECT rule, kind, count(*) AS findings, count(DISTINCT element_key) AS elements FROM f GROUP BY 1, 2")
def rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return scan(current(spark, d)).groupBy("rule", "kind").agg(F.count("*").alias("findings"), F.count_distinct("element_key").alias("elements"))


#: judged by page_findings with the page's class and the exemptions
_BY_PAGE = ("column-merge", "box-miscoupling", "shifted-chain")


@query("r16_page_findings")
def whole_scan(spark: SparkSession, d: str) -> DataFrame:
    """Text rules and page rules together; the test tables hold no images or band kinds, so the rules on those say nothing here."""
    e = current(spark, d)
    texts = scan(e, [r for r in RULES if r.name not in _BY_PAGE])
    return texts.unionByName(page_findings(e).drop("book", "page"))


_TOKENS = "unnest(string_split(trim(regexp_replace({}, '[ \\t\\r\\n]+', ' ', 'g')), ' '))"
_REAL = "word <> '' AND NOT regexp_matches(word, '^(-+|•)$')"


@query("b01_word_bag", f"SELECT type, word, count(*) AS n FROM (SELECT type, {_TOKENS.format('text')} AS word FROM bok WHERE text IS NOT NULL) WHERE {_REAL} GROUP BY 1, 2")
def bag_of_types(spark: SparkSession, d: str) -> DataFrame:
    return word_bag(table(spark, d, "bok"), F.col("text"), ["type"])


@query("b02_correction_difference", f"WITH w AS (SELECT coalesce(kind, '-') AS kind, word, 1 AS d FROM (SELECT kind, {_TOKENS.format('original')} AS word FROM corrections) WHERE {_REAL} UNION ALL SELECT coalesce(kind, '-'), word, -1 FROM (SELECT kind, {_TOKENS.format('corrected')} AS word FROM corrections) WHERE {_REAL}) SELECT kind, word, greatest(sum(d), 0)::BIGINT AS lost, greatest(-sum(d), 0)::BIGINT AS gained FROM w GROUP BY 1, 2 HAVING sum(d) <> 0")
def correction_difference(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corrections").withColumn("kind", F.coalesce("kind", F.lit("-")))
    return bag_difference(word_bag(c, F.col("original"), ["kind"]), word_bag(c, F.col("corrected"), ["kind"]), ["kind", "word"])


@query(
    "b03_unexplained_words",
    f"WITH w AS (SELECT book, word, 1 AS d FROM (SELECT book, {_TOKENS.format('text')} AS word FROM bok WHERE stage = 'embedded') WHERE {_REAL} UNION ALL SELECT book, word, -1 FROM (SELECT book, {_TOKENS.format('text')} AS word FROM bok WHERE stage = 'final') WHERE {_REAL}), "
    "n AS (SELECT book, word, greatest(sum(d), 0) AS lost, greatest(-sum(d), 0) AS gained FROM w GROUP BY 1, 2 HAVING sum(d) <> 0), "
    f"k AS (SELECT book, word, 1 AS d FROM (SELECT book, {_TOKENS.format('original')} AS word FROM corrections WHERE applied) WHERE {_REAL} UNION ALL SELECT book, word, -1 FROM (SELECT book, {_TOKENS.format('corrected')} AS word FROM corrections WHERE applied) WHERE {_REAL}), "
    "c AS (SELECT book, word, greatest(sum(d), 0) AS lost, greatest(-sum(d), 0) AS gained FROM k GROUP BY 1, 2 HAVING sum(d) <> 0), "
    "r AS (SELECT n.book, n.word, greatest(n.lost - coalesce(c.lost, 0), 0)::BIGINT AS lost, greatest(n.gained - coalesce(c.gained, 0), 0)::BIGINT AS gained FROM n LEFT JOIN c ON n.book = c.book AND n.word = c.word) SELECT * FROM r WHERE lost > 0 OR gained > 0",
)
def unexplained_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of the first stage that the last one lacks, and the reverse, as far as applied corrections don't account for them."""
    bok, c = table(spark, d, "bok"), table(spark, d, "corrections").filter("applied")
    bag = lambda stage: word_bag(bok.filter(F.col("stage") == stage), F.col("text"), ["book"])
    keys = ["book", "word"]
    credited = bag_difference(word_bag(c, F.col("original"), ["book"]), word_bag(c, F.col("corrected"), ["book"]), keys)
    return unexplained(bag_difference(bag("embedded"), bag("final"), keys), credited, keys)


_SIDES = f"WITH w AS (SELECT stage, word, count(*) AS n FROM (SELECT stage, {_TOKENS.format('text')} AS word FROM bok WHERE stage IN ('embedded', 'final') AND text IS NOT NULL) WHERE {_REAL} GROUP BY 1, 2), d AS (SELECT word, sum(CASE stage WHEN 'embedded' THEN n ELSE -n END) AS n FROM w GROUP BY 1 HAVING sum(CASE stage WHEN 'embedded' THEN n ELSE -n END) <> 0), r AS (SELECT CASE WHEN n > 0 THEN 'lost' ELSE 'gained' END AS side, word, abs(n)::BIGINT AS n FROM d), k AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY n DESC, word) AS place FROM r) "


@query("t02_top_words", _SIDES + "SELECT side, word, n FROM k WHERE place <= 25 UNION ALL SELECT side, NULL, count(*) FROM k WHERE place > 25 GROUP BY 1")
def top_words(spark: SparkSession, d: str) -> DataFrame:
    """The 25 words that the last stage has lost and gained most often against the first (a report's top list), and how many more there are on each side."""
    bok = table(spark, d, "bok")
    bag = lambda stage, sign: word_bag(bok.filter(F.col("stage") == stage), F.col("text")).select("word", (F.col("n") * sign).alias("n"))
    r = bag("embedded", 1).unionByName(bag("final", -1)).groupBy("word").agg(F.sum("n").alias("n")).filter("n <> 0").select(F.when(F.col("n") > 0, "lost").otherwise("gained").alias("side"), "word", F.abs("n").alias("n"))
    all_words = r.groupBy("side").agg((F.count("*") - 25).alias("n")).filter("n > 0").select("side", F.lit(None).cast("string").alias("word"), "n")
    tops = [r.filter(F.col("side") == side).orderBy(F.desc("n"), "word").limit(25) for side in ("lost", "gained")]
    return tops[0].unionByName(tops[1]).unionByName(all_words)


@query(
    "t01_language_scores",
    "WITH w AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '\\p{L}+'))) AS word FROM documents), s AS (SELECT w.doc_id, c.lang, count(*) AS hits FROM w JOIN common_words c ON c.word = w.word GROUP BY 1, 2) "
    "SELECT doc_id, lang AS detected, hits, round(hits / sum(hits) OVER (PARTITION BY doc_id), 4) AS confidence FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang) = 1",
)
def language_scores(spark: SparkSession, d: str) -> DataFrame:
    """The language whose frequent words a document uses most, with its share of all hits."""
    words = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), 0)).alias("w")).select("doc_id", F.lower("w").alias("word"))
    # only hits are shuffled, and those are summed up beforehand
    s = words.join(broadcast_checked(table(spark, d, "common_words").select("lang", "word"), 100_000), "word").groupBy("doc_id", "lang").agg(F.count("*").alias("hits"))
    best = s.groupBy("doc_id").agg(F.min_by(F.struct("lang", "hits"), F.struct(-F.col("hits"), F.col("lang"))).alias("b"), F.sum("hits").alias("all"))
    return best.select("doc_id", F.col("b.lang").alias("detected"), F.col("b.hits").alias("hits"), F.round(F.col("b.hits") / F.col("all"), 4).alias("confidence"))


@query(
    "f01_text_keys",
    f"WITH t AS (SELECT row_id, text FROM bok WHERE text IS NOT NULL) SELECT row_id, {_FOLD.format('text')} AS normal, {_NAME.format('text')} AS name, substring(regexp_replace(lower(trim(text)), '\\d+', '#', 'g'), 1, 60) AS artifact, "
    "regexp_replace(upper(trim(regexp_replace(text, '\\.{2,}.*$', ''))), '[:.\\s]+$', '') AS heading FROM t WHERE NOT contains(text, chr(10))",
)
def text_keys(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "bok").filter("text IS NOT NULL").filter(~F.contains("text", F.lit("\n")))
    c = F.col("text")
    return t.select("row_id", normalise(c).alias("normal"), name_key(c).alias("name"), artifact_key(c).alias("artifact"), without_leaders(c).alias("heading"))


@query("f03_slugs", f"SELECT book, CASE WHEN s = '' THEN 'bok' ELSE s END AS slug FROM (SELECT book, substring(regexp_replace(regexp_replace({_FOLD.format('title')}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS s FROM books)")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("book", slug(F.col("title")).alias("slug"))


@query(
    "f08_cell_numbers",
    f"WITH {CURRENT}, c AS (SELECT unnest(r) AS t FROM (SELECT unnest(rows) AS r FROM e WHERE type = 'table')) SELECT t, TRY_CAST(CASE WHEN regexp_matches(trim(t), '^-?\\d{{1,9}}\\s*%?$') THEN regexp_replace(trim(t), '\\s*%$', '') END AS INT) AS whole, TRY_CAST(nullif(CASE WHEN regexp_matches(t, '^-?\\d+[TtDd]') THEN '' ELSE regexp_extract(t, '^-?\\d+') END, '') AS INT) AS leading, count(*) AS n FROM c WHERE t IS NOT NULL GROUP BY 1, 2, 3",
)
def cell_numbers(spark: SparkSession, d: str) -> DataFrame:
    c = current(spark, d, "type", "rows").filter("type = 'table'").select(F.explode("rows").alias("r")).select(F.explode("r").alias("t")).filter("t IS NOT NULL")
    number = F.when(F.trim("t").rlike(r"^-?\d{1,9}\s*%?$"), as_int(F.col("t")))
    lead = F.when(~F.col("t").rlike(r"^-?\d+[TtDd]"), leading_int(F.col("t")))
    return c.groupBy("t", number.alias("whole"), lead.alias("leading")).agg(F.count("*").alias("n"))


@query("f26_cores", f"SELECT CASE WHEN core = '' THEN lower(word) ELSE core END AS core, count(*) AS n FROM (SELECT word, regexp_replace(lower(word), '^[^\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+$', '', 'g') AS core FROM (SELECT {_TOKENS.format('text')} AS word FROM bok WHERE type = 'heading') WHERE {_REAL}) GROUP BY 1")
def cores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").filter("type = 'heading'").select(F.explode(tokens(F.col("text"))).alias("word")).groupBy(core(F.col("word")).alias("core")).agg(F.count("*").alias("n"))


@query(
    "f23_unwrapped",
    "SELECT row_id, replace(regexp_replace(regexp_replace(regexp_replace(text, '(\\p{L})-[ \\t]*\\r?\\n[ \\t]*(\\p{Ll})', '\\1\\2', 'g'), '[ \\t]*\\r?\\n[ \\t]*\\r?\\n\\s*', chr(1), 'g'), '[ \\t]*\\r?\\n[ \\t]*', ' ', 'g'), chr(1), chr(10) || chr(10)) AS text FROM bok WHERE type IN ('paragraph', 'boxed_text') AND text IS NOT NULL",
)
def unwrapped_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").filter("type IN ('paragraph', 'boxed_text') AND text IS NOT NULL").select("row_id", unwrapped(F.col("text")).alias("text"))


@query(
    "f45_cells",
    f"WITH {CURRENT}, r AS (SELECT element_key, headers, unnest(rows) AS r, generate_subscripts(rows, 1) - 1 AS row FROM e WHERE type = 'table'), c AS (SELECT element_key, headers, row, unnest(r) AS text, generate_subscripts(r, 1) - 1 AS col FROM r) SELECT element_key, row::INT AS row, col::INT AS col, headers[col + 1] AS header, text FROM c",
)
def table_cells(spark: SparkSession, d: str) -> DataFrame:
    return cells(current(spark, d, "type", "headers", "rows").filter("type = 'table'"), "element_key")


@query(
    "w16_assembled_cells",
    f"WITH {CURRENT}, c AS (SELECT book, page, list(text ORDER BY idx, element_key) AS cells, list(round(x * 1000)::INT ORDER BY x) FILTER (x IS NOT NULL) AS xs FROM e WHERE type = 'table_cell' AND text IS NOT NULL GROUP BY 1, 2), "
    "n AS (SELECT book, page, cells, coalesce(len(list_reduce(list_transform(xs, lambda x: [x]), lambda a, b: CASE WHEN b[1] - a[-1] > 100 THEN list_append(a, b[1]) ELSE a END)), 1)::INT AS columns FROM c) "
    "SELECT book, page, columns, CASE WHEN len(cells) % columns = 0 THEN list_transform(range(len(cells) // columns), lambda i: cells[columns * i + 1:columns * i + columns]) END AS rows, CASE WHEN len(cells) % columns = 0 THEN 0 ELSE columns - len(cells) % columns END::INT AS short FROM n",
)
def assembled_cells(spark: SparkSession, d: str) -> DataFrame:
    """Loose cells of a page as a table: its columns are those that the cells' left edges tell, one if none is measured."""
    loose = current(spark, d, "book", "page", "idx", "type", "text", "x").filter("type = 'table_cell' AND text IS NOT NULL")
    edges = loose.filter("x IS NOT NULL").groupBy("book", "page").agg(F.array_sort(F.collect_list(F.round(F.col("x") * 1000).cast("int"))).alias("xs"))
    columns = edges.select("book", "page", F.size(column_starts(F.col("xs"), 100)).alias("n"))
    return assemble(loose.join(columns, ["book", "page"], "left"), ["book", "page"], ["idx", "element_key"], F.coalesce("n", F.lit(1)))


@query(
    "w18_stitched_tables",
    f"WITH {CURRENT}, t AS (SELECT *, CASE WHEN len(headers) > 0 AND headers IS NOT DISTINCT FROM lag(headers) OVER w AND page = lag(page) OVER w + 1 THEN 0 ELSE 1 END AS new FROM e WHERE type = 'table' WINDOW w AS (PARTITION BY book ORDER BY page, idx, element_key)), "
    "k AS (SELECT *, sum(new) OVER (PARTITION BY book ORDER BY page, idx, element_key) AS chain FROM t) SELECT min(element_key) AS least_key, count(*)::INT AS parts, sum(coalesce(len(rows), 0))::INT AS rows FROM k GROUP BY book, chain",
)
def stitched_tables(spark: SparkSession, d: str) -> DataFrame:
    t = stitch(current(spark, d, "book", "page", "idx", "type", "headers", "rows").filter("type = 'table'"), "element_key")
    return t.select(F.col("head").alias("least_key"), "parts", F.size("rows").alias("rows"))


#: SQL: a table as markdown, one without headers as bullets
TABLE_SQL = (
    "CASE WHEN len(headers) > 0 THEN array_to_string(list_concat(['| ' || array_to_string(list_transform(headers, lambda c: replace(coalesce(c, ''), '|', '\\|')), ' | ') || ' |', '|' || repeat(' --- |', len(headers))], "
    "list_transform(rows, lambda r: '| ' || array_to_string(list_transform(r, lambda c: replace(coalesce(c, ''), '|', '\\|')), ' | ') || ' |')), chr(10)) "
    "ELSE array_to_string(list_transform(rows, lambda r: '- ' || array_to_string(list_transform(r, lambda c: coalesce(c, '')), ' — ')), chr(10)) END"
)


@query(
    "k06_table_markdown",
    f"WITH {CURRENT} SELECT element_key, {TABLE_SQL} AS markdown FROM e WHERE type = 'table' AND rows IS NOT NULL",
)
def table_markdown(spark: SparkSession, d: str) -> DataFrame:
    t = current(spark, d, "type", "headers", "rows").filter("type = 'table' AND rows IS NOT NULL")
    return t.select("element_key", markdown(F.col("headers"), F.col("rows")).alias("markdown"))


_CSV = "array_to_string(list_transform({0}, lambda c: CASE WHEN regexp_matches(c, '[\",\r\n]') THEN '\"' || replace(c, '\"', '\"\"') || '\"' ELSE coalesce(c, '') END), ',')"


@query(
    "k05_table_csv",
    f"WITH {CURRENT}, t AS (SELECT element_key, list_concat(CASE WHEN len(headers) > 0 THEN [{{'line': 0, 'text': {_CSV.format('headers')}}}] ELSE [] END, list_transform(rows, lambda r, i: {{'line': i::INT, 'text': {_CSV.format('r')}}})) AS ls FROM e WHERE type = 'table' AND rows IS NOT NULL) SELECT element_key, l.line, l.text FROM (SELECT element_key, unnest(ls) AS l FROM t)",
)
def table_csv(spark: SparkSession, d: str) -> DataFrame:
    return csv_lines(current(spark, d, "type", "headers", "rows").filter("type = 'table' AND rows IS NOT NULL"), "element_key")


@query("k03_canonical_pages")
def pages_as_json(spark: SparkSession, d: str) -> DataFrame:
    return canonical_pages(current(spark, d))
