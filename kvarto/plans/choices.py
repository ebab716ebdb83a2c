"""Queries: choice of versions, lookups, filters and classifications of elements."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvarto.functions.text import name_key, normalise
from kvarto.operators.lookups import ambiguous_keys, range_lookup, single_match, term_index
from kvarto.operators.versions import MERGE_ORDER, SOURCE_ORDER, at_least, best_stage, newest
from kvarto.plans import query
from kvarto.plans.elements import CURRENT, current
from kvarto.sources.tables import table

_FOLD = "trim(regexp_replace(regexp_replace(translate(lower({}), 'åäàáâãöòóôõéèêëüùúûíìîïçñýÿ', 'aaaaaaoooooeeeeuuuuiiiicnyy'), '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g'))"
_NAME = f"trim(regexp_replace({_FOLD}, '[^a-z0-9]+', ' ', 'g'))"


def _stage_sql(order) -> str:
    case = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(order))
    return f"SELECT element_key, row_id, stage FROM bok WHERE stage IN ({', '.join(repr(s) for s in order)}) QUALIFY row_number() OVER (PARTITION BY element_key ORDER BY CASE stage {case} END, updated_at DESC NULLS LAST, row_id) = 1"


@query("j01_best_stage", _stage_sql(MERGE_ORDER))
def best_for_merge(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "bok").select("element_key", "row_id", "stage", "updated_at")
    return best_stage(df, ["element_key"], MERGE_ORDER, "updated_at", "row_id").select("element_key", "row_id", "stage")


@query("j02_source_stage", _stage_sql(SOURCE_ORDER))
def best_for_validation(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "bok").select("element_key", "row_id", "stage", "updated_at")
    return best_stage(df, ["element_key"], SOURCE_ORDER, "updated_at", "row_id").select("element_key", "row_id", "stage")


@query("i01_latest_version", "SELECT element_key, row_id, stage, updated_at FROM bok QUALIFY row_number() OVER (PARTITION BY element_key ORDER BY updated_at DESC NULLS LAST, row_id) = 1")
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    return newest(table(spark, d, "bok").select("element_key", "row_id", "stage", "updated_at"), ["element_key"], "updated_at", "row_id")


@query("i01_latest_event", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1")
def latest_event(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return newest(df, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


@query("j03_lexicon_index", f"SELECT {_FOLD.format('term')} AS key, list_sort(list(DISTINCT term)) AS forms, count(DISTINCT term) AS n FROM lexicon WHERE term IS NOT NULL GROUP BY 1")
def lexicon_index(spark: SparkSession, d: str) -> DataFrame:
    return term_index(table(spark, d, "lexicon"), normalise(F.col("term")), F.col("term")).withColumn("n", F.size("forms").cast("long"))


@query(
    "j04_lexicon_lookup",
    f"WITH w AS (SELECT {_FOLD.format('t.word')} AS key, count(*) AS n FROM (SELECT unnest(string_split(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g')), ' ')) AS word FROM bok WHERE text IS NOT NULL) t WHERE t.word <> '' GROUP BY 1), "
    f"l AS (SELECT {_FOLD.format('term')} AS key, count(DISTINCT term) AS forms FROM lexicon WHERE term IS NOT NULL GROUP BY 1) "
    "SELECT coalesce(l.forms, 0) AS forms, count(*) AS keys, sum(n)::BIGINT AS words FROM w LEFT JOIN l ON w.key = l.key GROUP BY 1",
)
def lexicon_lookup(spark: SparkSession, d: str) -> DataFrame:
    """How many words of the texts have no, one or several canonical forms."""
    index = term_index(table(spark, d, "lexicon"), normalise(F.col("term")), F.col("term")).select("key", F.size("forms").alias("forms"))
    words = table(spark, d, "bok").select(F.explode(F.split(F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " ")), " ")).alias("word")).filter("word <> ''")
    # words are counted before they are folded and looked up: the join sees each once
    counted = words.groupBy("word").agg(F.count("*").alias("n")).groupBy(normalise(F.col("word")).alias("key")).agg(F.sum("n").alias("n"))
    return counted.join(index, "key", "left").groupBy(F.coalesce("forms", F.lit(0)).cast("long").alias("forms")).agg(F.count("*").alias("keys"), F.sum("n").alias("words"))


@query(
    "j07_range_lookup",
    "WITH b AS (SELECT * FROM (VALUES (0.0, 1.99, 'light'), (2.0, 5.99, 'middle'), (6.0, 14.99, 'heavy')) AS t(low, high, class)) SELECT weapon_id, class FROM weapons LEFT JOIN b ON round(weight, 2) BETWEEN low AND high",
)
def weight_class(spark: SparkSession, d: str) -> DataFrame:
    bands = spark.createDataFrame([(0.0, 1.99, "light"), (2.0, 5.99, "middle"), (6.0, 14.99, "heavy")], "low double, high double, class string")
    return range_lookup(table(spark, d, "weapons").select("weapon_id", "weight"), F.round("weight", 2), bands, "low", "high", ["class"]).select("weapon_id", "class")


@query("j09_single_match", f"WITH a AS (SELECT armor_id, {_NAME.format(chr(39) + chr(39) + ' || bodyPart')} AS key FROM armor), u AS (SELECT key, min(armor_id) AS armor_id FROM a GROUP BY key HAVING count(*) = 1) SELECT a.armor_id AS id, u.armor_id AS single FROM a LEFT JOIN u USING (key)")
def single_armor(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "armor").select("armor_id", name_key(F.col("bodyPart")).alias("key"))
    return single_match(a.select(F.col("armor_id").alias("id"), "key"), a.select("key", F.col("armor_id").alias("single")), "key", ["single"]).select("id", "single")


@query("j10_ambiguous_ids", "SELECT book || '/' || id AS key, count(DISTINCT element_key) AS n FROM bok GROUP BY 1 HAVING count(DISTINCT element_key) > 1")
def ambiguous_ids(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "bok").select(F.concat_ws("/", "book", "id").alias("key"), "element_key").distinct()
    return ambiguous_keys(one.select("key"), "key")


@query("j15_added_elements", "SELECT DISTINCT element_key FROM bok b WHERE stage = 'final' AND NOT EXISTS (SELECT 1 FROM bok o WHERE o.element_key = b.element_key AND o.stage <> 'final')")
def added_elements(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok").select("element_key", "stage")
    return bok.groupBy("element_key").agg(F.bool_or(F.col("stage") == "final").alias("f"), F.bool_or(F.col("stage") != "final").alias("o")).filter("f AND NOT coalesce(o, false)").select("element_key")


@query("pf03_state_at_least", "SELECT stage, stage IN ('validated', 'reviewed', 'final') AS far, count(*) AS n FROM bok GROUP BY 1, 2")
def far_enough(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.col("stage") == "transcript", "transcribed").when(F.col("stage") == "embedded", "extracted").otherwise(F.col("stage"))
    return table(spark, d, "bok").groupBy("stage", at_least(state, "validated").alias("far")).agg(F.count("*").alias("n"))


@query("pf04_pending_pages", "SELECT book, page FROM bok GROUP BY 1, 2 HAVING NOT bool_or(stage = 'transcript' OR stage = 'final')")
def pending_pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bok").groupBy("book", "page").agg(F.bool_or(F.col("stage").isin("transcript", "final")).alias("seen")).filter("NOT seen").select("book", "page")


@query(
    "pf05_review_jobs",
    f"WITH {CURRENT}, p AS (SELECT book, page, bool_or(type = 'table') AS tables, count(*) AS n, bool_or(stage = 'final') AS done, bool_and(type = 'illustration') AS only_pictures FROM e GROUP BY 1, 2) "
    "SELECT book, page, CASE WHEN tables OR n > 8 THEN 'språk,layout' ELSE 'språk' END AS reviewers FROM p WHERE NOT done AND NOT only_pictures",
)
def review_jobs(spark: SparkSession, d: str) -> DataFrame:
    pages = current(spark, d, "book", "page", "type", "stage").groupBy("book", "page").agg(
        F.bool_or(F.col("type") == "table").alias("tables"), F.count("*").alias("n"), F.bool_or(F.col("stage") == "final").alias("done"), F.bool_and(F.col("type") == "illustration").alias("only_pictures")
    )
    layout = F.col("tables") | (F.col("n") > 8)
    return pages.filter("NOT done AND NOT only_pictures").select("book", "page", F.array_join(F.array_compact(F.array(F.lit("språk"), F.when(layout, "layout"))), ",").alias("reviewers"))


@query(
    "pf08_page_class",
    f"WITH {CURRENT}, b AS (SELECT book, page, count(*) FILTER (type NOT IN ('page_artifact', 'illustration')) AS body, count(*) FILTER (type IN ('table', 'table_cell', 'table_caption')) AS tables, "
    "count(*) FILTER (type NOT IN ('page_artifact', 'illustration') AND length(coalesce(text, '')) <= 40) AS short, count(DISTINCT region) FILTER (region LIKE 'kolumn%') AS columns FROM e WHERE NOT coalesce(removed, false) GROUP BY 1, 2) "
    "SELECT book, page, CASE WHEN body < 10 THEN 'annat' WHEN tables >= 0.30 * body THEN 'tabellsida' WHEN short >= 0.60 * body THEN 'blankett' WHEN columns >= 2 THEN 'löptext' ELSE 'annat' END AS class FROM b",
)
def page_class(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "type", "text", "region", "removed").filter(~F.coalesce("removed", F.lit(False)))
    body = ~F.col("type").isin("page_artifact", "illustration")
    b = e.groupBy("book", "page").agg(
        F.count_if(body).alias("body"), F.count_if(F.col("type").isin("table", "table_cell", "table_caption")).alias("tables"), F.count_if(body & (F.length(F.coalesce("text", F.lit(""))) <= 40)).alias("short"), F.count_distinct(F.when(F.col("region").startswith("kolumn"), F.col("region"))).alias("columns")
    )
    kind = F.when(F.col("body") < 10, "annat").when(F.col("tables") >= 0.30 * F.col("body"), "tabellsida").when(F.col("short") >= 0.60 * F.col("body"), "blankett").when(F.col("columns") >= 2, "löptext").otherwise("annat")
    return b.select("book", "page", kind.alias("class"))


@query(
    "pf13_proposal_state",
    f"WITH {CURRENT} SELECT correction_id, CASE WHEN applied THEN 'applied' WHEN e.element_key IS NULL THEN 'no element' WHEN verdict IS NOT NULL OR adjudicated_by IS NOT NULL THEN 'judged' WHEN e.text IS NULL OR NOT contains(e.text, original) THEN 'overtaken' ELSE 'open' END AS state "
    "FROM corrections c LEFT JOIN e ON e.element_key = c.element_key WHERE original IS NOT NULL",
)
def proposal_state(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corrections").select("correction_id", "element_key", "original", "applied", "verdict", "adjudicated_by").filter("original IS NOT NULL")
    e = current(spark, d, "text").select("element_key", F.col("text").alias("now"), F.lit(True).alias("there"))
    state = F.when(F.col("applied"), "applied").when(F.col("there").isNull(), "no element").when(F.col("verdict").isNotNull() | F.col("adjudicated_by").isNotNull(), "judged").when(F.col("now").isNull() | ~F.contains("now", "original"), "overtaken").otherwise("open")
    return c.join(e, "element_key", "left").select("correction_id", state.alias("state"))


@query("pf14_correction_kind", "SELECT coalesce(kind, CASE WHEN starts_with(source, 'manuell') THEN 'emendering' ELSE 'ocr' END) AS kind, count(*) AS n, count(*) FILTER (applied) AS applied FROM corrections GROUP BY 1")
def correction_kind(spark: SparkSession, d: str) -> DataFrame:
    kind = F.coalesce("kind", F.when(F.startswith("source", F.lit("manuell")), "emendering").otherwise("ocr"))
    return table(spark, d, "corrections").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_if("applied").alias("applied"))


@query("pf12_overtaken", f"WITH {CURRENT} SELECT correction_id FROM corrections c JOIN e USING (element_key) WHERE corrected IS NOT NULL AND e.text IS NOT NULL AND original IS NOT NULL AND original <> '' AND contains(e.text, corrected) AND NOT contains(e.text, original)")
def overtaken(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corrections").select("correction_id", "element_key", "original", "corrected")
    e = current(spark, d, "text").select("element_key", F.col("text").alias("now"))
    return c.join(e, "element_key").filter((F.col("original") != "") & F.contains("now", "corrected") & ~F.contains("now", "original")).select("correction_id")
