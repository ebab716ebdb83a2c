"""Queries of the general data-pipeline problems (copies of data, nested records)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvarto.operators.diff import compare_copies, difference_values
from kvarto.operators.nested import damaged, flat_table, labelled_nodes, linked_nodes
from kvarto.plans import query
from kvarto.sources.tables import table

FIELDS = ["text", "type", "level", "confidence"]
_NEWEST = """WITH b AS (SELECT element_key, max_by(struct_pack(text := text, type := type, level := level, confidence := confidence), coalesce(updated_at, TIMESTAMP '0001-01-01')) AS v FROM bok GROUP BY 1),
c AS (SELECT element_key, max_by(struct_pack(text := text, type := type, level := level, confidence := confidence), coalesce(updated_at, TIMESTAMP '0001-01-01')) AS v FROM bok_copy GROUP BY 1),
j AS (SELECT coalesce(b.element_key, c.element_key) AS element_key, b.element_key IS NULL AS no_b, c.element_key IS NULL AS no_c, b.v AS bv, c.v AS cv FROM b FULL JOIN c ON b.element_key = c.element_key),
d AS (SELECT element_key, 'only_bok' AS diff, NULL AS left_value, NULL AS right_value FROM j WHERE no_c
UNION ALL SELECT element_key, 'only_copy', NULL, NULL FROM j WHERE no_b
UNION ALL SELECT element_key, 'text', bv.text, cv.text FROM j WHERE NOT no_b AND NOT no_c AND bv.text IS DISTINCT FROM cv.text
UNION ALL SELECT element_key, 'type', bv.type, cv.type FROM j WHERE NOT no_b AND NOT no_c AND bv.type IS DISTINCT FROM cv.type
UNION ALL SELECT element_key, 'level', CAST(bv.level AS VARCHAR), CAST(cv.level AS VARCHAR) FROM j WHERE NOT no_b AND NOT no_c AND bv.level IS DISTINCT FROM cv.level
UNION ALL SELECT element_key, 'confidence', CAST(bv.confidence AS VARCHAR), CAST(cv.confidence AS VARCHAR) FROM j WHERE NOT no_b AND NOT no_c AND bv.confidence IS DISTINCT FROM cv.confidence)
"""


@query("p1_found", _NEWEST + "SELECT element_key, diff FROM d")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return compare_copies(table(spark, d, "bok"), table(spark, d, "bok_copy"), ["element_key"], FIELDS, "updated_at", ("only_bok", "only_copy"))


@query("p1_values", _NEWEST + "SELECT element_key, diff, left_value, right_value FROM d")
def p1_values(spark: SparkSession, d: str) -> DataFrame:
    return difference_values(table(spark, d, "bok"), table(spark, d, "bok_copy"), "element_key", FIELDS, "updated_at", ("only_bok", "only_copy"))


def _entries(value: str) -> str:
    """SQL: a JSON array as a list, a lone object as a list of one, anything else as none."""
    return f"CASE json_type({value}) WHEN 'ARRAY' THEN CAST({value} AS JSON[]) WHEN 'OBJECT' THEN [{value}] END"


_NESTED = f"""WITH v AS (SELECT raw_id, coalesce(CAST(payload AS JSON)->'$.pages', CAST(payload AS JSON)->'$.bok.pages') AS pages FROM bok_raw WHERE json_valid(payload)),
p AS (SELECT raw_id, generate_subscripts(l, 1) - 1 AS page_pos, unnest(l) AS page FROM (SELECT raw_id, {_entries('pages')} AS l FROM v)),
e AS (SELECT raw_id, page_pos, generate_subscripts(l, 1) - 1 AS element_pos, unnest(l) AS element FROM (SELECT raw_id, page_pos, {_entries("(page->'$.elements')")} AS l FROM p WHERE json_type(page) = 'OBJECT')),
o AS (SELECT * FROM e WHERE json_type(element) = 'OBJECT'),
c AS (SELECT raw_id, page_pos, element_pos, 'correction' AS child, generate_subscripts(l, 1) - 1 AS child_pos, unnest(l) AS value FROM (SELECT *, {_entries("(element->'$.corrections')")} AS l FROM o)
UNION ALL SELECT raw_id, page_pos, element_pos, 'row', generate_subscripts(l, 1) - 1, unnest(l) FROM (SELECT *, {_entries("(element->'$.rows')")} AS l FROM o)
UNION ALL SELECT raw_id, page_pos, element_pos, 'row', generate_subscripts(l, 1) - 1, unnest(l) FROM (SELECT *, {_entries("(element->'$.data.rows')")} AS l FROM o)
UNION ALL SELECT raw_id, page_pos, element_pos, 'row', generate_subscripts(l, 1) - 1, unnest(l) FROM (SELECT *, {_entries("(element->'$.data.table.rows')")} AS l FROM o))
SELECT raw_id, page_pos::INT AS page_pos, element_pos::INT AS element_pos, 'element' AS child, -1 AS child_pos FROM o
UNION ALL SELECT raw_id, page_pos::INT, element_pos::INT, child, child_pos::INT FROM c WHERE json_type(value) = 'OBJECT' OR child = 'row' AND json_type(value) = 'ARRAY'"""


@query("p4_found", _NESTED)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = linked_nodes(labelled_nodes(table(spark, d, "bok_raw"), "raw_id", "payload"))
    element = F.col("kind") == "element"
    return nodes.filter(F.col("kind") != "page").select(
        F.col("id").alias("raw_id"), "page_pos", F.when(element, F.col("pos")).otherwise(F.col("element_pos")).alias("element_pos"), F.col("kind").alias("child"), F.when(element, -1).otherwise(F.col("pos")).alias("child_pos")
    )


_PAGE = r"^\$(\.bok)?\.pages(\[\d+\])?"
_LAST_INDEX = r"\[(\d+)\]$"
_ELEMENT = _PAGE + r"\.elements(\[\d+\])?"
#: fields of each kind's table, by JSON path
TABLES = {
    "page": {"page": "$.page", "stage": "$.stage"},
    "element": {"element_id": "$.id", "type": "$.type", "level": "$.level", "text": "$.text", "confidence": "$.confidence"},
    "correction": {"original": "$.original", "corrected": "$.corrected", "kind": "$.kind", "verdict": "$.verdict"},
    "row": {"first_cell": "$[0]"},
}


def _flat_sql(kind: str, own: str, parent: str | None, types: str) -> str:
    """SQL of a flat table: nodes of the JSON tree numbered in pre-order, records and parents told by their paths."""
    link = f", p.pre AS {parent[0]}_key" if parent else ""
    join = f" JOIN t p ON p.raw_id = r.raw_id AND p.fullkey = regexp_extract(r.fullkey, '{parent[1]}')" if parent else ""
    fields = "".join(f", r.node->>'{path}' AS {name}" for name, path in TABLES[kind].items())
    tree = "SELECT raw_id, j.fullkey, j.type, j.value::JSON AS node, row_number() OVER (PARTITION BY raw_id ORDER BY j.id) - 1 AS pre FROM bok_raw, json_tree(CASE WHEN json_valid(payload) THEN payload END) j"
    return f"WITH t AS ({tree}) SELECT r.raw_id, r.pre AS {kind}_key, coalesce(TRY_CAST(regexp_extract(r.fullkey, '{_LAST_INDEX}', 1) AS INT), 0) AS {kind}_position{link}{fields} FROM t r{join} WHERE regexp_matches(r.fullkey, '{own}$') AND ({types})"


def _flat(spark: SparkSession, d: str, kind: str) -> DataFrame:
    nodes = labelled_nodes(table(spark, d, "bok_raw"), "raw_id", "payload", with_body=True)
    return flat_table(nodes, kind, TABLES[kind]).withColumnRenamed("id", "raw_id").drop("doc", "copy")


@query("p4_pages", _flat_sql("page", _PAGE, None, "r.type = 'OBJECT'"))
def p4_pages(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "page")


@query("p4_elements", _flat_sql("element", _ELEMENT, ("page", _PAGE), "r.type = 'OBJECT'"))
def p4_elements(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "element")


@query("p4_corrections", _flat_sql("correction", _ELEMENT + r"\.corrections(\[\d+\])?", ("element", _ELEMENT), "r.type = 'OBJECT'"))
def p4_corrections(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "correction")


@query("p4_rows", _flat_sql("row", _ELEMENT + r"(\.data|\.data\.table)?\.rows(\[\d+\])?", ("element", _ELEMENT), "r.type = 'OBJECT' OR r.type = 'ARRAY' AND r.fullkey LIKE '%]'"))
def p4_rows(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "row")


@query("p4_damaged", "SELECT raw_id AS id, CASE WHEN payload IS NULL THEN 'null' ELSE 'not JSON' END AS reason FROM bok_raw WHERE payload IS NULL OR NOT json_valid(payload)")
def p4_damaged(spark: SparkSession, d: str) -> DataFrame:
    return damaged(table(spark, d, "bok_raw"), "raw_id", "payload")
