"""The element table as queries use it: one current row per element, box parts as columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvarto.operators.versions import newest
from kvarto.sources.tables import table

COLUMNS = ["row_id", "element_key", "book", "page", "idx", "id", "type", "level", "text", "style", "confidence", "headers", "rows", "items", "needs_review", "review_reasons", "removed", "added_by", "stage"]
#: the same in SQL, as a common table expression
CURRENT = f"""e AS (SELECT {', '.join(COLUMNS)}, source.region AS region, source.method AS method, source.bbox_source AS bbox_source, source.rader AS bands,
source.bbox[1] AS x, source.bbox[2] AS y, source.bbox[3] AS w, source.bbox[4] AS h, updated_at
FROM bok QUALIFY row_number() OVER (PARTITION BY element_key ORDER BY updated_at DESC NULLS LAST, row_id) = 1)"""


def current(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Newest version of every element; only the asked columns are carried through the shuffle."""
    box = lambda i: F.try_element_at("source.bbox", F.lit(i))
    parts = {"region": F.col("source.region"), "method": F.col("source.method"), "bbox_source": F.col("source.bbox_source"), "bands": F.col("source.rader"), "x": box(1), "y": box(2), "w": box(3), "h": box(4)}
    wanted = dict.fromkeys(["row_id", "element_key", "updated_at", *(columns or (*COLUMNS, *parts))])
    df = table(spark, d, "bok").select(*[parts[c].alias(c) if c in parts else F.col(c) for c in wanted])
    return newest(df, ["element_key"], "updated_at", "row_id")
