"""Queries: windows over reading order, positions and times."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvarto.operators.drift import interleaved
from kvarto.operators.sequences import embedded_rows as embedded_rows_of
from kvarto.operators.sequences import anchor_bands, carried, gap_clusters, out_of_order, rolling_range, runs
from kvarto.plans import query
from kvarto.plans.elements import CURRENT, current
from kvarto.sources.tables import table


@query(
    "w01_reading_order",
    f"WITH {CURRENT}, n AS (SELECT *, lag(y) OVER w AS b, lead(y) OVER w AS a, count(*) OVER (PARTITION BY book, page, region) AS c FROM e WHERE y IS NOT NULL AND region IS NOT NULL AND NOT coalesce(removed, false) WINDOW w AS (PARTITION BY book, page, region ORDER BY idx, element_key)) "
    "SELECT element_key FROM n WHERE c >= 3 AND (y > b + 0.05 OR y < a - 0.05)",
)
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "idx", "region", "y", "removed").filter("y IS NOT NULL AND region IS NOT NULL AND NOT coalesce(removed, false)")
    return out_of_order(e, ["book", "page", "region"], ["idx", "element_key"], "y").select("element_key")


@query(
    "w02_interleaving",
    f"WITH {CURRENT}, c AS (SELECT book, page, idx, element_key, CASE region WHEN 'kolumn 1' THEN 1 WHEN 'kolumn 2' THEN 2 END AS col FROM e WHERE region IN ('kolumn 1', 'kolumn 2')), "
    "n AS (SELECT *, count(*) FILTER (col = 1) OVER (PARTITION BY book, page) AS firsts, count(*) FILTER (col = 2) OVER (PARTITION BY book, page) AS seconds, count(*) FILTER (col = 1) OVER (PARTITION BY book, page ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM c) SELECT element_key FROM n WHERE col = 2 AND firsts >= 5 AND seconds >= 5 AND after >= 0.8 * firsts",
)
def interleaving(spark: SparkSession, d: str) -> DataFrame:
    return interleaved(current(spark, d, "book", "page", "idx", "region"))


@query(
    "w03_x_clusters",
    f"WITH {CURRENT}, n AS (SELECT *, coalesce((x - lag(x) OVER w > 0.03)::INT, 1) AS new FROM e WHERE x IS NOT NULL WINDOW w AS (PARTITION BY book, page ORDER BY x, element_key)), "
    "k AS (SELECT *, sum(new) OVER (PARTITION BY book, page ORDER BY x, element_key) AS cluster FROM n) SELECT book, page, cluster::BIGINT AS cluster, count(*) AS n, min(x) AS left_edge FROM k GROUP BY 1, 2, 3",
)
def x_clusters(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "x").filter("x IS NOT NULL")
    return gap_clusters(e, ["book", "page"], "x", 0.03, ["element_key"]).groupBy("book", "page", "cluster").agg(F.count("*").alias("n"), F.min("x").alias("left_edge"))


@query(
    "w03_sessions",
    "WITH n AS (SELECT *, coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER w > 21600000000)::INT, 1) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM n) "
    "SELECT user_id, session::BIGINT AS session, count(*) AS n, round(sum(value), 4) AS value FROM k GROUP BY 1, 2",
)
def sessions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return gap_clusters(e, ["user_id"], "us", 6 * 3600 * 1_000_000, ["event_id"], "session").groupBy("user_id", "session").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query(
    "w04_anchor_rows",
    f"WITH {CURRENT}, p AS (SELECT book, page, list(-y ORDER BY y DESC) AS ys FROM e WHERE y IS NOT NULL GROUP BY 1, 2), s AS (SELECT book, page, list_reduce(list_transform(ys, lambda y: [y]), lambda a, b: CASE WHEN b[1] - a[-1] > 0.006 THEN list_append(a, b[1]) ELSE a END) AS starts FROM p) "
    "SELECT e.book, e.page, len(list_filter(starts, lambda v: v <= -e.y))::INT AS band, e.x, e.element_key FROM e JOIN s ON s.book = e.book AND s.page = e.page WHERE e.y IS NOT NULL",
)
def anchor_rows(spark: SparkSession, d: str) -> DataFrame:
    """Printed rows of each page: elements within .006 of the row's topmost one."""
    e = current(spark, d, "book", "page", "y", "x")
    return anchor_bands(e, ["book", "page"], "y", 0.006, ["x", "element_key"])


@query(
    "w06_embedded_rows",
    f"WITH {CURRENT}, n AS (SELECT book, page, idx, element_key, method = 'embedded' AND contains(text, chr(10)) AND len(string_split(text, chr(10))) >= 2 AND list_max(list_transform(string_split(text, chr(10)), lambda l: length(l))) <= 28 AS short, len(string_split(text, chr(10))) AS size FROM e WHERE text IS NOT NULL), m AS (SELECT *, CASE WHEN short THEN size ELSE 0 END AS cells FROM n), "
    "c AS (SELECT *, CASE WHEN lag(cells) OVER w IS NOT DISTINCT FROM cells THEN 0 ELSE 1 END AS new FROM m WINDOW w AS (PARTITION BY book, page ORDER BY idx, element_key)), r AS (SELECT *, sum(new) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS run FROM c) "
    "SELECT book, page, run::BIGINT AS run, max(cells)::INT AS cells, count(*) AS n FROM r WHERE cells > 0 GROUP BY 1, 2, 3 HAVING count(*) >= 2",
)
def embedded_rows(spark: SparkSession, d: str) -> DataFrame:
    return embedded_rows_of(current(spark, d, "book", "page", "idx", "text", "method"))


@query(
    "w07_row_pitch",
    f"WITH {CURRENT}, m AS (SELECT book, median(h) AS med FROM e WHERE h IS NOT NULL GROUP BY 1), s AS (SELECT DISTINCT book, page, region, y FROM e WHERE y IS NOT NULL AND region IS NOT NULL), "
    "t AS (SELECT book, region, lag(y) OVER (PARTITION BY book, page, region ORDER BY y DESC) - y AS step FROM s) SELECT t.book, t.region, round(median(step), 6) AS pitch FROM t JOIN m USING (book) WHERE step > 0 AND step <= 4 * med GROUP BY 1, 2",
)
def row_pitch(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "region", "y", "h")
    height = e.filter("h IS NOT NULL").groupBy("book").agg(F.median("h").alias("med"))
    places = e.filter("y IS NOT NULL AND region IS NOT NULL").select("book", "page", "region", "y").distinct()
    w = Window.partitionBy("book", "page", "region").orderBy(F.desc("y"))
    steps = places.withColumn("step", F.lag("y").over(w) - F.col("y")).filter("step > 0")
    return steps.join(height, "book").filter(F.col("step") <= 4 * F.col("med")).groupBy("book", "region").agg(F.round(F.median("step"), 6).alias("pitch"))


@query(
    "w08_split_tables",
    f"WITH {CURRENT}, p AS (SELECT book, page, arg_max(type, (idx, element_key)) AS last, arg_min(type, (idx, element_key)) AS first, arg_min(coalesce(len(headers), 0), (idx, element_key)) AS heads FROM e WHERE type NOT IN ('page_artifact') GROUP BY 1, 2) "
    "SELECT a.book, a.page FROM p a JOIN p b ON a.book = b.book AND b.page = a.page + 1 WHERE a.last IN ('table', 'table_cell') AND b.first IN ('table', 'table_cell') AND b.heads = 0",
)
def split_tables(spark: SparkSession, d: str) -> DataFrame:
    """Pages that end in a table where the next one begins with a table without headers."""
    e = current(spark, d, "book", "page", "idx", "type", "headers").filter("type <> 'page_artifact'")
    at = F.struct("idx", "element_key")
    p = e.groupBy("book", "page").agg(F.max_by("type", at).alias("last"), F.min_by(F.struct("type", F.coalesce(F.size("headers"), F.lit(0)).alias("heads")), at).alias("first"))
    w = Window.partitionBy("book").orderBy("page")
    n = p.withColumns({"next": F.lead("page").over(w), "then": F.lead("first").over(w)})
    return n.filter((F.col("next") == F.col("page") + 1) & F.col("last").isin("table", "table_cell") & F.col("then.type").isin("table", "table_cell") & (F.col("then.heads") <= 0)).select("book", "page")


@query(
    "w11_type_runs",
    f"WITH {CURRENT}, c AS (SELECT book, page, idx, element_key, type, CASE WHEN lag(type) OVER w = type THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY book, page ORDER BY idx, element_key)), r AS (SELECT *, sum(new) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS run FROM c) "
    "SELECT book, page, run::BIGINT AS run, min(type) AS type, count(*) AS n FROM r GROUP BY 1, 2, 3",
)
def type_runs(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "idx", "type")
    return runs(e, ["book", "page"], ["idx", "element_key"], F.col("type")).groupBy("book", "page", "run").agg(F.min("type").alias("type"), F.count("*").alias("n"))


@query(
    "w20_carried_headers",
    f"WITH {CURRENT}, g AS (SELECT *, sum(CASE WHEN type IN ('table', 'table_caption') THEN 0 ELSE 1 END) OVER (PARTITION BY book, page ORDER BY idx, element_key) AS chain FROM e WHERE NOT coalesce(removed, false)), "
    "c AS (SELECT element_key, coalesce(len(headers), 0) = 0 AS inherited, list_max(list_transform(rows, lambda r: len(r))) AS cells, last_value(CASE WHEN len(headers) >= 2 THEN headers END IGNORE NULLS) OVER (PARTITION BY book, page, chain ORDER BY idx, element_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM g WHERE type = 'table') "
    "SELECT element_key, inherited, CASE WHEN NOT inherited OR len(used) = cells THEN used END AS used FROM c",
)
def carried_headers(spark: SparkSession, d: str) -> DataFrame:
    """A table without headers takes those (two or more) of the table before it on the page, if only captions stand between and its widest row has as many cells."""
    e = current(spark, d, "book", "page", "idx", "type", "headers", "rows", "removed").filter("NOT coalesce(removed, false)")
    w = Window.partitionBy("book", "page").orderBy("idx", "element_key")
    t = e.withColumn("chain", F.sum(F.when(F.col("type").isin("table", "table_caption"), 0).otherwise(1)).over(w)).filter("type = 'table'")
    used = carried(t, ["book", "page", "chain"], ["idx", "element_key"], F.when(F.size("headers") >= 2, F.col("headers")), "used")
    inherited = F.coalesce(F.size("headers"), F.lit(0)) <= 0
    cells = F.array_max(F.transform("rows", lambda r: F.size(r)))
    return used.select("element_key", inherited.alias("inherited"), F.when(~inherited | (F.size("used") == cells), F.col("used")).alias("used"))


@query("j16_preceding_caption", f"WITH {CURRENT} SELECT * FROM (SELECT element_key, type, last_value(CASE WHEN type = 'table_caption' THEN text END IGNORE NULLS) OVER (PARTITION BY book, page ORDER BY idx, element_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS caption FROM e) WHERE type = 'table' AND caption IS NOT NULL")
def preceding_caption(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "idx", "type", "text").filter("type IN ('table', 'table_caption')")
    return carried(e, ["book", "page"], ["idx", "element_key"], F.when(F.col("type") == "table_caption", F.col("text")), "caption").filter("type = 'table' AND caption IS NOT NULL").select("element_key", "type", "caption")


@query("j16_shared_bands", f"WITH {CURRENT}, b AS (SELECT book, page, element_key, unnest(bands) AS band FROM e WHERE bands IS NOT NULL) SELECT book, page, band, count(DISTINCT element_key) AS owners FROM b GROUP BY 1, 2, 3 HAVING count(DISTINCT element_key) > 1")
def shared_bands(spark: SparkSession, d: str) -> DataFrame:
    """Measured rows that several elements of a page claim."""
    b = current(spark, d, "book", "page", "bands").select("book", "page", "element_key", F.explode("bands").alias("band")).distinct()
    return b.groupBy("book", "page", "band").agg(F.count("*").alias("owners")).filter("owners > 1")


@query(
    "j17_orphan_bands",
    f"WITH {CURRENT}, b AS (SELECT DISTINCT book, page, unnest(bands) AS band FROM e WHERE bands IS NOT NULL), s AS (SELECT book, page, band, lead(band) OVER (PARTITION BY book, page ORDER BY band) AS next FROM b) SELECT book, page, band AS after, next - band - 1 AS missing FROM s WHERE next > band + 1",
)
def orphan_bands(spark: SparkSession, d: str) -> DataFrame:
    """Gaps in the measured rows that a page's elements own."""
    b = current(spark, d, "book", "page", "bands").select("book", "page", F.explode("bands").alias("band")).distinct()
    s = b.withColumn("next", F.lead("band").over(Window.partitionBy("book", "page").orderBy("band")))
    return s.filter("next > band + 1").select("book", "page", F.col("band").alias("after"), (F.col("next") - F.col("band") - 1).alias("missing"))


@query(
    "w22_column_split",
    f"WITH {CURRENT}, m AS (SELECT book, page, x + w / 2 AS mid, element_key FROM e WHERE x IS NOT NULL), g AS (SELECT book, page, mid - lag(mid) OVER (PARTITION BY book, page ORDER BY mid, element_key) AS gap, mid FROM m) "
    "SELECT book, page, round(max(gap), 6) AS gap, round(arg_max(mid, (gap, -mid)) - max(gap) / 2, 6) AS split FROM g WHERE gap IS NOT NULL GROUP BY 1, 2 HAVING max(gap) >= 0.2",
)
def column_split(spark: SparkSession, d: str) -> DataFrame:
    """Where the widest gap between the middles of a page's boxes, if wide enough, splits it in two columns."""
    m = current(spark, d, "book", "page", "x", "w").filter("x IS NOT NULL").withColumn("mid", F.col("x") + F.col("w") / 2)
    g = m.withColumn("gap", F.col("mid") - F.lag("mid").over(Window.partitionBy("book", "page").orderBy("mid", "element_key"))).filter("gap IS NOT NULL")
    best = g.groupBy("book", "page").agg(F.max("gap").alias("gap"), F.max_by("mid", F.struct("gap", -F.col("mid"))).alias("mid")).filter("gap >= 0.2")
    return best.select("book", "page", F.round("gap", 6).alias("gap"), F.round(F.col("mid") - F.col("gap") / 2, 6).alias("split"))


@query("w30_rolling_range", f"WITH {CURRENT} SELECT element_key, min(h) OVER w AS low, max(h) OVER w AS high FROM e WHERE h IS NOT NULL WINDOW w AS (PARTITION BY book, page ORDER BY idx, element_key ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def rolling_heights(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "idx", "h").filter("h IS NOT NULL")
    return rolling_range(e, ["book", "page"], ["idx", "element_key"], "h", 2).select("element_key", "low", "high")


@query("w40_missing_pages", "WITH p AS (SELECT book, min(page) AS low, max(page) AS high FROM bok GROUP BY 1) SELECT book, page FROM (SELECT book, unnest(range(low, high + 1))::INT AS page FROM p) EXCEPT SELECT book, page FROM bok")
def missing_pages(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bok").select("book", "page").distinct().withColumn("next", F.lead("page").over(Window.partitionBy("book").orderBy("page")))
    return b.filter("next > page + 1").select("book", F.explode(F.sequence(F.col("page") + 1, F.col("next") - 1)).alias("page"))


@query("t04_topmost", f"WITH {CURRENT} SELECT book, page, element_key FROM e WHERE y IS NOT NULL QUALIFY row_number() OVER (PARTITION BY book, page ORDER BY y DESC, idx, element_key) = 1")
def topmost(spark: SparkSession, d: str) -> DataFrame:
    e = current(spark, d, "book", "page", "idx", "y").filter("y IS NOT NULL")
    return e.groupBy("book", "page").agg(F.min_by("element_key", F.struct(-F.col("y"), F.col("idx"), F.col("element_key"))).alias("element_key"))
