"""Queries of the text problems, by name, and SQL where it can express them."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvarto.llm.canonical import map_to_reference
from kvarto.llm.lookalike import normalise
from kvarto.llm.mixing import mix, mix_report, supply_report
from kvarto.llm.packing import filling, pack, sized_once
from kvarto.llm.quality import calibration_report, fit_model, forms_of, judge_texts, structured_texts, text_statistics, training_sample
from kvarto.llm.scanned import learn, repair_texts
from kvarto.llm.splitting import split_documents
from kvarto.llm.tokens import with_tokens
from kvarto.session import bounded_rows, broadcast_checked
from kvarto.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def _gear(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok").filter(F.col("type") == "list_item").select("row_id", "text")
    slot = F.when(F.startswith("text", F.lit("Vapen:")), "weapon").when(F.startswith("text", F.lit("Rustning:")), "armor")
    lines = bok.withColumn("slot", slot).filter(F.col("slot").isNotNull())
    lines = lines.withColumn("typed", F.expr("substring(text, instr(text, ':') + 1)"))
    weapons = table(spark, d, "weapons").select(F.col("weapon_id").alias("id"), "name")
    armor = table(spark, d, "armor").select(F.col("armor_id").alias("id"), "name")
    return map_to_reference(lines, "typed", weapons.unionByName(armor), "id", "name")


@query("p3_found")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _gear(spark, d).select("row_id", "slot", "item_id")


@query("p3_unmatched")
def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return _gear(spark, d).filter("item_id = -1").groupBy("slot", F.lower(F.trim("typed")).alias("typed")).agg(F.count("*").alias("lines"), F.max(F.col("ambiguous").cast("int")).alias("ambiguous"))


def _p5(spark: SparkSession, d: str) -> DataFrame:
    bok = table(spark, d, "bok").select("row_id", "text", "rows")
    cells = F.flatten(F.transform(F.filter("rows", lambda r: r.isNotNull()), lambda r: r))
    corpus = bok.select(F.concat_ws("\n", "text", cells).alias("all_text"))
    return normalise(bok, "row_id", {"text": F.array("text"), "rows": cells}, corpus, "all_text")


#: the characters alone, as an exact check of the cases; a mixed word has two neighbouring letters of different alphabets
_ODD_SQL = r"[\p{Mn}\p{Me}\p{Cf}\x{FF01}-\x{FFEF}]|[\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]|\p{Latin}[\p{Greek}\p{Cyrillic}\p{Armenian}\p{Hebrew}]|[\p{Greek}\p{Cyrillic}\p{Armenian}\p{Hebrew}]\p{Latin}"


@query("p5_found", f"SELECT row_id, 'text' AS field FROM bok WHERE regexp_matches(text, '{_ODD_SQL}') UNION ALL SELECT DISTINCT row_id, 'rows' FROM (SELECT row_id, unnest(flatten(list_filter(rows, lambda r: r IS NOT NULL))) AS cell FROM bok WHERE rows IS NOT NULL) WHERE regexp_matches(cell, '{_ODD_SQL}')")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _p5(spark, d).select(F.col("id").alias("row_id"), "field")


@query("p5_rewritten")
def p5_rewritten(spark: SparkSession, d: str) -> DataFrame:
    return _p5(spark, d).select(F.col("id").alias("row_id"), "field", "plain", F.concat_ws(",", "kinds").alias("kinds"))


#: running texts that the classifier of p6 is fitted on, at most
P6_SAMPLE = 6000


def common_set(spark: SparkSession, d: str) -> frozenset[str]:
    """Frequent Swedish words: the ranked list and the lexicon's function words (both tables have a fixed size)."""
    ranked = table(spark, d, "common_words").filter("lang = 'sv' AND word IS NOT NULL").select(F.lower("word").alias("w"))
    small = table(spark, d, "lexicon").filter("category IN ('smaord', 'preposition', 'lopande', 'adverb') AND term IS NOT NULL").select(F.lower("term").alias("w"))
    rows = bounded_rows(ranked.union(small).distinct(), 100_000)
    if rows is None:
        raise ValueError("the lists of common words are larger than the driver should hold")
    return frozenset(r["w"] for r in rows)


def _model(spark: SparkSession, d: str):
    """(running texts, common words, the classifier of p6)."""
    bok = table(spark, d, "bok")
    running = bok.filter(F.col("type").isin("paragraph", "boxed_text")).select("row_id", "text")
    common = common_set(spark, d)
    return running, common, fit_model(training_sample(running, "row_id", "text", structured_texts(F.col("items"), F.col("rows"), bok), P6_SAMPLE), common)


def _p6(spark: SparkSession, d: str, with_stats: bool) -> DataFrame:
    running, common, model = _model(spark, d)
    return judge_texts(running, "row_id", "text", model, common, with_stats).withColumnRenamed("id", "row_id")


@query("p6_found")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d, False).filter("form <> 'prose'").select("row_id", "form")


@query("p6_calibration")
def p6_calibration(spark: SparkSession, d: str) -> DataFrame:
    _, common, model = _model(spark, d)
    return spark.createDataFrame(calibration_report(model, common), "fold int, texts int, share_right double, mean_probability double, error double")


@query("p6_statistics")
def p6_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d, True)


def lexicon_words(spark: SparkSession, d: str) -> tuple[frozenset[str], frozenset[str]]:
    """(word forms, first parts of compounds) of the lexicon, a table of fixed size."""
    rows = bounded_rows(table(spark, d, "lexicon").filter("term IS NOT NULL").select(F.lower("term").alias("t"), F.coalesce("category", F.lit("")).alias("c")), 200_000)
    if rows is None:
        raise ValueError("the lexicon is larger than the driver should hold")
    return frozenset(r["t"] for r in rows if r["c"] != "förled"), frozenset(r["t"] for r in rows if r["c"] in ("förled", "substantiv"))


class NotProse:
    """Marks the running texts that p6 takes for a list, a table or junk."""

    def __init__(self, model, common):
        self.model, self.common = model, common

    def __call__(self, batch) -> list[bool]:
        out = [False] * len(batch)
        at = [i for i, f in enumerate(batch["field"]) if f == "text"]
        if at:
            stats = np.array([text_statistics(t, self.common) for t in batch["text"].iloc[at]])
            for i, form in zip(at, forms_of(self.model, stats)):
                out[i] = form != "prose"
        return out


def _p2(spark: SparkSession, d: str, only_noisy: bool) -> DataFrame:
    bok, corrections = table(spark, d, "bok"), table(spark, d, "corrections")
    running = bok.filter(F.col("type").isin("paragraph", "boxed_text"))
    part = lambda df, field, ident: df.select(F.lit(field).alias("field"), F.col(ident).alias("rec_id"), "book", "page", F.col(field).alias("text"))
    both = lambda c: part(c, "original", "correction_id").unionByName(part(c, "corrected", "correction_id"))
    texts = part(running, "text", "row_id").unionByName(both(corrections))
    # few bytes but much to look up in each: corrections are spread over all cores for the repair
    spread = part(running, "text", "row_id").unionByName(both(corrections).repartition(4 * spark.sparkContext.defaultParallelism))
    lexicon, prefixes = lexicon_words(spark, d)
    _, common, model = _model(spark, d)
    noise = corrections.filter("kind IS NULL OR kind <> 'emendering'")
    titles = table(spark, d, "books").select("book", F.col("title").alias("text"))
    learnt = learn(texts, noise, bok.filter("type = 'page_artifact'"), titles, bok.filter("type = 'heading'"), lexicon, prefixes)
    return repair_texts(spread, learnt, skip=NotProse(model, common), only_noisy=only_noisy)


@query("p2_found")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d, True).select("field", "rec_id", F.explode("kinds").alias("noise"))


@query("p2_repaired")
def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d, False).select("field", "rec_id", "repaired")


def _limits(spark: SparkSession, d: str) -> dict[str, tuple[int, int]]:
    rows = bounded_rows(table(spark, d, "size_limits"), 10_000) or []
    return {r["limit_name"]: (r["capacity_tokens"], r["overlap_tokens"]) for r in rows}


def _packed(spark: SparkSession, d: str) -> dict[str, tuple[int, DataFrame]]:
    sized = sized_once(with_tokens(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("doc_id", "id"))
    limits = _limits(spark, d)
    return {name: (limits[name][0], pack(sized, limits[name][0])) for name in ("pack_small", "pack_large") if name in limits}


@query("p7_packing")
def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    parts = [df.select(F.lit(name).alias("limit_name"), F.col("id").alias("doc_id"), "piece", "size", "sequence", "place") for name, (_, df) in _packed(spark, d).items()]
    return reduce(DataFrame.unionByName, parts)


@query("p7_filling")
def p7_filling(spark: SparkSession, d: str) -> DataFrame:
    parts = [filling(df, capacity).select(F.lit(name).alias("limit_name"), "sequences", "tokens", "unused", "filled") for name, (capacity, df) in _packed(spark, d).items()]
    return reduce(DataFrame.unionByName, parts)


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """Documents of sources to be mixed, with their tokens, counted once."""
    docs, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    wanted = docs.join(broadcast_checked(targets.select("source"), 100_000), "source", "left_semi")
    return sized_once(with_tokens(wanted, "doc_id", "text", ["source"]).withColumnRenamed("doc_id", "id"))


@query("p8_found")
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return supply_report(_sources(spark, d), table(spark, d, "mix_targets")).filter("short").select("source")


@query("p8_mix")
def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(_sources(spark, d), table(spark, d, "mix_targets")).groupBy(F.col("id").alias("doc_id"), "source").agg(F.count("*").alias("uses"))


@query("p8_shares")
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_report(_sources(spark, d), table(spark, d, "mix_targets"))


def _split(spark: SparkSession, d: str) -> DataFrame:
    return split_documents(table(spark, d, "documents"), "doc_id", "text", *_limits(spark, d)["cut"])


@query("p9_found")
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).filter("piece = 0").select(F.col("id").alias("doc_id"))


@query("p9_pieces")
def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).withColumnRenamed("id", "doc_id")
