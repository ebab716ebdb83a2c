"""Text statistics of each document and a verdict on what the text is: prose, list, table or junk.

Gradient-boosted trees are fitted on the statistics of a bounded sample: running texts with a weak label by rule, and texts
built from the structured lists and tables of the same corpus. A holdout checked by hand calibrates the probabilities.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Collection, Iterator
from copy import copy

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvarto.llm.boost import BoostedTrees
from kvarto.llm.holdout import HOLDOUT

FORMS = ("prose", "list", "table", "junk")
STATS = (
    "n_chars", "n_words", "n_lines", "mean_word_length", "letter_ratio", "digit_ratio", "symbol_ratio", "punctuated_lines",
    "common_words", "bullet_lines", "column_lines", "separator_ratio", "unique_words", "vowelless_words", "single_characters",
    "sentence_ends", "ends_punctuated", "starts_upper", "words_per_line", "bare_short_lines", "value_words", "odd_characters", "run_characters",
)
_WORD = re.compile(r"[^\W\d_]+")
_BULLET = re.compile(r"\s*(?:[-–—•*·▪◦]|\(?\d{1,3}[.)]|\(?[a-zåäö][.)])\s+[^\W\d]")
_RUN = re.compile(r"([^\s.])\1{4,}")
_SPACED = re.compile(r"(?<!\S)(?:\S {1,3}){3,}\S(?!\S)")
_MARKS = re.compile(r"[\u0300-\u036f\u200b-\u200f\u2060\ufeff]|[\uff00-\uffef]|[^\S\n\t ]")
_COLUMNS = re.compile(r"\S(?:\t|\s{3,}|\s*\|\s*|;)\S|(?:\.\s?){4,}|\S\s{2,}(?:\S+\s{2,}\S+|\S+\s*)$")
_END = re.compile(r"[.!?…:][\"”'’)]*\s*$")
_SENTENCE = re.compile(r"[a-zåäöé\d)\"”]{2}[.!?…][\"”'’)]*(?=\s*\n|\s+[\"”A-ZÅÄÖ]|\s*$)")
#: what every match of _COLUMNS and of _ODD holds, quick to look for
_MAY_BE_COLUMNS = re.compile(r"[\t|;]|\s\s|\.\s?\.")
_ODD_ANY = re.compile(r"[^\w\s.,;:!?\"'”’()\[\]/%+*–—…•|&=-]|[ÃÂï]")
_VALUE = re.compile(r"[\d–%+/-]+|\d+[TtDd]\d+(?:[+-]\d+)?")
_VOWEL = re.compile(r"[aeiouyåäöáéèïüæøAEIOUYÅÄÖ]")
#: signs that running text doesn't use, and the traces of a text decoded with the wrong character set
_ODD = re.compile(r"(?:[^\w\s.,;:!?\"'”’()\[\]/%+*–—…•|&=-]|[ÃÂï](?=[^\x00-\x7f])|(?<=[ÃÂ]).)+")


def text_statistics(text: str, common: Collection[str]) -> list[float]:
    """The statistics of one text, in the order of STATS; all but the length are 0 for an empty one.

    They are taken from the text in plain forms, without blanks at line ends; a line of spaced capitals counts as its letters.
    """
    size = float(len(text))
    if _needs_folding(text):
        text = _MARKS.sub(lambda m: "" if unicodedata.category(m[0]) == "Cf" else "\n" if m[0] in "\r\x85\u2028" else m[0], text.replace("\r\n", "\n"))
        text = unicodedata.normalize("NFKC", text)
    if " \n" in text:
        text = re.sub(r" +\n", "\n", text)
    tokens = text.split()
    if sum(1 for t in tokens if len(t) == 1) > 3:
        text = _SPACED.sub(lambda m: m[0].replace(" ", "") if m[0].isupper() else m[0], text)
        tokens = text.split()
    if not tokens:
        return [size] + [0.0] * (len(STATS) - 1)
    words = _WORD.findall(text)
    lines = [x for x in text.splitlines() if x.strip()]
    solid = sum(map(len, tokens))
    letters = sum(map(len, words))
    digits = sum(map(str.isdigit, text))
    n, m, k = len(tokens), max(1, len(words)), len(lines)
    longer = [w for w in words if len(w) > 1]
    ends = [bool(_END.search(x)) for x in lines]
    bare = sum(1 for x, end in zip(lines, ends) if not end and len(x.split()) <= 5)
    odd = sum(map(len, _ODD.findall(text))) if _ODD_ANY.search(text) else 0
    run = sum(len(m[0]) for m in _RUN.finditer(text)) if any(c * 5 in text for c in set(text) if c not in " .\n\t") else 0
    return [
        size, float(n), float(k), letters / m, letters / solid, digits / solid, (solid - letters - digits) / solid, sum(ends) / k,
        sum(1 for w in words if w.lower() in common) / m, sum(1 for x in lines if _BULLET.match(x)) / k, sum(1 for x in lines if _MAY_BE_COLUMNS.search(x) and _COLUMNS.search(x)) / k,
        (text.count(",") + text.count(";")) / n, len({t.lower() for t in tokens}) / n, sum(1 for w in longer if not _VOWEL.search(w)) / max(1, len(longer)),
        sum(1 for t in tokens if len(t) == 1) / n, len(_SENTENCE.findall(text)) / n, float(ends[-1]), float(lines[0].lstrip("\"”“ ")[:1].isupper()), n / k, bare / k,
        sum(1 for t in tokens if _VALUE.fullmatch(t)) / n, odd / solid, run / solid,
    ]


def _needs_folding(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _MARKS.search(text) is not None
    return "\r" in text or "\u00a0" in text or "\x85" in text or "\x0b" in text or "\x0c" in text


def weak_label(s: dict[str, float]) -> str | None:
    """A label where a rule is sure, else None."""
    if s["n_words"] == 0:
        return None
    if s["letter_ratio"] < 0.35 and s["value_words"] < 0.3 and s["column_lines"] < 0.5 or s["vowelless_words"] > 0.6 and s["n_words"] > 3:
        return "junk"
    if s["odd_characters"] > 0.15 or s["run_characters"] > 0.25 or s["single_characters"] > 0.7 and s["n_words"] > 5 or s["unique_words"] < 0.25 and s["n_words"] > 7:
        return "junk"
    if s["digit_ratio"] > 0.8 and s["n_words"] > 5 and s["n_lines"] == 1:
        return "junk"
    if s["common_words"] > 0.08 and s["sentence_ends"] > 0 and s["column_lines"] < 0.4 and s["bullet_lines"] < 0.4:
        return "prose"
    if s["sentence_ends"] or s["common_words"] > 0.05:
        return None
    if s["n_lines"] > 1 and s["column_lines"] > 0.75:
        return "table"
    if s["n_lines"] > 1 and s["bullet_lines"] > 0.75 and s["column_lines"] < 0.3:
        return "list"
    if s["separator_ratio"] > 0.3 and s["n_lines"] == 1 or s["bare_short_lines"] > 0.9 and s["n_lines"] > 2 and s["column_lines"] < 0.1:
        return "list"
    return None


def fit_model(sample: list[tuple[str, str | None]], common: Collection[str]) -> BoostedTrees:
    """Trees fitted on (text, given label or None) and calibrated on the holdout, whose texts take no part in the fitting.

    A form without examples in the sample is never found.
    """
    x, y, kept = [], [], {t for _, t in HOLDOUT}
    for text, given in sample:
        if text in kept:
            continue
        stats = text_statistics(text, common)
        got = given or weak_label(dict(zip(STATS, stats)))
        if got:
            x.append(stats)
            y.append(FORMS.index(got))
    return BoostedTrees().fit(np.array(x).reshape(-1, len(STATS)), np.array(y, dtype=int), len(FORMS)).calibrate(*held_out(common))


def held_out(common: Collection[str]) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and forms of the holdout."""
    return np.array([text_statistics(t, common) for _, t in HOLDOUT]), np.array([FORMS.index(f) for f, _ in HOLDOUT])


def calibration_report(model: BoostedTrees, common: Collection[str], seed: int = 11) -> list[tuple[int, int, float, float, float]]:
    """(fold, texts, share right, mean probability of the verdict, their difference) of each half of the holdout, calibrated on the other half."""
    x, y = held_out(common)
    halves = np.random.default_rng(seed).permutation(len(y)) % 2
    out = []
    for fold in (0, 1):
        test = halves == fold
        p = copy(model).calibrate(x[~test], y[~test]).probabilities(x[test])
        right, sure = float((p.argmax(1) == y[test]).mean()), float(p.max(1).mean())
        out.append((fold, int(test.sum()), right, sure, abs(right - sure)))
    return out


def training_sample(texts: DataFrame, id_col: str, text_col: str, structured: dict[str, DataFrame], bound: int) -> list[tuple[str, str | None]]:
    """At most `bound` running texts, chosen by a hash of their id, and a quarter as many of each structured form (its text is column `text`)."""
    chosen = texts.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.lit(17)).alias("h"))
    rows: list[tuple[str, str | None]] = [(t, None) for t in _least_hashes(chosen, bound)]
    for form, df in structured.items():
        rows += [(t, form) for t in _least_hashes(df.select("text", F.xxhash64("text", F.lit(17)).alias("h")), bound // 4)]
    return rows


def _least_hashes(df: DataFrame, bound: int) -> list[str]:
    """The texts with the `bound` least hashes `h`. Rows whose hash can't be among them stay where they are: the driver gets about 1.5 times the bound from all tasks together."""
    n = df.count()
    if n > bound:
        df = df.filter(F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) < min(1.0, 1.5 * bound / n))
    return [r["text"] for r in df.orderBy(F.shiftrightunsigned("h", 11), "text").limit(bound).collect()]


def structured_texts(items: Column, rows: Column, df: DataFrame) -> dict[str, DataFrame]:
    """Texts as lists and tables would stand if they had been read as running text."""
    listed = df.filter(F.size(items) > 2).select(F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n").alias("text"))
    tables = df.filter(F.size(rows) > 2).select(F.array_join(F.transform(F.filter(rows, lambda r: F.size(r) > 1), lambda r: F.array_join(r, "\t", "–")), "\n").alias("text"))
    return {"list": listed.filter(F.length("text") > 0), "table": tables.filter(F.length("text") > 0)}


def form_probabilities(model: BoostedTrees, stats: np.ndarray) -> np.ndarray:
    """Calibrated probabilities of FORMS; a text without words is junk."""
    p = model.probabilities(stats)
    p[stats[:, 1] == 0] = [f == "junk" for f in FORMS]
    return p


def forms_of(model: BoostedTrees, stats: np.ndarray) -> list[str]:
    return [FORMS[i] for i in form_probabilities(model, stats).argmax(1)]


def judge_texts(df: DataFrame, id_col: str, text_col: str, model: BoostedTrees, common: Collection[str], with_stats: bool = True) -> DataFrame:
    """(id, statistics.., form, p_prose..) of each text that isn't null.

    Cases: a null text has no row; an empty or blank one has zero statistics and the form junk (it has no content); repeated
    rows each get a row; very long texts are read whole; other columns of df are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast((model, frozenset(common)))
    probabilities = [f"p_{f}" for f in FORMS]
    kept = [*STATS, *probabilities] if with_stats else []

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, common = shared.value
        for batch in batches:
            stats = np.array([text_statistics(t, common) for t in batch["text"]]).reshape(-1, len(STATS))
            p = form_probabilities(model, stats)
            out = pd.DataFrame({"id": batch["id"], "form": np.array(FORMS)[p.argmax(1)]})
            if with_stats:
                out[list(STATS)], out[probabilities] = stats, p
            yield out

    source = df.filter(F.col(f"`{text_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = df.schema[id_col].dataType.simpleString()
    return source.mapInPandas(judge, ", ".join([f"id {id_type}", "form string", *[f"{c} double" for c in kept]]))
