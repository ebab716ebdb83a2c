"""One consistent form for text that looks alike and differs in its characters.

Look-alike pairs over all code points (full-width, mathematical and plain forms, composed letters and letter plus accent,
spaces, invisible characters and nothing, letters of two alphabets) are joined by union-find into classes; the member most
frequent in the corpus represents its class, and a multi-pattern automaton rewrites every other member, the longest first.
Letters of another alphabet are rewritten only inside words that also hold Latin letters; words wholly in another alphabet
stay. Which letters look alike comes from the public confusables data in the JVM's Unicode library, besides some fixed pairs;
a letter that looks like no Latin one takes the first letter of its name.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Collection, Iterator, Mapping
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed values: letters of the Cyrillic and Greek alphabets with the Latin letter of the same shape
LETTER_PAIRS = (
    "аa вb еe кk мm нh оo рp сc тt уy хx ѕs іi јj һh ԁd ԛq ԝw гr пn иu лn ѵv ьb ӏl ґr "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ Ԁd ԚQ ԜW Ѵv Ӏl "
    "αa βß γy εe ηn ιi κk νv οo ρp τt υu χx ωw ϲc ϳj σo "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC Ϳj"
).split()
#: Java pattern of texts that can hold a case at all; everything else never leaves the JVM
SUSPECT = r"[\p{Mn}\p{Me}\p{Cf}＀-￯]|[\p{Zs}&&[^ ]]|[\p{L}&&[^\p{IsLatin}]]"
#: blocks without look-alike forms: ideographs, syllables, private use and unassigned planes
_PLAIN_BLOCKS = ((0x3400, 0xF900), (0x13000, 0x16800), (0x17000, 0x1B000), (0x20000, 0xE0000), (0xE0200, 0x110000))
_UNSPACED = ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "BOPOMOFO", "MICRO", "FEMININE", "MASCULINE", "MODIFIER", "HALFWIDTH")


@lru_cache(maxsize=None)
def kind_of(ch: str) -> str:
    """latin, other (a letter of another alphabet), wide, mark, zero, space or plain."""
    code, cat = ord(ch), unicodedata.category(ch)
    if code < 128:
        return "latin" if ch.isalpha() else "plain"
    if unicodedata.decomposition(ch).startswith(("<wide>", "<narrow>", "<font>")) and (cat[0] != "S" or code >= 0xFF00):
        return "space" if ch == "　" else "wide"
    if cat in ("Mn", "Me"):
        return "mark"
    if cat == "Cf" or code in (0x115F, 0x1160, 0x3164, 0xFFA0):
        return "zero"
    if cat == "Zs":
        return "space"
    if cat.startswith("L"):
        name = unicodedata.name(ch, "")
        return "latin" if name.startswith("LATIN") or name.startswith(_UNSPACED) else "other"
    return "plain"


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return out


def code_points() -> Iterator[str]:
    start = 0x80
    for a, b in (*_PLAIN_BLOCKS, (0x110000, 0x110000)):
        yield from map(chr, range(start, a))
        start = b


def look_alikes(shapes: Mapping[str, str] | None = None) -> tuple[Classes, Classes]:
    """Classes of forms that are always rewritten, and, built on them, classes that also join letters of different alphabets.

    `shapes` gives more letters of other alphabets with what they look like.
    """
    always, letters = Classes(), Classes()
    for ch in code_points():
        cat, parts = unicodedata.category(ch), unicodedata.decomposition(ch)
        if not parts and cat not in ("Cf", "Zs") and cat[0] != "L":
            continue
        kind = kind_of(ch)
        if kind == "wide":
            always.union(ch, unicodedata.normalize("NFKC", ch))
        elif kind == "zero":
            always.union(ch, "")
        elif kind == "space":
            always.union(ch, " ")
        elif kind in ("latin", "other") and parts and parts[0] != "<":
            apart, composed = unicodedata.normalize("NFD", ch), unicodedata.normalize("NFC", ch)
            always.union(ch, apart)
            always.union(ch, composed)
            if len(apart) > 2:  # an accent upon a composed letter
                always.union(ch, unicodedata.normalize("NFC", apart[:-1]) + apart[-1])
    for x in list(always.parent):
        letters.union(x, always.find(x))
    for a, b in LETTER_PAIRS:
        letters.union(a, b)
    fixed = {a for a, _ in LETTER_PAIRS}
    for a, b in (shapes or {}).items():
        if a not in fixed and len(b) == 1 and kind_of(b) == "latin" and kind_of(a) == "other":
            letters.union(a, b)
    return always, letters


def confusable_shapes(spark: SparkSession) -> dict[str, str]:
    """Letters of other alphabets with the letter of the same shape, by the confusables data of the JVM's Unicode library."""
    others = [ch for ch in code_points() if unicodedata.category(ch)[0] == "L" and kind_of(ch) == "other"]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    alike = checker.getSkeleton("\n".join(others)).split("\n")
    return {a: b for a, b in zip(others, alike) if a != b}


@lru_cache(maxsize=None)
def by_name(ch: str) -> str:
    """The first letter of a letter's name, as its Latin form."""
    first = re.search(r"(?:LETTER|SIGN|SYLLABLE) (?:FINAL |YIDDISH |SHORT )?([A-Z])", unicodedata.name(ch, "")) or re.search(r"\b([A-Z])\w*$", unicodedata.name(ch, "X"))
    return first[1] if ch.isupper() else first[1].lower()


def corpus_forms(texts: DataFrame, column: str, wanted: Collection[str]) -> dict[str, int]:
    """Occurrences of the wanted forms, characters or pairs of a character and an accent (their number bounds what reaches the driver), over all rows of a text column.

    Words are counted first, so that characters are only taken apart once for each distinct word.
    """
    spark = texts.sparkSession
    words = texts.select(F.explode(F.split(F.col(f"`{column}`"), " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    forms = words.select("n", F.explode(F.flatten(F.array(F.regexp_extract_all("word", F.lit("(?s)."), F.lit(0)), F.regexp_extract_all("word", F.lit(r"(?s).\p{M}"), F.lit(0))))).alias("form"))
    counted = forms.groupBy("form").agg(F.sum("n").alias("n"))
    rows = counted.join(F.broadcast(spark.createDataFrame([(x,) for x in wanted], "form string")), "form", "left_semi").collect()
    found = {r["form"]: r["n"] for r in rows}
    if " " in wanted:  # words were split at them
        found[" "] = texts.select(F.sum(F.length(F.col(f"`{column}`")) - F.length(F.replace(F.col(f"`{column}`"), F.lit(" "), F.lit(""))))).first()[0] or 0
    return found


def representatives(classes: Classes, counts: dict[str, int]) -> dict[str, str]:
    """member -> representative, for members that aren't their class's most frequent form. Nothing represents invisible characters; ties go to the lower code."""
    out = {}
    for members in classes.members().values():
        best = "" if "" in members else min(members, key=lambda x: (-counts.get(x, 0), kind_of(x[0]) not in ("latin", "plain") or len(x) > 1, x))
        out.update((x, best) for x in members if x != best)
    return out


class Rewriter:
    """Greedy rewriting of look-alike forms."""

    def __init__(self, always: dict[str, str], letters: dict[str, str]):
        self.always, self.letters = always, letters
        self.automaton = ahocorasick.Automaton()
        for form, to in always.items():
            if form:
                self.automaton.add_word(form, (len(form), to))
        self.automaton.make_automaton()

    def forms(self, text: str) -> str:
        while True:
            out, last = [], 0
            for end, (size, to) in self.automaton.iter_long(text):
                out += [text[last : end + 1 - size], to]
                last = end + 1
            if not last:
                return text
            rewritten = "".join(out) + text[last:]
            if rewritten == text:
                return text
            text = rewritten

    def __call__(self, text: str) -> tuple[str, list[str]]:
        """(the text in its one form, the kinds of characters that needed it)."""
        kinds = {kind_of(ch) for ch in set(text)} & {"wide", "mark", "zero", "space"}
        plain = self.forms(text) if kinds else text
        if "mark" in kinds:  # accents that no composed letter takes
            plain = "".join(ch for ch in plain if kind_of(ch) != "mark")
        mixed = False

        def word(m: re.Match) -> str:
            nonlocal mixed
            w = m[0]
            found = {kind_of(ch) for ch in w}
            if not {"latin", "other"} <= found:
                return w
            mixed = True
            return "".join(self.letters.get(ch) or by_name(ch) if kind_of(ch) == "other" else ch for ch in w)

        plain = re.sub(r"[^\W\d_]+", word, plain)
        return plain, sorted(kinds | ({"mixed"} if mixed else set()))


def rewriter_for(texts: DataFrame, column: str) -> Rewriter:
    always, letters = look_alikes(confusable_shapes(texts.sparkSession))
    counts = corpus_forms(texts, column, set(always.parent) | set(letters.parent))
    # a letter's class may hold several letters of its own alphabet; what it is rewritten to must be Latin
    to = {}
    for members in letters.members().values():
        latin = [x for x in members if len(x) == 1 and kind_of(x) == "latin"]
        if latin:
            best = min(latin, key=lambda x: (-counts.get(x, 0), x))
            to.update((x, best) for x in members if len(x) == 1 and kind_of(x) == "other")
    return Rewriter(representatives(always, counts), to)


def normalise(df: DataFrame, id_col: str, fields: dict[str, Column], corpus: DataFrame, corpus_col: str) -> DataFrame:
    """(id, field, parts, plain, kinds) of each field that rewriting changes, with the kinds of characters that needed it.

    `fields` names array<string> columns (a plain text is an array of one). `corpus` gives the texts whose counts choose the
    representatives. Cases: null fields, null parts and empty texts need nothing; repeated ids give a row each; texts without
    a suspect character are left in the JVM; tabs and line breaks are no cases; an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(rewriter_rules(rewriter_for(corpus, corpus_col)))
    id_type = df.schema[id_col].dataType.simpleString()
    suspect = [F.when(F.exists(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.coalesce(x.rlike(SUSPECT), F.lit(False))), F.struct(F.lit(name).alias("field"), c.alias("parts"))) for name, c in fields.items()]
    cases = df.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.array_compact(F.array(*suspect))).alias("c")).select("id", "c.field", "c.parts")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rewriter = Rewriter(*shared.value)
        for batch in batches:
            rows = []
            for ident, field, parts in zip(batch["id"].astype(object), batch["field"], batch["parts"]):
                done = [rewriter(p) if p is not None else (None, []) for p in parts]
                kinds = sorted({k for _, ks in done for k in ks})
                if any(p != part for (p, _), part in zip(done, parts)):
                    rows.append((None if pd.isna(ident) else ident, field, list(parts), [p for p, _ in done], kinds))
            yield pd.DataFrame(rows, columns=["id", "field", "parts", "plain", "kinds"])

    return cases.mapInPandas(rewrite, f"id {id_type}, field string, parts array<string>, plain array<string>, kinds array<string>")


def rewriter_rules(rewriter: Rewriter) -> tuple[dict[str, str], dict[str, str]]:
    """What an executor needs to build the rewriter again."""
    return rewriter.always, rewriter.letters
