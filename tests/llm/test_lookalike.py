import unicodedata

import pytest
from pyspark.sql import functions as F

from kvarto.llm.lookalike import Rewriter, corpus_forms, kind_of, look_alikes, normalise, representatives, rewriter_for


@pytest.fixture(scope="module")
def rewriter(spark):
    corpus = spark.createDataFrame([("den gamla åsen öppnar sin dörr 1T8 ABCDEFGHIJKLMNOPQRSTUVXYZ abcdefghijklmnopqrstuvxyzåäö",), (None,)], "t string")
    return rewriter_for(corpus, "t")


@pytest.mark.parametrize(
    "text, plain, kinds",
    [
        ("ｈａｍｎ １Ｔ８＋１", "hamn 1T8+1", ["wide"]), ("åsen öppnar", "åsen öppnar", ["mark"]), ("ben​ga﻿st", "bengast", ["zero"]), ("77 mynt　x", "77 mynt x", ["space"]),
        ("sjötrappаn", "sjötrappan", ["mixed"]), ("rοllpersοn", "rollperson", ["mixed"]), ("”Хладомир”, Βαθρον", "”Хладомир”, Βαθρον", []), ("vanlig – text … ½ ±1\tx\ny", "vanlig – text … ½ ±1\tx\ny", []),
        ("x̵", "x", ["mark"]), ("a​̊", "å", ["mark", "zero"]), ("", "", []), ("еｍ", "em", ["mixed", "wide"]),
    ],
)
def test_forms(rewriter, text, plain, kinds):
    assert rewriter(text) == (plain, kinds)
    assert rewriter(plain)[0] == plain


def test_classes_are_transitive_and_follow_the_corpus():
    always, letters = look_alikes()
    assert letters.find("а") == letters.find("a") == letters.find("ａ") == letters.find("α")
    assert representatives(always, {"ａ": 9, "a": 1})["a"] == "ａ" and representatives(always, {})["ａ"] == "a"
    assert representatives(always, {"​": 99})["​"] == ""


def test_every_decomposed_letter_is_composed(rewriter):
    for ch in "åäöéèüñçÅÄÖ":
        assert rewriter(unicodedata.normalize("NFD", ch))[0] == ch


def test_counts(spark):
    df = spark.createDataFrame([("a\u030a å  ａa",), ("🙂a\u030a 𝐀",), (None,), ("",)], "t string").withColumns({"form": F.lit(1), "word": F.lit(2), "n": F.lit(3)})
    assert corpus_forms(df, "t", {"å", "a\u030a", "ａ", "a", " ", "𝐀", "x"}) == {"å": 1, "a\u030a": 2, "ａ": 1, "a": 3, " ": 4, "𝐀": 1}
    assert corpus_forms(df.limit(0), "t", {"a"}) == {}
    assert kind_of("е") == "other" and kind_of("e") == "latin" and kind_of("本") == "latin"


@pytest.mark.parametrize("text, plain", [("svзrd", "svɜrd"), ("sօord", "soord"), ("bδk", "bẟk"), ("xλx", "xlx"), ("𝐇amn", "Hamn"), ("\u212bsen", "Åsen"), ("aשb", "asb")])
def test_every_mixed_word_reaches_one_form(rewriter, text, plain):
    assert rewriter(text)[0] == plain and rewriter(plain)[0] == plain


def test_table(spark):
    rows = [(9, "hej hej hej", None), (1, "ｈej", [["a", None], None, ["ok"]]), (1, "ｈej", None), (2, None, [["b c"]]), (3, "", []), (4, "lång " * 20_000 + "​", None)]
    df = spark.createDataFrame(rows, "row_id long, text string, rows array<array<string>>").withColumns({"field": F.lit(1), "kinds": F.lit(2)})
    cells = F.flatten(F.filter("rows", lambda r: r.isNotNull()))
    got = normalise(df, "row_id", {"text": F.array("text"), "rows": cells}, df, "text").collect()
    assert sorted((r["id"], r["field"]) for r in got) == [(1, "text"), (1, "text"), (2, "rows"), (4, "text")]
    assert normalise(df.limit(0), "row_id", {"text": F.array("text")}, df.limit(0), "text").count() == 0
    assert Rewriter({}, {})("abc") == ("abc", [])
