import random

import pytest
from pyspark.sql import functions as F

from kvarto.llm.scanned import (
    Confusions, Lexicon, Repairer, bag_bits, cuts, differing, edits, header_parts, header_table, is_page, learn, learn_confusions, observed, offset_table, pair_table, repair_texts, roman, sought_pieces, stored_pieces, word_counts, word_readings,
)

COMMON = {w: 100 for w in "den gamla ringen lurar någon rollpersonen till bergjägaren hamnen ligger under vatten spelledaren slår och ser sjömannen vakten inget som för person".split()} | {"SL-person": 50, "Ulgrinäs": 40}
LEXICON = frozenset({"ring", "ringen", "jägaren", "skepp", "skeppet"})
PREFIXES = frozenset({"hamn", "berg"})
PAIRS = [("i", "!"), ("ll", "u"), ("n", "u"), ("e", "c"), ("r", "i"), ("i", "|"), ("l", "i")]
CASES = [
    ("den ring-\nen", "den ringen", {"hyphen"}), ("den hamn¬\nskeppet", "den hamnskeppet", {"hyphen"}), ("en SL-\nperson ser", "en SL-person ser", set()), ("skogs-\noch bergsfolk", "skogs- och bergsfolk", set()), ("rpg-\nbok", "rpgbok", {"hyphen"}),
    ("den ri- \r\nngen ser", "den ringen ser", {"hyphen"}), ("den r!ngen lurar", "den ringen lurar", {"misread"}), ("roUpersonen", "rollpersonen", {"misread"}), ("Iuget", "Inget", {"misread"}), ("hamnskcppet", "hamnskeppet", {"misread"}), ("roUper-\nsoncn", "rollpersonen", {"hyphen", "misread"}),
    ("slår ZT8+1 och 1T6", "slår 2T8+1 och 1T6", {"misread"}), ("3T1O", "3T10", {"misread"}), ("Ulgiinäs", "Ulgrinäs", {"misread"}), ("Ulkesvik", "Ulkesvik", set()), ("SL-pcrson", "SL-person", {"misread"}),
    ("den gamla\n- 3 -\nringen", "den gamla ringen", {"page_number"}), ("den gamla\n- 4 -\nringen", "den gamla - 4 - ringen", set()), ("den\n\niii   ~ Kråkdörren ~\n\ngamla", "den gamla", {"header", "page_number"}),
    ("DEN HÖGA ASKSMEDEN\nden ringen", "den ringen", {"header"}), ("D E N   H Ö G A   A S K S M E D E N\nden", "den", {"header"}), ("den\nKapitel 3: Kråkdörren\nringen", "den ringen", {"header"}), ("den\nDen höga asksmcden\nringen", "den ringen", {"header"}),
    ("den\n~ Asklägret vid sjön ~\nringen", "den ringen", {"header"}), ("en\n\nannan", "en\n\nannan", set()), ("", "", set()), ("DEN RINGEN LURAR\nNÅGON", "DEN RINGEN LURAR NÅGON", set()), ("den ringen!", "den ringen!", set()),
    ("Den ser någon.\nVARNING FÖR VATTEN\nDen lurar.", "Den ser någon. VARNING FÖR VATTEN Den lurar.", set()), ("Den ser.\nKapitel 3: nytt\nDen lurar.", "Den ser. Kapitel 3: nytt Den lurar.", set()), ("Den ser den\nRINGEN UNDER VATTEN\ngamla ringen.", "Den ser den gamla ringen.", {"header"}),
    ("Den\nringen\n\n\nlurar\n" + "Den höga asksmeden som " * 9 + "ser\nnågon", "Den ringen\n\nlurar någon", {"header"}),
]
TEXTS = "field string, rec_id long, book string, page int, text string"


def numbered(texts):
    return [("text", i, "b", 3, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def taught(spark):
    """(texts, what they teach): the cases among common words and the book's titles."""
    rows = numbered([t for t, _, _ in CASES] + [" ".join([w] * n) for w, n in COMMON.items()])
    texts = spark.createDataFrame(rows, TEXTS)
    noise = spark.createDataFrame([("x" + read + "x", "x" + printed + "x") for printed, read in PAIRS for _ in range(1)] + [("y" + read, "y" + printed) for printed, read in PAIRS], "original string, corrected string")
    artifacts = spark.createDataFrame([("b", 1, "KRÅKDÖRREN"), (None, 1, "x"), ("b", 2, None)], "book string, page int, text string")
    titles = spark.createDataFrame([("b", "Den höga asksmeden"), ("b", "Den höga asksmeden som " * 9 + "ser"), ("b", None)], "book string, text string")
    return texts, learn(texts, noise, artifacts, titles, titles.limit(0), LEXICON, PREFIXES)


def test_repairs(taught):
    repair = Repairer([tuple(r) for r in taught[1].collect()])
    for text, repaired, kinds in CASES:
        assert repair(text, "b", 3) == (repaired, kinds), text
    assert repair("den\n17\nringen", "b", None) == ("den ringen", {"page_number"})


def test_blocks_equal_broadcast(taught):
    texts, learnt = taught
    rows = lambda **k: sorted((r["rec_id"], r["repaired"], tuple(r["kinds"])) for r in repair_texts(texts, learnt, **k).collect())
    assert rows(max_rows=0, block_rows=3) == rows()


def test_confusions_are_learnt(spark):
    assert list(differing("den rnan ser", "den man ser")) == [("m", "rn")] and list(differing("en två", "en")) == [] and list(differing("aab", "aab")) == []
    rows = [("dcn", "den"), ("cn", "en"), ("dcn", "den"), ("ord", "annat"), (None, "x"), ("x", None), ("mun", "man")]
    assert learn_confusions(spark.createDataFrame(rows, "original string, corrected string")) == [("e", "c")]
    assert learn_confusions(spark.createDataFrame([], "original string, corrected string")) == []


def test_readings_equal_direct_search(spark):
    """One and two confusions, found by joins, against trying all."""
    r = random.Random(3)
    words = {"".join(r.choice("abcdei") for _ in range(r.randint(4, 9))): r.choice([1, 2, 9, 40, 400]) for _ in range(120)}
    confusions = Confusions([("a", "b"), ("c", "e"), ("d", "i"), ("ab", "c"), ("i", "1")])
    for w in list(words)[:60]:
        for f in sorted(confusions.made(w))[:3]:
            words.setdefault(f, 1)
            for g in sorted(confusions.made(f))[:1]:
                words.setdefault(g, 1)
    plain = {w: n for w, n in words.items() if w.isalpha()}
    lexicon = Lexicon(frozenset(list(plain)[:10]), frozenset({"ab"}))

    def direct(word):
        if lexicon.composes(word):
            return None
        odd, own = any(c.isdigit() for c in word), max(1, plain.get(word, 0))
        found = [(3, plain[f], f) for f in confusions.undone(word) if f in plain and (odd or plain[f] >= 8 * own)]
        found += [(2, plain.get(f, 1), f) for f in confusions.undone(word) if len(f) > 4 and lexicon.composes(f) and own <= 2 * plain.get(f, 1)]
        # a confusion is undone in the word, and made in the reading
        mids = confusions.undone(word)
        found += [(1, n, w) for w, n in plain.items() if n > 2 and len(w) > 3 and w != word and mids & confusions.made(w) and (odd or n >= 30 * own and len(word) > 6 and set(word) & set("aei"))]
        return max(found)[2] if found else None

    asked = spark.createDataFrame([(w,) for w in words], "word string")
    counts = spark.createDataFrame([(w, n, n) for w, n in plain.items()], "word string, n long, small long")
    got = {r["word"]: r["reading"] for r in word_readings(asked, counts, spark.sparkContext.broadcast(lexicon), confusions).collect()}
    assert got == {w: direct(w) for w in words} and sum(v is not None for v in got.values()) > 60


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, last[j + 1] + 1, last[j] + (x != y)))
    return row[-1]


def test_pieces_find_every_key_within_the_edits():
    r = random.Random(6)
    for size, most in ((12, 2), (70, 8), (24, 3)):
        for _ in range(150):
            key = "".join(r.choice("abcdefgh") for _ in range(r.randint(size - 6, size)))
            line = list(key)
            for _ in range(r.randint(0, most)):
                at = r.randrange(len(line))
                line[at : at + 1] = r.choice(["", "aa", "b"])
            line = "".join(line)
            if len(line) >= 6 and _distance(line, key) <= edits(len(line)):
                assert set(stored_pieces(key)) & set(sought_pieces(line, {len(key)}))
    assert [b - a for a, b in cuts(10, 2)] == [3, 3, 4]


def test_headers_by_repetition(spark):
    """Seeds exactly and within edits, lines that only texts repeat, forms that differ each time; nothing on one page alone."""
    texts = [
        ("text", 1, "b", 1, "ASKPÄRMEN\nden gamla"), ("text", 2, "b", 2, "den gamla\nASKPÄRMFN"), ("text", 3, "b", 5, "den\nSTORMBOKEN I REGN\nringen"), ("text", 4, "b", 6, "STORMBOKEN I REGN\nringen"), ("text", 5, "b", 6, "STORMBOKEN I REGN\nringen"),
        ("text", 6, "b", 7, "LÅNGA TITELN OM BERG\nx"), ("text", 7, "b", 8, "LÅNGA TITELN OM BEPG\nx"), ("text", 8, "b", 9, "ENSAM\nx"), ("text", 9, "b", 9, "ENSAM\nx"), ("text", 10, "c", 9, "ASKPÄRMEN\nx"), ("text", 11, None, 9, "ASKPÄRMEN\nx"),
    ]
    seeds = spark.createDataFrame([("b", "Askpärmen"), ("c", None), (None, "Askpärmen")], "book string, text string")
    got = {(r["book"], r["key"]): r["value"] for r in header_table(observed(spark.createDataFrame(texts, TEXTS)), seeds).collect()}
    # STORMBOKEN stands at the edge of a text only on page 6, and inside one on page 5
    assert got == {("b", "askpärmen"): "seed", ("b", "askpärmfn"): "seed", ("b", "långatitelnomberg"): "repeat", ("b", "långatitelnombepg"): "repeat"}


def test_no_recurring_line_is_left_out(spark):
    """All pairs within the edits: forms between the first and the last page's, longer and shorter ones, misread titles that recur; against trying all."""
    first, last, a, b = "abcdefgh" + "ijklmnop", "abcdefgh" + "yyyyyyyy", "abcdefgh" + "qrstuvxz", "abcdefgh" + "qrstuvxy"
    said = [("b", first, 1), ("b", a, 3), ("b", b, 5), ("b", last, 9), ("c", "sagornasbergtopp", 1), ("c", "xsagornasbergtop", 2), ("c", "sagornasbergtop", None), ("d", "askpärmfn", 1), ("d", "askpärmfn", 2), ("d", "runnor", 4), ("d", "ingen", 4), ("e", "ensamtorn", 1), ("e", "ensamtorm", 1)]
    seeds = [("d", "askpärmen"), ("d", "runor"), ("d", "ringen")]
    r = random.Random(8)
    for book in "fghi":
        stems = ["".join(r.choice("abcdef") for _ in range(r.choice([4, 9, 14, 15, 16, 24, 40, 70]))) for _ in range(12)]
        for _ in range(90):
            key = list(r.choice(stems))
            for _ in range(r.randint(0, 1 + len(key) // 6)):
                at = r.randrange(len(key))
                key[at : at + 1] = r.choice(["", "ab", "g"])
            if len(key) > 2:
                said.append((book, "".join(key), r.choice([None, 1, 1, 2, 3])))
        seeds += [(book, s) for s in stems[:2]]
    seeds = sorted(set(seeds))

    def direct(book, key):
        if any(c == book and _distance(key, s) <= edits(len(key)) for c, s in seeds):
            return "seed"
        return "repeat" if len({p for c, k, p in said if c == book and p and (k == key or _distance(key, k) <= edits(len(key)))}) > 1 else None

    seen = spark.createDataFrame([("line", c, k, p, 1) for c, k, p in said], "kind string, book string, key string, page int, n long")
    lines = spark.createDataFrame(seeds, "book string, text string")
    expected = {(c, k): v for c, k in {x[:2] for x in said} if (v := direct(c, k))}
    assert [expected.get(x) for x in (("b", first), ("b", a), ("b", b), ("c", "sagornasbergtop"), ("d", "askpärmfn"), ("d", "runnor"), ("d", "ingen"), ("e", "ensamtorn"))] == [None, "repeat", "repeat", "repeat", "seed", "seed", None, None]
    for crowd in (4_096, 20, 0):
        got = header_table(seen, lines, crowd).collect()
        assert {(r["book"], r["key"]): r["value"] for r in got} == expected and len(got) == len(expected)


def test_an_edit_changes_two_bits_of_a_bag():
    r = random.Random(9)
    for _ in range(500):
        key = [r.choice("abcdeåäö1") for _ in range(r.randint(3, 90))]
        other, at = key.copy(), r.randrange(len(key))
        other[at : at + 1] = r.choice(["", "ab", "g"])
        assert (bag_bits("".join(key)) ^ bag_bits("".join(other))).bit_count() <= 2 * _distance(key, other)


def test_offsets_follow_sequences(spark):
    texts = [("text", i, "b", i, f"den\n- {i + 4} -\ngamla") for i in range(1, 6)] + [("text", 9, "b", 9, "den\n77\ngamla"), ("text", 10, "c", 9, "den\n7\ngamla")]
    seen = observed(spark.createDataFrame(texts, TEXTS))
    artifacts = spark.createDataFrame([("c", 3, "sida 3"), ("c", None, "4"), (None, 3, "4"), ("b", 7, "x")], "book string, page int, text string")
    assert [tuple(r) for r in offset_table(seen, artifacts).collect()] == [("b", "4", "")]
    repair = Repairer([("offset", "b", "4", "")])
    assert repair("den\n- 6 -\ngamla", "b", 2)[1] == {"page_number"} and repair("den\n- 6 -\ngamla", "c", 2)[1] == set()


def test_pairs_follow_counts(spark):
    texts = ["ring-\nen ring-en ring-en ringen", "is-\nberg isberg", "ny-\nord", "SL-\nordet", "av-\noch till", "den¬\nna"]
    seen = observed(spark.createDataFrame(numbered(texts), TEXTS))
    lexicon = spark.sparkContext.broadcast(Lexicon(frozenset(), frozenset()))
    got = {r["key"]: r["value"] for r in pair_table(seen, word_counts(seen), lexicon).collect()}
    assert got == {"ring - en": "kept", "is - berg": "joined", "ny - ord": "joined", "SL - ordet": "kept", "av - och": "apart", "den ¬ na": "joined"}


def test_numbers_and_keys():
    assert [roman(n) for n in (4, 9, 14, 90)] == ["iv", "ix", "xiv", "xc"] and is_page("IV", 4) and not is_page("5", 4) and is_page("5", 4, [1]) and is_page("v", 4, [1])
    assert header_parts("s. 12   ~ Asklyktan ~") == ["asklyktan"] and header_parts("Pärmen – Lösa blad")[1:] == ["pärmen", "lösablad"]


def test_tables(spark, taught):
    rows = [("text", 1, "b", 3, "den r!ngen"), ("text", 1, "b", 3, "den r!ngen"), ("text", 2, None, None, "den\nringen"), ("text", 3, "b", 1, None), ("text", 4, "b", 1, "den gamla " * 20_000), ("text", 5, "b", 1, " \n\n"), ("text", 6, "b", 1, "RINGEN-\n" * 3000)]
    texts = spark.createDataFrame(rows, TEXTS).withColumns({"kinds": F.lit(1), "repaired": F.lit(2), "kind": F.lit(3), "key": F.lit(4), "n": F.lit(5)})
    none = spark.createDataFrame([], "book string, page int, text string")
    noise = spark.createDataFrame([("r!", "ri"), ("!s", "is")], "original string, corrected string")
    learnt = learn(texts, noise, none, none, none, LEXICON, PREFIXES)
    for bound in (10_000, 0):
        got = repair_texts(texts, learnt, bound).collect()
        assert sorted((r["rec_id"], tuple(r["kinds"])) for r in got if r["rec_id"] < 6) == [(1, ("misread",)), (1, ("misread",)), (2, ()), (4, ()), (5, ())]
    noisy = repair_texts(texts.filter("rec_id < 6"), learnt, skip=lambda batch: [False] * len(batch), only_noisy=True).collect()
    assert [(r["rec_id"], r["kinds"]) for r in noisy] == [(1, ["misread"])] * 2
    assert repair_texts(texts.limit(0), learnt).count() == 0 and learn(texts.limit(0), noise.limit(0), none, none, none, LEXICON, PREFIXES).count() == 0
