import random

import numpy as np
import pytest

from kvarto.llm.splitting import cohesion, depths, gaps, split_documents, split_text
from kvarto.llm.tokens import token_count, token_ends


def check(text, capacity, overlap):
    pieces = split_text(text, capacity, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for begin, end, n, _ in pieces:
        assert begin < end and n == token_count(text[begin:end]) <= capacity
    for (b1, e1, _, _), (b2, e2, _, _) in zip(pieces, pieces[1:]):
        assert b1 < b2 <= e1 < e2
        if overlap:
            assert token_count(text[b2:e1]) >= overlap - 2
        else:
            assert b2 == e1
    return pieces


TOPICS = [["sjö", "skepp", "hamn", "segel"], ["berg", "klippa", "gruva", "silver"], ["skog", "varg", "stig", "jägare"]]


def story(seed, n):
    r = random.Random(seed)
    return " ".join(f"Den {r.choice(TOPICS[i * 3 // n])}arna {r.choice(TOPICS[i * 3 // n])}erna ser {r.choice(TOPICS[i * 3 // n])}orna." for i in range(n))


@pytest.mark.parametrize("overlap", [0, 10])
def test_pieces_cover_the_text(overlap):
    for seed in range(3):
        pieces = check(story(seed, 120), 200, overlap)
        assert {p[3] for p in pieces[:-1]} == {"sentence"}


def test_texts_without_boundaries():
    check("å" * 3000, 64, 8)
    check("ord " * 1500, 100, 12)
    check("x🙂é" * 700, 50, 5)
    check("rad\r\n" * 900, 80, 10)
    assert len(split_text("kort text", 10, 2)) == 1


def test_cut_falls_at_the_change_of_topic():
    text = story(1, 90)
    change = text.index("berg")
    pieces = split_text(text, int(token_count(text) * 0.45), 0)
    assert any(abs(e - change) < 120 for _, e, _, _ in pieces)


def test_sliding_similarity_equals_direct_counting():
    text = story(2, 60)
    cuts = [p for p, _ in gaps(text)]
    got = cohesion(text, cuts, 20)
    from kvarto.llm.splitting import _WORD

    words = [(m.start(), m[0][:6].lower()) for m in _WORD.finditer(text)]
    for cut, value in zip(cuts, got):
        k = sum(1 for s, _ in words if s < cut)
        a, b = [w for _, w in words[max(0, k - 20) : k]], [w for _, w in words[k : k + 20]]
        dot = sum(a.count(w) * b.count(w) for w in set(a))
        norm = (sum(a.count(w) ** 2 for w in set(a)) * sum(b.count(w) ** 2 for w in set(b))) ** 0.5
        assert value == pytest.approx(dot / norm if norm else 0)


def test_depths():
    assert depths(np.array([0.5, 0.1, 0.6, 0.6, 0.2])).tolist() == pytest.approx([0, 0.9, 0, 0, 0.4])


def test_token_ends():
    for text in ("abc def", "åäö 🙂🙂 x", "a\r\n\nb"):
        ends = token_ends(text)
        assert ends[-1] == len(text) and list(ends) == sorted(ends)


def test_documents(spark):
    rows = [(1, story(1, 200)), (2, "kort"), (3, None), (4, ""), (1, story(1, 200))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS id", "1 AS piece")
    got = split_documents(df, "doc_id", "text", 300, 30).collect()
    assert {r["id"] for r in got} == {1} and len(got) == 2 * got[0]["pieces"]
    assert split_documents(df.limit(0), "doc_id", "text", 300, 30).count() == 0
