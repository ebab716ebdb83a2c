import numpy as np
import pytest

from kvarto.llm.boost import BoostedTrees
from kvarto.llm.holdout import HOLDOUT
from kvarto.llm.quality import FORMS, STATS, calibration_report, fit_model, forms_of, judge_texts, text_statistics, training_sample, weak_label

from written import WRITTEN

COMMON = frozenset("och i att det som en på är av för med till den har de inte om ett men var sig från kan när under där vid över två mer går igen innan måste".split())


def stats(text):
    return dict(zip(STATS, text_statistics(text, COMMON)))


def test_statistics():
    s = stats("Den gamla häxan ser en bok.\n- punkt\nX\t12\tY")
    assert s["n_words"] == 11 and s["n_lines"] == 3 and s["punctuated_lines"] == pytest.approx(1 / 3) and s["bullet_lines"] == pytest.approx(1 / 3) and s["column_lines"] == pytest.approx(1 / 3)
    assert s["common_words"] == pytest.approx(2 / 9)
    assert stats("")["n_words"] == 0 and stats(" \n ")["n_chars"] == 3 and stats("")["mean_word_length"] == 0
    assert stats("ｄｅｎ")["common_words"] == 1


def test_boosting_learns_and_is_deterministic():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 4))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)
    a = BoostedTrees().fit(x[:400], y[:400], 3)
    b = BoostedTrees().fit(x[:400], y[:400], 3)
    assert (a.scores(x) == b.scores(x)).all()
    assert (a.scores(x[400:]).argmax(1) == y[400:]).mean() > 0.93
    a.calibrate(x[400:500], y[400:500])
    p = a.probabilities(x[500:])
    assert np.allclose(p.sum(1), 1)
    assert -np.log(p[np.arange(100), y[500:]]).mean() < 0.5


@pytest.fixture(scope="module")
def model():
    return fit_model([(t, f) for f, t in WRITTEN] * 3, COMMON)


def test_held_out_accuracy(model):
    new = [
        ("prose", "Varken prästen eller tjuven vågar öppna den mörka kistan. När natten faller går de igen."),
        ("prose", "Om vakten ser en lykta måste den som har nyckeln vänta vid porten till gården."+" Det är inte mer än två steg dit."),
        ("list", "- bro\n- mossig sten, 2 st\n- båt\n- åra"),
        ("table", "Bro\t12\t4T6\nBåt\t9\t–\nÅra\t1\t1T4"),
        ("table", "| Bro | 12 |\n| Båt | – |\n| Åra | 1T4 |"),
        ("junk", "zzkrv mnbt xprl qqst vbnm krtp ssdf"),
        ("junk", "■■□ ▪▪¿ □□ ^^ ■▪ ¿¿ ▯▯"),
        ("junk", "stol stol stol stol stol stol stol stol stol stol"),
    ]
    got = forms_of(model, np.array([text_statistics(t, COMMON) for _, t in new]))
    assert sum(g == f for g, (f, _) in zip(got, new)) >= len(new) - 1
    own = forms_of(model, np.array([text_statistics(t, COMMON) for _, t in HOLDOUT]))
    assert np.mean([g == f for g, (f, _) in zip(own, HOLDOUT)]) > 0.9


def test_holdout_takes_no_part_in_fitting(model):
    again = fit_model([(t, f) for f, t in WRITTEN] * 3 + [(t, "junk") for _, t in HOLDOUT], COMMON)
    x = np.array([text_statistics(t, COMMON) for _, t in WRITTEN])
    assert (again.scores(x) == model.scores(x)).all()
    report = calibration_report(model, COMMON)
    assert sum(r[1] for r in report) == len(HOLDOUT) and all(r[2] > 0.8 and r[4] < 0.2 for r in report)


def test_a_form_without_examples_is_never_found():
    none = fit_model([], COMMON)
    assert none.probabilities(np.zeros((2, len(STATS)))).shape == (2, len(FORMS))
    few = fit_model([(t, f) for f, t in WRITTEN if f != "junk"] * 3, COMMON)
    got = forms_of(few, np.array([text_statistics(t, COMMON) for f, t in WRITTEN if f != "junk"]))
    assert np.mean([g == f for g, f in zip(got, [f for f, _ in WRITTEN if f != "junk"])]) > 0.9


def test_weak_labels_hold_for_the_hand_checked_texts():
    labels = [(f, weak_label(stats(t))) for f, t in HOLDOUT]
    assert all(w in (None, f) for f, w in labels) and sum(w is not None for _, w in labels) > 0.6 * len(labels)


def test_table(spark, model):
    rows = [(1, "Den som går till bron måste vänta på en båt."), (1, "Den som går till bron måste vänta på en båt."), (2, None), (3, "  "), (4, "ord " * 30_000)]
    df = spark.createDataFrame(rows, "row_id long, text string").selectExpr("*", "1 AS id", "2 AS form")
    got = judge_texts(df, "row_id", "text", model, COMMON).collect()
    assert sorted((r["id"], r["form"]) for r in got if r["id"] != 4) == [(1, "prose"), (1, "prose"), (3, "junk")]
    assert all(abs(sum(r[f"p_{f}"] for f in FORMS) - 1) < 1e-6 for r in got)
    assert judge_texts(df.limit(0), "row_id", "text", model, COMMON).count() == 0
    assert len(training_sample(df, "row_id", "text", {}, 2)) == 2
