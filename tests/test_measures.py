import pytest
from pyspark.sql import functions as F

from kvarto.operators.boxes import boxes_of_bands, normalised_box, overlapping
from kvarto.operators.formulas import compile_formula


@pytest.mark.parametrize(
    "text, value", [("ceil((FYS + STO) / 2)", 6.0), ("FYS - STO * 2", -5.0), ("-FYS // 2", -4.0), ("7 // 2 + 1", 4.0), ("FYS / 0", None), ("ÖGA + 1", None), ("NULLED + 1", None), ("2 * (3 + 4) - floor(1.9)", 13.0)]
)
def test_formulas(spark, text, value):
    df = spark.createDataFrame([(7, 6, None)], "FYS int, STO int, NULLED int")
    assert df.select(compile_formula(text, {c: F.col(c) for c in df.columns})).first()[0] == (value if text != "ceil((FYS + STO) / 2)" else 7.0)


@pytest.mark.parametrize("text", ["", "1 +", "(1", "a b", "x; drop", "sqrt(4)", "__import__('os')", "1 ** 2"])
def test_other_text_is_refused(text):
    with pytest.raises(ValueError):
        compile_formula(text, {})


def test_boxes(spark):
    e = spark.createDataFrame([("b", 1, 10, [0, 1]), ("b", 1, 11, [5]), ("b", 1, 12, [])], "book string, page int, k long, bands array<int>")
    bands = spark.createDataFrame([("b", 1, 0, 0.1, 0.5, 0.2, 0.01), ("b", 1, 1, 0.1, 0.48, 0.3, 0.01)], "book string, page int, row_idx int, x double, y double, w double, h double")
    got = {r["k"]: r for r in boxes_of_bands(e, bands, "k").collect()}
    assert tuple(got[10])[1:] == (0.1, 0.48, 0.3, 0.03, 0) and got[11]["missing"] == 1 and got[11]["x"] is None
    o = overlapping(bands.withColumn("y", F.lit(0.5)).filter("row_idx < 2"), ["book", "page"], "row_idx")
    assert sorted(r[0] for r in o.collect()) == [0, 1]
    assert overlapping(bands, ["book", "page"], "row_idx").count() == 0
    assert spark.range(1).select(normalised_box(F.array(F.lit(60), F.lit(80), F.lit(120), F.lit(160)), F.lit(600), F.lit(800))).first()[0] == [0.1, 0.8, 0.1, 0.1]
