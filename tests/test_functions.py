import random

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from tallyloom import functions as fn


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_title_case_is_str_title(spark):
    texts = ["less 10k", "X-RAY o'b", "one through four", "a1b2 c", "not man only, not woman", "", "ÉCOLE d'été", "10k 25k"]
    assert apply(spark, texts, "string", fn.title_case) == [t.title() for t in texts]


def test_percent_text_is_python_format(spark):
    random.seed(3)
    ratios = [a / b for b in (7, 64, 800, 2000, 12345, 20000) for a in random.sample(range(b + 1), min(b, 60))]
    ratios += [0.0, 1.0, 0.00125, 0.01015, 0.010049999, 1e-9, 0.125, 0.5]
    for digits in (0, 1, 2):
        assert apply(spark, ratios, "double", lambda c: fn.pct_text(c, digits)) == [f"{r:.{digits}%}" for r in ratios]


def test_answer_text(spark):
    answers = ["Stem: value", "no stem", "A: b: c", None, ": x"]
    assert apply(spark, answers, "string", fn.answer_text) == ["value", "", "bc", None, "x"]
    assert apply(spark, answers, "string", fn.after_stem) == ["value", "no stem", "b", None, "x"]


def test_clean_answer_folds_before_it_names(spark):
    answers = ["sex none of these", "prefer not to answer", None, "nhpi", "less 10k"]
    cleaned = apply(
        spark, answers, "string",
        lambda c: fn.clean_answer(c, refused=["prefer not to answer"], names={"Nhpi": "NHPI (long)"}),
    )
    assert cleaned == ["None Of These", "Not Specified", "Not Specified", "NHPI (long)", "Less 10K"]


def test_bands_are_right_closed(spark):
    labels = ["18-29", "30-39", "90+"]
    ages = [0, 17, 18, 29, 30, 39, 40, 200, None, -1]
    assert apply(spark, ages, "int", lambda c: fn.band(c, [0, 29, 39], labels)) == [
        "18-29", "18-29", "18-29", "18-29", "30-39", "30-39", "90+", "90+", None, None]
    assert apply(spark, ages, "int", lambda c: fn.band(c, [18, 29, 39], labels)) == [
        None, None, "18-29", "18-29", "30-39", "30-39", "90+", "90+", None, None]
    assert apply(spark, ages, "int", lambda c: fn.band(c, [18, 29, 39], labels, below="first"))[:2] == ["18-29", "18-29"]


def test_suppression(spark):
    assert apply(spark, [0, 1, 19, 20, 1234], "bigint", fn.suppress_cell) == ["-", "<20", "<20", "20", "1234"]
    cells = ["-", "0 (0.00%)", "19 (1.20%)", "20 (1.30%)", "1,234 (5.60%)", "<20", "<20 (-)"]
    once = apply(spark, cells, "string", fn.suppress_cell)
    assert once == ["-", "-", "<20", "20 (1.30%)", "1,234 (5.60%)", "<20", "<20 (-)"]
    assert apply(spark, once, "string", fn.suppress_cell) == once
    counts = column(spark, [0, 19, 20, 1234], "bigint").select(fn.suppressed_count_pct(F.col("v"), F.col("v") / 4000).alias("r"))
    assert rows(counts) == [("1,234 (31%)",), ("20 (<1%)",), ("<20 (-)",), ("<20 (-)",)]


def test_split_undoes_count_pct(spark):
    values = [20, 21, 999, 1000, 1234567]
    df = column(spark, values, "bigint").withColumn("cell", fn.count_pct(F.col("v"), F.col("v") / 5_000_000))
    back = df.withColumn("s", fn.split_count_pct(F.col("cell"))).select("v", "s.count", "s.pct").collect()
    assert all(r.v == r["count"] and abs(r.pct - r.v / 50_000) <= 0.005 for r in back)
    assert apply(spark, ["<20 (-)", "<20"], "string", fn.split_count_pct) == [(20, None), (20, None)]


def test_rounding_is_numpy_rounding(spark):
    values = [0.5, 1.5, 2.5, 2.675, 0.125, 2.345, 1.005, -0.5, -2.675]
    for digits in (0, 2):
        assert apply(spark, values, "double", lambda c: fn.round_half_even(c, digits)) == np.round(values, digits).tolist()


def test_number_text(spark):
    assert apply(spark, [5.0, 5.25, -3.0, 0.1], "double", fn.number_text) == ["5", "5.25", "-3", "0.1"]


def test_recode_keeps_the_rest(spark):
    assert apply(spark, ["a", "b", None], "string", lambda c: fn.recode(c, {"a": "x"})) == ["x", "b", None]
    assert apply(spark, ["WhatX_A", "PMI_WhatX_"], "string", lambda c: fn.strip_parts(c, ["WhatX_", "PMI_"])) == ["A", ""]


def test_yes_no_treats_unknown_as_no(spark):
    assert apply(spark, [1, None, 30], "int", lambda c: fn.yes_no(c > 18)) == ["no", "no", "yes"]
