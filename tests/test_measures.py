from conftest import rows

from tallyloom.operators import measures


def frame(spark, data):
    return spark.createDataFrame([("c", u, v) for u, values in data.items() for v in values], "c string, u string, v double")


def test_extremes(spark):
    df = frame(spark, {
        "high": [1.0, 10.0, 40.0, 40.0],       # 400% of the next value: both copies go
        "not high": [1.0, 10.0, 39.0],
        "low": [-100.0, -20.0, 5.0],           # 500% of the next value
        "single": [7.0, 7.0],
        "zero next": [0.0, 5.0],
        "nulls": [None, 1.0, 9.0],
        "both": [-50.0, -10.0, 1.0, 8.0],
    })
    kept = {u: sorted((r.v for r in measures.drop_extremes(df, ["c", "u"], "v").collect() if r.u == u), key=lambda v: (v is not None, v))
            for u in ("high", "not high", "low", "single", "zero next", "nulls", "both")}
    assert kept == {
        "high": [1.0, 10.0], "not high": [1.0, 10.0, 39.0], "low": [-20.0, 5.0], "single": [7.0, 7.0],
        "zero next": [0.0, 5.0], "nulls": [None, 1.0], "both": [-10.0, 1.0]}


def test_clean_measure(spark):
    df = spark.createDataFrame(
        [(1.0, 1, "mg/dl"), (None, 1, "mg/dl"), (2.0, None, "mg/dl"), (3.0, 1, "no value"), (4.0, 2, "Percent"), (5.0, 3, "g")],
        "v double, uid int, u string")
    kept = measures.clean_measure(df, "v", "uid", "u", ["no matching concept", "no value"], {"mg/dl": "milligram per deciliter", "Percent": "percent"})
    assert rows(kept) == [(1.0, 1, "milligram per deciliter"), (4.0, 2, "percent"), (5.0, 3, "g")]


def test_harmonise_then_trim(spark):
    df = spark.createDataFrame(
        [("hct", "a", 10.0, 1), ("hct", "b", 10.0, 1), ("hct", "?", 10.0, 1), ("hct", "a", 10_000_000.0, 1), ("hct", "a", 3.0, 9)],
        "lab string, u string, v double, site int")
    factors = spark.createDataFrame([("a", 1.0, "std"), ("b", 100.0, "std")], "u string, factor double, standard_unit string")
    done = measures.harmonise(df, factors, ["u"], "v", "u")
    assert ("hct", 1000.0, "std", 10.0, "b", True) in rows(done.select("lab", "v", "u", "raw_v", "raw_u", "harmonised"))
    bounds = spark.createDataFrame([("hct", 0.0, 50.0)], "lab string, minimum double, maximum double")
    kept = measures.trim(done, bounds, "lab", "v", site="site", drop_sites=[9])
    assert rows(kept.select("v", "harmonised")) == [(10.0, False), (10.0, True)]
    wider = measures.trim(done, bounds, "lab", "v", {"hct": (None, 1000.0)})
    assert sorted(r.v for r in wider.collect()) == [3.0, 10.0, 10.0, 1000.0]


def test_value_quality_is_over_distinct_values(spark):
    df = frame(spark, {"u": [1.0, 1.0, 1.0, 3.0, None], "w": [None]})
    (row,) = measures.value_quality(df, ["c", "u"], "v").collect()
    assert (row.n, row["mean"], row.q50) == (2, 2.0, 2.0)
    presence = df.selectExpr("1 AS p", "*")
    assert rows(measures.value_presence(presence, "p", ["c", "u"], "v")) == [
        ("c", "u", "has value", 1), ("c", "u", "no value", 1), ("c", "w", "no value", 1)]
