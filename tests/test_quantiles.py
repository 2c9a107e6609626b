import numpy as np
import pytest

from tallyloom.operators import stats
from tallyloom.operators.quantiles import describe_values, values_of

PROBS = (0.0, 0.01, 0.02, 0.25, 0.5, 0.75, 0.98, 0.99, 1.0)


def groups():
    rng = np.random.default_rng(5)
    return {
        "normal": rng.normal(size=9_000),
        "ties": rng.integers(0, 6, size=7_000).astype(float),
        "one value": np.full(3_000, 4.25),
        "tails": np.exp(rng.normal(size=5_000) * 6),
        "two clumps": np.concatenate([np.zeros(2_500), np.full(2_501, 1e9)]),
        "small": rng.normal(size=40),
        "single": np.array([3.0]),
    }


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, float(v)) for g, values in groups().items() for v in values]
    rows += [("small", None), (None, 1.0), ("only nulls", None), ("small", float("nan"))]
    return spark.createDataFrame(rows, "g string, v double").repartition(7)


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_groups_that_reach_over_partitions(spark, frame, partitions):
    """Adaptive execution is off, so that range partitions stay as many as are asked for."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.g: r for r in describe_values(values_of(frame, ["g"], "v"), ["g"], PROBS, True).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert set(got) == set(groups())
    for name, values in groups().items():
        assert np.allclose(got[name].q, np.quantile(values, PROBS), rtol=1e-12, atol=1e-12), name
        assert got[name].n == len(values) and got[name].n_distinct == len(set(values))
        assert np.isclose(got[name]["mean"], values.mean())


def test_whole_column(frame):
    values = np.concatenate([*groups().values(), [1.0]])
    (row,) = stats.describe_by(frame, [], "v", PROBS).collect()
    assert np.allclose([row[stats.quantile_name(p)] for p in PROBS], np.quantile(values, PROBS), rtol=1e-12)
    assert np.isclose(row.sd, values.std(ddof=1))


def test_box_whiskers(frame):
    got = {r.g: r for r in stats.box_stats(frame, ["g"], "v").collect()}
    for name, values in groups().items():
        q1, q3 = np.quantile(values, [0.25, 0.75])
        near = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert (got[name].whisker_low, got[name].whisker_high) == (near.min(), near.max())
    (row,) = stats.box_stats(frame, [], "v").collect()
    assert row.n == sum(map(len, groups().values())) + 1


def test_histogram_covers_all_values(frame):
    bins = stats.histogram(frame, "v", 5, ["g"]).collect()
    for name, values in groups().items():
        mine = sorted((r.bin, r.n) for r in bins if r.g == name)
        assert [b for b, _ in mine] == [1, 2, 3, 4, 5] and sum(n for _, n in mine) == len(values)
        if len(set(values)) > 1:
            assert [n for _, n in mine] == np.histogram(values, 5)[0].tolist()


def test_pretty_histogram_breaks(spark):
    values = [float(v) for v in range(0, 101)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bins = sorted((r.lo, r.hi, r.n) for r in stats.pretty_histogram(df, "v").collect())
    assert bins[0] == (0.0, 10.0, 11) and bins[-1] == (90.0, 100.0, 10) and len(bins) == 10
    both = df.selectExpr("'a' AS g", "v").unionByName(df.selectExpr("'b' AS g", "v / 1000 AS v")).unionByName(df.selectExpr("'c' AS g", "7D AS v"))
    keyed = stats.pretty_histogram(both, "v", ["g"]).collect()
    assert sorted((r.lo, r.hi, r.n) for r in keyed if r.g == "a") == bins
    assert [r.n for r in sorted((r for r in keyed if r.g == "b"), key=lambda r: r.bin)] == [n for _, _, n in bins]
    assert sum(r.n for r in keyed if r.g == "c") == 101


@pytest.mark.parametrize("low, high, first, last, n", [(0, 20, 0, 20, 10), (0, 45, 0, 45, 9), (-37, 12, -40, 15, 11), (-3, -1, -3, -1, 10)])
def test_pretty_histogram_steps(spark, low, high, first, last, n):
    df = spark.range(200).selectExpr(f"{low} + id * ({high} - ({low})) / 199D AS v")
    bins = sorted((round(r.lo, 9), round(r.hi, 9), r.n) for r in stats.pretty_histogram(df, "v").collect())
    assert (bins[0][0], bins[-1][1], len(bins), sum(b[2] for b in bins)) == (first, last, n, 200)


def test_latest_and_summary(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "mg", "2020-01-02"), (1, 7.0, "g", "2020-01-02"), (1, 9.0, "mg", "2019-01-01"), (1, None, "mg", "2018-01-01"),
         (2, 1.5, "mg", "2020-05-05"), (3, None, "mg", "2020-01-01")],
        "p long, v double, u string, d string",
    ).selectExpr("p", "v", "u", "to_timestamp(d) AS d")
    summary = {r.p: r for r in stats.entity_summary(df, "p", "v", "d", "u").collect()}
    assert summary[1].latest_value == "5, 7" and summary[1].latest_value_unit == "mg, g"
    assert (summary[1].values_count, summary[1]["mean"], summary[1].q50) == (3, 7.0, 7.0)
    assert summary[2].sd is None and 3 not in summary
    ranged = {r.p: r for r in stats.entity_range(df, "p", "v", "d", "u").collect()}
    assert (ranged[1].latest, ranged[1].units, ranged[1]["count"], ranged[1].median) == (7.0, "g, mg", 3, 7.0)


def test_spread_of_values_that_differ_in_their_last_digits(spark):
    """Large means and tiny spreads, both signs: squares must not cancel out."""
    rng = np.random.default_rng(8)
    data = {"plus": 1e9 + rng.normal(size=500) * 1e-3, "minus": -1e9 - rng.normal(size=500) * 1e-3, "near a power of two": 2.0**40 - rng.integers(0, 4000, 400) * 2.0**8}
    df = spark.createDataFrame([(g, float(v)) for g, values in data.items() for v in values], "g string, v double")
    for r in describe_values(values_of(df, ["g"], "v"), ["g"], PROBS, True).collect():
        values = data[r.g]
        assert np.isclose(r.sd, values.std(ddof=1), rtol=1e-6), r.g
        assert np.allclose(r.q, np.quantile(values, PROBS), rtol=1e-12) and r.n_distinct == len(set(values))
