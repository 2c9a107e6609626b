"""One entity, one site and one time hold a third or more of all rows; results must not change."""

import numpy as np
import pandas as pd
import pytest

from tallyloom.operators import crosstab, flags, history, measures, stats


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(9)
    n = 30_000
    person = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 400, n))
    return pd.DataFrame({
        "person": person,
        "site": np.where(rng.random(n) < 0.5, "big", np.char.add("s", rng.integers(0, 9, n).astype(str))),
        "domain": np.char.add("d", rng.integers(0, 4, n).astype(str)),
        "unit": np.where(rng.random(n) < 0.9, "mg", "g"),
        "value": np.round(rng.normal(100, 30, n), 2),
        "day": pd.to_datetime("2015-01-01") + pd.to_timedelta(rng.integers(0, 2000, n), unit="D"),
    })


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data).repartition(11)


def test_entity_summary(frame, data):
    got = stats.entity_summary(frame, "person", "value", "day", "unit").toPandas().set_index("person")
    by = data.groupby("person")["value"]
    for p, column in ((0.01, "q01"), (0.5, "q50"), (0.99, "q99")):
        assert np.allclose(got[column].sort_index(), by.quantile(p).sort_index())
    assert (got["values_count"].sort_index() == by.nunique().sort_index()).all()
    newest = data[data.day == data.groupby("person")["day"].transform("max")].sort_values(["value", "unit"])
    for person, rows in newest.groupby("person"):
        assert [float(v) for v in got.loc[person, "latest_value"].split(", ")] == rows.value.tolist()
        assert got.loc[person, "latest_value_unit"].split(", ") == rows.unit.tolist()


def test_site_statistics(frame, data):
    got = stats.describe_by(frame, ["site"], "value").toPandas().set_index("site").sort_index()
    for p in stats.REPORT_PROBS:
        assert np.allclose(got[stats.quantile_name(p)], data.groupby("site")["value"].quantile(p).sort_index())


def test_matrix_and_growth(frame, data):
    size = frame.selectExpr("count(DISTINCT person)")
    cells = {(r.row, r.col): r.n for r in crosstab.entity_matrix(frame, "person", "site", "domain", size).collect()}
    for (site, domain), rows in data.groupby(["site", "domain"]):
        assert cells[(site, domain)] == rows.person.nunique()
    assert cells[("big", "Any EHR")] == data[data.site == "big"].person.nunique()
    yearly = frame.selectExpr("person", "domain", "year(day) AS year")
    series = {(r.domain, r.year): r.cum_n for r in history.cumulative_entities(yearly, "person", "domain", "year", size, "Any").collect()}
    for year in range(2015, 2021):
        assert series[("Any", year)] == data[data.day.dt.year <= year].person.nunique()


def test_collapse_and_extremes(frame, data):
    collapsed = {r.person: r.unit for r in flags.multi_answer(frame, "person", "unit").collect()}
    expected = data.groupby("person")["unit"].agg(lambda u: u.iloc[0] if u.nunique() == 1 else "Multiple Selections").to_dict()
    assert collapsed == expected
    spoilt = frame.selectExpr("site", "value").unionByName(frame.sparkSession.createDataFrame([("big", 99_999.0)], "site string, value double"))
    clean = measures.drop_extremes(spoilt, ["site"], "value")
    kept = data.groupby("site")["value"].agg(_without_extremes)
    assert {r.site: r["count"] for r in clean.groupBy("site").count().collect()} == kept.to_dict()


def _without_extremes(values):
    low, second = sorted(set(values))[:2]
    drop_low = values.min() if abs(round(low * 100 / second)) >= 400 else None
    return int((values != drop_low).sum())
