from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import history


def records(spark):
    data = [
        (1, "Drug", "s", "2010-01-01 08:00:00", "2010-01-01 20:00:00"),
        (1, "Drug", "s", "2011-03-01 00:00:00", "2012-01-01 12:00:00"),
        (1, "Visit", "s", "2009-05-05 00:00:00", None),
        (2, "Drug", "s", "2010-06-01 00:00:00", "2010-06-01 00:00:00"),
        (2, "Drug", "s", "2012-06-01 00:00:00", "2010-01-01 00:00:00"),
    ]
    return spark.createDataFrame(data, "p long, domain string, site string, a string, b string").selectExpr(
        "p", "domain", "site", "to_timestamp(a) AS start", "to_timestamp(b) AS `end`")


def test_open_end_takes_the_cutoff(spark):
    cutoff = spark.createDataFrame([("2020-01-01",)], "d string").selectExpr("to_timestamp(d)").scalar()
    spans = history.periods(records(spark), "p", ["domain", "site"], "start", "end", cutoff, "Any EHR")
    ends = {(r.p, r.domain, str(r.start)): str(r["end"]) for r in spans.collect()}
    assert ends[(1, "Visit", "2009-05-05 00:00:00")] == "2020-01-01 00:00:00"
    assert sum(d == "Any EHR" for _, d, _ in ends) == 3 and len(ends) == 6


def test_years_of_data(spark):
    spans = records(spark).filter("end IS NOT NULL")
    years = {(r.p, r.domain): r.years for r in history.years_of_data(spans, "p", "domain").collect()}
    assert years == {(1, "Drug"): 730 / 365, (2, "Drug"): 1 / 365}
    reverse = spans.filter("p = 2 AND year(start) = 2012")
    assert [r.years for r in history.years_of_data(reverse, "p", "domain").collect()] == [882 / 365]
    stats = history.years_stats(history.years_of_data(spans, "p", "domain"), "domain").collect()
    assert [(r.domain, r.n, r["mean"], r.median) for r in stats] == [("Drug", 2, 1.0, 1.0)]


def test_years_without_newcomers_stay(spark):
    df = records(spark).withColumn("year", F.year("start"))
    series = rows(history.cumulative_entities(df, "p", "domain", "year", 4, "Any").select("domain", "year", "n_new", "cum_n", "cum_pct"))
    assert series == [
        ("Any", 2009, 1, 1, 25.0), ("Any", 2010, 1, 2, 50.0), ("Any", 2011, 0, 2, 50.0), ("Any", 2012, 0, 2, 50.0),
        ("Drug", 2010, 2, 2, 50.0), ("Drug", 2011, 0, 2, 50.0), ("Drug", 2012, 0, 2, 50.0), ("Visit", 2009, 1, 1, 25.0)]


def test_first_seen(spark):
    assert rows(history.first_seen(records(spark), "p", "domain", "start", "Any")) == [
        (1, "Any", 2009), (1, "Drug", 2010), (1, "Visit", 2009), (2, "Any", 2010), (2, "Drug", 2010)]
