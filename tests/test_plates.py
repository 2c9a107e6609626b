import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import plates


def samples(spark, n=1000):
    return spark.range(n).select(
        F.col("id"), F.concat(F.lit("S"), (F.col("id") % 7).cast("string")).alias("state"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 11).cast("int")).alias("day"))


def test_rank_is_a_global_order_even_with_one_hot_key(spark):
    hot = samples(spark, 5000).withColumn("state", F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.col("state"))).repartition(13)
    ranked = plates.global_rank(hot, ["state", "day", "id"]).collect()
    expected = sorted(ranked, key=lambda r: (r.state, r.day, r.id))
    assert [r.position for r in expected] == list(range(1, 5001))


def test_every_plate_is_full_but_the_last(spark):
    plated = plates.allocate_plates(samples(spark), 94, ["state", "day", "id"])
    sizes = [r["count"] for r in plated.groupBy("plate").count().orderBy("plate").collect()]
    assert sizes == [94] * 10 + [60]
    shuffled = plates.shuffle_plates(samples(spark), 94, "id", seed=4)
    assert sorted(r.id for r in shuffled.collect()) == list(range(1000))
    assert shuffled.groupBy("plate").count().count() == 11
    again = plates.shuffle_plates(samples(spark).repartition(9), 94, "id", seed=4)
    assert rows(again.select("id", "plate")) == rows(shuffled.select("id", "plate"))
    assert rows(plates.shuffle_plates(samples(spark), 94, "id", seed=5).select("id", "plate")) != rows(shuffled.select("id", "plate"))


def test_next_batch_skips_the_earlier(spark):
    first = plates.next_batch(samples(spark), 100, "id", "day")
    second = plates.next_batch(samples(spark), 100, "id", "day", exclude=first)
    a, b = ({r.id for r in df.collect()} for df in (first, second))
    assert len(a) == len(b) == 100 and not a & b
    assert min(r.day for r in first.collect()) >= max(r.day for r in second.collect())


@pytest.mark.parametrize("n_plates", [10, 11])
def test_controls_go_on_two_plates(spark, n_plates):
    batch = samples(spark).filter("state IN ('S1', 'S2')")
    used = samples(spark).filter("id < 500")
    drawn = plates.allocate_controls(
        samples(spark), n_plates, "id", plates.seeded_order("id", 3), exclude=used, match=(batch, "state")).collect()
    assert sorted(r.plate for r in drawn) == list(range(1, 11))
    per_control = {}
    for r in drawn:
        per_control.setdefault(r.id, []).append(r.plate)
        assert r.state in ("S1", "S2") and r.id >= 500
    assert len(per_control) == 5 and all(a + b == 11 for a, b in per_control.values())


def test_single_controls(spark):
    drawn = plates.allocate_controls(samples(spark), 7, "id", plates.seeded_order("id", 3), twice=False).collect()
    assert sorted(r.plate for r in drawn) == list(range(1, 8)) and len({r.id for r in drawn}) == 7


def test_manifest_and_quality(spark):
    manifest = spark.createDataFrame([("A1", "s1"), ("A2", "s2"), ("A9", "s9"), ("POS", "s3")], "cid string, specimen string")
    master = spark.createDataFrame([(1, "x", "2020-01-01", "No", "No")], "sample_id long, state string, day string, negative_control string, positive_control string")
    negatives = spark.createDataFrame([(2, "y", "2020-02-01", "Yes")], "sample_id long, state string, day string, negative_control string")
    labelled = plates.label_manifest(manifest, "cid", master, negatives)
    assert rows(labelled.select("specimen", "sample_id", "positive_control_id", "negative_control", "positive_control")) == [
        ("s1", 1, None, "No", "No"), ("s2", 2, None, "Yes", "No"), ("s3", None, "POS", "No", "Yes")]
    qc = {r.metric: r.value for r in plates.sample_qc(labelled, "sample_id", "day", plate=None, specimen="specimen").collect()}
    assert qc["all_unique"] == "3" and qc["positive_unique"] == "1" and qc["negative_first_day"] == "2020-02-01"
    assert qc["test_unique_without_day"] == "0" and qc["all_specimens"] == "3" and qc["positive_last_day"] is None


def test_quality_without_positive_ids_counts_ids_once(spark):
    df = spark.createDataFrame([(1, "2020-01-01", "No", "No"), (1, "2020-01-02", "Yes", "No"), (2, None, "No", "No")],
                               "sample_id long, day string, negative_control string, positive_control string")
    qc = {r.metric: r.value for r in plates.sample_qc(df, "sample_id", "day", plate=None, positive_key=None).collect()}
    assert qc["all_unique"] == "2" and qc["test_unique"] == "2" and qc["test_unique_without_day"] == "1" and qc["all_count"] == "3"


def test_share_by_plate(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 1), (2, "y", 1), (3, "x", 2), (4, None, 2)], "p long, state string, plate int")
    assert rows(plates.share_by(df, "p", "state", "plate")) == [(1, "x", 1, 50.0), (1, "y", 1, 50.0), (2, "x", 1, 50.0)]
    assert rows(plates.share_by(df, "p", "state")) == [("x", 2, 50.0), ("y", 1, 25.0)]


def test_too_few_controls_are_an_error(spark):
    pool = spark.range(3).selectExpr("id AS sample_id")
    with pytest.raises(ValueError, match="5 controls are needed for 10 plates, there are 3"):
        plates.allocate_controls(pool, 10, "sample_id", F.col("sample_id"))


def test_first_rows_with_nulls_and_any_n(spark):
    df = spark.range(500).selectExpr("id", "CASE WHEN id % 7 > 0 THEN id % 50 END AS day")
    order = sorted(df.collect(), key=lambda r: (r.day is None, -(r.day or 0), r.id))
    for n in (0, 1, 60, 499, 600):
        got = plates.first_rows(df, n, ["day", "id"], descending=1).collect()
        assert {r.id for r in got} == {r.id for r in order[:n]}
