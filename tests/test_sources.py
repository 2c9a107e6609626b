from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.runtime import shared_folder
from tallyloom.sources import files


def wide(spark):
    return spark.createDataFrame([(1, True, 2.5, 'a "b", c'), (2, None, None, None)], "person_id long, `401.1` boolean, `88` double, note string")


SCHEMA = "person_id BIGINT, `401.1` BOOLEAN, `88` DOUBLE, note STRING"


@pytest.mark.parametrize("kind", ["csv", "tsv"])
def test_round_trip(spark, tmp_path, kind):
    path = files.write_flat(wide(spark), f"{tmp_path}/wide.{kind}")
    assert rows(files.read_flat(spark, path, SCHEMA)) == rows(wide(spark))
    assert files.read_flat(spark, path, SCHEMA, n=1).count() == 1
    assert files.read_flat(spark, path).dtypes[0] == ("person_id", "string")
    concept = files.read_concept(spark, path, "401.1", SCHEMA)
    assert rows(concept) == [(1, True), (2, None)]
    plan = concept._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<person_id:bigint,401.1:boolean>" in plan


def test_other_files_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_flat(spark, f"{tmp_path}/x.xlsx")


def test_ancestry(spark, tmp_path):
    raw = spark.createDataFrame([(1, "x", "eur", "y")], "research_id int, skip1 string, ancestry_pred string, skip2 string")
    path = files.write_flat(raw, f"{tmp_path}/ancestry.tsv")
    got = files.read_ancestry(spark, path, raw.schema, "research_id", "ancestry_pred")
    assert got.columns == ["person_id", "ancestry_pred"] and rows(got) == [(1, "EUR")]


def test_concept_columns_start_no_job(spark):
    assert files.concept_columns(wide(spark)) == ["401.1", "88", "note"]


def test_stamps(spark, tmp_path):
    now = datetime(2024, 5, 6, 7, 8, 9)
    assert files.stamped("x", "today", now) == "x_2024-05-06"
    assert files.stamped("x", "today.time", now) == "x_2024-05-06_07.08"
    assert files.stamped("x", "today.time.seconds", now) == "x_2024-05-06_07.08.09"
    path = files.write_stamped(wide(spark), f"{tmp_path}/out", "today.time", now=now)
    assert path.endswith("out_2024-05-06_07.08.csv") and files.read_flat(spark, path, SCHEMA).count() == 2


def test_one_folder_per_concept(spark, tmp_path):
    text = """concat('a "quoted", ', id, ' text')"""
    df = spark.range(300).selectExpr("id AS person_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE 2 END AS concept_id", "id * 0.5 AS value", f"{text} AS note")
    path = files.write_by_concept(df, f"{tmp_path}/measurements", "concept_id", rows_per_file=70)
    back = files.read_flat(spark, path, "person_id BIGINT, value DOUBLE, note STRING, concept_id INT", kind="csv")
    assert back.filter("concept_id = 1").count() == 100 and back.count() == 300
    assert back.filter(f"note = {text.replace('id', 'person_id')}").count() == 300
    assert len(list((tmp_path / "measurements" / "concept_id=2").glob("*.csv"))) >= 3


def test_a_task_writes_few_rows_of_a_large_concept(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id % 90 AS person_id", "CASE WHEN id % 10 < 8 THEN 1 WHEN id % 10 = 8 THEN 2 END AS concept_id", "id % 3 * 0.5 AS value")
    before = {p for p in Path(shared_folder(spark)).glob("tallyloom/*")}
    path = files.write_by_concept(df, f"{tmp_path}/large", "concept_id", rows_per_task=1_000)
    back = files.read_flat(spark, path, "person_id BIGINT, value DOUBLE, concept_id INT", kind="csv")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name().alias("file")).count().collect()]
    assert max(sizes) < 3_000 and len(sizes) < 30, "no task sorts a whole concept, and no concept is cut finer than that"
    columns = ["person_id", "concept_id", "value"]
    assert rows(back.groupBy(*columns).count()) == rows(df.groupBy(*columns).count())
    assert {p for p in Path(shared_folder(spark)).glob("tallyloom/*")} == before, "the pinned rows are deleted"
    assert files.read_flat(spark, files.write_flat(df.limit(0), f"{tmp_path}/none.csv"), df.schema).count() == 0
    files.write_by_concept(df.limit(0), f"{tmp_path}/empty", "concept_id")


def test_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines "and" quotes'), (2, "x")], "person_id long, note string")
    path = files.write_flat(df, f"{tmp_path}/notes.csv")
    assert rows(files.read_flat(spark, path, "person_id BIGINT, note STRING", line_breaks=True)) == rows(df)


def test_sql(spark):
    assert rows(files.query(spark, "SELECT count(*) FROM some_people", {"some_people": wide(spark)})) == [(2,)]
