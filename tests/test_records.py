"""Extracts and whole reports over a tiny set of health-records tables."""

import pytest
from conftest import rows
from records import tables as make_tables

from tallyloom.plans import extracts, reports


@pytest.fixture(scope="module")
def tables(spark):
    return make_tables(spark)


@pytest.fixture(scope="module")
def history(tables):
    return reports.record_history(tables)


def test_flags(tables):
    assert rows(extracts.data_type_flags(tables)) == [
        (1, 1, 1, 1, 0, 1, 1), (2, 1, 0, 0, 0, 1, 0), (3, 0, 0, 1, 1, 0, 1), (4, 0, 0, 0, 0, 0, 0), (5, 0, 0, 0, 0, 0, 0)]
    assert rows(extracts.add_on_flags(tables)) == [(1, 1, 0, 1, 1), (2, 0, 1, 1, 0), (3, 0, 0, 1, 0), (4, 0, 0, 0, 0)]
    assert rows(extracts.consent_cohort(tables)) == [(1,), (3,)]


def test_demographics(tables):
    got = {r.person_id: r for r in extracts.demographics(tables).collect()}
    assert got[1].race == "White" and got[2].race == "Black" and got[3].race == "None Of These" and got[5].race == "Not Specified"
    assert got[2].ethnicity == "Not Specified" and got[1].ethnicity == "Not Hispanic Or Latino"
    assert [got[p].age_group for p in (1, 2, 3, 4, 5)] == ["18-29", "30-39", "90+", "18-29", None]
    assert (got[1].income, got[2].income, got[3].income) == ("Less 10K", "Multiple Selections", "Not Specified")
    assert (got[1].sexual_orientation, got[2].sexual_orientation) == ("None Of These", "Not Specified")
    assert got[3].sex_at_birth == "None Of These"
    assert rows(extracts.self_reported_race(tables)) == [
        (1, "White"), (2, "Asian"), (2, "Black"), (3, "Skip"), (4, "Not Specified"), (5, "None Of These")]


def test_history_demographics(tables):
    got = {r.person_id: r for r in extracts.history_demographics(tables).collect()}
    assert got[1].race == "White" and got[2].race == "NHPI (Native Hawaiian and Other Pacific Islander)"
    assert got[3].race == "Multiple Selections" and got[4].race == "None Of These" and got[5].race == "Not Specified"
    assert got[1].annual_income == "Skip" and got[3].ethnicity == "Hispanic Or Latino"
    assert [got[p].age_group for p in (1, 2, 3, 4)] == ["18-29", "30-39", "90+", None]


def test_group_flags(tables):
    got = {r.person_id: tuple(r)[1:] for r in extracts.group_flags(tables).collect()}
    #           race   age    sex    income education minority overall
    assert got[1] == ("no", "no", "no", "yes", "no", "no", "yes")
    assert got[2] == ("yes", "no", "no", "no", "no", "yes", "yes")
    assert got[3] == ("yes", "yes", "yes", "no", "no", "no", "yes")
    assert got[4] == ("no", "yes", "no", "no", "no", "yes", "yes")
    assert got[5] == ("no", "no", "no", "no", "yes", "no", "yes")


def test_headlines(tables):
    got = {r.label: r.n for r in reports.headline_report(tables).collect()}
    assert got == {
        "Total in CDR": 5, "AIAN Race Ethnicity": 1, "Disability or Life Functioning Survey ": 1, "Life Functioning Survey": 2,
        "CareEvolution PPI": 2, "Wear Consent": 2, "Healthpro Deceased": 1, "Remote self-Reported Height PM": 1,
        "Remote self-Reported Weight PM": 1, "Mediated EHR data": 1, "Self-Reported Racial/Ethnicity Subcategories": 1}


def test_data_type_reports(tables):
    table = {r.data_type: (r["Whole CDR"], r.AIAN, r.WEAR) for r in reports.data_type_report(tables).collect()}
    assert table["PPI"] == ("2 (40.00%)", "1 (100.00%)", "1 (50.00%)")
    assert table["None"] == ("2 (40.00%)", "-", "-")
    combos = {(r.label, r.combo): r["Whole CDR"] for r in reports.data_type_report(tables, combinations=True).collect()}
    assert combos[("Participants with ONLY 2 Data Type(s)", "PPI and WGS")] == "1 (20.00%)"
    add_on = {(r.data_type, r.population): r.n for r in reports.add_on_report(tables).collect()}
    assert add_on[("WGS OR Array", "Whole CDR")] == 3 and add_on[("Structural Variant", "AIAN")] == 1


def test_demographic_report(tables):
    table = {(r.population, r.cohort, r.category): r.label for r in reports.demographic_report(tables, "race").collect()}
    assert table[("Whole CDR", "OVERALL", "White")] == "1 (20.00%)" and table[("WEAR", "EHR", "TOTAL")] == "2 (100.00%)"
    assert table[("AIAN", "FITBIT", "Black")] == "0 (0.00%)"
    several = {(r.population, r.cohort, r.category): r.n for r in reports.demographic_report(tables, "self_reported_race").collect()}
    assert several[("Whole CDR", "OVERALL", "TOTAL")] == 6 and several[("AIAN", "PPI", "Asian")] == 1


def test_genomics_report(tables):
    races, combinations = reports.genomics_report(tables, "WGS")
    assert [(r.group, r.n) for r in races.collect()] == [("AIAN,White", 1), ("White", 1), ("Other", 0), ("Skip", 0), ("Total", 2)]
    assert {r.combination: r.n for r in combinations.collect()}["WGS and PPI and PM"] == 1
    races, combinations = reports.genomics_report(tables, "WGS and Array")
    assert {r.combination: r.n for r in combinations.collect()}["WGS and Array"] == 1


def test_record_history(history):
    got = {(r.person_id, r.domain, r.site, r.vocabulary): str(r["end"])[:10] for r in history.collect()}
    assert got[(2, "Condition", "EHR site 2", "ICD10CM")] == "2022-07-01"
    assert got[(1, "Measurement", "EHR site 1", "LOINC")] == "2015-01-01" and (1, "Any EHR", "ehr site 2", "LOINC") in got
    assert not any(p == 4 for p, *_ in got)


def test_history_reports(tables, history):
    years = {r.domain: r for r in reports.years_report(history).collect()}
    assert years["Drug"]["max"] == 0.0 and years["Condition"].n == 2
    growth = {(r.domain, r.year): (r.cum_n, r.cum_pct) for r in reports.growth_report(tables).collect()}
    assert growth[("Any EHR", 2020)] == (3, 60.0) and growth[("Condition", 2011)] == (2, 40.0) and ("Drug", 2009) not in growth
    by_race = {(r.domain, r.category): (r.n, r.label) for r in reports.demographic_history_report(tables, history, "race").collect()}
    assert by_race[("All Pids", "TOTAL")] == (5, "<20 (-)") and by_race[("No Data", "None Of These")][0] == 1
    groups = {(r.diversity_category, r.domain, r.category): r.n for r in reports.group_history_report(tables, history).collect()}
    assert groups[("age", "Any EHR", "UBR")] == 1 and groups[("overall", "All Pids", "TOTAL")] == 5
    size = tables["person"].selectExpr("count(*) AS n")
    by_site = {(r.row, r.col): r.n for r in reports.site_report(history, size).collect()}
    assert by_site[("TOTAL PIDS", "Any EHR")] == 3 and by_site[("EHR site 1", "Drug")] == 1
    by_vocabulary = {(r.row, r.col): r.n for r in reports.site_report(history, size, "vocabulary").collect()}
    assert by_vocabulary[("EHR site 1", "RxNorm")] == 1 and by_vocabulary[("EHR site 3", "Any EHR")] == 1
    assert ("EHR site 3", "Visit") not in by_vocabulary


def test_lab_extracts(tables):
    full = {(r.person_id, r.value_as_number): r for r in extracts.lab_extract(tables, [11]).collect()}
    assert len(full) == 2
    assert full[(1, 40.0)].unit_concept_name == "percent" and full[(1, 40.0)].ancestor_concept_name == "blood panel"
    assert full[(1, 41.0)].value_as_concept_name == "positive" and full[(1, 41.0)].unit_concept_name is None
    narrow = rows(extracts.measurement_extract(tables, [11]).select("person_id", "value_as_number", "src_id"))
    assert narrow == [(1, 40.0, "EHR site 1"), (2, None, "EHR site 1")]
    assert rows(extracts.concept_name_map(tables, [11])) == [(10, "hematocrit", 5, "hct", 20, "percent", None, None)]


def test_lab_extract_is_distinct_when_concepts_repeat(spark, tables):
    """Ids that occur twice with one name, with two, under two ancestors of one name, and rows that differ in nothing."""
    schema = tables["concept"].schema
    more = spark.createDataFrame([
        (10, "HEMATOCRIT", "hct2", "LOINC", "Measurement"), (20, "percent", "%", "UCUM", "Unit"), (20, "Ratio", "%", "UCUM", "Unit"),
        (12, "Blood panel", "bp2", "LOINC", "Measurement"), (62, "LA2", "LA1", "LOINC", "Answer"), (60, "LA1", "la1", "LOINC", "Meas Value"),
    ], schema)
    twice = {"concept": tables["concept"].union(more), "measurement": tables["measurement"].union(tables["measurement"])}
    twice["concept_ancestor"] = tables["concept_ancestor"].union(spark.createDataFrame([(12, 10), (11, 10)], tables["concept_ancestor"].schema))
    got = rows(extracts.lab_extract({**tables, **twice}, [11, 12]))
    single = extracts.lab_extract(tables, [11])
    place = {c: i for i, c in enumerate(single.columns)}
    wanted = set()
    for r in single.collect():
        units = ["percent", "ratio"] if r.unit_concept_name == "percent" else [r.unit_concept_name]
        answers = ["positive", "la2"] if r.value_as_concept_name == "positive" else [r.value_as_concept_name]
        for unit in units:
            for answer in answers:
                row = list(r)
                row[place["unit_concept_name"]], row[place["value_as_concept_name"]] = unit, answer
                wanted.add(tuple(row))
    assert got and len(got) == len(set(got)) and set(got) == wanted



def test_indexes(spark, tables):
    wide = spark.createDataFrame([(1, True, None), (2, False, True)], "person_id long, `J11` boolean, `rx` boolean")
    index = extracts.phenotype_index(tables, wide, "concept_code", "mcc2_phecode")
    assert rows(index.select("concept_code", "concept_name", "n_pids", "report_name")) == [
        ("J11", "flu", 2, "mcc2_phecode_J11_summary"), ("rx", "pill", 1, "mcc2_phecode_rx_summary")]
    family = spark.createDataFrame([(1, True)], "person_id long, `10` boolean")
    assert rows(reports.family_history_index(tables, family).select("short_name", "n_pids")) == [("hematocrit", 1)]
    physical = extracts.physical_measure_index(tables).select("concept_name", "measurement_source_value", "report_name")
    assert rows(physical) == [("weight", "height", "height_summary"), ("weight", "weight", "weight_summary")]
    lab = spark.createDataFrame([(3023314,)], "measurement_concept_id long")
    assert rows(extracts.lab_index(lab)) == [(3023314, "measurement_3023314")]
    wanted = spark.createDataFrame([("J11",), ("40",), ("none",)], "c string")
    assert rows(extracts.concept_names(tables, wanted, "c")) == [("40", "Pill"), ("J11", "Flu")]


def test_catalog_tables(spark, tables):
    tables["person"].createOrReplaceTempView("person")
    found = extracts.CatalogTables(spark, names={"deaths": "person"})
    assert found["person"].count() == 5 and found["deaths"].count() == 5


def test_phenotype_reports(spark, tables):
    demographics = spark.createDataFrame([(1, "18-29", "F"), (2, "18-29", "M"), (3, "90+", "F")], "person_id long, age_group string, sex_at_birth string")
    ancestry = spark.createDataFrame([(1, "EUR"), (2, "AFR"), (4, "EUR")], "person_id long, ancestry string")
    strata = reports.person_strata(demographics, ancestry)
    wide = spark.createDataFrame([(1, True, None), (2, False, True), (3, True, False), (4, True, True)], "person_id long, `J11` boolean, `40` boolean")
    got = {(r.stratum, r.concept, r.age_group, r.sex_at_birth, r.ancestry, r["class"]): r for r in reports.case_control_report(tables, wide, strata).collect()}
    row = got[("age_group", "J11", "18-29", None, None, "Cases")]
    assert (row.n_pids, row.numerator, row.pct, row.label, row.concept_name) == (1, 2, 50.0, "1 (50%)", "Flu")
    row = got[("ancestry", "J11", None, None, "EUR", "Cases")]
    assert (row.n_pids, row.numerator) == (2, 2)
    assert got[("sex_at_birth x ancestry", "40", None, "M", "AFR", "Cases")].numerator == 1

    values = spark.createDataFrame([(1, 60.0, 1.7), (2, 70.0, None), (3, None, 1.6)], "person_id long, weight double, height double")
    got = {(r.stratum, r.measure, r.sex_at_birth, r.ancestry): (r.n_pids, r.numerator) for r in reports.measure_report(values, strata).collect()}
    assert got[("sex_at_birth", "weight", "F", None)] == (1, 2) and got[("sex_at_birth", "height", "F", None)] == (2, 2)
    assert got[("sex_at_birth x ancestry", "weight", "M", "AFR")] == (1, 1)


def test_lab_report(tables):
    report = reports.lab_report(tables, [11])
    assert rows(report["statistics"].select("lab", "site", "n", "mean")) == [("blood panel", "#1", 1, 40.0), ("blood panel", "ehr site 2", 1, 41.0)]
    (person,) = report["people"].collect()
    assert (person.lab, person.person_id, person.values_count, person.latest_value, person.latest_value_unit) == ("blood panel", 1, 2, "41", "NA")
    assert sum(r.n for r in report["histogram"].collect()) == 2 and report["boxes"].count() == 2
