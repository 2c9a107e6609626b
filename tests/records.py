"""A tiny set of health-records tables."""


def tables(spark):
    def t(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    out = {
        "person": t(
            "person_id long, race_source_value string, ethnicity_source_value string, ethnicity_concept_id long, "
            "sex_at_birth_source_value string, gender_source_value string",
            (1, "WhatRaceEthnicity_White", "x", 901, "SexAtBirth_Female", "GenderIdentity_Woman"),
            (2, "WhatRaceEthnicity_Black", None, 901, "SexAtBirth_Male", "GenderIdentity_Woman"),
            (3, None, "WhatRaceEthnicity_Hispanic", 902, "SexAtBirth_Intersex", None),
            (4, "PMI_Skip", None, 902, None, "GenderIdentity_Man"),
            (5, None, None, 901, "PMI_Skip", "PMI_Skip"),
        ),
        "person_ext": t(
            "person_id long, self_reported_category_source_value string",
            (1, "WhatRaceEthnicity_White"), (2, "WhatRaceEthnicity_Black"), (2, "WhatRaceEthnicity_Asian"), (3, "PMI_Skip"),
            (4, "PreferNotToAnswer"), (5, "WhatRaceEthnicity_RaceEthnicityNoneOfThese"),
        ),
        "cb_search_person": t(
            "person_id long, race string, ethnicity string, age_at_cdr int, age_at_consent int, has_ppi_survey_data int, "
            "has_physical_measurement_data int, has_ehr_data int, has_fitbit int, has_whole_genome_variant int, has_array_data int, "
            "has_lr_whole_genome_variant int, has_structural_variant_data int",
            (1, "White", "Not Hispanic or Latino", 29, 28, 1, 1, 1, 0, 1, 1, 1, None),
            (2, "Black or African American", "None Indicated", 30, 29, 1, None, 0, 0, 1, 0, 0, 1),
            (3, "None of these", "Hispanic or Latino", 90, 88, 0, 0, 1, 1, 0, 1, None, None),
            (4, None, "I prefer not to answer", 17, 16, 0, 0, 0, 0, 0, 0, 0, 0),
        ),
        "ds_survey": t(
            "person_id long, question_concept_id long, answer string",
            (1, 1586140, "What Race Ethnicity: White"), (2, 1586140, "What Race Ethnicity: AIAN"), (2, 1586140, "What Race Ethnicity: White"),
            (3, 1586140, "PMI: Skip"),
            (1, 1585845, "Sex At Birth: Female"), (2, 1585845, "Sex At Birth: Male"), (3, 1585845, "Sex At Birth: Sex At Birth None Of These"),
            (1, 1585375, "Annual Income: less 10k"), (2, 1585375, "Annual Income: 10k 25k"), (2, 1585375, "Annual Income: 25k 35k"),
            (1, 1585899, "Sexual Orientation: none"), (2, 1585899, "PMI: Prefer Not To Answer"),
            (3, 1586150, "x"),
        ),
        "wear_study": t("person_id long, resultsconsent_wear string", (1, "Yes"), (2, "No"), (3, "Yes")),
        "deaths": t("person_id long, src_id string", (4, "Staff Portal: HealthPro"), (5, "EHR site 1")),
        "survey_conduct": t("survey_conduct_id long, person_id long, survey_source_concept_id long", (1, 1, 705190), (2, 2, 705190), (3, 3, 5)),
        "survey_conduct_ext": t("survey_conduct_id long, src_id string", (1, "PTSC"), (2, "xTPC"), (3, "y TPC")),
        "concept": t(
            "concept_id long, concept_name string, concept_code string, vocabulary_id string, domain_id string",
            (901, "Not Hispanic or Latino", "nh", "Ethnicity", "Ethnicity"), (902, "Hispanic or Latino", "h", "Ethnicity", "Ethnicity"),
            (10, "Hematocrit", "hct", "LOINC", "Measurement"), (11, "Blood Panel", "bp", "LOINC", "Measurement"),
            (20, "Percent", "%", "UCUM", "Unit"), (30, "Flu", "J11", "ICD10CM", "Condition"), (40, "Pill", "rx", "RxNorm Extension", "Drug"),
            (50, "Clinic", "c", "Visit", "Visit"), (60, "LA1", "la1", "LOINC", "Meas Value"), (61, "Positive", "LA1", "LOINC", "Answer"),
            (70, "PMI: Skip", "s", "PPI", "Answer"), (71, "Race Ethnicity None Of These", "n", "PPI", "Answer"),
            (72, "What Race Ethnicity: NHPI", "nh", "PPI", "Answer"), (73, "What Race Ethnicity: White", "w", "PPI", "Answer"),
            (80, "Weight", "wt", "PPI", "Measurement"),
        ),
        "concept_ancestor": t("ancestor_concept_id long, descendant_concept_id long", (11, 10), (11, 11), (705190, 705191)),
        "observation": t(
            "observation_id long, person_id long, observation_concept_id long, observation_source_concept_id long, value_source_concept_id long, "
            "value_source_value string, observation_datetime timestamp",
            (1, 1, 705191, 1586140, 73, "x", _ts("2012-01-01")), (2, 2, 10, 1586140, 72, "x", _ts("2012-01-01")),
            (3, 3, 10, 1586140, 72, "x", _ts("2012-01-01")), (4, 3, 10, 1586140, 73, "x", _ts("2012-01-01")),
            (5, 4, 10, 1586140, 71, "x", _ts("2012-01-01")), (6, 1, 10, 1585375, 70, "AnnualIncome_less10k", _ts("2012-01-01")),
            (7, 5, 10, 1585899, 70, "SexualOrientation_Straight", _ts("2012-01-01")),
            (8, 4, 10, 1585899, 70, "SexualOrientation_Gay", _ts("2012-01-01")), (9, 4, 10, 1585899, 70, "PMI_Skip", _ts("2012-01-01")),
            (10, 5, 10, 1585940, 70, "HighestGrade_NeverAttended", _ts("2012-01-01")),
        ),
        "measurement": t(
            "measurement_id long, person_id long, measurement_concept_id long, measurement_source_concept_id long, measurement_type_concept_id long, "
            "measurement_source_value string, measurement_datetime timestamp, value_as_number double, value_as_concept_id long, range_low double, "
            "range_high double, unit_concept_id long, unit_source_value string, operator_concept_id long",
            (1, 1, 10, 5, 0, "HCT", _ts("2015-01-01"), 40.0, None, None, None, 20, "PCT", None),
            (2, 1, 10, 5, 0, "HCT", _ts("2016-01-01"), 41.0, 60, None, None, None, "PCT", None),
            (3, 2, 10, 5, 0, "HCT", _ts("2016-01-01"), None, None, None, None, 20, "PCT", None),
            (4, 3, 80, 903121, 32865, "Weight", _ts("2016-01-01"), 70.0, None, None, None, 20, "kg", None),
            (5, 4, 80, 903133, 32865, "Height", _ts("2016-01-01"), 170.0, None, None, None, 20, "cm", None),
        ),
        "measurement_ext": t("measurement_id long, src_id string", (1, "EHR site 1"), (2, "ehr site 2"), (3, "EHR site 1"), (4, "Portal"), (5, "Participant Mediated EHR")),
        "observation_ext": t("observation_id long, src_id string", (1, "EHR site 1"), (2, "PPI")),
        "ds_measurement": t(
            "measurement_concept_id long, measurement_source_concept_id long, unit_concept_id long, operator_concept_id long, "
            "standard_concept_name string, source_concept_name string, unit_concept_name string, operator_concept_name string",
            (10, 5, 20, None, "Hematocrit", "HCT", "Percent", None), (10, 5, 20, None, "Hematocrit", "HCT", "Percent", None),
            (80, 5, 20, None, "Weight", "W", "kg", None),
        ),
        "_cdr_metadata": t("ehr_cutoff_date string", ("2022-07-01",)).selectExpr("to_date(ehr_cutoff_date) AS ehr_cutoff_date"),
    }
    events = {
        "condition_occurrence": ("condition", "condition_occurrence_id", 30, [(1, 1, "2010-01-01", "2010-02-01"), (2, 2, "2011-01-01", None)]),
        "device_exposure": ("device_exposure", "device_exposure_id", 30, []),
        "drug_exposure": ("drug_exposure", "drug_exposure_id", 40, [(1, 1, "2009-01-01", "2009-01-01")]),
        "procedure_occurrence": ("procedure", "procedure_occurrence_id", 30, []),
        "visit_occurrence": ("visit", "visit_occurrence_id", 50, [(1, 3, "2020-01-01", "2020-01-03")]),
    }
    for name, (stem, key, concept, rows) in events.items():
        domain = name.split("_")[0]
        ends = "" if domain == "procedure" else f", {stem}_end_datetime timestamp"
        start = "procedure_datetime" if domain == "procedure" else f"{stem}_start_datetime"
        out[name] = t(
            f"{key} long, person_id long, {domain}_concept_id long, {start} timestamp{ends}",
            *[(i, p, concept, _ts(a), _ts(b)) for i, p, a, b in rows],
        )
        out[f"{name}_ext"] = t(f"{key} long, src_id string", *[(i, f"EHR site {p}") for i, p, *_ in rows])
    out["procedure_occurrence"] = out["procedure_occurrence"].selectExpr("*")
    return out


def _ts(text):
    import datetime

    return text and datetime.datetime.fromisoformat(text)
