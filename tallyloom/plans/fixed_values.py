"""Lists, labels, codes and edges that reports are matched on.

Fixed values: they must equal those in the source data and in earlier reports, and are not derived
from anything.
"""

# Categories in report order.
GENERIC_ORDER = ["Multiple Selections", "None Of These", "Skip", "Not Specified", "TOTAL"]

SEX_ORDER = ["Female", "Male", "Intersex", "None Of These", "Skip", "Not Specified"]
RACE_ORDER = [
    "White", "Black", "Asian", "AIAN (American Indian or Alaska Native)",
    "MENA (Middle Eastern or North African)", "NHPI (Native Hawaiian or Other Pacific Islander)",
    "More Than One Population", "None Of These", "Skip", "Not Specified",
]
SELF_REPORTED_RACE_ORDER = [
    "White", "Black", "Asian", "AIAN (American Indian or Alaska Native)",
    "MENA (Middle Eastern or North African)", "NHPI (Native Hawaiian or Other Pacific Islander)",
    "Hispanic", "GeneralizedMultPopulations", "None Of These", "Skip", "Not Specified",
]
ETHNICITY_ORDER = ["Not Hispanic Or Latino", "Hispanic Or Latino", "None Of These", "Skip", "Not Specified"]
AGE_ORDER = ["18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80-89", "90+"]
GENDER_ORDER = ["Woman", "Man", "Non Binary", "Transgender", "Additional Options", "Skip", "Not Specified"]
INCOME_ORDER = [
    "Less 10K", "10K 25K", "25K 35K", "35K 50K", "50K 75K", "75K 100K", "100K 150K", "150K 200K", "More 200K",
    "Skip", "Not Specified",
]
EDUCATION_ORDER = [
    "Never Attended", "One Through Four", "Five Through Eight", "Nine Through Eleven", "Twelve Or Ged",
    "College One To Three", "College Graduate", "Advanced Degree", "Skip", "Not Specified",
]
EMPLOYMENT_ORDER = [
    "Employed For Wages", "Self Employed", "Out Of Work One Or More", "Out Of Work Less Than One", "Student",
    "Homemaker", "Retired", "Unable To Work", "Skip", "Not Specified",
]
ORIENTATION_ORDER = [
    "Straight", "Bisexual", "Gay", "Prefer not to answer", "Lesbian", "None Of These", "Skip", "Not Specified",
]

# The orders of the record-history report; GENERIC_ORDER follows each but the ages.
HISTORY_ORDERS = {
    "sex_assigned_at_birth": ["Female", "Male", "Intersex", *GENERIC_ORDER],
    "race": [
        "White", "Black", "Hispanic", "Asian", "MENA (Middle Eastern and North African)",
        "NHPI (Native Hawaiian and Other Pacific Islander)", "More Than One Population", *GENERIC_ORDER,
    ],
    "ethnicity": ["Not Hispanic Or Latino", "Hispanic Or Latino", *GENERIC_ORDER],
    "age_group": [*AGE_ORDER, "TOTAL"],
    "gender_identity": ["Woman", "Man", "Non Binary", "Transgender", *GENERIC_ORDER],
    "annual_income": [*INCOME_ORDER[:9], *GENERIC_ORDER],
    "educational_attainment": [*EDUCATION_ORDER[:8], *GENERIC_ORDER],
    "employment": [*EMPLOYMENT_ORDER[:8], *GENERIC_ORDER],
}

# Lower ends of the right-closed age bands.
AGE_EDGES = [0, 29, 39, 49, 59, 69, 79, 89]
ADULT_AGE_EDGES = [18, 29, 39, 49, 59, 69, 79, 89]

# Answers after title case, and the names reports use for them.
REFUSED_ANSWERS = [
    "prefer not to answer", "i prefer not to answer", "none indicated", "no matching concept",
    "PreferNotToAnswer", "No matching concept",
]
ANSWER_NAMES = {
    "Native Hawaiian Or Other Pacific Islander": "NHPI (Native Hawaiian or Other Pacific Islander)",
    "Nhpi": "NHPI (Native Hawaiian or Other Pacific Islander)",
    "Middle Eastern Or North African": "MENA (Middle Eastern or North African)",
    "Mena": "MENA (Middle Eastern or North African)",
    "American Indian Or Alaska Native": "AIAN (American Indian or Alaska Native)",
    "Aian": "AIAN (American Indian or Alaska Native)",
    "Black Or African American": "Black",
    "Noneofthese": "None Of These",
    "Generalizedmultpopulations": "GeneralizedMultPopulations",
}
HISTORY_ANSWER_NAMES = {
    "Race Ethnicity None Of These": "None Of These",
    "Sex At Birth None Of These": "None Of These",
    "None": "None Of These",
    "Nhpi": "NHPI (Native Hawaiian and Other Pacific Islander)",
    "Mena": "MENA (Middle Eastern and North African)",
    "Prefer Not To Answer": "Not Specified",
    "I Prefer Not To Answer": "Not Specified",
    "No Matching Concept": "Not Specified",
    "Additional Options": "Not Specified",
    "Not Man Only, Not Woman Only, Prefer Not To Answer, Or Skipped": "Not Specified",
}
DEMOGRAPHIC_TITLES = {
    "race": "Self-Reported Race",
    "sex_at_birth": "Self-Reported Sex at Birth",
    "ethnicity": "Self-Reported Ethnicity",
    "gender_identity": "Self-Reported Gender Identity",
    "age_group": "Age Group at CDR",
    "education": "Self-Reported Educational Attainment",
    "income": "Self-Reported Income",
    "employment": "Self-Reported Employment",
    "sexual_orientation": "Self-Reported Sexual Orientation",
    "self_reported_race": "Self-Reported Categories of Demographic Descriptors",
}

# Race groups of the genomics report; text cut from race answers.
RACE_GROUPS = [
    "AIAN", "AIAN,White", "Asian", "Asian,White", "Black", "Black,White", "Hispanic", "Hispanic,White",
    "MENA", "MENA,White", "White", "Skip",
]
RACE_ANSWER_PARTS = ["What Race Ethnicity: ", "Race Ethnicity ", "PMI: "]
RACE_CODE_PARTS = ["WhatRaceEthnicity_", "RaceEthnicity", "PMI_"]

# Flag combinations counted beside a base flag.
DATA_TYPE_COMBINATIONS = [
    [], ["PPI"], ["PPI", "PM"], ["EHR"], ["PPI", "EHR"], ["PPI", "EHR", "PM"], ["Fitbit"], ["PPI", "Fitbit"],
    ["PPI", "PM", "Fitbit"], ["Fitbit", "PPI", "EHR"], ["PPI", "EHR", "PM", "Fitbit"],
]
DATA_TYPE_COHORTS = {
    "OVERALL": None, "PPI": "PPI", "PM": "PM", "FITBIT": "Fitbit", "WGS": "WGS", "ARRAY": "Array", "EHR": "EHR",
}

# Row labels of the data-type tables.
ALL_PARTICIPANTS = "TOTAL PARTICIPANTS IN CDR"
NO_DATA_TYPES = "Participants with 0 Data Types"

# Flag columns of the search table and their short names.
DATA_TYPE_FLAGS = {
    "PPI": "has_ppi_survey_data",
    "PM": "has_physical_measurement_data",
    "EHR": "has_ehr_data",
    "Fitbit": "has_fitbit",
    "WGS": "has_whole_genome_variant",
    "Array": "has_array_data",
}

# Survey questions by concept id.
QUESTIONS = {
    "race": 1586140,
    "sex_at_birth": 1585845,
    "gender_identity": 1585838,
    "income": 1585375,
    "education": 1585940,
    "employment": 1585952,
    "sexual_orientation": 1585899,
}
AIAN_ANSWER = "What Race Ethnicity: AIAN"
SUBCATEGORY_QUESTIONS = [
    1586150, 1586151, 1586152, 1586156, 1586153, 1586154, 1586149, 1586139, 1586155, 1585599,
]
LIFE_FUNCTIONING_SURVEY = 705190
SELF_REPORTED_TYPE = 32865
SELF_REPORTED_HEIGHT = 903133
SELF_REPORTED_WEIGHT = 903121
MEDIATED_SOURCE = "participant mediated ehr"
PARTNER_SOURCE = "tpc"
DEATH_SOURCE = "healthpro"

# Labels of the headline counts.
HEADLINES = {
    "total": "Total in CDR",
    "aian": "AIAN Race Ethnicity",
    "functioning": "Disability or Life Functioning Survey ",
    "functioning_survey": "Life Functioning Survey",
    "partner_survey": "CareEvolution PPI",
    "wear": "Wear Consent",
    "deceased": "Healthpro Deceased",
    "height": "Remote self-Reported Height PM",
    "weight": "Remote self-Reported Weight PM",
    "mediated": "Mediated EHR data",
    "subcategories": "Self-Reported Racial/Ethnicity Subcategories",
}

# Answers that say nothing, and the codes of under-represented groups.
NULL_CODES = ["Null", "No matching concept", "PMI_Skip", "PMI_PreferNotToAnswer", "AoUDRC_NoneIndicated"]
INTERSEX_CODES = ["SexAtBirth_Intersex", "SexAtBirth_SexAtBirthNoneOfThese"]
LOW_INCOME_CODES = ["AnnualIncome_less10k", "AnnualIncome_10k25k"]
LOW_EDUCATION_CODES = [
    "HighestGrade_NineThroughEleven", "HighestGrade_FiveThroughEight", "HighestGrade_OneThroughFour",
    "HighestGrade_NeverAttended",
]
GROUP_FLAGS = [
    "ubr_race_ethnicity", "ubr_age", "ubr_sex_assigned_at_birth", "ubr_annual_income",
    "ubr_educational_attainment", "ubr_sexual_and_gender_minorities",
]
GROUP_LABELS = {"yes": "UBR", "no": "RBR"}

# Vocabularies: dropped, and gathered under another name.
DROPPED_VOCABULARIES = [
    "Visit", "CMS Place of Service", "UB04 Pt dis status", "Medicare Specialty", "None", "OMOP Extension",
]
VOCABULARY_GROUPS = {
    "Cancer Modifier": "Others", "CIEL": "Others", "DRG": "Others", "NDC": "Others", "CVX": "Others",
    "Multum": "Others", "HemOnc": "Others", "PPI": "Others", "Nebraska Lexicon": "Others",
    "ICD10CM": "ICD10", "ICD10PCS": "ICD10",
    "RxNorm": "RxNorm", "RxNorm Extension": "RxNorm",
}

# Units of measurements.
UNUSABLE_UNITS = ["no matching concept", "no value"]
UNIT_SYNONYMS = {
    "mg/dl": "milligram per deciliter", "Percent": "percent", "meq/l": "milliequivalent per liter",
}

# Physical measures and the question stem cut from family-history names.
PHYSICAL_MEASURES = [
    "weight", "height", "waist-circumference-mean", "hip-circumference-mean", "heart-rate-mean",
    "blood-pressure-diastolic-mean", "blood-pressure-systolic-mean",
]
FAMILY_HISTORY_PARTS = ["including yourself, who in your family has had", "select all that apply."]

# Record domains: label, table, id column, concept column, start and end columns.
RECORD_DOMAINS = [
    ("Measurement", "measurement", "measurement_id", "measurement_concept_id", "measurement_datetime", "measurement_datetime"),
    ("Condition", "condition_occurrence", "condition_occurrence_id", "condition_concept_id", "condition_start_datetime", "condition_end_datetime"),
    ("Device", "device_exposure", "device_exposure_id", "device_concept_id", "device_exposure_start_datetime", "device_exposure_end_datetime"),
    ("Drug", "drug_exposure", "drug_exposure_id", "drug_concept_id", "drug_exposure_start_datetime", "drug_exposure_end_datetime"),
    ("Observation", "observation", "observation_id", "observation_concept_id", "observation_datetime", "observation_datetime"),
    ("Procedure", "procedure_occurrence", "procedure_occurrence_id", "procedure_concept_id", "procedure_datetime", "procedure_datetime"),
    ("Visit", "visit_occurrence", "visit_occurrence_id", "visit_concept_id", "visit_start_datetime", "visit_end_datetime"),
]
ANY_DOMAIN = "Any EHR"
