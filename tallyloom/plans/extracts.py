"""Extracts over health-records tables: persons, surveys, records of seven domains, concepts.

Every function takes ``tables``, a mapping from table name to DataFrame; ``CatalogTables`` reads
them from the session catalog. Table and column names follow the public common data model; ``deaths``
is the table of reported deaths.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answer_text, any_of, band, clean_answer, clean_answer_stem_last, recode, strip_parts, yes_no
from ..operators.answers import recode_distinct
from ..operators.flags import multi_answer_columns
from ..operators.shares import fixed_table
from ..operators.strata import column_sums
from ..runtime import materialise
from . import fixed_values as fixed

Tables = Mapping[str, DataFrame]


class CatalogTables(Mapping):
    """Tables of a catalog database by name."""

    def __init__(self, spark: SparkSession, database: str | None = None, names: Mapping[str, str] | None = None):
        self._spark, self._database, self._names = spark, database, dict(names or {})

    def __getitem__(self, name: str) -> DataFrame:
        table = self._names.get(name, name)
        return self._spark.table(f"{self._database}.{table}" if self._database else table)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


# Cohorts and flags


def survey_cohort(tables: Tables, question: int, answer: str) -> DataFrame:
    """Persons who gave an answer to a question."""
    chosen = (F.col("question_concept_id") == question) & (F.col("answer") == answer)
    return tables["ds_survey"].filter(chosen).select("person_id").distinct()


def consent_cohort(tables: Tables) -> DataFrame:
    """Persons who consented to the wearables study."""
    return tables["wear_study"].filter(F.col("resultsconsent_wear") == "Yes").select("person_id").distinct()


def data_type_flags(tables: Tables) -> DataFrame:
    """One row per person with a 0/1 flag per data type; no search row means no data."""
    flags = tables["cb_search_person"].select(
        "person_id", *[F.col(c).cast("int").alias(name) for name, c in fixed.DATA_TYPE_FLAGS.items()]
    )
    people = tables["person"].select("person_id").join(flags, "person_id", "left")
    return people.na.fill(0, list(fixed.DATA_TYPE_FLAGS))


def add_on_flags(tables: Tables) -> DataFrame:
    """Further 0/1 flags: long-read and structural-variant data, and either or both genomic types."""
    wgs, array = F.col("has_whole_genome_variant") == 1, F.col("has_array_data") == 1

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return tables["person"].select("person_id").join(tables["cb_search_person"], "person_id").select(
        "person_id",
        flag(F.col("has_lr_whole_genome_variant") == 1).alias("Long_Read_WGS"),
        flag(F.col("has_structural_variant_data") == 1).alias("Structural_Variant"),
        flag(wgs | array).alias("WGS_OR_Array"),
        flag(wgs & array).alias("WGS_AND_Array"),
    )


# Demographics


def _answer_ends(rows: DataFrame, questions: Mapping[str, int], question: str, value: str) -> DataFrame:
    """One row per person with a collapsed answer per question, from one pass over the answers.

    One aggregation stands in for a join per question, which would also multiply a person's rows by
    the number of answers given.
    """
    wide = rows.select(
        "person_id", *[F.when(F.col(question) == code, F.col(value)).alias(name) for name, code in questions.items()]
    )
    return multi_answer_columns(wide, "person_id", list(questions))


def demographics(tables: Tables) -> DataFrame:
    """One row per person: cleaned race, ethnicity, age and six survey answers."""
    names = [n for n in fixed.QUESTIONS if n != "race"]

    def clean(value: Column) -> Column:
        return clean_answer(value, refused=fixed.REFUSED_ANSWERS, names=fixed.ANSWER_NAMES)

    def clean_asked(asked: Column) -> Column:
        text = F.lower(answer_text(asked["answer"]))
        orientation = asked["question"] == fixed.QUESTIONS["sexual_orientation"]
        return clean(F.when(orientation, F.replace(text, F.lit("none"), F.lit("none of these"))).otherwise(text))

    asked = tables["ds_survey"].filter(F.col("question_concept_id").isin([fixed.QUESTIONS[n] for n in names]))
    given = asked.select("person_id", F.struct(F.col("question_concept_id").alias("question"), "answer").alias("_given"))
    cleaned = recode_distinct(given, "_given", clean_asked, "_clean_answer").withColumn("_question", F.col("_given.question"))
    answers = _answer_ends(cleaned, {n: fixed.QUESTIONS[n] for n in names}, "_question", "_clean_answer")
    search = tables["cb_search_person"].select(
        "person_id", F.lower("race").alias("race"), F.lower("ethnicity").alias("ethnicity"),
        F.col("age_at_cdr").cast("int").alias("age_at_cdr"),
    )
    people = tables["person"].select("person_id").join(search, "person_id", "left").join(answers, "person_id", "left")
    return people.select(
        "person_id", clean(F.col("race")).alias("race"), clean(F.col("ethnicity")).alias("ethnicity"), "age_at_cdr",
        band(F.col("age_at_cdr"), fixed.AGE_EDGES, fixed.AGE_ORDER).alias("age_group"),
        *[F.coalesce(n, F.lit("Not Specified")).alias(n) for n in names],
    )


def self_reported_race(tables: Tables) -> DataFrame:
    """Person and self-reported category, one row per answer."""
    value = strip_parts(F.col("self_reported_category_source_value"), fixed.RACE_CODE_PARTS)
    cleaned = clean_answer(value, refused=fixed.REFUSED_ANSWERS, names=fixed.ANSWER_NAMES)
    return tables["person_ext"].select("person_id", cleaned.alias("self_reported_race")).distinct()


def history_demographics(tables: Tables) -> DataFrame:
    """The variant from coded observations: answers are collapsed as given, then cleaned."""
    questions = {
        "race": "race", "sex_assigned_at_birth": "sex_at_birth", "annual_income": "income",
        "gender_identity": "gender_identity", "educational_attainment": "education", "employment": "employment",
    }
    codes = {name: fixed.QUESTIONS[q] for name, q in questions.items()}
    asked = tables["observation"].filter(F.col("observation_source_concept_id").isin(list(codes.values())))
    said = _role(_used_concepts(tables, asked, ["value_source_concept_id"]), "value_source_concept_id", "_value")
    answers = _answer_ends(asked.join(said, "value_source_concept_id"), codes, "observation_source_concept_id", "_value")
    ethnicity = _role(
        _used_concepts(tables, tables["person"], ["ethnicity_concept_id"]), "ethnicity_concept_id", "ethnicity"
    )
    age = tables["cb_search_person"].select("person_id", F.col("age_at_cdr").cast("int").alias("age_at_cdr"))
    people = (
        tables["person"].select("person_id", "ethnicity_concept_id")
        .join(ethnicity, "ethnicity_concept_id").join(age, "person_id", "left").join(answers, "person_id", "left")
    )
    cleaned = [
        clean_answer_stem_last(F.coalesce(c, F.lit("Not Specified")), fixed.HISTORY_ANSWER_NAMES).alias(c)
        for c in ["ethnicity", *questions]
    ]
    age_group = band(F.col("age_at_cdr"), fixed.ADULT_AGE_EDGES, fixed.AGE_ORDER)
    return people.select("person_id", age_group.alias("age_group"), *cleaned)


def group_flags(tables: Tables) -> DataFrame:
    """Yes/no per under-represented group, and overall; of several answers one is enough."""
    nulls = fixed.NULL_CODES

    def known(c: Column) -> Column:
        return c.isNotNull() & ~c.isin(nulls)

    question, value = F.col("observation_source_concept_id"), F.col("value_source_value")
    rules = {
        "_income": (question == fixed.QUESTIONS["income"]) & value.isin(fixed.LOW_INCOME_CODES),
        "_education": (question == fixed.QUESTIONS["education"]) & value.isin(fixed.LOW_EDUCATION_CODES),
        "_orientation": (question == fixed.QUESTIONS["sexual_orientation"])
        & known(value) & (value != "SexualOrientation_Straight"),
    }
    asked = [fixed.QUESTIONS[q] for q in ("income", "education", "sexual_orientation")]
    answers = tables["observation"].filter(question.isin(asked)).groupBy("person_id").agg(
        *[F.max(F.when(rule, 1).otherwise(0)).alias(name) for name, rule in rules.items()]
    )
    age = tables["cb_search_person"].select("person_id", "age_at_consent")
    people = tables["person"].join(age, "person_id", "left").join(answers, "person_id", "left")
    race, sex, gender = F.col("race_source_value"), F.col("sex_at_birth_source_value"), F.col("gender_source_value")

    def differs(gender_code: str, sex_code: str) -> Column:
        return (gender == gender_code) & known(sex) & (sex != sex_code)

    minority = (
        (known(gender) & ~gender.isin("GenderIdentity_Woman", "GenderIdentity_Man"))
        | differs("GenderIdentity_Woman", "SexAtBirth_Female")
        | differs("GenderIdentity_Man", "SexAtBirth_Male")
        | (F.col("_orientation") == 1)
    )
    flags = {
        "ubr_race_ethnicity": (known(race) & (race != "WhatRaceEthnicity_White"))
        | (F.col("ethnicity_source_value") == "WhatRaceEthnicity_Hispanic"),
        "ubr_age": (F.col("age_at_consent") < 18) | (F.col("age_at_consent") >= 65),
        "ubr_sex_assigned_at_birth": sex.isin(fixed.INTERSEX_CODES),
        "ubr_annual_income": F.col("_income") == 1,
        "ubr_educational_attainment": F.col("_education") == 1,
        "ubr_sexual_and_gender_minorities": minority,
    }
    flagged = people.select("person_id", *[yes_no(rule).alias(name) for name, rule in flags.items()])
    return flagged.withColumn("ubr_overall", any_of([F.col(f) for f in flags]))


def genomic_people(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Flags of persons with genomic data, and their race answers."""
    people = data_type_flags(tables).filter((F.col("WGS") == 1) | (F.col("Array") == 1))
    race = strip_parts(F.col("answer"), fixed.RACE_ANSWER_PARTS)
    answers = tables["ds_survey"].filter(F.col("question_concept_id") == fixed.QUESTIONS["race"]).select(
        "person_id", race.alias("race")
    )
    return people, people.select("person_id").join(answers.distinct(), "person_id", "left")


# Headline counts


def labelled_counts(sources: Mapping[str, DataFrame], entity: str) -> DataFrame:
    """Distinct entities per labelled id table, smallest first, in one aggregation over all of them."""
    empty = [(label,) for label in sources]
    spark = next(iter(sources.values())).sparkSession
    stacked = reduce(
        DataFrame.unionByName, [ids.select(F.lit(label).alias("label"), entity) for label, ids in sources.items()]
    )
    counts = stacked.groupBy("label").agg(F.count_distinct(entity).alias("n"))
    every = fixed_table(spark, empty, "label string").join(counts, "label", "left")
    return every.select("label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")).orderBy("n", "label")


def with_source(tables: Tables, table: str, key: str) -> DataFrame:
    """A record table with the source id from its companion table."""
    return tables[table].join(tables[f"{table}_ext"].select(key, "src_id"), key)


def mediated_records(tables: Tables) -> DataFrame:
    """Persons with records they brought themselves, in any of the seven domains."""
    parts = [
        with_source(tables, table, key).filter(F.lower("src_id") == fixed.MEDIATED_SOURCE).select("person_id")
        for _, table, key, *_ in fixed.RECORD_DOMAINS
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def headline_sources(tables: Tables) -> dict[str, DataFrame]:
    """The labelled id tables of the headline summary."""
    survey, conduct = tables["ds_survey"], tables["survey_conduct"]
    label = fixed.HEADLINES
    asked = descendants(tables, [fixed.LIFE_FUNCTIONING_SURVEY], "observation_concept_id")
    functioning = tables["observation"].join(asked, "observation_concept_id", "left_semi")
    remote = tables["measurement"].filter(F.col("measurement_type_concept_id") == fixed.SELF_REPORTED_TYPE)
    remote = remote.join(tables["person_ext"].select("person_id"), "person_id", "left_semi")
    return {
        label["total"]: tables["person"],
        label["aian"]: survey_cohort(tables, fixed.QUESTIONS["race"], fixed.AIAN_ANSWER),
        label["functioning"]: functioning,
        label["functioning_survey"]: conduct.filter(F.col("survey_source_concept_id") == fixed.LIFE_FUNCTIONING_SURVEY),
        label["partner_survey"]: with_source(tables, "survey_conduct", "survey_conduct_id").filter(F.lower("src_id").endswith(fixed.PARTNER_SOURCE)),
        label["wear"]: consent_cohort(tables),
        label["deceased"]: tables["deaths"].filter(F.lower("src_id").contains(fixed.DEATH_SOURCE)),
        label["height"]: remote.filter(F.col("measurement_source_concept_id") == fixed.SELF_REPORTED_HEIGHT),
        label["weight"]: remote.filter(F.col("measurement_source_concept_id") == fixed.SELF_REPORTED_WEIGHT),
        label["mediated"]: mediated_records(tables),
        label["subcategories"]: survey.filter(F.col("question_concept_id").isin(fixed.SUBCATEGORY_QUESTIONS)),
    }


# Record history


def domain_records(tables: Tables, with_vocabulary: bool = True) -> DataFrame:
    """Records of all domains from care sites, one row per person, domain, site and concept: first start, last end.

    Every record table is read and reduced once. The reduced rows are written; their concepts are
    then looked up in one short table of known size, so no raw record ever meets the concept table.
    """
    extra = ["concept_id"] if with_vocabulary else []

    def one(label: str, table: str, key: str, concept_id: str, start: str, end: str) -> DataFrame:
        records = with_source(tables, table, key).filter(F.lower("src_id").startswith("ehr site"))
        rows = records.select(
            "person_id", F.lit(label).alias("domain"), F.col("src_id").alias("site"), F.col(concept_id).alias("concept_id"),
            F.col(start).alias("start"), F.col(end).alias("end"),
        )
        return rows.groupBy("person_id", "domain", "site", *extra).agg(F.min("start").alias("start"), F.max("end").alias("end"))

    reduced = reduce(DataFrame.unionByName, [one(*d) for d in fixed.RECORD_DOMAINS])
    if not with_vocabulary:
        return reduced
    reduced = materialise(reduced)
    concept = tables["concept"].select("concept_id", F.col("vocabulary_id").alias("vocabulary"))
    used = materialise(concept.join(reduced.select("concept_id").distinct(), "concept_id", "left_semi"))
    return reduced.join(used, "concept_id").select("person_id", "domain", "site", "vocabulary", "start", "end")


def data_cutoff(tables: Tables) -> Column:
    """The cutoff date of the data, from its one-row table."""
    return tables["_cdr_metadata"].select("ehr_cutoff_date").scalar()


def vocabulary_group(vocabulary: Column) -> Column:
    """Vocabulary under its report name; null if the report drops it."""
    return F.when(~vocabulary.isin(fixed.DROPPED_VOCABULARIES), recode(vocabulary, fixed.VOCABULARY_GROUPS))


# Measurements and concepts


def descendants(tables: Tables, ancestors: Sequence[int], name: str = "measurement_concept_id") -> DataFrame:
    """Concepts under the ancestors. Written out first, so the join knows its true size."""
    closure = tables["concept_ancestor"].filter(F.col("ancestor_concept_id").isin(list(ancestors)))
    return materialise(closure.select("ancestor_concept_id", F.col("descendant_concept_id").alias(name)).distinct())


def _measured_under(records: DataFrame, tree: DataFrame) -> DataFrame:
    """Records of the concepts of a tree. Unlike a semi join, the condition moves below the joins that the records are made of."""
    return records.filter(F.col("measurement_concept_id").isin(tree.select("measurement_concept_id")))


def _used_concepts(tables: Tables, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Names of the concepts that occur in the rows: a table as short as the code lists in use.

    Joining the rows to the whole concept table once per role would shuffle them every time, on keys
    as skewed as units are.
    """
    ids = rows.select(F.explode(F.array(*[F.col(c).cast("bigint") for c in columns])).alias("concept_id")).distinct()
    return materialise(
        tables["concept"].join(ids, "concept_id").select("concept_id", F.lower("concept_name").alias("concept_name"))
    )


def _role(names: DataFrame, concept_id: str, name: str) -> DataFrame:
    return names.select(F.col("concept_id").alias(concept_id), F.col("concept_name").alias(name))


def measurement_extract(tables: Tables, ancestors: Sequence[int]) -> DataFrame:
    """Measurements under the ancestors, from care sites."""
    records = _measured_under(tables["measurement"], descendants(tables, ancestors))
    source = tables["measurement_ext"].select("measurement_id", "src_id").filter(F.col("src_id").contains("EHR"))
    return records.join(source, "measurement_id").select(
        "person_id", "measurement_concept_id", "measurement_source_concept_id",
        F.lower("measurement_source_value").alias("measurement_source_value"), "value_as_number", "range_low", "range_high",
        F.lower("unit_source_value").alias("unit_source_value"), "operator_concept_id", "src_id", "measurement_datetime",
    ).distinct()


def lab_extract(tables: Tables, ancestors: Sequence[int]) -> DataFrame:
    """The full extract: numeric measurements with the names of their concepts in every role.

    Distinct rows are found and written with ids alone, so no name is shuffled and the measurements are read once. A name
    belongs to an id that is itself a column, and every lookup has distinct rows: what is joined to distinct rows stays distinct.
    """
    tree = descendants(tables, ancestors)
    records = _measured_under(tables["measurement"].filter(F.col("value_as_number").isNotNull()), tree)
    source = tables["measurement_ext"].select("measurement_id", "src_id").filter(F.lower("src_id").contains("ehr"))
    rows = materialise(
        records.join(source, "measurement_id").select(
            "person_id", "measurement_concept_id", "value_as_number", "range_low", "range_high", "unit_concept_id",
            "value_as_concept_id", "operator_concept_id", "measurement_datetime", "src_id", "measurement_source_concept_id",
            F.lower("measurement_source_value").alias("measurement_source_value"),
            F.lower("unit_source_value").alias("unit_source_value"),
        ).distinct()
    )
    roles = ["measurement_concept_id", "ancestor_concept_id", "operator_concept_id", "unit_concept_id"]
    names = _used_concepts(tables, rows.join(tree, "measurement_concept_id"), roles)
    measured = materialise(
        tree.join(_role(names, "measurement_concept_id", "measurement_concept_name"), "measurement_concept_id")
        .join(_role(names, "ancestor_concept_id", "ancestor_concept_name"), "ancestor_concept_id")
        .select("measurement_concept_id", "measurement_concept_name", "ancestor_concept_name").distinct()
    )
    answer, coded = tables["concept"].alias("c1"), tables["concept"].alias("c2")
    values = materialise(
        answer.filter(F.col("c1.domain_id") == "Meas Value")
        .join(coded, F.col("c1.concept_name") == F.col("c2.concept_code"))
        .select(F.col("c1.concept_id").alias("value_as_concept_id"), F.lower("c2.concept_name").alias("value_as_concept_name"))
        .distinct()
    )
    full = (
        rows.join(measured, "measurement_concept_id")
        .join(values, "value_as_concept_id", "left")
        .join(_role(names, "operator_concept_id", "operator_concept_name").distinct(), "operator_concept_id", "left")
        .join(_role(names, "unit_concept_id", "unit_concept_name").distinct(), "unit_concept_id", "left")
    )
    return full.select(
        "person_id", "measurement_concept_id", "measurement_concept_name", "ancestor_concept_name", "value_as_number",
        "range_low", "range_high", "unit_concept_id", "unit_concept_name", "value_as_concept_id", "value_as_concept_name",
        "operator_concept_id", "operator_concept_name", "measurement_datetime", "src_id", "measurement_source_concept_id",
        "measurement_source_value", "unit_source_value",
    )


def concept_name_map(tables: Tables, ancestors: Sequence[int]) -> DataFrame:
    """Distinct ids and names of measurements under the ancestors, with source, unit and operator."""
    names = {
        "measurement_concept_id": ("standard_concept_name", "measurement_concept_name"),
        "measurement_source_concept_id": ("source_concept_name", "measurement_source_concept_name"),
        "unit_concept_id": ("unit_concept_name", "unit_concept_name"),
        "operator_concept_id": ("operator_concept_name", "operator_concept_name"),
    }
    rows = tables["ds_measurement"].join(descendants(tables, ancestors), "measurement_concept_id", "left_semi")
    columns = [c for key, (source, name) in names.items() for c in (F.col(key), F.lower(source).alias(name))]
    return rows.select(*columns).distinct()


def concept_names(tables: Tables, ids: DataFrame, column: str) -> DataFrame:
    """Names of concepts given by id or by code: two equi-joins, as an OR would compare all pairs."""
    concept = tables["concept"]
    key = F.col(column).cast("string")
    wanted = ids.select(key.alias(column)).distinct()
    by_id = wanted.join(concept.select(F.col("concept_id").cast("string").alias(column), "concept_name"), column)
    by_code = wanted.join(concept.select(F.col("concept_code").alias(column), "concept_name"), column)
    return by_id.unionByName(by_code).distinct()


def report_name(kind: str, concept: Column) -> Column:
    """Name of a concept's report: by measure name, by lab id, or by kind and id."""
    words = kind.replace("_", " ")
    if "measurement" in words:
        return F.concat(F.replace(F.lower(concept.cast("string")), F.lit("-"), F.lit("_")), F.lit("_summary"))
    if "lab" in words:
        return F.concat(F.lit("measurement_"), concept.cast("string"))
    return F.concat(F.lit(f"{kind}_"), concept.cast("string"), F.lit("_summary"))


def phenotype_index(
    tables: Tables, phenotypes: DataFrame, by: str, kind: str, entity: str = "person_id", name_parts: Sequence[str] = ()
) -> DataFrame:
    """A row per concept column of a wide phenotype table: name, short name, report name, persons.

    ``by`` says whether the columns are named by ``concept_id`` or ``concept_code``. The table has one
    row per person, so the counts of all columns are row counts from one pass, combined map-side.
    """
    columns = [c for c in phenotypes.columns if c != entity]
    ids = fixed_table(phenotypes.sparkSession, [(c,) for c in columns], f"`{by}` string")
    concept = tables["concept"].select(F.col(by).cast("string").alias(by), F.lower("concept_name").alias("concept_name"))
    people = column_sums(phenotypes, [], columns, {"n_pids": lambda c: c.isNotNull()}, by)
    index = ids.join(concept.distinct(), by).join(people, by, "left").na.fill({"n_pids": 0})
    short = strip_parts(F.col("concept_name"), name_parts)
    return index.withColumn("short_name", short).withColumn("report_name", report_name(kind, F.col(by)))


def physical_measure_index(tables: Tables) -> DataFrame:
    """Concepts of the physical measures, with their report names."""
    concept = tables["concept"].select(F.col("concept_id").alias("measurement_concept_id"), F.lower("concept_name").alias("concept_name"))
    named = F.lower("measurement_source_value")
    rows = tables["measurement"].filter(named.isin(fixed.PHYSICAL_MEASURES)).select(
        "measurement_concept_id", named.alias("measurement_source_value")
    )
    index = rows.distinct().join(concept, "measurement_concept_id")
    return index.withColumn("report_name", report_name("physical_measurement", F.col("measurement_source_value")))


def lab_index(index: DataFrame) -> DataFrame:
    """A lab index with the report name of every concept."""
    return index.withColumn("report_name", report_name("lab", F.col("measurement_concept_id")))
