"""The order and document tables in the roles the operators need."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.flags import flag_matrix
from ..operators.history import Domain
from ..operators.shares import fixed_table
from . import fixed_values as fixed

FLAGS = ["has_events", "household", "high_balance", "high_value_order", "has_urgent"]
HIGH_VALUE = 490_000
HIGH_BALANCE = 5_000


class ParquetTables(Mapping):
    """``name`` -> the parquet file of that name; its schema is read once per instance."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder
        self._schemas: dict[str, StructType] = {}

    def __getitem__(self, name: str) -> DataFrame:
        path = f"{self._folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def __iter__(self) -> Iterator[str]:
        return iter(())

    def __len__(self) -> int:
        return 0


def customers(t: ParquetTables) -> DataFrame:
    """Customers with nation and region names."""
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return t["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("c_custkey", "person_id")


def customer_flags(t: ParquetTables) -> DataFrame:
    """One row per customer: five overlapping flags and two sub-populations."""
    orders = t["orders"]
    people = customers(t).select(
        "person_id",
        (F.col("c_mktsegment") == "HOUSEHOLD").cast("int").alias("household"),
        (F.col("c_acctbal") > HIGH_BALANCE).cast("int").alias("high_balance"),
        (F.col("r_name") == "ASIA").cast("int").alias("in_asia"),
    )
    members = {
        "has_events": t["events"].select(F.col("user_id").alias("person_id")),
        "high_value_order": orders.filter(F.col("o_totalprice") > HIGH_VALUE).select(F.col("o_custkey").alias("person_id")),
        "has_urgent": orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("person_id")),
    }
    return flag_matrix(people, "person_id", members)


def lines(t: ParquetTables) -> DataFrame:
    """Order lines with their customer as the person and the supplier's nation as the site.

    Suppliers and nations are joined one by one and before the orders: each is broadcast by the size of its own file, where
    that of their join could only be guessed, and lines that a filter of the site drops are dropped before any shuffle.
    """
    orders = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person_id"))
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nations = t["nation"].select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("site"))
    return t["lineitem"].join(suppliers, "l_suppkey").join(nations, "s_nationkey").join(orders, "l_orderkey")


def typed_lines(t: ParquetTables) -> DataFrame:
    """Order lines with the part's type as the concept."""
    parts = t["part"].select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("concept"))
    return lines(t).join(parts, "l_partkey")


HISTORY_DOMAINS = [
    Domain("Order", "orders", "o_orderdate", "o_orderdate", {"code": "o_orderpriority"}),
    Domain("Line", "lines", "l_shipdate", "l_shipdate", {"code": "l_returnflag"}),
    Domain("Event", "events", "ts", "open_end", {"code": "event_type"}),
]


def history_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """Record tables of three domains; events have no end, so theirs is the cutoff."""
    orders = t["orders"].withColumnRenamed("o_custkey", "person_id")
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"), "person_id")
    events = t["events"].withColumnRenamed("user_id", "person_id")
    return {
        "orders": orders,
        "lines": t["lineitem"].join(keys, "l_orderkey"),
        "events": events.withColumn("open_end", F.lit(None).cast(dict(events.dtypes)["ts"])),
    }


def cutoff(t: ParquetTables):
    """The last ship date stands for the cutoff of the data."""
    return t["lineitem"].agg(F.max("l_shipdate")).scalar()


def record_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """Measurements and concepts: lines measured as their part type, under the region of the supplier.

    Nations are the measured concepts, regions their ancestors, flags the units and operators.
    """
    rows = lines(t)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    unit = F.when(F.col("l_returnflag") == "A", 1001).when(F.col("l_returnflag") == "N", 1002)
    operator = F.when(F.col("l_linestatus") == "O", 2001)
    answer = F.when(F.col("l_linenumber") == 1, 3001)
    nations, regions = t["nation"], t["region"]

    def concept(rows: DataFrame, concept_id, name, code, domain: str) -> DataFrame:
        return rows.select(
            concept_id.cast("bigint").alias("concept_id"), name.alias("concept_name"), code.alias("concept_code"),
            F.lit("Custom").alias("vocabulary_id"), F.lit(domain).alias("domain_id"),
        )

    def from_flags(column: str, ids: dict[str, int], domain: str) -> DataFrame:
        flags = t["lineitem"].select(F.col(column).alias("flag")).distinct().filter(F.col("flag").isin(list(ids)))
        number = F.coalesce(*[F.when(F.col("flag") == flag, code) for flag, code in ids.items()])
        return concept(flags, number, F.concat(F.lit(f"{domain} "), F.col("flag")), F.concat(F.lit(f"{domain}-"), F.col("flag")), domain)

    # An answer whose name is the code of another concept.
    answers = concept(
        regions.filter(F.col("r_regionkey") == 0), F.lit(3001), F.lit("NATION_3-CODE"), F.lit("ANSWER"), "Meas Value"
    )
    concepts = (
        concept(nations, F.col("n_nationkey") + 100, F.col("n_name"), F.concat("n_name", F.lit("-CODE")), "Measurement")
        .unionByName(concept(regions, F.col("r_regionkey") + 500, F.col("r_name"), F.concat("r_name", F.lit("-CODE")), "Measurement"))
        .unionByName(from_flags("l_returnflag", {"A": 1001, "N": 1002}, "Unit"))
        .unionByName(from_flags("l_linestatus", {"O": 2001}, "Operator"))
        .unionByName(answers)
    )
    measured = rows.select(
        key.alias("measurement_id"), "person_id", (F.col("s_nationkey") + 100).cast("bigint").alias("measurement_concept_id"),
        F.col("l_partkey").alias("measurement_source_concept_id"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("measurement_source_value"),
        F.when(F.col("l_quantity") > 2, F.col("l_extendedprice")).alias("value_as_number"),
        F.col("l_discount").alias("range_low"), F.col("l_tax").alias("range_high"),
        unit.cast("bigint").alias("unit_concept_id"), F.col("l_returnflag").alias("unit_source_value"),
        operator.cast("bigint").alias("operator_concept_id"), answer.cast("bigint").alias("value_as_concept_id"),
        F.col("l_shipdate").alias("measurement_datetime"),
    )
    number = F.col("l_linenumber")
    source = F.when(number == 7, F.lit("Portal")).otherwise(F.concat(F.lit("EHR site "), number.cast("string")))
    return {
        "measurement": measured,
        "measurement_ext": t["lineitem"].select(key.alias("measurement_id"), source.alias("src_id")),
        "concept": concepts,
        "concept_ancestor": nations.select(
            (F.col("n_regionkey") + 500).cast("bigint").alias("ancestor_concept_id"),
            (F.col("n_nationkey") + 100).cast("bigint").alias("descendant_concept_id"),
        ),
        "ds_measurement": measured.select(
            "measurement_concept_id", "measurement_source_concept_id", "unit_concept_id", "operator_concept_id",
            F.concat(F.lit("Nation "), F.col("measurement_concept_id").cast("string")).alias("standard_concept_name"),
            F.col("measurement_source_value").alias("source_concept_name"),
            F.concat(F.lit("Unit "), F.col("unit_source_value")).alias("unit_concept_name"),
            F.concat(F.lit("Operator "), F.col("operator_concept_id").cast("string")).alias("operator_concept_name"),
        ),
    }


# Health-records tables from the order tables: every order is an answer, every line a record.

QUESTION_OF = {
    "1-URGENT": "race", "2-HIGH": "sex_at_birth", "3-MEDIUM": "income", "4-NOT SPECIFIED": "education",
    "5-LOW": "sexual_orientation",
}
STATUSES = ["F", "O", "P"]
ANSWERS = {
    "race": ["What Race Ethnicity: White", "What Race Ethnicity: AIAN", "PMI: Skip"],
    "sex_at_birth": ["Sex At Birth: Female", "Sex At Birth: Male", "Sex At Birth: Sex At Birth None Of These"],
    "income": ["Annual Income: less 10k", "Annual Income: 10k 25k", "PMI: Prefer Not To Answer"],
    "education": ["Highest Grade: College Graduate", "Highest Grade: Never Attended", "PMI: Skip"],
    "sexual_orientation": ["Sexual Orientation: none", "Sexual Orientation: Straight", "Sexual Orientation: Gay"],
}
CODES = {
    "race": ["WhatRaceEthnicity_White", "WhatRaceEthnicity_AIAN", "PMI_Skip"],
    "sex_at_birth": ["SexAtBirth_Female", "SexAtBirth_Male", "SexAtBirth_SexAtBirthNoneOfThese"],
    "income": ["AnnualIncome_more200k", "AnnualIncome_10k25k", "PMI_Skip"],
    "education": ["HighestGrade_CollegeGraduate", "HighestGrade_NeverAttended", "PMI_Skip"],
    "sexual_orientation": ["PMI_Skip", "SexualOrientation_Straight", "SexualOrientation_Gay"],
}
RACE_CODES = {
    "BUILDING": "WhatRaceEthnicity_White", "MACHINERY": "WhatRaceEthnicity_Black", "HOUSEHOLD": "PMI_Skip",
    "AUTOMOBILE": "WhatRaceEthnicity_Asian",
}
RACES = {
    "BUILDING": "White", "MACHINERY": "Black or African American", "HOUSEHOLD": "None of these",
    "AUTOMOBILE": "I prefer not to answer",
}
GENDER_CODES = {
    "AFRICA": "GenderIdentity_Woman", "AMERICA": "GenderIdentity_Man", "ASIA": "GenderIdentity_NonBinary", "EUROPE": "PMI_Skip",
}
VOCABULARIES = ["LOINC", "ICD10CM", "ICD10PCS", "RxNorm Extension", "Visit", "NDC", "None"]


def _case(column: str, values: dict, kind: str = "string") -> Column:
    chosen = F.lit(None).cast(kind)
    for value, result in values.items():
        chosen = F.when(F.col(column) == value, F.lit(result)).otherwise(chosen)
    return chosen


def _by_answer(texts: dict[str, list]) -> Column:
    chosen = F.lit(None).cast("string")
    for priority, question in QUESTION_OF.items():
        for status, text in zip(STATUSES, texts[question]):
            hit = (F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == status)
            chosen = F.when(hit, F.lit(text)).otherwise(chosen)
    return chosen


def survey_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """Customers as persons, their orders as survey answers and coded observations."""
    flags = customer_flags(t).select("person_id", *FLAGS, "in_asia")
    people = customers(t).join(flags, "person_id")
    balance = F.col("c_acctbal")
    age = F.floor(F.abs(balance) / 100).cast("int")
    question = _case("o_orderpriority", {p: fixed.QUESTIONS[q] for p, q in QUESTION_OF.items()}, "bigint")
    status = _case("o_orderstatus", {"F": 0, "O": 1, "P": 2}, "bigint")
    concept_id = 7000 + F.substring("o_orderpriority", 1, 1).cast("bigint") * 10 + status
    orders = t["orders"]
    answers = [
        (7000 + 10 * (i + 1) + j, text, f"a{i}{j}", "PPI", "Answer")
        for i, q in enumerate(QUESTION_OF.values()) for j, text in enumerate(ANSWERS[q])
    ]
    ethnicities = [
        (901, "Not Hispanic or Latino", "nh", "Ethnicity", "Ethnicity"), (902, "Hispanic or Latino", "h", "Ethnicity", "Ethnicity"),
    ]
    region = F.col("r_name")
    sex = F.when(balance < 0, "SexAtBirth_Intersex").when(balance < 4000, "SexAtBirth_Female").when(balance < 9000, "SexAtBirth_Male")
    ethnicity = F.when(region == "ASIA", "Hispanic or Latino").when(region == "EUROPE", "No matching concept")
    return {
        "person": people.select(
            "person_id",
            _case("c_mktsegment", RACE_CODES).alias("race_source_value"),
            _case("r_name", {"ASIA": "WhatRaceEthnicity_Hispanic"}).alias("ethnicity_source_value"),
            sex.alias("sex_at_birth_source_value"),
            _case("r_name", GENDER_CODES).alias("gender_source_value"),
            F.when(region.isin("ASIA", "EUROPE"), 902).otherwise(901).cast("bigint").alias("ethnicity_concept_id"),
        ),
        "cb_search_person": people.select(
            "person_id",
            _case("c_mktsegment", RACES).alias("race"),
            ethnicity.otherwise("Not Hispanic or Latino").alias("ethnicity"),
            age.alias("age_at_cdr"), (age - 1).alias("age_at_consent"),
            F.col("has_urgent").alias("has_ppi_survey_data"), F.col("household").alias("has_physical_measurement_data"),
            F.col("has_events").alias("has_ehr_data"), F.col("high_balance").alias("has_fitbit"),
            F.col("high_value_order").alias("has_whole_genome_variant"), F.when(F.col("in_asia") == 1, 1).alias("has_array_data"),
            (balance > 6000).cast("int").alias("has_lr_whole_genome_variant"),
            F.when(F.col("c_mktsegment") == "BUILDING", 1).alias("has_structural_variant_data"),
        ),
        "person_ext": orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
            F.col("o_custkey").alias("person_id"), _by_answer(CODES).alias("self_reported_category_source_value")
        ),
        "wear_study": people.select("person_id", F.when(balance > 8000, "Yes").otherwise("No").alias("resultsconsent_wear")),
        "ds_survey": orders.select(
            F.col("o_custkey").alias("person_id"), question.alias("question_concept_id"), _by_answer(ANSWERS).alias("answer")
        ),
        "observation": orders.select(
            F.col("o_custkey").alias("person_id"), question.alias("observation_source_concept_id"),
            concept_id.alias("value_source_concept_id"), _by_answer(CODES).alias("value_source_value"),
        ),
        "concept": fixed_table(
            t.spark, answers + ethnicities,
            "concept_id bigint, concept_name string, concept_code string, vocabulary_id string, domain_id string",
        ),
    }


def domain_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """Lines, orders and events as the records of seven domains, each with its table of sources."""
    orders, events = t["orders"], t["events"]
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person_id"))
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    number = F.col("l_linenumber")
    line_rows = t["lineitem"].join(keys, "l_orderkey").select(
        key.alias("id"), "person_id", number.cast("bigint").alias("concept"), F.col("l_shipdate").alias("start"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("end"), F.col("l_returnflag").alias("part"),
    )
    line_sources = t["lineitem"].select(
        key.alias("id"), F.when(number == 7, "Portal").otherwise(F.concat(F.lit("EHR site "), number.cast("string"))).alias("src_id"),
        F.col("l_returnflag").alias("part"),
    )
    digit = F.substring("o_orderpriority", 1, 1)
    order_rows = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person_id"), digit.cast("bigint").alias("concept"),
        F.col("o_orderdate").alias("start"), F.col("o_orderdate").alias("end"), F.col("o_orderstatus").alias("part"),
    )
    order_sources = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("EHR site "), digit).alias("src_id"), F.col("o_orderstatus").alias("part")
    )
    event_rows = events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("person_id"), F.lit(5).cast("bigint").alias("concept"),
        F.col("ts").alias("start"), F.col("ts").alias("end"), F.lit("E").alias("part"),
    )
    event_sources = events.select(F.col("event_id").alias("id"), F.lit("EHR site 9").alias("src_id"), F.lit("E").alias("part"))
    parts = [
        (line_rows, line_sources, "A"), (line_rows, line_sources, "N"), (line_rows, line_sources, "R"), (order_rows, order_sources, "F"),
        (order_rows, order_sources, "O"), (order_rows, order_sources, "P"), (event_rows, event_sources, "E"),
    ]
    tables = {}
    for (_, table, key_name, concept, start, end), (rows, sources, part) in zip(fixed.RECORD_DOMAINS, parts):
        ends = [] if start == end else [F.col("end").alias(end)]
        mine = F.col("part") == part
        tables[table] = rows.filter(mine).select(
            F.col("id").alias(key_name), "person_id", F.col("concept").alias(concept), F.col("start").alias(start), *ends
        )
        tables[f"{table}_ext"] = sources.filter(mine).select(F.col("id").alias(key_name), "src_id")
    concepts = [(i + 1, v) for i, v in enumerate(VOCABULARIES)]
    tables["concept"] = fixed_table(t.spark, concepts, "concept_id bigint, vocabulary_id string")
    tables["_cdr_metadata"] = t["lineitem"].agg(F.max("l_shipdate").alias("ehr_cutoff_date"))
    tables["person"] = t["customer"].select(F.col("c_custkey").alias("person_id"))
    return tables


def headline_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """The record domains with self-brought sources, and what else the headline counts look at."""
    tables, survey = domain_tables(t), survey_tables(t)
    for name in [n for n in tables if n.endswith("_ext")]:
        own = F.when(F.col("src_id") == "Portal", "Participant Mediated EHR").otherwise(F.col("src_id"))
        tables[name] = tables[name].withColumn("src_id", own)
    orders, events, number = t["orders"], t["events"], F.col("l_linenumber")
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person_id"))
    education = F.col("question_concept_id") == fixed.QUESTIONS["education"]
    question = F.when(education, fixed.SUBCATEGORY_QUESTIONS[0]).otherwise(F.col("question_concept_id"))
    return tables | {
        "ds_survey": survey["ds_survey"].withColumn("question_concept_id", question),
        "wear_study": survey["wear_study"],
        "measurement": t["lineitem"].filter(F.col("l_returnflag") == "A").join(keys, "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("measurement_id"), "person_id",
            F.when(number <= 2, fixed.SELF_REPORTED_TYPE).alias("measurement_type_concept_id"),
            F.when(number == 1, fixed.SELF_REPORTED_HEIGHT).otherwise(fixed.SELF_REPORTED_WEIGHT).alias("measurement_source_concept_id"),
        ),
        "person_ext": t["customer"].filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("person_id")),
        "survey_conduct": events.select(
            F.col("event_id").alias("survey_conduct_id"), F.col("user_id").alias("person_id"),
            F.when(F.col("event_type") == "view", fixed.LIFE_FUNCTIONING_SURVEY).alias("survey_source_concept_id"),
        ),
        "survey_conduct_ext": events.select(
            F.col("event_id").alias("survey_conduct_id"), F.when(F.col("event_type") == "click", "Portal TPC").otherwise("Portal").alias("src_id")
        ),
        "concept_ancestor": fixed_table(t.spark, [(fixed.LIFE_FUNCTIONING_SURVEY, 2)], "ancestor_concept_id bigint, descendant_concept_id bigint"),
        "deaths": orders.filter(F.col("o_totalprice") > HIGH_VALUE).select(
            F.col("o_custkey").alias("person_id"), F.when(F.col("o_orderstatus") == "F", "HealthPro form").otherwise("EHR").alias("src_id")
        ),
    }


def person_tables(t: ParquetTables) -> tuple[DataFrame, DataFrame]:
    """Age group and sex of most persons, ancestry of others: each table lacks some, and some values are missing."""
    people, balance = customers(t), F.col("c_acctbal")
    demographics = people.filter(F.col("r_name") != "AFRICA").select(
        "person_id", F.when(balance < 3000, "young").otherwise("old").alias("age_group"),
        F.when(balance.between(0, 5000), "Female").when(balance > 5000, "Male").alias("sex_at_birth"),
    )
    ancestry = people.filter(F.col("c_mktsegment") != "MACHINERY").select("person_id", F.col("r_name").alias("ancestry"))
    return demographics, ancestry


def phenotypes(t: ParquetTables) -> DataFrame:
    """Wide yes/no columns per customer, named by concept id or code; two have cases only."""
    orders = t["orders"]
    return orders.groupBy(F.col("o_custkey").alias("person_id")).agg(
        F.max(F.col("o_orderstatus") == "F").alias("101"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", True)).alias("102"),
        F.max(F.col("o_totalprice") > HIGH_VALUE).alias("NATION_3-CODE"),
        F.max(F.when(F.col("o_orderpriority") == "5-LOW", True)).alias("104"),
    )


def measures(t: ParquetTables) -> DataFrame:
    """Wide measure columns per customer, with gaps."""
    spent = t["orders"].groupBy("o_custkey").agg(F.max("o_totalprice").alias("largest"))
    return t["customer"].join(spent, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("person_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("largest") > HIGH_VALUE, F.col("largest")).alias("largest_order"),
    )


def physical_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """Lines as physical measurements, named by their number, and the concepts of some."""
    names = {1: "Weight", 2: "HEIGHT", 3: "Heart-Rate-Mean", 4: "blood-pressure-diastolic-mean"}
    named = F.coalesce(*[F.when(F.col("l_linenumber") == n, name) for n, name in names.items()], F.lit("other"))
    return {
        "measurement": t["lineitem"].select((F.col("l_linenumber") + 100).cast("bigint").alias("measurement_concept_id"), named.alias("measurement_source_value")),
        "concept": t["nation"].select((F.col("n_nationkey") + 100).cast("bigint").alias("concept_id"), F.col("n_name").alias("concept_name")),
    }


def family_tables(t: ParquetTables) -> dict[str, DataFrame]:
    """Nations as questions with a stem and an end that the index leaves out."""
    question = F.concat(F.lit("Including yourself, who in your family has had "), F.col("n_name"), F.lit("? Select all that apply."))
    return {"concept": t["nation"].select((F.col("n_nationkey") + 100).cast("bigint").alias("concept_id"), question.alias("concept_name"))}
