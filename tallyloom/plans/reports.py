"""Whole reports over health-records tables, put together from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_pct, suppressed_count_pct
from ..operators.crosstab import by_row_total, cross_tab, domain_cross_tab, entity_matrix, group_cross_tab, side_by_side
from ..operators.flags import (
    combo_groups, count_by_flag, count_by_flag_combo, flag_counts_by_population, flag_intersections, flag_lattice, flag_matrix,
    overlap_regions,
)
from ..operators.history import cumulative_entities, first_seen, periods, years_of_data, years_stats
from ..operators.shares import fixed_table, position
from ..runtime import materialise
from ..operators.stats import box_stats, describe_by, entity_summary, pretty_histogram
from ..operators.strata import case_control_counts, measure_counts
from ..sources.files import concept_columns
from . import extracts, fixed_values as fixed

Tables = Mapping[str, DataFrame]
DATA_TYPES = list(fixed.DATA_TYPE_FLAGS)
DEMOGRAPHIC_ORDERS = {
    "race": fixed.RACE_ORDER, "ethnicity": fixed.ETHNICITY_ORDER, "sex_at_birth": fixed.SEX_ORDER,
    "gender_identity": fixed.GENDER_ORDER, "age_group": fixed.AGE_ORDER, "income": fixed.INCOME_ORDER,
    "education": fixed.EDUCATION_ORDER, "employment": fixed.EMPLOYMENT_ORDER,
    "sexual_orientation": fixed.ORIENTATION_ORDER, "self_reported_race": fixed.SELF_REPORTED_RACE_ORDER,
}


def headline_report(tables: Tables) -> DataFrame:
    """Distinct persons per headline."""
    return extracts.labelled_counts(extracts.headline_sources(tables), "person_id")


def population_flags(tables: Tables) -> DataFrame:
    """Data-type flags and the two sub-populations, one row per person."""
    cohorts = {
        "AIAN": extracts.survey_cohort(tables, fixed.QUESTIONS["race"], fixed.AIAN_ANSWER),
        "WEAR": extracts.consent_cohort(tables),
    }
    return flag_matrix(extracts.data_type_flags(tables), "person_id", cohorts)


def data_type_report(tables: Tables, combinations: bool = False) -> DataFrame:
    """Persons per data type (or per combination) for the whole data and both sub-populations.

    All three are read from one lattice of data types and populations.
    """
    sets = flag_lattice(population_flags(tables), "person_id", DATA_TYPES, ["AIAN", "WEAR"])
    populations = {"Whole CDR": sets, "AIAN": sets.filter("AIAN = 1"), "WEAR": sets.filter("WEAR = 1")}
    keys = ["label", "combo"] if combinations else ["data_type"]
    cell = count_pct(F.col("n"), F.col("ratio")).alias("cell")

    def count(rows: DataFrame) -> DataFrame:
        if combinations:
            return count_by_flag_combo(rows, "person_id", DATA_TYPES, total=fixed.ALL_PARTICIPANTS, zero=fixed.NO_DATA_TYPES)
        return count_by_flag(rows, "person_id", DATA_TYPES)

    return side_by_side({name: count(rows).select(*keys, cell) for name, rows in populations.items()}, keys, "cell")


def add_on_report(tables: Tables) -> DataFrame:
    """Further data types for every population."""
    cohorts = population_flags(tables).select("person_id", "AIAN", "WEAR")
    people = extracts.add_on_flags(tables).join(cohorts, "person_id", "left")
    flags = ["Long_Read_WGS", "Structural_Variant", "WGS_OR_Array", "WGS_AND_Array"]
    return flag_counts_by_population(people, "person_id", flags, {"Whole CDR": None, "AIAN": "AIAN", "WEAR": "WEAR"}, unique=True)


def demographic_report(tables: Tables, demographic: str) -> DataFrame:
    """One demographic by all data types for the whole data and both sub-populations."""
    several = demographic == "self_reported_race"
    answers = extracts.self_reported_race(tables) if several else extracts.demographics(tables)
    table = cross_tab(
        population_flags(tables), answers.select("person_id", demographic), "person_id", demographic,
        fixed.DATA_TYPE_COHORTS, {"Whole CDR": None, "AIAN": "AIAN", "WEAR": "WEAR"},
        DEMOGRAPHIC_ORDERS[demographic], multi_counted=several, one_answer=not several,
    )
    title = F.lit(fixed.DEMOGRAPHIC_TITLES[demographic])
    return table.withColumn("variable", title).withColumn("label", count_pct(F.col("n"), F.col("ratio")))


def genomics_report(tables: Tables, name: str) -> tuple[DataFrame, DataFrame]:
    """Race groups and data-type combinations of persons with one genomic type, or 'A and B'."""
    people, answers = extracts.genomic_people(tables)
    wanted = [name.split(" ")[0], name.split(" ")[-1]]
    chosen = (F.col(wanted[0]) == 1) & (F.col(wanted[1]) == 1)
    members = people.filter(chosen).select("person_id")
    races = combo_groups(answers.join(members, "person_id", "left_semi"), "person_id", "race", fixed.RACE_GROUPS)
    combinations = flag_intersections(people, "person_id", chosen, name, fixed.DATA_TYPE_COMBINATIONS, unique=True)
    return races, combinations


def record_history(tables: Tables) -> DataFrame:
    """Periods of data per person, domain, site and vocabulary, and over any domain.

    Written out, as all history reports start from it.
    """
    return materialise(
        periods(
            extracts.domain_records(tables), "person_id", ["domain", "site", "vocabulary"], "start", "end",
            extracts.data_cutoff(tables), fixed.ANY_DOMAIN,
        )
    )


def years_report(history: DataFrame) -> DataFrame:
    """Years of data per domain."""
    return years_stats(years_of_data(history, "person_id", "domain"), "domain")


def growth_report(tables: Tables, from_year: int = 2010) -> DataFrame:
    """Share of persons with records up to each year, per domain."""
    first = first_seen(extracts.domain_records(tables, with_vocabulary=False), "person_id", "domain", "start")
    size = tables["person"].agg(F.count_distinct("person_id"))
    series = cumulative_entities(first, "person_id", "domain", "year", size, fixed.ANY_DOMAIN)
    return series.filter(F.col("year") >= from_year)


def period_growth_report(tables: Tables, history: DataFrame, from_year: int = 2010) -> DataFrame:
    """Share of persons with periods that began up to each year, per domain; years without newcomers stay."""
    size = tables["person"].agg(F.count_distinct("person_id"))
    begun = history.select("person_id", "domain", F.year("start").alias("year"))
    series = cumulative_entities(begun, "person_id", "domain", "year", size)
    return series.filter(F.col("year") >= from_year)


def overlap_report(tables: Tables, exclude: Sequence[str] = ()) -> DataFrame:
    """Persons in every exclusive overlap of the data types, small cells masked; genomics is either kind."""
    people = extracts.data_type_flags(tables)
    genomics = F.when((F.col("WGS") == 1) | (F.col("Array") == 1), 1).otherwise(0)
    types = [c for c in ("Genomics", "PPI", "EHR", "Fitbit", "PM") if c not in exclude]
    return overlap_regions(people.withColumn("Genomics", genomics), "person_id", types)


def demographic_history_report(tables: Tables, history: DataFrame, variable: str) -> DataFrame:
    """Persons per category and domain, suppressed, in report order; unlisted categories left out."""
    table = domain_cross_tab(extracts.history_demographics(tables), history, "person_id", variable, "domain")
    place = position(F.col("category"), fixed.HISTORY_ORDERS[variable], exact=False)
    shown = table.withColumn("sort_ord", place).filter(place.isNotNull())
    return shown.withColumn("label", suppressed_count_pct(F.col("n"), F.col("ratio")))


def group_history_report(tables: Tables, history: DataFrame) -> DataFrame:
    """Persons per under-represented group and domain, suppressed."""
    flags = [*fixed.GROUP_FLAGS, "ubr_overall"]
    table = group_cross_tab(
        extracts.group_flags(tables), history, "person_id", flags, "domain", fixed.GROUP_LABELS, prefix="ubr_"
    )
    return table.withColumn("label", suppressed_count_pct(F.col("n"), F.col("ratio")))


def site_report(history: DataFrame, denominator: DataFrame, which: str = "domain") -> DataFrame:
    """Persons per site and domain or vocabulary, with totals, suppressed, largest site first."""
    if which == "domain":
        matrix = entity_matrix(history, "person_id", "site", "domain", denominator, any_col=None)
    else:
        grouped = history.withColumn("vocabulary", extracts.vocabulary_group(F.col("vocabulary")))
        matrix = entity_matrix(grouped, "person_id", "site", "vocabulary", denominator)
    return by_row_total(matrix).withColumn("label", suppressed_count_pct(F.col("n"), F.col("ratio")))


STRATA = [["age_group"], ["sex_at_birth"], ["ancestry"], ["sex_at_birth", "ancestry"], ["age_group", "ancestry"]]


def person_strata(demographics: DataFrame, ancestry: DataFrame) -> DataFrame:
    """Age group, sex and ancestry per person; null if the person is not in the table.

    A person who is in the table without a value belongs to the category 'NA'.
    """

    def filled(table: DataFrame, columns: list[str]) -> DataFrame:
        return table.select("person_id", *[F.coalesce(c, F.lit("NA")).alias(c) for c in columns])

    return filled(demographics, ["age_group", "sex_at_birth"]).join(filled(ancestry, ["ancestry"]), "person_id", "full")


def case_control_report(tables: Tables, phenotypes: DataFrame, strata: DataFrame) -> DataFrame:
    """Cases and controls of every concept of a phenotype table by the five breakdowns, with its name.

    A person counts in a breakdown if it is in the tables the breakdown needs.
    """
    concepts = concept_columns(phenotypes)
    counts = case_control_counts(phenotypes, "person_id", concepts, strata, STRATA, known_only=True)
    ids = fixed_table(phenotypes.sparkSession, [(c,) for c in concepts], "concept string")
    return counts.join(extracts.concept_names(tables, ids, "concept"), "concept", "left")


def measure_report(measures: DataFrame, strata: DataFrame) -> DataFrame:
    """Persons with a value of every measure by the five breakdowns."""
    columns = concept_columns(measures)
    of = {
        "age_group": "measure", "sex_at_birth": "measure", "ancestry": "measure",
        "sex_at_birth x ancestry": ["ancestry"], "age_group x ancestry": ["ancestry"],
    }
    return measure_counts(measures, "person_id", columns, strata, STRATA, of, known_only=True)


def family_history_index(tables: Tables, phenotypes: DataFrame) -> DataFrame:
    """The index of a family-history table, ordered by names without the question's stem."""
    index = extracts.phenotype_index(tables, phenotypes, "concept_id", "pfhh_survey", name_parts=fixed.FAMILY_HISTORY_PARTS)
    return index.orderBy("short_name", "concept_id")


def lab_report(tables: Tables, ancestors: list[int]) -> dict[str, DataFrame]:
    """Everything about a lab in four tables, for all given concepts together.

    The extract is written out once; ``people`` is what ``write_by_concept`` delivers.
    """
    rows = materialise(extracts.lab_extract(tables, ancestors).withColumnRenamed("ancestor_concept_name", "lab"))
    sites = rows.withColumn("site", F.replace("src_id", F.lit("EHR site "), F.lit("#")))
    who = F.struct("lab", "person_id")
    people = entity_summary(
        rows.withColumn("who", who), "who", "value_as_number", "measurement_datetime", "unit_concept_name"
    )
    return {
        "statistics": describe_by(sites, ["lab", "site"], "value_as_number"),
        "boxes": box_stats(sites, ["lab", "site"], "value_as_number"),
        "histogram": pretty_histogram(rows, "value_as_number", ["lab"]),
        "people": people.select("who.lab", "who.person_id", *[c for c in people.columns if c != "who"]),
    }
