"""The query catalogue: every operator on the order, event and document tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    answer_text, any_of, band, clean_answer, clean_answer_stem_last, count_pct, pct_text,
    split_count_pct, suppress_cell, suppressed_count_pct, yes_no,
)
from ..operators import crosstab, flags, history, measures, plates, reshape, stats, strata
from ..operators.answers import recode_distinct
from ..operators.shares import order_columns, position, share, share_of_sum
from ..runtime import materialise, shared_folder
from ..sources import files
from . import bindings, extracts, fixed_values, reports
from .bindings import (
    FLAGS, HISTORY_DOMAINS, HIGH_BALANCE, HIGH_VALUE, ParquetTables, customer_flags, customers, cutoff, domain_tables,
    history_tables, lines, record_tables, survey_tables, typed_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "view", "error", "signup", "purchase"]
COHORTS = {
    "OVERALL": None, "EVENTS": "has_events", "HOUSEHOLD": "household", "BALANCE": "high_balance",
    "VALUE": "high_value_order", "URGENT": "has_urgent",
}
POPULATIONS = {"Whole": None, "Asia": "in_asia", "Events": "has_events"}


def query(function: Callable[[ParquetTables], DataFrame]) -> Callable[[ParquetTables], DataFrame]:
    """Register a query under its function name."""
    QUERIES[function.__name__] = lambda spark, folder: function(ParquetTables(spark, folder))
    return function


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round all doubles: sums of doubles depend on their order in the last bits."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def day(column: str) -> Column:
    return F.col(column).cast("date").cast("string").alias(column)


# Flags


@query
def flag_counts(t):
    return flags.count_by_flag(customer_flags(t), "person_id", FLAGS, unique=True)


@query
def n_flag_distribution(t):
    return flags.count_by_n_flags(customer_flags(t), "person_id", FLAGS, unique=True)


@query
def flag_combinations(t):
    return flags.count_by_flag_combo(customer_flags(t), "person_id", FLAGS, unique=True)


@query
def flag_table_labels(t):
    by_flag, by_number, by_combo = flags.flag_tables(customer_flags(t), "person_id", FLAGS, unique=True)
    cell = count_pct(F.col("n"), F.col("ratio")).alias("cell")
    parts = [
        by_flag.select(F.lit("flag").alias("part"), F.col("data_type").alias("row"), cell),
        by_number.select(F.lit("number").alias("part"), F.col("label").alias("row"), cell),
        by_combo.select(F.lit("combination").alias("part"), F.col("combo").alias("row"), cell),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def flag_counts_by_population(t):
    return flags.flag_counts_by_population(customer_flags(t), "person_id", FLAGS, POPULATIONS, unique=True)


@query
def overlap_regions(t):
    return flags.overlap_regions(customer_flags(t), "person_id", FLAGS, unique=True)


@query
def flag_intersections(t):
    combos = [[], ["has_events"], ["household"], ["household", "high_balance"], ["has_events", "household", "high_balance"]]
    chosen = (F.col("has_urgent") == 1) & (F.col("high_value_order") == 1)
    return flags.flag_intersections(customer_flags(t), "person_id", chosen, "urgent and high value", combos, unique=True)


@query
def flag_matrix(t):
    return customer_flags(t)


@query
def cohort_flags(t):
    """Cohort ids, flags derived from flags by AND and OR, null flags as 0."""
    orders = t["orders"]
    urgent_open = orders.filter((F.lower("o_orderpriority") == "1-urgent") & F.col("o_orderstatus").isin("O"))
    people = flags.flag_matrix(
        t["customer"].select(F.col("c_custkey").alias("person_id"), F.lower("c_mktsegment").alias("segment"), "c_acctbal"),
        "person_id",
        {
            "urgent_open": urgent_open.select(F.col("o_custkey").alias("person_id")),
            "early": orders.filter(F.year("o_orderdate").between(1995, 1996)).select(F.col("o_custkey").alias("person_id")),
        },
    )
    in_debt = F.coalesce(F.when(F.col("c_acctbal") < 0, 1), F.lit(0))
    return people.select(
        "person_id",
        "urgent_open",
        "early",
        in_debt.alias("in_debt"),
        F.when(F.col("segment").startswith("b") | F.col("segment").endswith("ery"), 1).otherwise(0).alias("builds"),
        F.when((F.col("urgent_open") == 1) | (F.col("early") == 1), 1).otherwise(0).alias("urgent_or_early"),
        F.when((F.col("urgent_open") == 1) & (F.col("early") == 1), 1).otherwise(0).alias("urgent_and_early"),
    )


@query
def headline_counts(t):
    orders, events = t["orders"], t["events"]
    person = F.col("o_custkey").alias("person_id")
    region = t["region"].filter(F.lower("r_name") == "asia")
    asia = t["nation"].join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    customer = F.col("c_custkey").alias("person_id")
    status, priority = orders["o_orderstatus"], F.lower("o_orderpriority")
    sources = {
        "Total": t["customer"].select(customer),
        "In Asia": t["customer"].join(asia, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(customer),
        "Low or unspecified priority": orders.filter(priority.endswith("low") | priority.contains("not spec")).select(person),
        "Not finished": orders.filter(~status.isin("F") & status.isNotNull()).select(person),
        "Any activity": orders.select(person).unionByName(events.select(F.col("user_id").alias("person_id"))).distinct(),
        "Purchase": events.filter(F.lower("event_type").startswith("purch")).select(F.col("user_id").alias("person_id")),
        "Very high value": orders.filter(F.col("o_totalprice") > HIGH_VALUE).select(person),
        "Unknown status": orders.filter(status.isNull()).select(person),
    }
    return extracts.labelled_counts(sources, "person_id")


# Category tables


@query
def category_cross_tab(t):
    answers = t["customer"].select(F.col("c_custkey").alias("person_id"), F.initcap("c_mktsegment").alias("segment"))
    order = ["Building", "Household", "Machinery", "Furniture", "Never Seen"]
    return crosstab.cross_tab(customer_flags(t), answers, "person_id", "segment", COHORTS, POPULATIONS, order, one_answer=True)


def _priorities(t) -> DataFrame:
    return t["orders"].select(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("priority"))


@query
def multi_answer_cross_tab(t):
    table = crosstab.cross_tab(
        customer_flags(t), _priorities(t), "person_id", "priority", COHORTS, POPULATIONS, PRIORITIES[:4], keep_unlisted=True
    )
    return table.withColumn("label", count_pct(F.col("n"), F.col("ratio")))


@query
def multi_counted_cross_tab(t):
    return crosstab.cross_tab(
        customer_flags(t), _priorities(t), "person_id", "priority", COHORTS, POPULATIONS, PRIORITIES, multi_counted=True
    )


@query
def cross_tab_wide(t):
    """The cross-tab as delivered: a label column per cohort and population, in key order."""
    table = multi_counted_cross_tab(t)
    cells = table.select(
        "category", "sort_ord", F.concat_ws("__", "cohort", "population").alias("_column"),
        count_pct(F.col("n"), F.col("ratio")).alias("_cell"),
    )
    names = [f"{c}__{p}" for c in COHORTS for p in POPULATIONS]
    wide = cells.groupBy("category", "sort_ord").pivot("_column", names).agg(F.first("_cell"))
    return order_columns(wide, ["category", "sort_ord"], ["OVERALL", "URGENT", "EVENTS"])


@query
def banded_counts(t):
    size = F.col("p_size")
    closed = band(size, [0, 9, 19, 29, 39], ["00-09", "10-19", "20-29", "30-39", "40+"])
    from_ten = band(size, [10, 19, 29, 39], ["10-19", "20-29", "30-39", "40+"])
    from_first = band(size, [10, 19, 29, 39], ["<20", "20-29", "30-39", "40+"], below="first")
    return (
        t["part"].select(closed.alias("closed"), from_ten.alias("from_ten"), from_first.alias("from_first"))
        .groupBy("closed", "from_ten", "from_first").agg(F.count(F.lit(1)).alias("n"))
    )


def _raw_answers(t) -> DataFrame:
    """Survey-like answers 'Stem: value' with refusals and catch-alls, several per person."""
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", "Priority: PMI none of these here")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Priority: prefer not to answer")
        .otherwise(F.concat(F.lit("Priority: less "), F.col("o_orderpriority"), F.lit("k o'b")))
    )
    return t["orders"].select(F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("year"), text.alias("answer"))


@query
def answer_cleaning(t):
    """Clean, then collapse several answers per person and year."""

    def clean(answer: Column) -> Column:
        return clean_answer(F.lower(answer_text(answer)), refused=["prefer not to answer"], names={"Less 1-UrgentK O'B": "Urgent"})

    cleaned = recode_distinct(_raw_answers(t), "answer", clean, "cleaned")
    one = flags.multi_answer(cleaned.select(F.struct("person_id", "year").alias("who"), "cleaned"), "who", "cleaned")
    return one.groupBy(F.col("cleaned").alias("answer")).agg(F.count(F.lit(1)).alias("n"))


@query
def answer_cleaning_stem_last(t):
    """Collapse on the raw text, then drop the stem and clean."""
    raw = _raw_answers(t).select(F.struct("person_id", "year").alias("who"), "answer")
    one = flags.multi_answer(raw, "who", "answer")
    counts = one.groupBy("answer").agg(F.count(F.lit(1)).alias("_n"))
    cleaned = clean_answer_stem_last(F.col("answer"), {"Prefer Not To Answer": "Not Specified"})
    return counts.groupBy(cleaned.alias("answer")).agg(F.sum("_n").alias("n"))


@query
def multi_answer_columns(t):
    """Two answer columns collapsed in one aggregation."""
    rows = t["orders"].select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") > HIGH_VALUE, "high").otherwise("usual").alias("value_class"),
    )
    return flags.multi_answer_columns(rows, "person_id", ["status", "value_class"])


@query
def combo_groups(t):
    """Orders by the list of return flags of their lines."""
    answers = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").distinct()
    everyone = t["orders"].select("o_orderkey").join(answers, "o_orderkey", "left")
    return flags.combo_groups(everyone, "o_orderkey", "l_returnflag", ["A", "N", "R", "A,N", "A,N,R", "None"])


# History


@query
def first_seen_year(t):
    rows = t["orders"].select(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("domain"), "o_orderdate")
    return history.first_seen(rows, "person_id", "domain", "o_orderdate", "Any")


def _years(t) -> DataFrame:
    return t["orders"].select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("domain"), F.year("o_orderdate").alias("year")
    )


@query
def cumulative_entities(t):
    size = t["customer"].agg(F.count_distinct("c_custkey"))
    return history.cumulative_entities(_years(t), "person_id", "domain", "year", size, "Any")


@query
def cumulative_entities_shown(t):
    """The years of the series that a chart shows; their sums still count all years before."""
    return cumulative_entities(t).filter(F.col("year").between(1996, 2001))


@query
def year_pivot(t):
    size = t["customer"].agg(F.count_distinct("c_custkey"))
    series = history.cumulative_entities(_years(t), "person_id", "domain", "year", size)
    wide = reshape.to_wide(series, ["year"], "domain", PRIORITIES, "cum_pct")
    return wide.toDF("year", *[f"p{i + 1}" for i in range(len(PRIORITIES))])


def _spans(t) -> DataFrame:
    records = history.union_domains(history_tables(t), HISTORY_DOMAINS, "person_id")
    return history.periods(records, "person_id", ["domain", "code"], "start", "end", cutoff(t), "Any")


@query
def periods(t):
    return _spans(t).select("person_id", "domain", "code", day("start"), F.col("end").cast("date").cast("string").alias("end"))


@query
def years_of_data(t):
    return rounded(history.years_of_data(_spans(t), "person_id", "domain"), 6)


@query
def years_stats(t):
    return history.years_stats(history.years_of_data(_spans(t), "person_id", "domain"), "domain")


def _events_by_person(t) -> DataFrame:
    return t["events"].select(F.col("user_id").alias("person_id"), F.col("event_type").alias("domain"))


@query
def domain_cross_tab(t):
    people = t["customer"].select(F.col("c_custkey").alias("person_id"), "c_mktsegment")
    table = crosstab.domain_cross_tab(people, _events_by_person(t), "person_id", "c_mktsegment", "domain")
    return table.withColumn("label", suppressed_count_pct(F.col("n"), F.col("ratio")))


@query
def domain_cross_tab_wide(t):
    """The same with a column per domain, absent cells 0."""
    wide = reshape.to_wide(domain_cross_tab(t), ["category"], "domain", [*EVENT_TYPES, "No Data", "All Pids"], "n")
    return wide.withColumnsRenamed({"No Data": "no_data", "All Pids": "all_pids"})


def _groups(t) -> DataFrame:
    """Yes/no rules per customer; of several orders one 'yes' is enough.

    Orders are reduced to one row per customer before they meet the customers, so one who placed a
    third of all orders is one row in the join.
    """
    segment = F.col("c_mktsegment")
    pressing = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > HIGH_VALUE)
    orders = t["orders"].select(F.col("o_custkey").alias("person_id"), yes_no(pressing).alias("grp_pressing_order"))
    per_person = flags.any_yes(orders, "person_id", ["grp_pressing_order"])
    people = t["customer"].withColumnRenamed("c_custkey", "person_id").join(per_person, "person_id", "left").select(
        "person_id",
        yes_no(segment.isNotNull() & ~segment.isin("BUILDING", "MACHINERY")).alias("grp_segment"),
        yes_no((F.col("c_acctbal") < 0) | (F.col("c_acctbal") >= 9_000)).alias("grp_balance"),
        F.coalesce("grp_pressing_order", F.lit("no")).alias("grp_pressing_order"),
    )
    names = ["grp_segment", "grp_balance", "grp_pressing_order"]
    return people.withColumn("grp_overall", any_of([F.col(n) for n in names]))


@query
def diversity_flags(t):
    return _groups(t)


@query
def diversity_cross_tab(t):
    names = ["grp_segment", "grp_balance", "grp_pressing_order", "grp_overall"]
    return crosstab.group_cross_tab(
        _groups(t), _events_by_person(t), "person_id", names, "domain", {"yes": "UBR", "no": "RBR"}, prefix="grp_"
    )


@query
def site_domain_matrix(t):
    records = lines(t).select("person_id", "site", F.col("l_returnflag").alias("domain"))
    size = t["customer"].agg(F.count_distinct("c_custkey"))
    matrix = crosstab.entity_matrix(records, "person_id", "site", "domain", size)
    return matrix.withColumn("label", suppressed_count_pct(F.col("n"), F.col("ratio")))


@query
def site_domain_matrix_wide(t):
    """The same with a column per domain, absent cells 0, the largest site first."""
    wide = reshape.to_wide(site_domain_matrix(t), ["row"], "col", ["A", "N", "R", "Any EHR"], "n")
    return wide.withColumnRenamed("Any EHR", "any_ehr").orderBy(F.desc("any_ehr"), "row")


@query
def site_vocabulary_matrix(t):
    groups = {"ECONOMY": "Others", "STANDARD": "Others", "LARGE": "Big", "PROMO": "PROMO"}
    bucket = F.when(~F.col("concept").isin("SMALL"), F.coalesce(F.try_element_at(
        F.create_map(*[F.lit(x) for pair in groups.items() for x in pair]), F.col("concept")), F.col("concept")))
    records = typed_lines(t).select("person_id", "site", bucket.alias("vocabulary"))
    size = t["customer"].agg(F.count_distinct("c_custkey"))
    return crosstab.by_row_total(crosstab.entity_matrix(records, "person_id", "site", "vocabulary", size))


# Case/control and measures


def _document_attributes(t) -> DataFrame:
    return t["documents"].select("doc_id", "lang", "source")


@query
def case_control_by_one(t):
    counts = strata.case_control_counts(
        t["labels"], "doc_id", ["quality", "toxic"], _document_attributes(t), [["lang"], ["source"]]
    )
    return counts


@query
def case_control_by_two(t):
    return strata.case_control_counts(
        t["labels"], "doc_id", ["quality", "toxic"], _document_attributes(t), [["lang", "source"]]
    )


@query
def case_control_five_sets(t):
    length = band(F.col("n_chars"), [0, 999, 4_999], ["short", "middle", "long"])
    attributes = t["documents"].select("doc_id", "lang", "source", length.alias("length"))
    sets = [["length"], ["lang"], ["source"], ["lang", "source"], ["length", "source"]]
    return strata.case_control_counts(t["labels"], "doc_id", ["quality", "toxic"], attributes, sets)


@query
def class_share(t):
    """Counts with the total of their class beside each row."""
    rows = t["labels"].join(_document_attributes(t), "doc_id")
    counts = rows.groupBy("lang", F.when(F.col("quality") == 1, "Cases").otherwise("Controls").alias("class")).agg(
        F.count_distinct("doc_id").alias("n")
    )
    return share_of_sum(counts, keys=["class"]).orderBy("class", "n", "lang")


@query
def measure_counts(t):
    wide = bindings.measures(t)
    attributes = customers(t).select("person_id", F.col("c_mktsegment").alias("segment"), F.col("r_name").alias("region"))
    return strata.measure_counts(
        wide, "person_id", ["balance", "largest_order"], attributes, [["segment"], ["region"], ["segment", "region"]],
        {"segment": "measure", "region": "overall", "segment x region": ["region"]},
    )


# Statistics


@query
def site_statistics(t):
    return rounded(stats.describe_by(lines(t), ["site"], "l_extendedprice", pin=True))


@query
def global_statistics(t):
    return rounded(stats.describe_by(t["lineitem"], [], "l_extendedprice"))


@query
def hot_group_statistics(t):
    """Groups of which each holds a large share of all rows."""
    return rounded(stats.describe_by(t["lineitem"], ["l_returnflag"], "l_extendedprice"))


@query
def approximate_statistics(t):
    """Sketched quantiles, checked by the share of rows below and up to them.

    The sketches are written first: the rows then meet a table of known size instead of being dealt and sorted by a few flags.
    """
    flag, price = "l_returnflag", "l_extendedprice"
    sketched = materialise(stats.describe_by(t["lineitem"], [flag], price, exact=False))
    names = [stats.quantile_name(p) for p in stats.REPORT_PROBS]
    rows = t["lineitem"].select(flag, price).join(sketched.select(flag, *names), flag)
    part = lambda condition: F.sum(condition.cast("int")) / F.count(price)
    near = [
        ((part(F.col(price) < F.col(name)) <= p + 0.001) & (part(F.col(price) <= F.col(name)) >= p - 0.001)).alias(f"{name}_in_rank")
        for p, name in zip(stats.REPORT_PROBS, names, strict=True)
    ]
    return rounded(sketched.select(flag, "n", "mean", "min", "max", "sd").join(rows.groupBy(flag).agg(*near), flag))


@query
def box_stats(t):
    return rounded(stats.box_stats(t["events"], ["event_type"], "value"))


@query
def histogram(t):
    return rounded(stats.histogram(t["events"], "value", 12, ["event_type"]))


@query
def pretty_histogram(t):
    return stats.pretty_histogram(t["customer"], "c_acctbal")


@query
def pretty_histogram_by_site(t):
    quantities = lines(t).select("site", "l_extendedprice")
    return rounded(stats.pretty_histogram(quantities, "l_extendedprice", ["site"]))


@query
def latest_value(t):
    return stats.latest(lines(t), "person_id", "l_shipdate", ["l_extendedprice"])


@query
def latest_with_unit_list(t):
    return stats.latest(lines(t), "person_id", "l_shipdate", ["l_extendedprice", "l_returnflag"], ties="all")


@query
def entity_summary(t):
    return rounded(stats.entity_summary(lines(t), "person_id", "l_quantity", "l_shipdate", "l_returnflag", pin=True))


@query
def entity_range(t):
    return rounded(stats.entity_range(lines(t), "person_id", "l_quantity", "l_shipdate", "l_returnflag", pin=True))


def _measured(t) -> DataFrame:
    """Lines as measurements: some without a value, some without a usable unit, two spellings of one."""
    unit = F.when(F.col("l_returnflag") == "A", "mg/dl").when(F.col("l_linestatus") == "O", "no value").otherwise("Percent")
    return typed_lines(t).select(
        "person_id", "concept", "site", "l_shipdate", F.col("l_linestatus").alias("operator"),
        F.concat_ws("-", "concept", "l_returnflag").alias("source_concept"),
        F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice")).alias("value"),
        F.when(F.col("l_quantity") > 1, F.col("l_linenumber")).alias("unit_id"),
        unit.alias("unit"),
    )


@query
def measure_qc_presence(t):
    return measures.value_presence(_measured(t), "person_id", ["source_concept", "concept", "unit", "operator"], "value")


@query
def measure_qc_values(t):
    return rounded(measures.value_quality(_measured(t), ["concept", "unit"], "value"))


@query
def clean_measure(t):
    cleaned = measures.clean_measure(
        _measured(t), "value", "unit_id", "unit", fixed_values.UNUSABLE_UNITS, fixed_values.UNIT_SYNONYMS
    )
    return rounded(cleaned.groupBy("concept", "unit").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 2)


def _with_outliers(t) -> DataFrame:
    """Prices per brand and type; those of the largest sizes are blown up or negative."""
    price, size = F.col("p_retailprice"), F.col("p_size")
    value = F.when(size == 50, price * 6).when(size == 49, -price * 9).when(size == 48, -1.0).otherwise(price)
    return t["part"].select("p_partkey", "p_brand", "p_type", value.alias("value"))


@query
def extreme_limits(t):
    return measures.extreme_limits(_with_outliers(t), ["p_brand", "p_type"], "value")


@query
def drop_extremes(t):
    kept = measures.drop_extremes(_with_outliers(t), ["p_brand", "p_type"], "value")
    return rounded(
        kept.groupBy("p_brand", "p_type").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
    )


def _harmonised(t) -> DataFrame:
    factors = t["lineitem"].select(F.col("l_returnflag").alias("unit")).distinct().filter(F.col("unit") != "R").select(
        "unit", F.when(F.col("unit") == "A", 0.5).otherwise(2.0).alias("factor"), F.lit("standard").alias("standard_unit")
    )
    rows = lines(t).select("person_id", "site", F.col("l_returnflag").alias("unit"), F.col("l_quantity").alias("value"))
    return measures.harmonise(rows, factors, ["unit"], "value", "unit")


@query
def harmonise(t):
    return rounded(
        _harmonised(t).groupBy("raw_unit", "unit", "harmonised").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.sum("raw_value").alias("raw_total")
        ), 2,
    )


@query
def trim(t):
    units = _harmonised(t).select("unit").distinct()
    bounds = units.select("unit", F.lit(5.0).alias("minimum"), F.lit(60.0).alias("maximum"))
    kept = measures.trim(
        _harmonised(t), bounds, "unit", "value", overrides={"standard": (None, 40.0)}, missing_values=[10.0, 20.0],
        site="site", drop_sites=["NATION_3"],
    )
    return rounded(kept.groupBy("unit", "site").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 2)


@query
def unit_distribution(t):
    return rounded(measures.unit_distribution(_harmonised(t), ["unit"], "value", "person_id"))


# Extracts


@query
def ancestor_extract(t):
    full = extracts.lab_extract(record_tables(t), [502, 503])
    return full.withColumn("measurement_datetime", F.col("measurement_datetime").cast("date").cast("string"))


@query
def measurement_extract(t):
    narrow = extracts.measurement_extract(record_tables(t), [501])
    return narrow.withColumn("measurement_datetime", F.col("measurement_datetime").cast("date").cast("string"))


@query
def concept_name_map(t):
    return extracts.concept_name_map(record_tables(t), [501])


@query
def concept_index(t):
    wide = t["lineitem"].groupBy(F.col("l_suppkey").alias("person_id")).agg(
        *[F.max(F.col("l_linenumber") == n).alias(str(100 + n)) for n in range(1, 8)]
    )
    wide = wide.withColumn("101", F.when(F.col("101"), True))
    return extracts.phenotype_index(record_tables(t), wide, "concept_id", "drug", name_parts=["nation_"])


@query
def concept_lookup(t):
    ids = t["nation"].select(
        F.when(F.col("n_regionkey") == 0, F.concat("n_name", F.lit("-CODE")))
        .otherwise((F.col("n_nationkey") + 100).cast("string")).alias("wanted")
    )
    return extracts.concept_names(record_tables(t), ids, "wanted")


# Batches and plates


def _samples(t) -> DataFrame:
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(
        t["nation"], F.col("c_nationkey") == F.col("n_nationkey")
    )
    return orders.select(
        F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("participant_id"),
        F.col("o_orderdate").cast("date").alias("collected"), F.col("n_name").alias("state"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("negative_control"),
        F.lit("No").alias("positive_control"),
    )


def _modular(key: str) -> Column:
    """A scrambled order that SQL can repeat; library callers use ``seeded_order``."""
    return (F.col(key) * 7919) % 10007


def _batch(samples: DataFrame) -> DataFrame:
    tests = samples.filter(F.col("negative_control") == "No")
    earlier = plates.next_batch(tests, 500, "sample_id", "collected")
    return plates.next_batch(tests, 900, "sample_id", "collected", exclude=earlier)


@query
def next_batch(t):
    return _batch(materialise(_samples(t))).withColumn("collected", F.col("collected").cast("string"))


@query
def allocate_plates(t):
    rows = _samples(t).select("sample_id", "state", F.col("collected").cast("string").alias("collected"))
    return plates.allocate_plates(rows, 94, ["state", "collected", "sample_id"])


@query
def shuffle_plates(t):
    rows = _samples(t).select("sample_id", "state")
    return plates.shuffle_plates(rows, 94, "sample_id", seed=11, order=_modular("sample_id"))


@query
def seeded_sample(t):
    return plates.seeded_sample(materialise(_samples(t).select("sample_id", "state")), 250, "sample_id", seed=7, order=_modular("sample_id"))


def _controls(samples: DataFrame, batch: DataFrame) -> DataFrame:
    pool = samples.filter(F.col("negative_control") == "Yes")
    return plates.allocate_controls(pool, 10, "sample_id", _modular("sample_id"), match=(batch, "state"))


@query
def control_plates(t):
    samples = materialise(_samples(t))
    return _controls(samples, _batch(samples)).withColumn("collected", F.col("collected").cast("string"))


@query
def single_control_plates(t):
    pool = materialise(_samples(t).filter(F.col("negative_control") == "Yes"))
    used = plates.allocate_controls(pool, 10, "sample_id", _modular("sample_id")).select("sample_id")
    chosen = plates.allocate_controls(pool, 9, "sample_id", _modular("sample_id"), exclude=used, twice=False)
    return chosen.select("sample_id", "state", "plate")


def _positives(t) -> DataFrame:
    pool = t["supplier"].select(F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("positive_control_id"),
                                F.col("s_suppkey").alias("_n"), F.col("s_acctbal").alias("volume"))
    chosen = plates.allocate_controls(pool, 10, "positive_control_id", _modular("_n")).drop("_n")
    return plates.label_controls(chosen, "No", "Yes")


@query
def positive_control_plates(t):
    return _positives(t)


@query
def control_volume(t):
    chosen = _positives(t).select("positive_control_id", "volume").distinct()
    return rounded(plates.control_volume(chosen, "volume", 20))


def _final(t) -> DataFrame:
    samples = materialise(_samples(t))
    batch = _batch(samples)
    tests = plates.allocate_plates(batch, 94, ["state", _modular("sample_id"), "sample_id"])
    return plates.append_all(tests, _controls(samples, batch), _positives(t))


@query
def final_samples(t):
    return rounded(_final(t).withColumn("collected", F.col("collected").cast("string")), 2)


@query
def sample_qc(t):
    return plates.sample_qc(materialise(_final(t)), "sample_id", "collected")


@query
def share_by_plate(t):
    final = materialise(_final(t))
    by_plate = plates.share_by(final, "participant_id", "state", "plate")
    overall = plates.share_by(final, "participant_id", "state").withColumn("plate", F.lit(None).cast("int"))
    return rounded(by_plate.unionByName(overall), 6)


@query
def manifest_labels(t):
    orders = t["orders"]
    ids = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("POS-"), F.col("o_orderkey").cast("string"))).otherwise(
        F.concat(F.lit("A"), F.col("o_orderkey").cast("string"))
    )
    manifest = orders.select(ids.alias("current_id"), F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("specimen_id"))
    known = _samples(t).select("sample_id", "state", "negative_control", "positive_control")
    master, negatives = known.filter("negative_control = 'No'"), known.filter("negative_control = 'Yes'").drop("positive_control")
    return plates.label_manifest(manifest, "current_id", master, negatives)


# Formatting, shapes, files


def _priority_counts(t) -> DataFrame:
    counts = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy(
        "c_nationkey", "o_orderpriority", "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("n"))
    size = t["orders"].agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("ratio", share(F.col("n"), size))


@query
def suppressed_report(t):
    n, ratio = F.col("n"), F.col("ratio")
    return _priority_counts(t).select(
        "c_nationkey", "o_orderpriority", "o_orderstatus", "n",
        count_pct(n, ratio).alias("plain"), suppressed_count_pct(n, ratio).alias("suppressed"),
        pct_text(ratio, 1).alias("one_decimal"), suppress_cell(count_pct(n, ratio)).alias("hidden_text"),
        suppress_cell(n - 18).alias("hidden_number"),
    )


@query
def formatted_columns(t):
    """A finished table as text, its counts hidden if small, and split back into numbers."""
    table = _priority_counts(t).withColumnRenamed("o_orderpriority", "priority").withColumnRenamed("o_orderstatus", "status")
    cells = table.withColumn("cell", count_pct(F.col("n"), F.col("ratio"))).withColumn("shown", F.col("n"))
    text = reshape.suppress_columns(reshape.format_columns(cells, ["n"], ["ratio"]), ["shown"])
    return reshape.split_columns(text, ["cell"])


@query
def split_count_pct_cells(t):
    cells = _priority_counts(t).select("c_nationkey", "o_orderpriority", "o_orderstatus", count_pct(F.col("n"), F.col("ratio")).alias("cell"))
    return cells.withColumn("_p", split_count_pct(F.col("cell"))).select(
        "c_nationkey", "o_orderpriority", "o_orderstatus", F.col("_p.count").alias("count"), F.col("_p.pct").alias("pct")
    )


@query
def threshold_dimension(t):
    """Thresholds from each region's yearly order values, and orders whose value is under twice theirs.

    The number of orders a customer placed in the year stands for the household size.
    """
    per_year = t["orders"].groupBy(F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).cast("int").alias("household_size"), F.sum("o_totalprice").alias("spent"), F.min("o_totalprice").alias("least")
    )
    yearly = per_year.join(customers(t).select("person_id", F.col("r_name").alias("state")), "person_id")
    base = yearly.groupBy("year", "state").agg(F.floor(F.min("least")).alias("low"))
    guideline = base.select("year", "state", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("household_size"), "low").withColumn(
        "income", F.col("low") * F.col("household_size")
    )
    large = base.select("year", "state", (F.col("low") * 8).alias("eight_persons"), (F.col("low") + 10).alias("each_additional"))
    dimension = reshape.threshold_dimension(guideline, large)
    known = reshape.with_threshold(yearly, dimension)
    return known.groupBy("year", "state", "household_size", "fpl", "fpl_200").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("spent") < F.col("fpl_200"), 1).otherwise(0)).alias("below")
    )


@query
def id_set_ops(t):
    """Difference, intersection and distinct union of id sets."""
    buyers = t["orders"].filter(F.col("o_totalprice") > HIGH_VALUE).select(F.col("o_custkey").alias("person_id"))
    users = t["events"].select(F.col("user_id").alias("person_id"))
    rich = t["customer"].filter(F.col("c_acctbal") > HIGH_BALANCE).select(F.col("c_custkey").alias("person_id"))
    parts = {
        "buyers without events": buyers.subtract(users),
        "buyers with events and balance": buyers.intersect(users).intersect(rich),
        "buyers or users": buyers.union(users).distinct(),
    }
    return extracts.labelled_counts(parts, "person_id")


@query
def population_alignment(t):
    sets = flags.flag_lattice(customer_flags(t), "person_id", FLAGS, unique=True)
    whole = flags.count_by_flag_combo(sets, "person_id", FLAGS)
    events = flags.count_by_flag_combo(sets.filter("has_events = 1"), "person_id", FLAGS)
    tables = {"Whole": whole.select("combo", "n", "ratio"), "Events": events.select("combo", "n", "ratio")}
    return crosstab.align_populations(tables, "combo", "Whole")


@query
def tables_side_by_side(t):
    sets = flags.flag_lattice(customer_flags(t), "person_id", FLAGS, ["in_asia"], unique=True)
    tables = {
        name: flags.count_by_flag_combo(rows, "person_id", FLAGS).withColumn("cell", count_pct(F.col("n"), F.col("ratio")))
        for name, rows in (("whole", sets), ("asia", sets.filter("in_asia = 1")), ("events", sets.filter("has_events = 1")))
    }
    return crosstab.side_by_side(tables, ["combo"], "cell")


@query
def ordered_categories(t):
    """Categories with their place in a fixed list; the unlisted have none."""
    counts = t["orders"].groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("sort_ord", position(F.col("o_orderpriority"), ["5-LOW", "1-URGENT", "3-MEDIUM"])).orderBy("sort_ord")


@query
def sql_over_views(t):
    """Plain SQL over registered tables."""
    sql = """SELECT lower(event_type) AS domain, count(DISTINCT user_id) AS n_pids, min(year(ts)) AS first_year
             FROM tallyloom_events WHERE event_type LIKE 'p%' OR event_type IN ('view', 'click') GROUP BY 1"""
    return files.query(t.spark, sql, {"tallyloom_events": t["events"]})


@query
def flat_file_round_trip(t):
    """The wide customer table written as TSV into the shared folder, then one typed column read back."""
    path = f"{shared_folder(t.spark)}/tallyloom/{uuid.uuid4().hex}.tsv"
    files.write_flat(t["customer"].withColumnRenamed("c_custkey", "research_id"), path)
    schema = "research_id BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    labels = files.read_ancestry(t.spark, path, schema, "research_id", "c_mktsegment")
    balances = files.read_concept(t.spark, path, "c_acctbal", schema, entity="research_id")
    joined = labels.join(balances.withColumnRenamed("research_id", "person_id"), "person_id")
    return rounded(
        joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.max("c_acctbal").alias("largest")), 2
    )


@query
def concept_files(t):
    """Lines written as one folder of files per line number under a stamped name, text with quotes and separators in it, and read back."""
    note = F.concat(F.lit('a "'), F.col("l_returnflag"), F.lit('", of '), F.col("l_linestatus"))
    rows = t["lineitem"].select("l_orderkey", F.col("l_quantity").cast("double").alias("quantity"), note.alias("note"), F.col("l_linenumber").alias("concept"))
    path = files.write_by_concept(rows, files.stamped(f"{shared_folder(t.spark)}/tallyloom/{uuid.uuid4().hex}", "today.time"), "concept")
    schema = "l_orderkey BIGINT, quantity DOUBLE, note STRING, concept INT"
    back = files.read_flat(t.spark, path, schema, kind="csv")
    return back.groupBy("concept", "note").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("total"))


# Health-records extracts and reports


@query
def survey_demographics(t):
    return extracts.demographics(survey_tables(t))


@query
def history_demographics(t):
    return extracts.history_demographics(survey_tables(t))


@query
def under_represented_groups(t):
    return extracts.group_flags(survey_tables(t))


@query
def survey_cohorts(t):
    """Persons by an answer, by consent and by data-type flag."""
    tables = survey_tables(t)
    return reports.population_flags(tables)


@query
def demographic_report(t):
    return reports.demographic_report(survey_tables(t), "income")


@query
def genomic_race_groups(t):
    return reports.genomics_report(survey_tables(t), "WGS")[0]


@query
def genomic_combinations(t):
    return reports.genomics_report(survey_tables(t), "WGS and Array")[1]


@query
def data_type_report(t):
    return reports.data_type_report(survey_tables(t))


@query
def record_history(t):
    history = reports.record_history(domain_tables(t))
    return history.withColumns({c: F.col(c).cast("date").cast("string") for c in ("start", "end")})


@query
def record_years(t):
    return reports.years_report(reports.record_history(domain_tables(t)))


@query
def record_growth(t):
    return reports.growth_report(domain_tables(t), from_year=1996)


@query
def period_growth(t):
    """Growth over the periods: years without newcomers stay in the series."""
    tables = domain_tables(t)
    return reports.period_growth_report(tables, reports.record_history(tables), from_year=1996)


@query
def overlap_report(t):
    return reports.overlap_report(survey_tables(t))


@query
def site_domain_report(t):
    tables = domain_tables(t)
    size = tables["person"].agg(F.count_distinct("person_id"))
    return reports.site_report(reports.record_history(tables), size, "domain")


@query
def demographic_history_report(t):
    """Persons per ethnicity and domain, from answers and records together."""
    return reports.demographic_history_report(survey_tables(t), reports.record_history(domain_tables(t)), "ethnicity")


@query
def record_sites(t):
    tables = domain_tables(t)
    size = tables["person"].agg(F.count_distinct("person_id"))
    return reports.site_report(reports.record_history(tables), size, "vocabulary")


@query
def group_history_report(t):
    """Under-represented groups by domain, from answers and records together."""
    tables = domain_tables(t)
    survey = survey_tables(t)
    return reports.group_history_report(survey, reports.record_history(tables))


@query
def headline_report(t):
    """Eleven headlines over surveys, seven record domains, deaths and consents."""
    return reports.headline_report(bindings.headline_tables(t))


@query
def add_on_report(t):
    return reports.add_on_report(survey_tables(t))


@query
def self_reported_race(t):
    return extracts.self_reported_race(survey_tables(t))


@query
def case_control_report(t):
    """All concept columns of a wide table, with their names."""
    wide = bindings.phenotypes(t)
    return reports.case_control_report(record_tables(t), wide, reports.person_strata(*bindings.person_tables(t)))


@query
def measure_report(t):
    return reports.measure_report(bindings.measures(t), reports.person_strata(*bindings.person_tables(t)))


@query
def lab_report_sites(t):
    return rounded(reports.lab_report(record_tables(t), [502, 503])["statistics"])


@query
def lab_report_people(t):
    return rounded(reports.lab_report(record_tables(t), [502, 503])["people"], 7)  # means of eight prices end in a 5 at the fifth digit


@query
def family_history_index(t):
    wide = bindings.phenotypes(t).drop("NATION_3-CODE")
    return reports.family_history_index(bindings.family_tables(t), wide)


@query
def physical_measure_index(t):
    return extracts.physical_measure_index(bindings.physical_tables(t))


@query
def lab_index(t):
    return extracts.lab_index(extracts.concept_name_map(record_tables(t), [501]))
