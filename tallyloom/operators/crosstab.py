"""Category counts against several denominators and populations, in one pass over the entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .flags import _as_rows, _is_set, _sum_of, entity_flags, multi_answer
from .shares import fixed_table, share, total_and_share


def _cells(cohorts: Mapping[str, str | None], populations: Mapping[str, str | None]):
    """One conditional sum per population and cohort, and the labels to read it back by."""
    sums, entries = [], []
    for p, (population, pop_flag) in enumerate(populations.items()):
        for c, (cohort, cohort_flag) in enumerate(cohorts.items()):
            condition = F.lit(True)
            for flag in (pop_flag, cohort_flag):
                condition = condition & _is_set(flag) if flag else condition
            sums.append(_sum_of(condition).alias(f"_{p}_{c}"))
            entries.append((f"_{p}_{c}", population, cohort))
    return sums, entries


def cross_tab(
    people: DataFrame,
    answers: DataFrame,
    entity: str,
    category: str,
    cohorts: Mapping[str, str | None],
    populations: Mapping[str, str | None],
    order: Sequence[str],
    missing: str = "Not Specified",
    several: str = "Multiple Selections",
    multi_counted: bool = False,
    keep_unlisted: bool = False,
    total: str = "TOTAL",
    one_answer: bool = False,
) -> DataFrame:
    """Entities per category for every population and cohort, with share and a total row.

    ``people`` has one row per entity with the 0/1 flags that ``cohorts`` and ``populations`` name
    (None: everybody). Each population x cohort cell is a conditional sum, so 3 populations of 7
    denominators cost one aggregation with map-side combine instead of 21 passes. An entity with
    several answers goes to ``several``, or with ``multi_counted`` into each of its categories.
    ``one_answer`` says that the answers are one row per entity already, which saves an aggregation.

    Listed categories always appear, with 0 if need be (``several`` only if it occurs); others
    count towards the total but are shown only with ``keep_unlisted``.
    """
    flags = [f for f in [*cohorts.values(), *populations.values()] if f]
    members = entity_flags(people, entity, list(dict.fromkeys(flags)), unique=True)
    if one_answer:
        one = answers.select(entity, category)
    elif multi_counted:
        one = answers.select(entity, category).distinct()
    else:
        one = multi_answer(answers, entity, category)
    joined = members.join(one, entity, "left").withColumn(category, F.coalesce(category, F.lit(missing)))

    sums, entries = _cells(cohorts, populations)
    counted = _as_rows(joined.groupBy(category).agg(*sums), ["population", "cohort"], entries, keep=[category])
    keys = ["population", "cohort"]
    size = None
    if multi_counted:
        size = "_size"
        counted = counted.join(_as_rows(members.agg(*sums), keys, entries).withColumnRenamed("n", size), keys)
    table = total_and_share(counted, category, total, keys, size)

    listed = [*order, *([] if several in order else [several])]
    places = [*[(c, i + 1) for i, c in enumerate(listed)], (total, 10_000)]
    rows = [(p, c, name, place) for p in populations for c in cohorts for name, place in places]
    frame = fixed_table(people.sparkSession, rows, f"population string, cohort string, `{category}` string, sort_ord int")
    shaped = frame.join(table, [*keys, category], "full" if keep_unlisted else "left")
    shaped = shaped.na.fill({"n": 0, "ratio": 0.0, "sort_ord": 9_999})
    if several not in order:
        anywhere = F.max("n").over(Window.partitionBy(category))
        shaped = shaped.withColumn("_any", anywhere).filter((F.col(category) != several) | (F.col("_any") > 0))
    return shaped.select(*keys, F.col(category).alias("category"), "sort_ord", "n", "ratio")


def domain_cross_tab(
    people: DataFrame,
    history: DataFrame,
    entity: str,
    variable: str,
    domain: str,
    everyone: str = "All Pids",
    no_data: str = "No Data",
    total: str = "TOTAL",
) -> DataFrame:
    """Entities per category and domain, with columns for everybody and for those without a domain.

    The total row is the sum of the categories. Shares are of all entities in ``people``.
    """
    joined = _domains_of(people.select(entity, variable).distinct(), history, entity, domain, everyone, no_data)
    counts = joined.filter(F.col(variable).isNotNull()).groupBy(variable, "domain").agg(F.count(F.lit(1)).alias("n"))
    size = people.agg(F.count_distinct(entity)).scalar()
    table = counts.select("domain", F.col(variable).alias("category"), "n", size.alias("_size"))
    return total_and_share(table, "category", total, ["domain"], "_size")


def _domains_of(people: DataFrame, history: DataFrame, entity: str, domain: str, everyone: str, no_data: str) -> DataFrame:
    """A row per entity and domain it has, plus one for ``everyone``.

    A domain list is no longer than the list of domains, however many records an entity has.
    """
    lists = history.groupBy(entity).agg(F.collect_set(domain).alias("_domains"))
    domains = F.concat(F.coalesce("_domains", F.array(F.lit(no_data))), F.array(F.lit(everyone)))
    return people.join(lists, entity, "left").withColumn("domain", F.explode(domains)).drop("_domains")


def group_cross_tab(
    people: DataFrame,
    history: DataFrame,
    entity: str,
    flags: Sequence[str],
    domain: str,
    labels: Mapping[str, str],
    prefix: str = "",
    everyone: str = "All Pids",
    no_data: str = "No Data",
    total: str = "TOTAL",
) -> DataFrame:
    """The same for many yes/no columns at once: sums per domain, one pass for all columns."""
    joined = _domains_of(people.select(entity, *flags), history, entity, domain, everyone, no_data)
    sums, entries = [], []
    for i, flag in enumerate(flags):
        for j, (value, label) in enumerate(labels.items()):
            sums.append(_sum_of(F.col(flag) == value).alias(f"_{i}_{j}"))
            entries.append((f"_{i}_{j}", flag.removeprefix(prefix).replace("_", " "), label))
    counted = _as_rows(joined.groupBy("domain").agg(*sums), ["diversity_category", "category"], entries, keep=["domain"])
    size = people.agg(F.count_distinct(entity)).scalar()
    table = counted.select("diversity_category", "domain", "category", "n", size.alias("_size"))
    return total_and_share(table, "category", total, ["diversity_category", "domain"], "_size")


def entity_matrix(
    records: DataFrame,
    entity: str,
    row: str,
    col: str,
    denominator: int | DataFrame,
    total_row: str | None = "TOTAL PIDS",
    any_col: str | None = "Any EHR",
) -> DataFrame:
    """Distinct entities per row and column, with a distinct total row and an any-column.

    Totals are counted anew, as entities overlap. Records are reduced to one row per entity with the
    set of its (row, column) pairs, combined before the one shuffle by entity; each entity then counts
    once in every cell its pairs touch. A null ``col`` counts towards the any-column only.
    """
    rows = lambda p: [p["row"], *([F.lit(total_row)] if total_row else [])]
    cols = lambda p: [p["col"], *([F.lit(any_col)] if any_col else [])]
    cells = lambda p: F.array(*[F.struct(r.alias("row"), c.alias("col")) for r in rows(p) for c in cols(p)])
    pairs = F.collect_set(F.struct(F.col(row).alias("row"), F.col(col).alias("col"))).alias("_pairs")
    people = records.filter(F.col(entity).isNotNull()).groupBy(entity).agg(pairs)
    counts = (
        people.select(F.explode(F.array_distinct(F.flatten(F.transform("_pairs", cells)))).alias("_cell"))
        .select("_cell.row", "_cell.col")
        .filter(F.col("row").isNotNull() & F.col("col").isNotNull())
        .groupBy("row", "col")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    size = F.lit(denominator) if isinstance(denominator, int) else denominator.scalar()
    return counts.withColumn("ratio", share(F.col("n"), size))


def by_row_total(matrix: DataFrame, any_col: str = "Any EHR") -> DataFrame:
    """Add ``row_total``, the any-column of the row, to order a finished matrix by."""
    total = F.max(F.when(F.col("col") == any_col, F.col("n"))).over(Window.partitionBy("row"))
    return matrix.withColumn("row_total", total).orderBy(F.desc("row_total"), "row", "col")


def align_populations(
    tables: Mapping[str, DataFrame], label: str, base: str, value_columns: Sequence[str] = ("n", "ratio")
) -> DataFrame:
    """Stack finished tables; each gets the labels it lacks from the ``base`` table, with 0."""
    parts = []
    for population, table in tables.items():
        rows = table.select(label, *value_columns)
        if population != base:
            absent = tables[base].select(label).join(rows.select(label), label, "left_anti")
            zeros = [F.lit(0).cast(rows.schema[c].dataType).alias(c) for c in value_columns]
            rows = rows.unionByName(absent.select(label, *zeros))
        parts.append(rows.withColumn("population", F.lit(population)))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def side_by_side(tables: Mapping[str, DataFrame], keys: Sequence[str], cell: str, empty: str = "-") -> DataFrame:
    """Finished tables as columns next to each other, aligned on the keys, gaps as '-'.

    The tables are stacked and grouped once instead of being joined one after the other.
    """
    stacked = None
    for name, table in tables.items():
        part = table.select(*keys, F.lit(name).alias("_name"), F.col(cell).cast("string").alias("_cell"))
        stacked = part if stacked is None else stacked.unionByName(part)
    firsts = [
        F.coalesce(F.max(F.when(F.col("_name") == name, F.col("_cell"))), F.lit(empty)).alias(name) for name in tables
    ]
    return stacked.groupBy(*keys).agg(*firsts)
