"""Counts of entities over overlapping 0/1 flags.

All of them bring the input to one row per entity first. From there every count is a plain sum with
map-side partial aggregation; several distinct counts in one query would instead multiply the rows.

Where several tables are wanted of the same entities, :func:`flag_lattice` counts them once per set of
flags. Every function here takes its rows in place of entities: a flag, a combination, an
intersection or a region is then a sum over the sets that include it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import suppressed_count
from ..runtime import materialise
from .shares import fixed_table, position, share, total_and_share

TOTAL_LABEL = "TOTAL PARTICIPANTS"
ZERO_LABEL = "Participants with 0 Data Type(s)"
#: How many entities a row stands for.
ENTITIES = "_entities"


def flag_matrix(base: DataFrame, entity: str, members: Mapping[str, DataFrame]) -> DataFrame:
    """One row per entity of ``base`` and a 0/1 flag for each of the id tables.

    The id tables are stacked and reduced to one row per entity in a single shuffle, then joined
    once, so the number of flags does not add joins.
    """
    names = list(members)
    stacked = reduce(
        DataFrame.unionByName,
        [ids.select(entity, *[F.lit(int(n == name)).alias(n) for n in names]) for name, ids in members.items()],
    )
    per_entity = stacked.groupBy(entity).agg(*[F.max(n).alias(n) for n in names])
    return base.join(per_entity, entity, "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in names})


def entity_flags(df: DataFrame, entity: str, flags: Sequence[str], unique: bool = False) -> DataFrame:
    """One row per entity; a missing flag means no. ``unique`` says the rows are per entity already."""
    clean = df.filter(F.col(entity).isNotNull()).select(
        entity, *[F.coalesce(F.col(f).cast("int"), F.lit(0)).alias(f) for f in flags]
    )
    return clean if unique else clean.groupBy(entity).agg(*[F.max(f).alias(f) for f in flags])


def flag_lattice(df: DataFrame, entity: str, flags: Sequence[str], members: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Entities per set of flags and populations: written once, a row per set that occurs.

    At most 2 to the number of flags and ``members`` rows, however many entities there are. The result
    goes to the functions of this module as ``df``, filtered by a member for one population.
    """
    columns = list(dict.fromkeys([*flags, *members]))
    people = entity_flags(df, entity, columns, unique)
    return materialise(people.groupBy(*columns).agg(F.count(F.lit(1)).alias(ENTITIES)))


def _weighted(df: DataFrame, entity: str, flags: Sequence[str], unique: bool) -> DataFrame:
    """Flags, and the entities that a row stands for: one, or more in a lattice."""
    if ENTITIES in df.columns:
        return df.select(*flags, ENTITIES)
    return entity_flags(df, entity, flags, unique).withColumn(ENTITIES, F.lit(1))


def _is_set(flag: str) -> Column:
    return F.col(flag) == 1


def _sum_of(condition: Column, weight: Column | int = 1) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight).otherwise(0)), F.lit(0)).cast("bigint")


def _entities_with(condition: Column) -> Column:
    return _sum_of(condition, F.col(ENTITIES))


def _as_rows(sums: DataFrame, columns: Sequence[str], entries: Sequence[tuple], keep: Sequence[str] = ()) -> DataFrame:
    """Turn one row of sums into labelled rows: each entry is (count column, label, ...)."""
    structs = [
        F.struct(F.col(f"`{entry[0]}`").alias("n"), *[F.lit(v).alias(c) for c, v in zip(columns, entry[1:])])
        for entry in entries
    ]
    rows = sums.select(*keep, F.explode(F.array(*structs)).alias("_row"))
    return rows.select(*keep, *[F.col(f"_row.{c}").alias(c) for c in columns], F.col("_row.n").alias("n"))


def count_by_flag(df: DataFrame, entity: str, flags: Sequence[str], none: str = "None", unique: bool = False) -> DataFrame:
    """Entities per flag, and those without any, with their share of all. Sorted by count."""
    people = _weighted(df, entity, flags, unique)
    empty = ~reduce(lambda a, b: a | b, map(_is_set, flags))
    sums = people.agg(
        _entities_with(F.lit(True)).alias("_all"),
        *[_entities_with(_is_set(f)).alias(f"_{i}") for i, f in enumerate(flags)],
        _entities_with(empty).alias("_none"),
    )
    entries = [(f"_{i}", f) for i, f in enumerate(flags)] + [("_none", none)]
    rows = _as_rows(sums, ["data_type"], entries, keep=["_all"]).filter(F.col("n") > 0)
    return rows.select("data_type", "n", share(F.col("n"), F.col("_all")).alias("ratio")).orderBy("n", "data_type")


def _n_flags_label(n: Column, n_flags: int, zero: str) -> Column:
    return (
        F.when(n == 0, zero)
        .when(n == n_flags, f"Participants with all {n_flags} Data Type(s)")
        .otherwise(F.concat(F.lit("Participants with ONLY "), n.cast("string"), F.lit(" Data Type(s)")))
    )


def _n_set(flags: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f) for f in flags]).cast("int")


def count_by_n_flags(
    df: DataFrame, entity: str, flags: Sequence[str], unique: bool = False, total: str = TOTAL_LABEL, zero: str = ZERO_LABEL
) -> DataFrame:
    """Entities by the number of flags they have, with a total row."""
    people = _weighted(df, entity, flags, unique)
    counts = people.groupBy(_n_set(flags).alias("n_flags")).agg(F.sum(ENTITIES).alias("n"))
    labelled = counts.withColumn("label", _n_flags_label(F.col("n_flags"), len(flags), zero))
    return total_and_share(labelled, "label", total)


def combination(flags: Sequence[str], joiner: str = " and ", none: str = "None") -> Column:
    """The names of the set flags, in the order the flags are given."""
    names = F.concat_ws(joiner, *[F.when(_is_set(f), F.lit(f)) for f in flags])
    return F.when(names == "", none).otherwise(names)


def count_by_flag_combo(
    df: DataFrame, entity: str, flags: Sequence[str], unique: bool = False, total: str = TOTAL_LABEL, zero: str = ZERO_LABEL
) -> DataFrame:
    """Entities by the exact set of flags they have, with a total row."""
    people = _weighted(df, entity, flags, unique)
    counts = people.groupBy(_n_set(flags).alias("n_flags"), combination(flags).alias("combo")).agg(
        F.sum(ENTITIES).alias("n")
    )
    labelled = counts.withColumn("label", _n_flags_label(F.col("n_flags"), len(flags), zero))
    return total_and_share(labelled, "combo", total)


def flag_tables(df: DataFrame, entity: str, flags: Sequence[str], unique: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three flag tables of one population, read from one lattice."""
    sets = df if ENTITIES in df.columns else flag_lattice(df, entity, flags, unique=unique)
    return count_by_flag(sets, entity, flags), count_by_n_flags(sets, entity, flags), count_by_flag_combo(sets, entity, flags)


def flag_counts_by_population(
    df: DataFrame, entity: str, flags: Sequence[str], populations: Mapping[str, str | None], unique: bool = False
) -> DataFrame:
    """Entities per flag and population; a population is a 0/1 column, or None for everybody.

    All flags of all populations are sums over one pass. Flags nobody has are left out.
    """
    members = [p for p in populations.values() if p]
    people = _weighted(df, entity, list(dict.fromkeys([*flags, *members])), unique)
    sums, entries = [], []
    for p, (population, member) in enumerate(populations.items()):
        inside = _is_set(member) if member else F.lit(True)
        sums.append(_entities_with(inside).alias(f"_all{p}"))
        for i, flag in enumerate(flags):
            sums.append(_entities_with(inside & _is_set(flag)).alias(f"_{p}_{i}"))
            entries.append((f"_{p}_{i}", flag.replace("_", " "), population, p))
    totals = [f"_all{p}" for p in range(len(populations))]
    rows = _as_rows(people.agg(*sums), ["data_type", "population", "_p"], entries, keep=totals)
    total = F.element_at(F.array(*totals), F.col("_p") + 1)
    return rows.filter(F.col("n") > 0).select("data_type", "population", "n", share(F.col("n"), total).alias("ratio"))


def overlap_regions(
    df: DataFrame, entity: str, flags: Sequence[str], min_cell: int = 20, unique: bool = False
) -> DataFrame:
    """Size of every exclusive overlap of the flags, empty ones included, small ones masked."""
    people = _weighted(df, entity, flags, unique)
    region = F.concat(*[F.col(f).cast("string") for f in flags]).alias("region")
    counts = people.groupBy(region).agg(F.sum(ENTITIES).alias("n"))
    code = F.lpad(F.bin("id"), len(flags), "0")
    regions = df.sparkSession.range(1, 1 << len(flags)).select(code.alias("region"))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return regions.join(counts, "region", "left").select("region", n.alias("n"), suppressed_count(n, min_cell).alias("n_label"))


def flag_intersections(
    df: DataFrame,
    entity: str,
    base: Column,
    base_name: str,
    combos: Sequence[Sequence[str]],
    unique: bool = False,
) -> DataFrame:
    """Entities that meet ``base`` and have all flags of a combination, for all combinations at once."""
    flags = sorted({f for combo in combos for f in combo})
    used = [c for c in df.columns if c not in (entity, ENTITIES)]
    people = _weighted(df, entity, used, unique)
    missing = [f for f in flags if f not in used]
    if missing:
        raise ValueError(f"no such flags: {missing}")
    sums, entries = [], []
    for i, combo in enumerate(combos):
        condition = reduce(lambda a, b: a & b, map(_is_set, combo), base)
        sums.append(_entities_with(condition).alias(f"_{i}"))
        entries.append((f"_{i}", " and ".join([base_name, *combo])))
    return _as_rows(people.agg(*sums), ["combination"], entries)


def combo_groups(
    answers: DataFrame,
    entity: str,
    category: str,
    main: Sequence[str],
    other: str = "Other",
    last: Sequence[str] = ("Other", "Skip"),
    missing: str = "None",
) -> DataFrame:
    """Entities by their sorted list of answers, lists that are not in ``main`` under ``other``.

    The answers are de-duplicated before they are gathered, so a gathered list is no longer than
    the list of possible answers however many rows an entity has.
    """
    groups = entity_groups(answers, entity, category, main, other, missing)
    counts = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    always = fixed_table(answers.sparkSession, [(g,) for g in last], "group string")
    rows = counts.join(always, "group", "full").na.fill({"n": 0})
    place = F.coalesce(position(F.col("group"), last), F.lit(0))
    total = total_and_share(rows.withColumn("sort_ord", place), "group", "Total")
    return total.withColumn("sort_ord", F.coalesce("sort_ord", F.lit(len(last) + 1))).orderBy("sort_ord", "group")


def entity_groups(
    answers: DataFrame, entity: str, category: str, main: Sequence[str], other: str = "Other", missing: str = "None"
) -> DataFrame:
    """One row per entity with the group its answers put it in."""
    distinct = answers.select(entity, F.coalesce(F.col(category), F.lit(missing)).alias(category)).distinct()
    joined = F.array_join(F.array_sort(F.collect_set(category)), ",")
    return distinct.groupBy(entity).agg(joined.alias("group")).withColumn(
        "group", F.when(F.col("group").isin(list(main)), F.col("group")).otherwise(other)
    )


def multi_answer(answers: DataFrame, entity: str, category: str, several: str = "Multiple Selections") -> DataFrame:
    """One row per entity: its answer, or ``several`` if it gave different ones.

    The smallest and the largest answer tell that apart, so no answer list is built and no window
    or join back is needed.
    """
    ends = answers.filter(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.min(category).alias("_low"), F.max(category).alias("_high")
    )
    return ends.select(entity, F.when(F.col("_low") != F.col("_high"), several).otherwise(F.col("_low")).alias(category))


def multi_answer_columns(
    df: DataFrame, entity: str, categories: Sequence[str], several: str = "Multiple Selections"
) -> DataFrame:
    """The same for several category columns in one aggregation."""
    ends = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(
        *[f(c).alias(f"_{side}_{c}") for c in categories for side, f in (("low", F.min), ("high", F.max))]
    )
    return ends.select(
        entity,
        *[
            F.when(F.col(f"_low_{c}") != F.col(f"_high_{c}"), several).otherwise(F.col(f"_low_{c}")).alias(c)
            for c in categories
        ],
    )


def any_yes(df: DataFrame, entity: str, flags: Sequence[str]) -> DataFrame:
    """One row per entity: 'yes' if any of its rows says so ('yes' sorts after 'no')."""
    return df.groupBy(entity).agg(*[F.max(f).alias(f) for f in flags])
