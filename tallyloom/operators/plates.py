"""Batches, plates and controls.

Positions in a total order come from a range partitioning: each partition is sorted on its own and
gets the number of rows in the partitions before it added. First rows are found by counting their
keys (:mod:`.selection`), not by sorting. No task ever holds the whole list, and
the partition layout is written out before it is counted, so both reads see the same one. Random
choices order by a hash of the id and a seed, which is the same after any repartitioning or retry.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialise
from .selection import first_rows
from .shares import share

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def seeded_order(key: str, seed: int) -> Column:
    """A reproducible random order key."""
    return F.xxhash64(F.col(key), F.lit(seed))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """1-based position of every row in the given order, which must be total (end it with an id)."""
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = materialise(ordered.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", _ROW_BITS)
    index = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one count per range partition comes to the driver and goes back as an array of sums
    counts = {r.part: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    before = [0, *accumulate(counts.get(i, 0) for i in range(max(counts, default=0)))]
    offset = F.get(F.lit(before).cast("array<bigint>"), part.cast("int"))
    return placed.withColumn(name, offset + index + 1).drop("_mid")


def next_batch(
    samples: DataFrame, n: int, key: str, newest: str, exclude: DataFrame | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` most recent samples that are not in an earlier batch; ties by id."""
    pool = samples.select(*columns).distinct() if columns else samples.distinct()
    if exclude is not None:
        pool = pool.join(exclude.select(key), key, "left_anti")
    return first_rows(materialise(pool), n, [newest, key], descending=1)


def seeded_sample(df: DataFrame, n: int, key: str, seed: int, order: Column | None = None) -> DataFrame:
    """``n`` random rows; with ``n`` as large as the table, a shuffle of all rows."""
    return first_rows(df, n, [seeded_order(key, seed) if order is None else order, F.col(key)])


def allocate_plates(df: DataFrame, wells: int, order: Sequence[Column | str], name: str = "plate") -> DataFrame:
    """Fill plates of ``wells`` rows in the given total order, starting with plate 1."""
    ranked = global_rank(df, order, "_position")
    return ranked.withColumn(name, F.ceil(F.col("_position") / wells).cast("int")).drop("_position")


def shuffle_plates(df: DataFrame, wells: int, key: str, seed: int, name: str = "plate", order: Column | None = None) -> DataFrame:
    """Fill plates in random order; ``order`` replaces the seeded one."""
    return allocate_plates(df, wells, [seeded_order(key, seed) if order is None else order, key], name)


def allocate_controls(
    controls: DataFrame,
    plates: int,
    key: str,
    order: Column,
    exclude: DataFrame | None = None,
    match: tuple[DataFrame, str] | None = None,
    twice: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One control per plate, drawn in ``order`` (a seeded hash) from those not used before.

    ``match`` keeps controls whose value of a column occurs in a batch. Normally ``plates // 2``
    controls are drawn and each goes on two plates: up the list by id, then down again, so plate
    numbers run from 1 to twice the number drawn. With ``twice=False`` every plate has its own.
    Too few controls for the plates are an error.
    """
    pool = controls.select(*columns).distinct() if columns else controls.distinct()
    if exclude is not None:
        pool = pool.join(exclude.select(key), key, "left_anti")
    if match is not None:
        batch, column = match
        pool = pool.join(batch.select(column).distinct(), column, "left_semi")
    needed = plates // 2 if twice else plates
    ranked = global_rank(first_rows(materialise(pool), needed, [order, F.col(key)]), [key], "_up")
    drawn = ranked.count()
    if drawn < needed:
        raise ValueError(f"{needed} controls are needed for {plates} plates, there are {drawn}")
    if not twice:
        return ranked.withColumn("plate", F.col("_up").cast("int")).drop("_up")
    both = F.array(F.col("_up").cast("int"), (2 * drawn - F.col("_up") + 1).cast("int"))
    return ranked.withColumn("plate", F.explode(both)).drop("_up")


def control_volume(controls: DataFrame, volume: str, aliquots: int) -> DataFrame:
    """Volume of the chosen controls per aliquot needed."""
    return controls.agg((F.sum(volume) / aliquots).alias("volume_per_aliquot"))


def label_controls(df: DataFrame, negative: str, positive: str) -> DataFrame:
    """Write the two yes/no control columns."""
    return df.withColumns({"negative_control": F.lit(negative), "positive_control": F.lit(positive)})


def append_all(*parts: DataFrame) -> DataFrame:
    """Append tables with different columns; columns come out sorted by name, gaps are null."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.select(sorted(stacked.columns))


def parse_manifest(manifest: DataFrame, field: str, prefix: str = "A") -> tuple[DataFrame, DataFrame]:
    """Split a manifest by its id field: 'A123' are samples with id 123, all others positive controls."""
    is_sample = F.col(field).startswith(prefix)
    text = F.split_part(F.col(field), F.lit(prefix), F.lit(2))
    samples = manifest.filter(is_sample).withColumn("sample_id", text.try_cast("bigint")).drop(field)
    positives = label_controls(manifest.filter(~is_sample).withColumnRenamed(field, "positive_control_id"), "No", "Yes")
    return samples, positives


def label_manifest(manifest: DataFrame, field: str, master: DataFrame, negatives: DataFrame, key: str = "sample_id") -> DataFrame:
    """All rows of a manifest with their details: test samples, negative and positive controls."""
    samples, positives = parse_manifest(manifest, field)
    everything = append_all(samples.join(master, key), samples.join(negatives, key), positives)
    return everything.na.fill("No", ["negative_control", "positive_control"])


def sample_class(negative: str = "negative_control", positive: str = "positive_control") -> Column:
    """'test', 'negative' or 'positive'."""
    return (
        F.when(F.col(positive) == "Yes", "positive").when(F.col(negative) == "Yes", "negative").otherwise("test")
    )


def sample_qc(
    samples: DataFrame,
    key: str,
    collected: str,
    plate: str | None = "plate",
    positive_key: str | None = "positive_control_id",
    specimen: str | None = None,
) -> DataFrame:
    """Quality numbers as (metric, value) rows: ids, rows and date range per sample class, and totals.

    Every distinct count is over its own narrow (class, id) rows; a query with several distinct
    counts would copy the whole table once per count.
    """
    id_text = F.col(key).cast("string")
    if positive_key and positive_key in samples.columns:
        id_text = F.when(sample_class() == "positive", F.col(positive_key).cast("string")).otherwise(id_text)
    rows = samples.select(sample_class().alias("class"), id_text.alias("id"), F.col(collected).cast("date").alias("day"))
    # A positive control's id is of another kind, so ids of different classes are different samples.
    whole = F.struct("class", "id") if positive_key else F.struct(F.lit("").alias("class"), "id")
    copies = F.explode(
        F.array(
            F.struct("class", F.struct("class", "id").alias("who")), F.struct(F.lit("all").alias("class"), whole.alias("who"))
        )
    )
    per_class = (
        rows.select("day", copies.alias("_c"))
        .select("day", "_c.class", F.when(F.col("_c.who.id").isNotNull(), F.col("_c.who")).alias("who"))
        .groupBy("class")
        .agg(
            F.count_distinct("who").cast("string").alias("unique"),
            F.count("who").cast("string").alias("count"),
            F.min("day").cast("string").alias("first_day"),
            F.max("day").cast("string").alias("last_day"),
        )
    )
    facts = per_class.unpivot("class", ["unique", "count", "first_day", "last_day"], "fact", "value")
    undated = rows.filter((F.col("class") == "test") & F.col("day").isNull()).agg(
        F.count_distinct("id").cast("string").alias("value")
    ).select(F.lit("test").alias("class"), F.lit("unique_without_day").alias("fact"), "value")
    parts = [facts, undated]
    for column, fact in ((plate, "plates"), (specimen, "specimens")):
        if column:
            counted = samples.agg(
                F.count_distinct(column).cast("string").alias(fact), F.count(column).cast("string").alias(f"{fact}_rows")
            )
            parts.append(counted.withColumn("class", F.lit("all")).unpivot("class", [fact, f"{fact}_rows"], "fact", "value"))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.select(F.concat_ws("_", "class", "fact").alias("metric"), "value")


def share_by(df: DataFrame, entity: str, variable: str, group: str | None = None) -> DataFrame:
    """Entities per value of a variable and their percent of the whole set, or of every group."""
    keys = [group] if group else []
    counts = df.filter(F.col(variable).isNotNull()).groupBy(*keys, variable).agg(F.count_distinct(entity).alias("n"))
    sizes = df.groupBy(*keys).agg(F.count_distinct(entity).alias("_size"))
    sized = counts.join(sizes, keys) if keys else counts.withColumn("_size", sizes.scalar())
    return sized.withColumn("pct", share(F.col("n"), F.col("_size")) * 100).drop("_size")
