"""Flat files and tables as DataFrames. Paths may be any URI Spark has a connector for."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..runtime import delete, new_place

SEPARATORS = {"csv": ",", "tsv": "\t"}
#: One set of rules for all readers and writers here: quotes are doubled inside quoted fields.
QUOTES = {"header": True, "quote": '"', "escape": '"'}
STAMPS = {"today": "%Y-%m-%d", "today.time": "%Y-%m-%d_%H.%M", "today.time.seconds": "%Y-%m-%d_%H.%M.%S"}


def query(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over the catalog and the given DataFrames; the result stays lazy."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def _separator(path: str, kind: str | None) -> str:
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1]
    if kind not in SEPARATORS:
        raise ValueError(f"not a csv or tsv file: {path}")
    return SEPARATORS[kind]


def read_flat(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
    n: int | None = None,
    kind: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """A CSV or TSV file with a header. Give a schema: without one all columns are text.

    ``columns`` are matched by the header names and only they are parsed; ``n`` keeps the first rows.
    Say ``line_breaks`` if fields may hold some; a file is then read by one task, not split.
    """
    reader = spark.read.options(**QUOTES, sep=_separator(path, kind), multiLine=line_breaks)
    df = (reader.schema(schema) if schema else reader).csv(path)
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df.limit(n) if n is not None else df


def read_concept(spark: SparkSession, path: str, concept: str, schema: StructType | str, entity: str = "person_id") -> DataFrame:
    """The entity column and one concept column of a wide file."""
    return read_flat(spark, path, schema, columns=[entity, concept])


def read_ancestry(spark: SparkSession, path: str, schema: StructType | str, key: str, label: str, entity: str = "person_id") -> DataFrame:
    """Two typed columns of a wider file: the id, renamed, and the label in capitals."""
    rows = read_flat(spark, path, schema, columns=[key, label])
    return rows.withColumnRenamed(key, entity).withColumn(label, F.upper(label))


def concept_columns(df: DataFrame, entity: str = "person_id") -> list[str]:
    """The concept columns of a wide table: all but the entity. Reads the schema, starts no job."""
    return [c for c in df.columns if c != entity]


def stamped(path: str, stamp: str = "today", now: datetime | None = None) -> str:
    """Path with a date, date and minute, or date and second at its end."""
    return f"{path}_{(now or datetime.now()).strftime(STAMPS[stamp])}"


def write_flat(df: DataFrame, path: str, mode: str = "error", kind: str | None = None) -> str:
    """Write CSV or TSV with a header, one file per task; nothing is pulled to the driver."""
    df.write.mode(mode).options(**QUOTES, sep=_separator(path, kind)).csv(path)
    return path


def write_stamped(df: DataFrame, path: str, stamp: str = "today", kind: str = "csv", now: datetime | None = None) -> str:
    """Write under a name that carries the time."""
    return write_flat(df, f"{stamped(path, stamp, now)}.{kind}", kind=kind)


def write_by_concept(
    df: DataFrame, path: str, concept: str, mode: str = "error", rows_per_file: int = 5_000_000, kind: str = "csv",
    rows_per_task: int = 1_000_000,
) -> str:
    """One folder per concept in one job, in files of ``rows_per_file`` rows at most.

    The writer sorts all rows of a task by concept, so a task gets ``rows_per_task`` rows or so, however large a concept is:
    rows are dealt by ranges of concept and place. Places must not change, so the rows are written out first, for the time of the job.
    """
    spark, pinned = df.sparkSession, new_place(df.sparkSession)
    df.write.parquet(pinned)
    rows = spark.read.schema(df.schema).parquet(pinned)
    tasks = max(1, math.ceil(rows.count() / rows_per_task))
    dealt = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(tasks, concept, "_place").drop("_place")
    writer = dealt.write.mode(mode).partitionBy(concept).options(**QUOTES, sep=SEPARATORS[kind])
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)
    delete(spark, pinned)
    return path
