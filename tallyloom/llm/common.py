"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.runtime import delete, new_place

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name.

    Further columns do no harm, not even some whose names differ in case alone.
    """
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"c{columns.index(name)}").alias(name) for name in names])


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage.

    The shuffle files of the write are dropped as soon as it is done: nothing reads them again, a
    lost executor is made good from the written table.
    """
    spark = df.sparkSession
    path = new_place(spark)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing will read again."""
    for df in tables:
        delete(df.sparkSession, df.stored_at)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(column: pa.Array, chars: int = 500_000) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch (null: empty) in runs of about ``chars`` characters, with each run's first row.

    A text is never cut: one longer than ``chars`` is a run of its own.
    """
    first, held, run = 0, 0, []
    for i, text in enumerate(column):
        run.append(text.as_py() or "")
        held += len(run[-1])
        if held >= chars:
            yield first, run
            first, held, run = i + 1, 0, []
    if run:
        yield first, run


def by_batch(make: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 500) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``make`` for runs of ``rows`` rows, so that what it holds and returns stays small whatever a batch holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield make(batch.slice(at, rows))

    return run


def keep_rows(df: DataFrame, text: str, keep: Callable[[pa.Array], list[bool]]) -> DataFrame:
    """The rows, with all their columns, whose text ``keep`` says yes to; nothing is shuffled."""
    place = df.columns.index(text)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(keep(batch.column(place)), pa.bool_()))

    return plain.mapInArrow(by_batch(run), plain.schema).toDF(*df.columns)
