"""Session settings and the two ways an operator pins an intermediate result."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tallyloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Temporary folders of local sessions, by application: a context's own settings stay as they are.
_LOCAL: dict[str, str] = {}
#: Tables written so far, in order.
_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that folder would exist
    on one machine alone. A folder that is named is taken as shared, whatever its kind of path.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="tallyloom-")
        folder = _LOCAL[context.applicationId]
    return folder.rstrip("/")


def new_place(spark: SparkSession) -> str:
    """A path in the shared folder that is not in use; :func:`intermediates` and :func:`delete` know it."""
    _WRITTEN.append(f"{shared_folder(spark)}/tallyloom/{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing will read again."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all tables that were written within; results must have been written or collected by then."""
    begin = len(_WRITTEN)
    try:
        yield
    finally:
        delete(spark, *_WRITTEN[begin:])


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it back.

    The lineage ends at the files, so a lost executor cannot change ids or range bounds that were
    already handed out, and later joins see the true file size: Catalyst then broadcasts the table
    only if it is below ``spark.sql.autoBroadcastJoinThreshold``. Operators rely on that check and
    give no broadcast hints for tables that grow with the data.
    """
    path = new_place(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
