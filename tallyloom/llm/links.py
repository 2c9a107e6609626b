"""Groups of linked documents: connected components, and all pairs of large groups in blocks."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``root``, the smallest id of its component, of every id in the edges ``u``, ``v`` (longs).

    Large-star and small-star steps in turn: each hangs neighbours on the smallest one known, until
    nothing changes. Nothing is collected but a count and a checksum; rounds grow with the logarithm of a component.
    """
    one = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(joined.select(F.col("v").alias("u"), F.col("m").alias("v")))
        one = stored(small.filter("u <> v").distinct())
        now = one.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return one.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(one.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
        before = now


def in_blocks(rows: DataFrame, group: str, size: str, *, block: int, most: int = 8192) -> DataFrame:
    """Repeats rows of large groups so that every two of them meet in one ``task_key``.

    A group of up to ``block`` rows has one key. A larger one is dealt by id into blocks, up to 16 of them and more
    where they would exceed ``most`` rows, and has a key for every two blocks; ``side`` tells them
    apart. So no key ever has more than ``2 * most`` rows, however large a group is.
    """
    n = F.col(size)
    blocks = F.when(n <= block, 1).otherwise(F.greatest(F.least(F.lit(16), F.ceil(n / block)), F.ceil(n / most))).cast("int")
    rows = rows.withColumn("_n", blocks).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_n")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    key = F.xxhash64(group, F.least("_own", "_other"), F.greatest("_own", "_other"))
    return rows.withColumn("task_key", key).withColumn("side", (F.col("_own") > F.col("_other")).cast("int")).withColumn("alone", F.col("_own") == F.col("_other")).drop("_n", "_own", "_other")


def by_key(rows: DataFrame) -> DataFrame:
    """Rows of a ``task_key`` next to each other in one partition."""
    return rows.repartition("task_key").sortWithinPartitions("task_key", "id")


def groups(batches: Iterable[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, over the borders of batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        if held and held[0].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        ends = [*cuts.tolist(), batch.num_rows]
        begin = 0
        for end in ends[:-1]:
            yield pa.Table.from_batches([*held, batch.slice(begin, end - begin)])
            held, begin = [], end
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Which of ``n`` items hang together; the smallest index stands for each set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, others: Iterable[int]) -> None:
        for y in others:
            a, b = self.find(x), self.find(y)
            if a != b:
                self.up[max(a, b)] = min(a, b)

    def roots(self) -> list[int]:
        return [self.find(i) for i in range(len(self.up))]


def union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


