import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import selection


def test_keys_of_doubles_are_their_bits(spark):
    rnd = random.Random(1)
    values = [0.0, -0.0, 1.0, 1 / 3, 5e-324, -5e-324, 2.2250738585072014e-308, 2.2250738585072009e-308, 1.7976931348623157e308, math.inf, -math.inf, 1023.9999999999999]
    values += [struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0] for _ in range(2000)]
    values += [math.nextafter(2.0**e, to) for e in range(-1022, 1024, 9) for to in (0, math.inf)] + [2.0**e for e in range(-1074, 1024)]
    df = spark.createDataFrame([(v,) for v in values if v == v], "v double")
    for v, key in df.select("v", selection.double_key(F.col("v"))).collect():
        bits = struct.unpack("q", struct.pack("d", abs(v)))[0]
        assert key == (-bits if v < 0 else bits), v


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 7 > 0 THEN id % 50 END AS day", "concat('longer-than-one-piece-', cast(id % 300 as string)) AS s",
        "date_add(date'2020-01-01', cast(id % 11 as int)) AS d", "timestamp_micros(id % 40 * 1000003) AS t",
        "cast(id * id % 1000 - 300 as double) / 7 AS x", "'same' AS same", "cast(id % 90 as decimal(10,2)) / 7 AS dec", "xxhash64(id) AS hash",
    ).repartition(5)


ORDERS = [(["day", "id"], 1), (["day", "id"], 0), (["s", "id"], 1), (["d", "x", "id"], 2), (["x", "s", "id"], 0), (["t", "dec", "id"], 1), (["same", "id"], 0), (["hash", "id"], 0)]


@pytest.mark.parametrize("order,descending", ORDERS)
def test_first_rows_are_those_of_a_sort(spark, frame, monkeypatch, order, descending):
    monkeypatch.setattr(selection, "SORTED", 40)
    sort = [F.desc(c) if i < descending else F.asc(c) for i, c in enumerate(order)]
    expected = [r.id for r in frame.orderBy(*sort).select("id").collect()]
    for n in (1777, 3999):
        assert {r.id for r in selection.first_rows(frame, n, order, descending).collect()} == set(expected[:n])


def test_rows_equal_in_every_key_are_told_apart_by_a_sort(spark, monkeypatch):
    """Texts that differ behind the bytes that the keys hold."""
    monkeypatch.setattr(selection, "SORTED", 10)
    df = spark.range(500).selectExpr("concat(repeat('x', 80), lpad(cast(id as string), 4, '0')) AS s")
    assert sorted(r.s[-4:] for r in selection.first_rows(df, 123, ["s"]).collect()) == [f"{i:04d}" for i in range(123)]


def test_nothing_but_counts_is_shuffled(spark, frame):
    plan = selection.first_rows(frame, 700, ["day", "id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_empty_and_odd_types(spark, frame):
    assert selection.first_rows(frame.limit(0), 5, ["day", "id"]).count() == 0
    assert [selection.first_rows(frame, n, ["day", "id"]).count() for n in (0, 1, 4000, 5000)] == [0, 1, 4000, 4000]
    with pytest.raises(TypeError, match="no order key"):
        selection.first_rows(frame.select(F.array("id").alias("a")), 5, ["a"])
