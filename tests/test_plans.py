"""Plan shapes that matter at scale, and results that must not hang on session settings."""

import re
from contextlib import contextmanager

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tallyloom.operators import crosstab, flags, measures, strata
from tallyloom.plans import bindings, extracts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, node):
    return len(re.findall(rf"(?<![A-Za-z]){node}(?![A-Za-z])", plan.split("== Initial Plan ==")[0]))


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def people(spark, folder):
    t = bindings.ParquetTables(spark, folder)
    return t["customer"].select(
        F.col("c_custkey").alias("p"), F.col("c_mktsegment").alias("segment"),
        *[(F.col("c_acctbal") > 1000 * i).cast("int").alias(f"f{i}") for i in range(6)],
    )


def test_flag_counts_are_one_aggregation(people):
    plan = plan_of(flags.count_by_flag(people, "p", [f"f{i}" for i in range(6)], unique=True).groupBy().count())
    assert count(plan, "FileScan") == 1 and count(plan, "Expand") == 0


def test_cross_tab_reads_each_table_once(people):
    cohorts = {"ALL": None, **{f"c{i}": f"f{i}" for i in range(6)}}
    populations = {"whole": None, "a": "f1", "b": "f2"}
    table = crosstab.cross_tab(people, people.select("p", "segment"), "p", "segment", cohorts, populations, ["BUILDING"])
    plan = plan_of(table)
    assert count(plan, "FileScan") == 2 and count(plan, "Expand") == 0
    assert len(cohorts) * len(populations) == 21


def test_strata_expand_only_the_summed_table(people, spark):
    attributes = people.select("p", "segment", F.col("f1").cast("string").alias("band"))
    table = strata.case_control_counts(people.select("p", "f2", "f3"), "p", ["f2", "f3"], attributes, [["segment"], ["band"], ["segment", "band"]])
    lines = plan_of(table).splitlines()
    expands = [i for i, line in enumerate(lines) if re.search(r"\bExpand\b", line)]
    below = "\n".join(lines[expands[0]:])
    assert len(expands) == 1 and below.count("HashAggregate") >= 2, "entity rows are neither made long nor copied once per set"


def test_many_columns_are_summed_in_blocks(spark):
    names = [f"c{i}" for i in range(250)]
    wide = spark.range(300).select(F.col("id").alias("p"), *[F.when(F.col("id") % 7 != i % 7, (F.col("id") + i) % 3 == 0).alias(c) for i, c in enumerate(names)])
    attributes = spark.range(300).select(F.col("id").alias("p"), (F.col("id") % 2).cast("string").alias("side"))
    table = strata.case_control_counts(wide, "p", names, attributes, [["side"]])
    assert count(plan_of(table), "Expand") == 1
    got = {(r.concept, r.side, r["class"]): (r.n_pids, r.numerator) for r in table.collect()}
    for i in (0, 1, 99, 100, 249):
        values = {side: [(p + i) % 3 == 0 for p in range(side, 300, 2) if p % 7 != i % 7] for side in (0, 1)}
        for name, wanted in (("Cases", True), ("Controls", False)):
            counts = {side: v.count(wanted) for side, v in values.items()}
            assert all(got[f"c{i}", str(side), name] == (n, sum(counts.values())) for side, n in counts.items())
    assert len(got) == 250 * 2 * 2


def test_small_limits_are_broadcast_by_their_size_and_large_ones_are_not(spark, people):
    df = people.select("segment", F.col("f1").cast("double").alias("v"), "p")
    assert "BroadcastHashJoin" in plan_of(measures.drop_extremes(df, ["segment"], "v", max_pct=0))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert "BroadcastHashJoin" not in plan_of(measures.drop_extremes(df, ["segment"], "v", max_pct=0))


@pytest.fixture(scope="module")
def orders_folder(spark, tmp_path_factory):
    """Lines and orders of some size beside short suppliers and nations; one flag holds all lines but a few."""
    folder = str(tmp_path_factory.mktemp("orders"))

    def write(name, df):
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    write("lineitem", spark.range(40_000).selectExpr(
        "id % 10000 AS l_orderkey", "id % 700 AS l_partkey", "id % 2000 AS l_suppkey", "CAST(id % 7 AS int) + 1 AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity", "CAST(xxhash64(id) % 1000000 AS double) / 7 AS l_extendedprice", "0.05D AS l_discount", "0.01D AS l_tax",
        "CASE WHEN id % 1000 = 0 THEN 'A' WHEN id % 1000 < 900 THEN 'N' END AS l_returnflag", "IF(id % 2 = 0, 'O', 'F') AS l_linestatus",
        "date_add(date'1995-01-01', CAST(id % 900 AS int)) AS l_shipdate",
    ))
    write("orders", spark.range(10_000).selectExpr("id AS o_orderkey", "xxhash64(id) % 3000 AS o_custkey"))
    write("supplier", spark.range(2_000).selectExpr("id AS s_suppkey", "CAST(id % 25 AS int) AS s_nationkey"))
    write("nation", spark.range(25).selectExpr("CAST(id AS int) AS n_nationkey", "concat('NATION_', id) AS n_name", "CAST(id % 5 AS int) AS n_regionkey"))
    write("region", spark.range(5).selectExpr("CAST(id AS int) AS r_regionkey", "concat('REGION ', id) AS r_name"))
    return folder


def test_rows_meet_their_sketches_without_being_dealt_by_flag(spark, orders_folder):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "100000", "spark.sql.adaptive.enabled": "false"}):
        table = queries()["approximate_statistics"](spark, orders_folder)
        assert count(plan_of(table), "SortMergeJoin") == 0, "no task sorts all rows of a flag"
    got = {r.l_returnflag: r for r in table.collect()}
    assert {flag: r.n for flag, r in got.items()} == {"A": 40, "N": 40_000 * 899 // 1000}
    assert all(v for r in got.values() for name, v in r.asDict().items() if name.endswith("_in_rank"))


def test_only_orders_are_joined_by_shuffling_lines(spark, orders_folder):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "30000", "spark.sql.adaptive.enabled": "false"}):
        rows = bindings.lines(bindings.ParquetTables(spark, orders_folder))
        assert count(plan_of(rows), "SortMergeJoin") == 1, "suppliers and nations are broadcast by their own sizes"
    assert rows.count() == 40_000 and rows.filter("site = 'NATION_3'").count() == 1_600


def test_measurements_are_chosen_before_they_are_joined(spark, orders_folder):
    tables = bindings.record_tables(bindings.ParquetTables(spark, orders_folder))
    plan = extracts.measurement_extract(tables, [502])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (l_orderkey") < plan.index("Join LeftSemi"), "the choice of concepts lies below the join with the orders"


def test_names_are_no_part_of_distinct_rows(spark, orders_folder):
    tables = bindings.record_tables(bindings.ParquetTables(spark, orders_folder))
    full = extracts.lab_extract(tables, [502, 503])
    first = full._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert not first.startswith("Aggregate"), "rows are made distinct before they get names"
    assert full.count() == full.distinct().count() == tables["measurement"].filter("value_as_number IS NOT NULL").join(
        tables["measurement_ext"].filter("src_id LIKE 'EHR%'"), "measurement_id"
    ).filter("(measurement_concept_id - 100) % 5 IN (2, 3)").drop("measurement_id").distinct().count() > 10_000


STURDY = [
    "flag_counts", "overlap_regions", "category_cross_tab", "combo_groups", "periods", "years_stats", "diversity_cross_tab", "site_vocabulary_matrix",
    "case_control_five_sets", "hot_group_statistics", "box_stats", "histogram", "latest_with_unit_list", "entity_summary", "drop_extremes", "trim",
    "ancestor_extract", "concept_lookup", "allocate_plates", "final_samples", "sample_qc", "manifest_labels", "threshold_dimension",
]


@pytest.mark.parametrize("name", STURDY)
def test_results_do_not_hang_on_settings(spark, folder, name):
    """No broadcast, no adaptive execution, another number of partitions, other input splits."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "7", "spark.sql.files.maxPartitionBytes": "16384", "spark.sql.files.openCostInBytes": "1024",
    }
    with settings(spark, **conf):
        df = queries()[name](spark, folder)
        assert "Broadcast" not in plan_of(df).replace("BroadcastQueryStage", "")
        assert compare(df, connect(folder), oracle_sql()[name]) is None
