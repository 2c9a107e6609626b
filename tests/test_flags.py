from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import crosstab, flags
from tallyloom.plans import fixed_values

NAMES = ["PPI", "PM", "EHR"]


def people(spark):
    return spark.createDataFrame(
        [(1, 1, 1, 1), (2, 1, None, 0), (3, 0, 0, 0), (4, None, None, None), (5, 0, 1, 1), (6, 1, 0, 0)],
        "person_id long, PPI int, PM int, EHR int",
    )


def test_counts_and_invariants(spark):
    df = people(spark)
    by_flag = {r.data_type: (r.n, r.ratio) for r in flags.count_by_flag(df, "person_id", NAMES).collect()}
    assert by_flag == {"PPI": (3, 0.5), "PM": (2, 2 / 6), "EHR": (2, 2 / 6), "None": (2, 2 / 6)}
    by_n = {r.label: r.n for r in flags.count_by_n_flags(df, "person_id", NAMES).collect()}
    assert by_n == {
        "Participants with 0 Data Type(s)": 2, "Participants with ONLY 1 Data Type(s)": 2,
        "Participants with ONLY 2 Data Type(s)": 1, "Participants with all 3 Data Type(s)": 1, "TOTAL PARTICIPANTS": 6}
    combos = {r.combo: r.n for r in flags.count_by_flag_combo(df, "person_id", NAMES).collect()}
    assert combos == {"None": 2, "PPI": 2, "PM and EHR": 1, "PPI and PM and EHR": 1, "TOTAL PARTICIPANTS": 6}
    regions = {r.region: (r.n, r.n_label) for r in flags.overlap_regions(df, "person_id", NAMES).collect()}
    assert len(regions) == 7 and sum(n for n, _ in regions.values()) == 6 - by_flag["None"][0]
    assert regions["100"] == (2, "<20") and regions["110"] == (0, "<20")


def test_rows_of_one_entity_are_merged(spark):
    twice = people(spark).unionByName(people(spark).withColumn("PM", F.lit(1)))
    by_flag = {r.data_type: r.n for r in flags.count_by_flag(twice, "person_id", NAMES).collect()}
    assert by_flag == {"PPI": 3, "PM": 6, "EHR": 2}


def test_populations_are_independent(spark):
    df = people(spark).withColumn("a", (F.col("person_id") <= 3).cast("int")).withColumn("b", (F.col("person_id") > 3).cast("int"))
    table = flags.flag_counts_by_population(df, "person_id", ["PPI", "PM"], {"All": None, "A": "a", "B": "b"})
    assert {(r.data_type, r.population): r.n for r in table.collect()} == {
        ("PPI", "All"): 3, ("PM", "All"): 2, ("PPI", "A"): 2, ("PM", "A"): 1, ("PPI", "B"): 1, ("PM", "B"): 1}


def test_all_fixed_intersections(spark):
    df = people(spark).withColumn("Fitbit", F.lit(1)).withColumn("WGS", (F.col("person_id") != 6).cast("int"))
    table = flags.flag_intersections(df, "person_id", F.col("WGS") == 1, "WGS", fixed_values.DATA_TYPE_COMBINATIONS)
    assert {r.combination: r.n for r in table.collect()} == {
        "WGS": 5, "WGS and PPI": 2, "WGS and PPI and PM": 1, "WGS and EHR": 2, "WGS and PPI and EHR": 1,
        "WGS and PPI and EHR and PM": 1, "WGS and Fitbit": 5, "WGS and PPI and Fitbit": 2, "WGS and PPI and PM and Fitbit": 1,
        "WGS and Fitbit and PPI and EHR": 1, "WGS and PPI and EHR and PM and Fitbit": 1}


def test_combo_groups_sort_and_pad(spark):
    answers = spark.createDataFrame(
        [(1, "White"), (1, "Asian"), (1, "White"), (2, "White"), (3, None), (4, "B"), (4, "A"), (5, "Skip")],
        "person_id long, race string",
    )
    table = flags.combo_groups(answers, "person_id", "race", fixed_values.RACE_GROUPS).collect()
    assert [(r.group, r.n) for r in table] == [("Asian,White", 1), ("White", 1), ("Other", 2), ("Skip", 1), ("Total", 5)]


def test_several_answers_collapse(spark):
    answers = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None)], "p long, c string")
    assert rows(flags.multi_answer(answers, "p", "c")) == [(1, "a"), (2, "Multiple Selections"), (3, None)]


def cohorts(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 1, 0)], "p long, x int, empty int")


def test_cross_tab_zero_cohort_and_unlisted(spark):
    answers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (1, "a")], "p long, c string")
    table = crosstab.cross_tab(
        cohorts(spark), answers, "p", "c", {"ALL": None, "X": "x"}, {"whole": None, "nobody": "empty"}, ["a", "b", "never"])
    cells = {(r.population, r.cohort, r.category): (r.n, r.ratio) for r in table.collect()}
    assert cells[("whole", "ALL", "a")] == (1, 0.25)
    assert cells[("whole", "X", "b")] == (0, 0.0)
    assert cells[("whole", "ALL", "never")] == (0, 0.0)
    assert cells[("whole", "ALL", "TOTAL")] == (4, 1.0)
    assert cells[("nobody", "X", "a")] == (0, 0.0) and cells[("nobody", "ALL", "TOTAL")] == (0, 0.0)
    assert not any(c in ("z", "Multiple Selections", "Not Specified") for _, _, c in cells)


def test_cross_tab_multi_counted_total_repeats(spark):
    answers = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "p long, c string")
    table = crosstab.cross_tab(
        cohorts(spark), answers, "p", "c", {"ALL": None}, {"whole": None}, ["a", "b", "Not Specified"], multi_counted=True)
    assert {r.category: (r.n, r.ratio) for r in table.collect()} == {
        "a": (1, 0.25), "b": (2, 0.5), "Not Specified": (2, 0.5), "TOTAL": (5, 1.25)}


def test_matrix_totals_are_distinct(spark):
    records = spark.createDataFrame(
        [(1, "s1", "d1"), (1, "s2", "d1"), (2, "s1", "d1"), (2, "s1", "d2"), (3, "s2", None)], "p long, site string, d string")
    size = spark.createDataFrame([(10,)], "n long")
    cells = {(r.row, r.col): r.n for r in crosstab.entity_matrix(records, "p", "site", "d", size).collect()}
    assert cells == {
        ("s1", "d1"): 2, ("s2", "d1"): 1, ("s1", "d2"): 1, ("TOTAL PIDS", "d1"): 2, ("TOTAL PIDS", "d2"): 1,
        ("s1", "Any EHR"): 2, ("s2", "Any EHR"): 2, ("TOTAL PIDS", "Any EHR"): 3}


def test_absent_categories_keep_their_label(spark):
    whole = spark.createDataFrame([("a", 5, 0.5), ("b", 5, 0.5)], "c string, n long, ratio double")
    part = spark.createDataFrame([("a", 2, 1.0)], "c string, n long, ratio double")
    table = crosstab.align_populations({"Whole": whole, "Part": part}, "c", "Whole")
    assert ("b", 0, 0.0, "Part") in rows(table)


def test_position_by_part(spark):
    from tallyloom.operators.shares import position

    df = spark.createDataFrame([("sex at birth none of these",), ("Woman",), ("Man",), ("else",)], "v string")
    order = ["Woman", "Man", "None Of These"]
    assert rows(df.select("v", position(F.col("v"), order).alias("exact"), position(F.col("v"), order, exact=False).alias("part"))) == [
        ("Man", 2, 2), ("Woman", 1, 1), ("else", None, None), ("sex at birth none of these", None, 3)]


def test_every_flag_table_reads_the_lattice(spark):
    """A table of 2 ** n rows at most gives what the entities give."""
    names = ["a", "b", "c"]
    df = spark.range(300).selectExpr("id", "cast(id % 2 as int) a", "cast(id % 3 = 0 as int) b", "CASE WHEN id % 5 < 2 THEN 1 END AS c", "cast(id % 7 = 0 as int) m")
    sets = flags.flag_lattice(df, "id", names, ["m"], unique=True)
    assert sets.count() <= 16 and sets.columns == [*names, "m", flags.ENTITIES]
    assert "Aggregate" not in sets._jdf.queryExecution().optimizedPlan().toString()
    for part, whole in ((sets, df), (sets.filter("m = 1"), df.filter("m = 1"))):
        for table in (flags.count_by_flag, flags.count_by_n_flags, flags.count_by_flag_combo, flags.overlap_regions):
            assert rows(table(part, "id", names)) == rows(table(whole, "id", names, unique=True)), table
    populations = {"all": None, "m": "m"}
    assert rows(flags.flag_counts_by_population(sets, "id", names, populations)) == rows(flags.flag_counts_by_population(df, "id", names, populations, unique=True))
    chosen, combos = F.col("m") == 1, [[], ["a"], ["a", "c"]]
    assert rows(flags.flag_intersections(sets, "id", chosen, "m", combos)) == rows(flags.flag_intersections(df, "id", chosen, "m", combos, unique=True))
    for got, want in zip(flags.flag_tables(df, "id", names, unique=True), flags.flag_tables(sets, "id", names), strict=True):
        assert rows(got) == rows(want)
    assert rows(flags.count_by_flag(sets.limit(0), "id", names)) == rows(flags.count_by_flag(df.limit(0), "id", names))
