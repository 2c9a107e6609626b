"""The same queries as plain SQL over the same tables, to check the results against."""

from __future__ import annotations

from .bindings import ANSWERS, CODES, HIGH_BALANCE, HIGH_VALUE, QUESTION_OF, STATUSES
from .fixed_values import HEADLINES

FLAG_ROWS = f"""
f AS (
  SELECT c_custkey AS person_id,
         CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS household,
         CAST(c_acctbal > {HIGH_BALANCE} AS INTEGER) AS high_balance,
         CAST(r_name = 'ASIA' AS INTEGER) AS in_asia,
         CAST(c_custkey IN (SELECT user_id FROM events) AS INTEGER) AS has_events,
         CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > {HIGH_VALUE}) AS INTEGER) AS high_value_order,
         CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS INTEGER) AS has_urgent
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

FLAG_SETS = FLAG_ROWS + """,
s AS (
  SELECT *, has_events + household + high_balance + high_value_order + has_urgent AS n_flags,
         coalesce(nullif(concat_ws(' and ', CASE WHEN has_events = 1 THEN 'has_events' END,
           CASE WHEN household = 1 THEN 'household' END, CASE WHEN high_balance = 1 THEN 'high_balance' END,
           CASE WHEN high_value_order = 1 THEN 'high_value_order' END, CASE WHEN has_urgent = 1 THEN 'has_urgent' END), ''),
           'None') AS combo
  FROM f
)"""

FLAG_NAMES = ["has_events", "household", "high_balance", "high_value_order", "has_urgent"]
BY_FLAG = " UNION ALL ".join(
    [f"SELECT '{n}' AS data_type, sum({n})::BIGINT AS n FROM s" for n in FLAG_NAMES]
    + ["SELECT 'None', count(*) FROM s WHERE n_flags = 0"]
)
NUMBER_LABEL = """CASE n_flags WHEN 0 THEN 'Participants with 0 Data Type(s)' WHEN 5 THEN 'Participants with all 5 Data Type(s)'
  ELSE 'Participants with ONLY ' || n_flags || ' Data Type(s)' END"""
CELL = "format('{:,}', n) || ' (' || printf('%.2f%%', ratio * 100) || ')'"
SUPPRESSED = """CASE WHEN n < 20 THEN '<20' ELSE format('{:,}', n) END || ' (' ||
  CASE WHEN n < 20 THEN '-' WHEN ratio < 0.01 THEN '<1%' ELSE printf('%.0f%%', ratio * 100) END || ')'"""


def total_rows(table: str, label: str, text: str, nulls: str = "") -> str:
    return f"SELECT {nulls} '{text}' AS {label}, sum(n)::BIGINT AS n FROM {table}"


COHORT_RULE = """(population = 'Whole' OR (population = 'Asia' AND in_asia = 1) OR (population = 'Events' AND has_events = 1))
  AND (cohort = 'OVERALL' OR (cohort = 'EVENTS' AND has_events = 1) OR (cohort = 'HOUSEHOLD' AND household = 1)
    OR (cohort = 'BALANCE' AND high_balance = 1) OR (cohort = 'VALUE' AND high_value_order = 1)
    OR (cohort = 'URGENT' AND has_urgent = 1))"""


def cross_tab(answers: str, order: list[str], several: bool, keep_unlisted: bool = False) -> str:
    """CTEs up to ``x``: population, cohort, category, sort_ord, n, ratio."""
    listed = [*order, *(["Multiple Selections"] if several else [])]
    frame = ", ".join([f"('{c}', {i + 1})" for i, c in enumerate(listed)] + ["('TOTAL', 10000)"])
    return f"""WITH {FLAG_ROWS},
a AS ({answers}),
pc AS (SELECT * FROM (VALUES ('Whole'), ('Asia'), ('Events')) p(population),
  (VALUES ('OVERALL'), ('EVENTS'), ('HOUSEHOLD'), ('BALANCE'), ('VALUE'), ('URGENT')) c(cohort)),
m AS (SELECT person_id, population, cohort FROM f, pc WHERE {COHORT_RULE}),
g AS (SELECT population, cohort, coalesce(category, 'Not Specified') AS category, count(DISTINCT person_id) AS n
      FROM m LEFT JOIN a USING (person_id) GROUP BY ALL),
d AS (SELECT population, cohort, count(DISTINCT person_id) AS size FROM m GROUP BY ALL),
r AS (SELECT * FROM g UNION ALL SELECT population, cohort, 'TOTAL', sum(n)::BIGINT FROM g GROUP BY population, cohort),
v AS (SELECT * FROM (VALUES {frame}) v(category, sort_ord)
      {"UNION ALL SELECT DISTINCT category, 9999 FROM g WHERE category NOT IN (" + ", ".join(f"'{c}'" for c in listed) + ")" if keep_unlisted else ""}),
o AS (SELECT * FROM pc, v),
x AS (
  SELECT population, cohort, category, CAST(sort_ord AS INTEGER) AS sort_ord, coalesce(n, 0) AS n,
         coalesce(n / nullif(size, 0), 0.0) AS ratio
  FROM o LEFT JOIN r USING (population, cohort, category) LEFT JOIN d USING (population, cohort)
  QUALIFY category <> 'Multiple Selections' OR max(n) OVER (PARTITION BY category) > 0
)"""


PRIORITY_ANSWERS = "SELECT DISTINCT o_custkey AS person_id, o_orderpriority AS category FROM orders"
ONE_PRIORITY = """SELECT o_custkey AS person_id,
  CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN 'Multiple Selections' ELSE min(o_orderpriority) END AS category
  FROM orders GROUP BY 1"""
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

RAW_ANSWERS = """raw AS (
  SELECT o_custkey AS person_id, year(o_orderdate) AS year,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Priority: PMI none of these here'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Priority: prefer not to answer'
              ELSE 'Priority: less ' || o_orderpriority || 'k o''b' END AS answer
  FROM orders)"""


def title(text: str) -> str:
    runs = f"regexp_extract_all(lower({text}), '([a-z]+|[^a-z]+)')"
    return f"list_aggregate(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), 'string_agg', '')"


HISTORY_ROWS = """h AS (
  SELECT o_custkey AS person_id, 'Order' AS domain, o_orderpriority AS code, o_orderdate AS t0, o_orderdate AS t1 FROM orders
  UNION ALL SELECT o_custkey, 'Line', l_returnflag, l_shipdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT user_id, 'Event', event_type, ts, NULL FROM events),
p AS (SELECT person_id, domain, code, min(t0) AS t0, coalesce(max(t1), (SELECT max(l_shipdate) FROM lineitem)) AS t1
      FROM h GROUP BY ALL),
spans AS (SELECT * FROM p UNION ALL SELECT DISTINCT person_id, 'Any', code, t0, t1 FROM p),
y AS (SELECT person_id, domain,
             greatest(abs(floor(date_diff('microsecond', min(t0), max(t1)) / 86400000000.0)), 1) / 365 AS years
      FROM spans GROUP BY ALL)"""

LINES = """l AS (
  SELECT lineitem.*, o_custkey AS person_id, n_name AS site, s_nationkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
TYPED_LINES = LINES + ", tl AS (SELECT l.*, p_type AS concept FROM l JOIN part ON l_partkey = p_partkey)"

CUMULATIVE = """
y AS (SELECT o_custkey AS person_id, o_orderpriority AS domain, year(o_orderdate) AS year FROM orders
      UNION ALL SELECT o_custkey, 'Any', year(o_orderdate) FROM orders),
first_year AS (SELECT domain, person_id, min(year) AS year FROM y GROUP BY ALL),
seen AS (SELECT DISTINCT domain, year FROM y),
new AS (SELECT domain, year, count(person_id) AS n_new FROM seen LEFT JOIN first_year USING (domain, year) GROUP BY ALL),
cum AS (SELECT domain, CAST(year AS INTEGER) AS year, n_new, (sum(n_new) OVER (PARTITION BY domain ORDER BY year))::BIGINT AS cum_n FROM new),
c AS (SELECT *, round_even(cum_n / (SELECT count(*) FROM customer) * 100 * 100, 0) / 100 AS cum_pct FROM cum)"""

GROUPS = f"""g AS (
  SELECT c_custkey AS person_id,
         max(CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'yes' ELSE 'no' END) AS grp_segment,
         max(CASE WHEN c_acctbal < 0 OR c_acctbal >= 9000 THEN 'yes' ELSE 'no' END) AS grp_balance,
         max(CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > {HIGH_VALUE} THEN 'yes' ELSE 'no' END) AS grp_pressing_order
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1),
gg AS (SELECT *, greatest(grp_segment, grp_balance, grp_pressing_order) AS grp_overall FROM g)"""

EVENT_DOMAINS = """dom AS (
  SELECT c_custkey AS person_id, coalesce(event_type, 'No Data') AS domain
  FROM customer LEFT JOIN (SELECT DISTINCT user_id, event_type FROM events) ON c_custkey = user_id
  UNION ALL SELECT c_custkey, 'All Pids' FROM customer)"""


def matrix(rows: str) -> str:
    """Distinct persons by row and col, with the total row and the any-column, over ``rows``."""
    return f"""WITH {TYPED_LINES}, b AS ({rows}),
k AS (SELECT person_id, "row", col FROM b WHERE col IS NOT NULL
      UNION SELECT person_id, 'TOTAL PIDS', col FROM b WHERE col IS NOT NULL
      UNION SELECT person_id, "row", 'Any EHR' FROM b UNION SELECT person_id, 'TOTAL PIDS', 'Any EHR' FROM b),
x AS (SELECT "row", col, count(DISTINCT person_id) AS n, count(DISTINCT person_id) / (SELECT count(*) FROM customer) AS ratio
      FROM k GROUP BY ALL)"""


CLASSES = """w AS (
  SELECT doc_id, lang, source, concept, CASE WHEN flag = 1 THEN 'Cases' ELSE 'Controls' END AS class
  FROM (SELECT doc_id, 'quality' AS concept, quality AS flag FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels)
  JOIN documents USING (doc_id))"""


def number_text(x: str) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


def percent_label(table: str) -> str:
    """Add pct and label to rows with n_pids and numerator."""
    return f"""SELECT *, format('{{:,}}', n_pids) || ' (' || {number_text('pct')} || '%)' AS label
FROM (SELECT *, coalesce(round_even(n_pids / numerator * 100 * 100, 0) / 100, 0.0) AS pct FROM ({table}))"""


def stratum(keys: list[str], attributes: tuple[str, ...] = ("lang", "source")) -> str:
    picked = ", ".join(f"{k if k in keys else 'NULL'} AS {k}" for k in attributes)
    name = " x ".join(keys)
    return f"""SELECT '{name}' AS stratum, concept, {picked}, class, count(DISTINCT doc_id) AS n_pids,
  (sum(count(DISTINCT doc_id)) OVER (PARTITION BY concept, class))::BIGINT AS numerator
  FROM w GROUP BY concept, class, {', '.join(keys)}"""


QUANTILES = ", ".join(
    f"round(quantile_cont(v, {p}), 4) AS q{round(p * 100):02d}" for p in (0.01, 0.02, 0.25, 0.5, 0.75, 0.98, 0.99)
)
MOMENTS = "count(v) AS n, round(avg(v), 4) AS mean, round(min(v), 4) AS min, round(max(v), 4) AS max, round(stddev_samp(v), 4) AS sd"

MEASURED = TYPED_LINES + """, me AS (
  SELECT person_id, concept, site, l_shipdate, l_linestatus AS operator, concept || '-' || l_returnflag AS source_concept, CASE WHEN l_linenumber < 7 THEN l_extendedprice END AS value,
         CASE WHEN l_quantity > 1 THEN l_linenumber END AS unit_id,
         CASE WHEN l_returnflag = 'A' THEN 'mg/dl' WHEN l_linestatus = 'O' THEN 'no value' ELSE 'Percent' END AS unit
  FROM tl)"""

OUTLIERS = """ov AS (
  SELECT p_partkey, p_brand, p_type,
         CASE p_size WHEN 50 THEN p_retailprice * 6 WHEN 49 THEN -p_retailprice * 9 WHEN 48 THEN -1.0
              ELSE p_retailprice END AS value FROM part),
top AS (SELECT p_brand, p_type, max(value) AS hi, min(value) AS lo FROM ov GROUP BY ALL),
sec AS (SELECT p_brand, p_type, any_value(hi) AS hi, any_value(lo) AS lo, max(CASE WHEN value < hi THEN value END) AS hi2,
               min(CASE WHEN value > lo THEN value END) AS lo2
        FROM ov JOIN top USING (p_brand, p_type) GROUP BY ALL),
lim AS (SELECT p_brand, p_type,
               CASE WHEN round_even(hi * 100 / nullif(hi2, 0), 0) >= 400 THEN hi END AS drop_at_or_above,
               CASE WHEN abs(round_even(lo * 100 / nullif(lo2, 0), 0)) >= 400 THEN lo END AS drop_at_or_below FROM sec)"""

HARMONISED = LINES + """, ha AS (
  SELECT person_id, site, l_returnflag AS raw_unit, l_quantity AS raw_value,
         CASE l_returnflag WHEN 'A' THEN l_quantity * 0.5 WHEN 'N' THEN l_quantity * 2.0 ELSE l_quantity END AS value,
         CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'standard' END AS unit, l_returnflag <> 'R' AS harmonised FROM l)"""

RECORDS = LINES + """,
con AS (
  SELECT n_nationkey + 100 AS id, n_name AS name, n_name || '-CODE' AS code FROM nation
  UNION ALL SELECT r_regionkey + 500, r_name, r_name || '-CODE' FROM region
  UNION ALL SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 1001 ELSE 1002 END, 'Unit ' || l_returnflag, 'Unit-' || l_returnflag
            FROM lineitem WHERE l_returnflag IN ('A', 'N')
  UNION ALL SELECT DISTINCT 2001, 'Operator O', 'Operator-O' FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL SELECT 3001, 'NATION_3-CODE', 'ANSWER'),
meas AS (
  SELECT person_id, CAST(s_nationkey + 100 AS BIGINT) AS measurement_concept_id, n_regionkey + 500 AS ancestor_id,
         l_partkey AS measurement_source_concept_id, 'Part ' || l_partkey AS measurement_source_value,
         CASE WHEN l_quantity > 2 THEN l_extendedprice END AS value_as_number, l_discount AS range_low, l_tax AS range_high,
         CAST(CASE l_returnflag WHEN 'A' THEN 1001 WHEN 'N' THEN 1002 END AS BIGINT) AS unit_concept_id,
         l_returnflag AS unit_source_value, CAST(CASE WHEN l_linestatus = 'O' THEN 2001 END AS BIGINT) AS operator_concept_id,
         CAST(CASE WHEN l_linenumber = 1 THEN 3001 END AS BIGINT) AS value_as_concept_id,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS measurement_datetime,
         CASE WHEN l_linenumber = 7 THEN 'Portal' ELSE 'EHR site ' || l_linenumber END AS src_id
  FROM l JOIN nation n ON s_nationkey = n.n_nationkey)"""

SAMPLES = """sam AS (
  SELECT o_orderkey AS sample_id, o_custkey AS participant_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS collected, n_name AS state,
         CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS negative_control, 'No' AS positive_control
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

BATCH = SAMPLES + """,
earlier AS (SELECT sample_id FROM sam WHERE negative_control = 'No' ORDER BY collected DESC, sample_id LIMIT 500),
batch AS (SELECT * FROM sam WHERE negative_control = 'No' AND sample_id NOT IN (SELECT sample_id FROM earlier)
          ORDER BY collected DESC, sample_id LIMIT 900)"""


def controls(name: str, pool: str, key: str, order: str, plates: int = 10) -> str:
    """CTE of controls on two plates each."""
    half = plates // 2
    return f"""{name}_drawn AS (SELECT * FROM ({pool}) ORDER BY {order}, {key} LIMIT {half}),
{name}_ranked AS (SELECT *, row_number() OVER (ORDER BY {key}) AS up, (SELECT count(*) FROM {name}_drawn) AS k FROM {name}_drawn),
{name} AS (SELECT * EXCLUDE (up, k), CAST(up AS INTEGER) AS plate FROM {name}_ranked
  UNION ALL SELECT * EXCLUDE (up, k), CAST(2 * k - up + 1 AS INTEGER) FROM {name}_ranked)"""


MODULAR = "(sample_id * 7919) % 10007"
NEGATIVES = controls(
    "neg", "SELECT * FROM sam WHERE negative_control = 'Yes' AND state IN (SELECT state FROM batch)", "sample_id", MODULAR
)
POSITIVES = controls(
    "pos", "SELECT 'P' || s_suppkey AS positive_control_id, s_acctbal AS volume, s_suppkey AS nr FROM supplier",
    "positive_control_id", "(nr * 7919) % 10007",
)
FINAL = BATCH + ", " + NEGATIVES + ", " + POSITIVES + f""",
plated AS (SELECT *, CAST(ceil(row_number() OVER (ORDER BY state, {MODULAR}, sample_id) / 94) AS INTEGER) AS plate FROM batch),
fin AS (
  SELECT collected, negative_control, participant_id, plate, positive_control, NULL AS positive_control_id, sample_id, state,
         CAST(NULL AS DOUBLE) AS volume FROM plated
  UNION ALL SELECT collected, negative_control, participant_id, plate, positive_control, NULL, sample_id, state, NULL FROM neg
  UNION ALL SELECT NULL, 'No', NULL, plate, 'Yes', positive_control_id, NULL, NULL, volume FROM pos)"""

PRIORITY_COUNTS = """pcount AS (
  SELECT c_nationkey, o_orderpriority, o_orderstatus, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS ratio
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def hidden(text: str) -> str:
    """Suppression of a finished cell by its leading count."""
    number = f"TRY_CAST(regexp_replace(split_part({text}, ' (', 1), '[,%]', '', 'g') AS DOUBLE)"
    return f"CASE WHEN {number} = 0 THEN '-' WHEN {number} < 20 THEN '<20' ELSE {text} END"


def combo_table(where: str) -> str:
    """combo, n, ratio with the total row, for the flag rows that meet a condition."""
    return f"""SELECT combo, n, n / sum(CASE WHEN combo <> 'TOTAL PARTICIPANTS' THEN n END) OVER () AS ratio FROM (
  SELECT combo, count(*) AS n FROM s WHERE {where} GROUP BY 1
  UNION ALL SELECT 'TOTAL PARTICIPANTS', count(*) FROM s WHERE {where})"""


def histogram_step() -> str:
    lead = "(rough / pw)"
    return f"""pw * CASE WHEN 10 - {lead} < 1.5 * ({lead} - 5) THEN 10.0 WHEN 5 - {lead} < 2.75 * ({lead} - 2) THEN 5.0
  WHEN 2 - {lead} < 1.5 * ({lead} - 1) THEN 2.0 ELSE 1.0 END"""


ORACLES: dict[str, str] = {
    "flag_counts": f"WITH {FLAG_SETS} SELECT data_type, n, n / (SELECT count(*) FROM s) AS ratio FROM ({BY_FLAG}) WHERE n > 0",
    "n_flag_distribution": f"""WITH {FLAG_SETS}, c AS (SELECT CAST(n_flags AS INTEGER) AS n_flags, {NUMBER_LABEL} AS label, count(*) AS n FROM s GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL {total_rows('c', 'label', 'TOTAL PARTICIPANTS', 'NULL AS n_flags,')})
SELECT *, n / (SELECT count(*) FROM s) AS ratio FROM a""",
    "flag_combinations": f"""WITH {FLAG_SETS}, c AS (SELECT CAST(n_flags AS INTEGER) AS n_flags, {NUMBER_LABEL} AS label, combo, count(*) AS n FROM s GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL {total_rows('c', 'combo', 'TOTAL PARTICIPANTS', 'NULL, NULL,')})
SELECT *, n / (SELECT count(*) FROM s) AS ratio FROM a""",
    "flag_table_labels": f"""WITH {FLAG_SETS}, c AS (
  SELECT 'flag' AS part, data_type AS "row", n FROM ({BY_FLAG}) WHERE n > 0
  UNION ALL SELECT 'number', {NUMBER_LABEL}, count(*) FROM s GROUP BY n_flags
  UNION ALL SELECT 'number', 'TOTAL PARTICIPANTS', count(*) FROM s
  UNION ALL SELECT 'combination', combo, count(*) FROM s GROUP BY combo
  UNION ALL SELECT 'combination', 'TOTAL PARTICIPANTS', count(*) FROM s)
SELECT part, "row", {CELL} AS cell FROM (SELECT *, n / (SELECT count(*) FROM s) AS ratio FROM c)""",
    "flag_counts_by_population": f"""WITH {FLAG_ROWS}, m AS (
  SELECT f.*, population FROM f, (VALUES ('Whole'), ('Asia'), ('Events')) v(population)
  WHERE population = 'Whole' OR (population = 'Asia' AND in_asia = 1) OR (population = 'Events' AND has_events = 1)),
t AS ({" UNION ALL ".join(f"SELECT '{n.replace('_', ' ')}' AS data_type, population, sum({n})::BIGINT AS n, sum({n}) / count(*) AS ratio FROM m GROUP BY population" for n in FLAG_NAMES)})
SELECT * FROM t WHERE n > 0""",
    "overlap_regions": f"""WITH {FLAG_ROWS}, c AS (
  SELECT concat(has_events, household, high_balance, high_value_order, has_urgent) AS region, count(*) AS n FROM f GROUP BY 1)
SELECT region, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) < 20 THEN '<20' ELSE format('{{:,}}', n) END AS n_label
FROM (SELECT lpad(bin(i), 5, '0') AS region FROM range(1, 32) r(i)) LEFT JOIN c USING (region)""",
    "flag_intersections": f"""WITH {FLAG_ROWS}, b AS (SELECT * FROM f WHERE has_urgent = 1 AND high_value_order = 1)
SELECT 'urgent and high value' AS combination, count(*) AS n FROM b
UNION ALL SELECT 'urgent and high value and has_events', count(*) FROM b WHERE has_events = 1
UNION ALL SELECT 'urgent and high value and household', count(*) FROM b WHERE household = 1
UNION ALL SELECT 'urgent and high value and household and high_balance', count(*) FROM b WHERE household = 1 AND high_balance = 1
UNION ALL SELECT 'urgent and high value and has_events and household and high_balance', count(*) FROM b
  WHERE has_events = 1 AND household = 1 AND high_balance = 1""",
    "flag_matrix": f"WITH {FLAG_ROWS} SELECT * FROM f",
    "cohort_flags": """WITH u AS (
  SELECT c_custkey AS person_id,
         CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') AS INTEGER) AS urgent_open,
         CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1996) AS INTEGER) AS early,
         CAST(c_acctbal < 0 AS INTEGER) AS in_debt,
         CAST(lower(c_mktsegment) LIKE 'b%' OR lower(c_mktsegment) LIKE '%ery' AS INTEGER) AS builds
  FROM customer)
SELECT *, CAST(urgent_open = 1 OR early = 1 AS INTEGER) AS urgent_or_early, CAST(urgent_open = 1 AND early = 1 AS INTEGER) AS urgent_and_early FROM u""",
    "headline_counts": f"""SELECT 'Total' AS label, count(DISTINCT c_custkey) AS n FROM customer
UNION ALL SELECT 'In Asia', count(DISTINCT c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
UNION ALL SELECT 'Low or unspecified priority', count(DISTINCT o_custkey) FROM orders WHERE lower(o_orderpriority) LIKE '%low' OR lower(o_orderpriority) LIKE '%not spec%'
UNION ALL SELECT 'Not finished', count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus NOT IN ('F') AND o_orderstatus IS NOT NULL
UNION ALL SELECT 'Any activity', count(*) FROM (SELECT o_custkey FROM orders UNION SELECT user_id FROM events)
UNION ALL SELECT 'Purchase', count(DISTINCT user_id) FROM events WHERE lower(event_type) LIKE 'purch%'
UNION ALL SELECT 'Very high value', count(DISTINCT o_custkey) FROM orders WHERE o_totalprice > {HIGH_VALUE}
UNION ALL SELECT 'Unknown status', count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus IS NULL""",
    "category_cross_tab": cross_tab(
        "SELECT c_custkey AS person_id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS category FROM customer",
        ["Building", "Household", "Machinery", "Furniture", "Never Seen"], several=True,
    ) + " SELECT * FROM x",
    "multi_answer_cross_tab": cross_tab(ONE_PRIORITY, PRIORITY_ORDER[:4], several=True, keep_unlisted=True) + f" SELECT *, {CELL} AS label FROM x",
    "multi_counted_cross_tab": cross_tab(PRIORITY_ANSWERS, PRIORITY_ORDER, several=False) + " SELECT * FROM x",
    "cross_tab_wide": cross_tab(PRIORITY_ANSWERS, PRIORITY_ORDER, several=False) + " SELECT category, sort_ord, " + ", ".join(
        f"max(CASE WHEN cohort = '{c}' AND population = '{p}' THEN {CELL} END) AS {c}__{p}"
        for c in ("OVERALL", "URGENT", "EVENTS") for p in ("Whole", "Asia", "Events")
    ) + " FROM x GROUP BY ALL",
    "banded_counts": """SELECT
  CASE WHEN p_size > 39 THEN '40+' WHEN p_size > 29 THEN '30-39' WHEN p_size > 19 THEN '20-29' WHEN p_size > 9 THEN '10-19' WHEN p_size >= 0 THEN '00-09' END AS closed,
  CASE WHEN p_size > 39 THEN '40+' WHEN p_size > 29 THEN '30-39' WHEN p_size > 19 THEN '20-29' WHEN p_size >= 10 THEN '10-19' END AS from_ten,
  CASE WHEN p_size > 39 THEN '40+' WHEN p_size > 29 THEN '30-39' WHEN p_size > 19 THEN '20-29' ELSE '<20' END AS from_first,
  count(*) AS n FROM part GROUP BY ALL""",
    "answer_cleaning": f"""WITH {RAW_ANSWERS}, v AS (SELECT person_id, year, lower(split_part(answer, ': ', 2)) AS v FROM raw),
c AS (SELECT person_id, year, {title("CASE WHEN v LIKE '%none of these%' THEN 'none of these' WHEN v = 'prefer not to answer' THEN 'not specified' ELSE v END")} AS t FROM v),
o AS (SELECT person_id, year, CASE WHEN count(DISTINCT t) > 1 THEN 'Multiple Selections' ELSE min(CASE WHEN t = 'Less 1-UrgentK O''B' THEN 'Urgent' ELSE t END) END AS answer FROM c GROUP BY ALL)
SELECT answer, count(*) AS n FROM o GROUP BY ALL""",
    "answer_cleaning_stem_last": f"""WITH {RAW_ANSWERS},
o AS (SELECT person_id, year, CASE WHEN count(DISTINCT answer) > 1 THEN 'Multiple Selections' ELSE min(answer) END AS answer FROM raw GROUP BY ALL),
c AS (SELECT {title("CASE WHEN contains(answer, ': ') THEN split_part(answer, ': ', 2) ELSE answer END")} AS answer FROM o)
SELECT CASE WHEN answer = 'Prefer Not To Answer' THEN 'Not Specified' ELSE answer END AS answer, count(*) AS n FROM c GROUP BY ALL""",
    "multi_answer_columns": f"""SELECT o_custkey AS person_id,
  CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'Multiple Selections' ELSE min(o_orderstatus) END AS status,
  CASE WHEN count(DISTINCT o_totalprice > {HIGH_VALUE}) > 1 THEN 'Multiple Selections' WHEN bool_or(o_totalprice > {HIGH_VALUE}) THEN 'high' ELSE 'usual' END AS value_class
  FROM orders GROUP BY 1""",
    "combo_groups": """WITH a AS (
  SELECT o_orderkey, coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag), 'None') AS g
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
c AS (SELECT CASE WHEN g IN ('A', 'N', 'R', 'A,N', 'A,N,R', 'None') THEN g ELSE 'Other' END AS "group", count(*) AS n FROM a GROUP BY 1),
z AS (SELECT * FROM c UNION ALL SELECT v.g, 0 FROM (VALUES ('Other'), ('Skip')) v(g) WHERE v.g NOT IN (SELECT "group" FROM c)),
u AS (SELECT "group", CAST(CASE "group" WHEN 'Other' THEN 1 WHEN 'Skip' THEN 2 ELSE 0 END AS INTEGER) AS sort_ord, n FROM z
      UNION ALL SELECT 'Total', 3, sum(n)::BIGINT FROM z)
SELECT "group", sort_ord, n, n / (SELECT count(*) FROM orders) AS ratio FROM u""",
    "first_seen_year": """WITH y AS (SELECT o_custkey AS person_id, o_orderpriority AS domain, year(o_orderdate) AS year FROM orders
  UNION ALL SELECT o_custkey, 'Any', year(o_orderdate) FROM orders)
SELECT person_id, domain, CAST(min(year) AS INTEGER) AS year FROM y GROUP BY ALL""",
    "cumulative_entities": f"WITH {CUMULATIVE} SELECT * FROM c",
    "cumulative_entities_shown": f"WITH {CUMULATIVE} SELECT * FROM c WHERE year BETWEEN 1996 AND 2001",
    "year_pivot": f"WITH {CUMULATIVE} SELECT year, " + ", ".join(
        f"coalesce(max(CASE WHEN domain = '{p}' THEN cum_pct END), 0) AS p{i + 1}" for i, p in enumerate(PRIORITY_ORDER)
    ) + " FROM c WHERE domain <> 'Any' GROUP BY year",
    "periods": f"""WITH {HISTORY_ROWS} SELECT person_id, domain, code, CAST(CAST(t0 AS DATE) AS VARCHAR) AS start,
  CAST(CAST(t1 AS DATE) AS VARCHAR) AS "end" FROM spans""",
    "years_of_data": f"WITH {HISTORY_ROWS} SELECT person_id, domain, round(years, 6) AS years FROM y",
    "years_stats": f"""WITH {HISTORY_ROWS} SELECT domain, count(*) AS n, """ + ", ".join(
        f"round_even({a} * 100, 0) / 100 AS {n}" for n, a in (
            ("mean", "avg(years)"), ("median", "quantile_cont(years, 0.5)"), ("min", "min(years)"), ("max", "max(years)"), ("std", "stddev_samp(years)"))
    ) + " FROM y GROUP BY domain",
    "domain_cross_tab": f"""WITH {EVENT_DOMAINS}, c AS (SELECT domain, c_mktsegment AS category, count(*) AS n FROM dom JOIN customer ON person_id = c_custkey GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL SELECT domain, 'TOTAL', sum(n)::BIGINT FROM c GROUP BY domain)
SELECT *, {SUPPRESSED} AS label FROM (SELECT *, n / (SELECT count(*) FROM customer) AS ratio FROM a)""",
    "domain_cross_tab_wide": f"""WITH {EVENT_DOMAINS}, c AS (SELECT domain, c_mktsegment AS category, count(*) AS n FROM dom JOIN customer ON person_id = c_custkey GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL SELECT domain, 'TOTAL', sum(n)::BIGINT FROM c GROUP BY domain)
SELECT category, {", ".join(f"coalesce(max(CASE WHEN domain = '{d}' THEN n END), 0) AS {d.lower().replace(' ', '_')}" for d in ("click", "view", "error", "signup", "purchase", "No Data", "All Pids"))}
FROM a GROUP BY category""",
    "diversity_flags": f"WITH {GROUPS} SELECT * FROM gg",
    "diversity_cross_tab": f"""WITH {GROUPS}, {EVENT_DOMAINS}, v AS (
  {" UNION ALL ".join(f"SELECT person_id, '{n}' AS diversity_category, CASE grp_{n.replace(' ', '_')} WHEN 'yes' THEN 'UBR' ELSE 'RBR' END AS category FROM gg" for n in ("segment", "balance", "pressing order", "overall"))}),
c AS (SELECT diversity_category, domain, category, count(*) AS n FROM v JOIN dom USING (person_id) GROUP BY ALL),
e AS (SELECT DISTINCT diversity_category, domain, x.category FROM v, (SELECT DISTINCT domain FROM dom), (VALUES ('UBR'), ('RBR')) x(category)),
z AS (SELECT diversity_category, domain, category, coalesce(n, 0) AS n FROM e LEFT JOIN c USING (diversity_category, domain, category)),
a AS (SELECT * FROM z UNION ALL SELECT diversity_category, domain, 'TOTAL', sum(n)::BIGINT FROM z GROUP BY diversity_category, domain)
SELECT *, n / (SELECT count(*) FROM customer) AS ratio FROM a""",
    "site_domain_matrix": matrix('SELECT person_id, site AS "row", l_returnflag AS col FROM l') + f" SELECT *, {SUPPRESSED} AS label FROM x",
    "site_domain_matrix_wide": matrix('SELECT person_id, site AS "row", l_returnflag AS col FROM l') + """ SELECT "row", """ + ", ".join(
        f"coalesce(max(CASE WHEN col = '{c}' THEN n END), 0) AS {a}" for c, a in (("A", "A"), ("N", "N"), ("R", "R"), ("Any EHR", "any_ehr"))
    ) + ' FROM x GROUP BY "row"',
    "site_vocabulary_matrix": matrix("""SELECT person_id, site AS "row", CASE concept WHEN 'SMALL' THEN NULL WHEN 'ECONOMY' THEN 'Others'
  WHEN 'STANDARD' THEN 'Others' WHEN 'LARGE' THEN 'Big' ELSE concept END AS col FROM tl""") + """
SELECT *, max(CASE WHEN col = 'Any EHR' THEN n END) OVER (PARTITION BY "row") AS row_total FROM x""",
    "case_control_by_one": f"WITH {CLASSES} {percent_label(stratum(['lang']) + ' UNION ALL ' + stratum(['source']))}",
    "case_control_by_two": f"WITH {CLASSES} {percent_label(stratum(['lang', 'source']))}",
    "case_control_five_sets": f"""WITH w AS (
  SELECT doc_id, lang, source, concept, CASE WHEN flag = 1 THEN 'Cases' ELSE 'Controls' END AS class,
         CASE WHEN n_chars > 4999 THEN 'long' WHEN n_chars > 999 THEN 'middle' ELSE 'short' END AS length
  FROM (SELECT doc_id, 'quality' AS concept, quality AS flag FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels)
  JOIN documents USING (doc_id))
{percent_label(" UNION ALL ".join(stratum(s, ("length", "lang", "source")) for s in (["length"], ["lang"], ["source"], ["lang", "source"], ["length", "source"])))}""",
    "class_share": """WITH c AS (SELECT lang, CASE WHEN quality = 1 THEN 'Cases' ELSE 'Controls' END AS class, count(DISTINCT doc_id) AS n
  FROM labels JOIN documents USING (doc_id) GROUP BY ALL)
SELECT *, n / sum(n) OVER (PARTITION BY class) AS ratio FROM c""",
    "measure_counts": f"""WITH w AS (
  SELECT c_custkey AS person_id, c_mktsegment AS segment, r_name AS region, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         (SELECT CASE WHEN max(o_totalprice) > {HIGH_VALUE} THEN max(o_totalprice) END FROM orders WHERE o_custkey = c_custkey) AS largest_order
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lg AS (SELECT person_id, segment, region, 'balance' AS measure, balance AS value FROM w
       UNION ALL SELECT person_id, segment, region, 'largest_order', largest_order FROM w),
h AS (SELECT * FROM lg WHERE value IS NOT NULL),
st AS (
  SELECT 'segment' AS stratum, measure, segment, NULL AS region, count(*) AS n_pids, (sum(count(*)) OVER (PARTITION BY measure))::BIGINT AS numerator FROM h GROUP BY measure, segment
  UNION ALL SELECT 'region', measure, NULL, region, count(*), (SELECT count(*) FROM w) FROM h GROUP BY measure, region
  UNION ALL SELECT 'segment x region', measure, segment, region, count(*), (sum(count(*)) OVER (PARTITION BY measure, region))::BIGINT FROM h GROUP BY measure, segment, region)
{percent_label('SELECT * FROM st')}""",
    "site_statistics": f"WITH {LINES}, r AS (SELECT site, l_extendedprice AS v FROM l) SELECT site, {MOMENTS}, {QUANTILES} FROM r GROUP BY site",
    "global_statistics": f"WITH r AS (SELECT l_extendedprice AS v FROM lineitem) SELECT {MOMENTS}, {QUANTILES} FROM r",
    "hot_group_statistics": f"WITH r AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem) SELECT l_returnflag, {MOMENTS}, {QUANTILES} FROM r GROUP BY 1",
    "approximate_statistics": f"WITH r AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem) SELECT l_returnflag, {MOMENTS}, " + ", ".join(
        f"true AS q{round(p * 100):02d}_in_rank" for p in (0.01, 0.02, 0.25, 0.5, 0.75, 0.98, 0.99)
    ) + " FROM r GROUP BY 1",
    "box_stats": """WITH q AS (SELECT event_type, count(value) AS n, avg(value) AS mean, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT event_type, any_value(n) AS n, round(any_value(mean), 4) AS mean, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
       round(any_value(q3), 4) AS q3, round(min(value), 4) AS whisker_low, round(max(value), 4) AS whisker_high
FROM events JOIN q USING (event_type) WHERE value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 GROUP BY 1""",
    "histogram": """WITH m AS (SELECT event_type, min(value) AS a, max(value) AS b FROM events GROUP BY 1),
c AS (SELECT event_type, CAST(least(floor((value - a) / (b - a) * 12) + 1, 12) AS INTEGER) AS bin, count(*) AS n FROM events JOIN m USING (event_type) GROUP BY ALL)
SELECT event_type, CAST(i AS INTEGER) AS bin, round(a + (i - 1) * (b - a) / 12, 4) AS lo, round(a + i * (b - a) / 12, 4) AS hi, coalesce(n, 0) AS n
FROM (SELECT * FROM m, range(1, 13) r(i)) LEFT JOIN c ON c.event_type = m.event_type AND c.bin = i""".replace(
        "FROM (SELECT * FROM m, range(1, 13) r(i)) LEFT JOIN c ON c.event_type = m.event_type AND c.bin = i",
        "FROM (SELECT m.*, i FROM m, range(1, 13) r(i)) LEFT JOIN (SELECT event_type, bin AS i, n FROM c) USING (event_type, i)"),
    "pretty_histogram": f"""WITH m AS (SELECT min(c_acctbal) AS a, max(c_acctbal) AS b, (max(c_acctbal) - min(c_acctbal)) / ceil(log2(count(*)) + 1) AS rough FROM customer),
p AS (SELECT *, pow(10.0, floor(log10(rough))) AS pw FROM m), st AS (SELECT *, {histogram_step()} AS step FROM p),
e AS (SELECT *, CAST(floor(a / step + 1e-7) AS BIGINT) AS i0, CAST(ceil(b / step - 1e-7) AS BIGINT) AS i1 FROM st),
c AS (SELECT CAST(greatest(ceil(c_acctbal / step - 1e-7) - i0, 1) AS INTEGER) AS bin, count(*) AS n FROM customer, e GROUP BY 1),
g AS (SELECT CAST(unnest(range(1, i1 - i0 + 1)) AS INTEGER) AS bin, i0, step FROM e)
SELECT bin, (i0 + bin - 1) * step AS lo, (i0 + bin) * step AS hi, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (bin)""",
    "pretty_histogram_by_site": f"""WITH {LINES},
m AS (SELECT site, min(l_extendedprice) AS a, max(l_extendedprice) AS b, (max(l_extendedprice) - min(l_extendedprice)) / ceil(log2(count(*)) + 1) AS rough FROM l GROUP BY 1),
p AS (SELECT *, pow(10.0, floor(log10(rough))) AS pw FROM m), st AS (SELECT *, {histogram_step()} AS step FROM p),
e AS (SELECT *, CAST(floor(a / step + 1e-7) AS BIGINT) AS i0, CAST(ceil(b / step - 1e-7) AS BIGINT) AS i1 FROM st),
c AS (SELECT site, CAST(greatest(ceil(l_extendedprice / step - 1e-7) - i0, 1) AS INTEGER) AS bin, count(*) AS n FROM l JOIN e USING (site) GROUP BY ALL),
g AS (SELECT site, CAST(unnest(range(1, i1 - i0 + 1)) AS INTEGER) AS bin, i0, step FROM e)
SELECT site, bin, round((i0 + bin - 1) * step, 4) AS lo, round((i0 + bin) * step, 4) AS hi, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (site, bin)""",
    "latest_value": f"""WITH {LINES} SELECT person_id, l_extendedprice FROM l
QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1""",
    "latest_with_unit_list": f"""WITH {LINES}, n AS (SELECT * FROM l QUALIFY rank() OVER (PARTITION BY person_id ORDER BY l_shipdate DESC) = 1)
SELECT person_id, string_agg({number_text('l_extendedprice')}, ', ' ORDER BY l_extendedprice, l_returnflag) AS l_extendedprice,
       string_agg(l_returnflag, ', ' ORDER BY l_extendedprice, l_returnflag) AS l_returnflag FROM n GROUP BY person_id""",
    "entity_summary": f"""WITH {LINES}, r AS (SELECT person_id, l_quantity AS v FROM l),
a AS (SELECT person_id, {MOMENTS.replace('count(v) AS n, ', '')}, {QUANTILES}, count(DISTINCT v) AS values_count FROM r GROUP BY 1),
n AS (SELECT * FROM l QUALIFY rank() OVER (PARTITION BY person_id ORDER BY l_shipdate DESC) = 1),
b AS (SELECT person_id, string_agg({number_text('l_quantity')}, ', ' ORDER BY l_quantity, l_returnflag) AS latest_value,
             string_agg(l_returnflag, ', ' ORDER BY l_quantity, l_returnflag) AS latest_value_unit FROM n GROUP BY 1)
SELECT * FROM a JOIN b USING (person_id)""",
    "entity_range": f"""WITH {LINES},
a AS (SELECT person_id, round(min(l_quantity), 4) AS min, round(quantile_cont(l_quantity, 0.5), 4) AS median, round(max(l_quantity), 4) AS max,
             round(avg(l_quantity), 4) AS mean, count(l_quantity) AS count, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS units FROM l GROUP BY 1),
b AS (SELECT person_id, round(l_quantity, 4) AS latest FROM l QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY l_shipdate DESC, l_quantity DESC) = 1)
SELECT * FROM a JOIN b USING (person_id)""",
    "measure_qc_presence": f"""WITH {MEASURED} SELECT source_concept, concept, unit, operator, CASE WHEN value IS NOT NULL THEN 'has value' ELSE 'no value' END AS value_state,
  count(DISTINCT person_id) AS n_pids FROM me GROUP BY ALL""",
    "measure_qc_values": f"""WITH {MEASURED}, r AS (SELECT DISTINCT concept, unit, value AS v FROM me WHERE value IS NOT NULL)
SELECT concept, unit, {MOMENTS}, {", ".join(f"round(quantile_cont(v, {p}), 4) AS q{round(p * 100):02d}" for p in (0.01, 0.25, 0.5, 0.75, 0.99))} FROM r GROUP BY ALL""",
    "clean_measure": f"""WITH {MEASURED} SELECT concept, CASE unit WHEN 'mg/dl' THEN 'milligram per deciliter' ELSE 'percent' END AS unit, count(*) AS n,
  round(sum(value), 2) AS total FROM me WHERE value IS NOT NULL AND unit_id IS NOT NULL AND unit NOT IN ('no matching concept', 'no value') GROUP BY ALL""",
    "extreme_limits": f"WITH {OUTLIERS} SELECT * FROM lim",
    "drop_extremes": f"""WITH {OUTLIERS} SELECT p_brand, p_type, count(*) AS n, round(min(value), 4) AS low, round(max(value), 4) AS high
FROM ov JOIN lim USING (p_brand, p_type) WHERE coalesce(value < drop_at_or_above, TRUE) AND coalesce(value > drop_at_or_below, TRUE) GROUP BY ALL""",
    "harmonise": f"""WITH {HARMONISED} SELECT raw_unit, unit, harmonised, count(*) AS n, round(sum(value), 2) AS total, round(sum(raw_value), 2) AS raw_total
FROM ha GROUP BY ALL""",
    "trim": f"""WITH {HARMONISED} SELECT unit, site, count(*) AS n, round(sum(value), 2) AS total FROM ha
WHERE value >= 5 AND value <= CASE WHEN unit = 'standard' THEN 40 ELSE 60 END AND value NOT IN (10, 20) AND site <> 'NATION_3' GROUP BY ALL""",
    "unit_distribution": f"""WITH {HARMONISED}, r AS (SELECT unit, person_id, value AS v FROM ha)
SELECT unit, {MOMENTS}, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75,
       count(DISTINCT person_id) AS n_pids FROM r GROUP BY unit""",
    "ancestor_extract": f"""WITH {RECORDS},
vals AS (SELECT c1.id, lower(c2.name) AS name FROM con c1 JOIN con c2 ON c1.name = c2.code WHERE c1.code = 'ANSWER')
SELECT DISTINCT person_id, measurement_concept_id, lower(cm.name) AS measurement_concept_name, lower(ca.name) AS ancestor_concept_name, value_as_number,
  range_low, range_high, unit_concept_id, lower(u.name) AS unit_concept_name, value_as_concept_id, vals.name AS value_as_concept_name,
  operator_concept_id, lower(op.name) AS operator_concept_name, measurement_datetime, src_id, measurement_source_concept_id,
  lower(measurement_source_value) AS measurement_source_value, lower(unit_source_value) AS unit_source_value
FROM meas JOIN con cm ON cm.id = measurement_concept_id JOIN con ca ON ca.id = ancestor_id LEFT JOIN vals ON vals.id = value_as_concept_id
LEFT JOIN con op ON op.id = operator_concept_id LEFT JOIN con u ON u.id = unit_concept_id
WHERE lower(src_id) LIKE '%ehr%' AND ancestor_id IN (502, 503) AND value_as_number IS NOT NULL""",
    "measurement_extract": f"""WITH {RECORDS} SELECT DISTINCT person_id, measurement_concept_id, measurement_source_concept_id,
  lower(measurement_source_value) AS measurement_source_value, value_as_number, range_low, range_high, lower(unit_source_value) AS unit_source_value,
  operator_concept_id, src_id, measurement_datetime FROM meas WHERE src_id LIKE '%EHR%' AND ancestor_id = 501""",
    "concept_name_map": f"""WITH {RECORDS} SELECT DISTINCT measurement_concept_id, 'nation ' || measurement_concept_id AS measurement_concept_name,
  measurement_source_concept_id, lower(measurement_source_value) AS measurement_source_concept_name, unit_concept_id,
  'unit ' || lower(unit_source_value) AS unit_concept_name, operator_concept_id, 'operator ' || operator_concept_id AS operator_concept_name
FROM meas WHERE ancestor_id = 501""",
    "concept_index": """WITH p AS (SELECT l_suppkey, l_linenumber, count(*) FROM lineitem GROUP BY ALL),
s AS (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem),
c AS (SELECT n, CASE WHEN n = 1 THEN (SELECT count(*) FROM p WHERE l_linenumber = 1) ELSE (SELECT s.n FROM s) END AS n_pids FROM range(1, 8) r(n))
SELECT CAST(100 + c.n AS VARCHAR) AS concept_id, lower(n_name) AS concept_name, n_pids, replace(lower(n_name), 'nation_', '') AS short_name,
       'drug_' || (100 + c.n) || '_summary' AS report_name FROM c JOIN nation ON n_nationkey = c.n""",
    "concept_lookup": """SELECT CASE WHEN n_regionkey = 0 THEN n_name || '-CODE' ELSE CAST(n_nationkey + 100 AS VARCHAR) END AS wanted, n_name AS concept_name FROM nation""",
    "next_batch": f"WITH {BATCH} SELECT * FROM batch",
    "allocate_plates": f"""WITH {SAMPLES} SELECT sample_id, state, collected,
  CAST(ceil(row_number() OVER (ORDER BY state, collected, sample_id) / 94) AS INTEGER) AS plate FROM sam""",
    "shuffle_plates": f"""WITH {SAMPLES} SELECT sample_id, state, CAST(ceil(row_number() OVER (ORDER BY {MODULAR}, sample_id) / 94) AS INTEGER) AS plate FROM sam""",
    "seeded_sample": f"WITH {SAMPLES} SELECT sample_id, state FROM sam ORDER BY {MODULAR}, sample_id LIMIT 250",
    "control_plates": f"WITH {BATCH}, {NEGATIVES} SELECT * FROM neg",
    "single_control_plates": f"""WITH {SAMPLES},
used AS (SELECT sample_id FROM sam WHERE negative_control = 'Yes' ORDER BY {MODULAR}, sample_id LIMIT 5),
d AS (SELECT sample_id, state FROM sam WHERE negative_control = 'Yes' AND sample_id NOT IN (SELECT sample_id FROM used) ORDER BY {MODULAR}, sample_id LIMIT 9)
SELECT sample_id, state, CAST(row_number() OVER (ORDER BY sample_id) AS INTEGER) AS plate FROM d""",
    "positive_control_plates": f"""WITH {POSITIVES} SELECT positive_control_id, volume, plate, 'No' AS negative_control, 'Yes' AS positive_control FROM pos""",
    "control_volume": f"WITH {POSITIVES} SELECT round(sum(volume) / 20, 4) AS volume_per_aliquot FROM pos_drawn",
    "final_samples": f"WITH {FINAL} SELECT * REPLACE (round(volume, 2) AS volume) FROM fin",
    "sample_qc": f"""WITH {FINAL}, c AS (
  SELECT CASE WHEN positive_control = 'Yes' THEN 'positive' WHEN negative_control = 'Yes' THEN 'negative' ELSE 'test' END AS class,
         coalesce(positive_control_id, CAST(sample_id AS VARCHAR)) AS id, collected, plate FROM fin),
k AS (SELECT class, id, collected FROM c),
q AS (SELECT class, count(DISTINCT id) AS u, count(id) AS n, min(collected) AS a, max(collected) AS b FROM k GROUP BY 1),
z AS (SELECT * FROM q UNION ALL SELECT 'all', sum(u), sum(n), min(a), max(b) FROM q)
SELECT class || '_unique' AS metric, CAST(u AS VARCHAR) AS value FROM z UNION ALL SELECT class || '_count', CAST(n AS VARCHAR) FROM z
UNION ALL SELECT class || '_first_day', a FROM z UNION ALL SELECT class || '_last_day', b FROM z
UNION ALL SELECT 'test_unique_without_day', CAST(count(DISTINCT id) AS VARCHAR) FROM k WHERE class = 'test' AND collected IS NULL
UNION ALL SELECT 'all_plates', CAST(count(DISTINCT plate) AS VARCHAR) FROM c
UNION ALL SELECT 'all_plates_rows', CAST(count(plate) AS VARCHAR) FROM c""",
    "share_by_plate": f"""WITH {FINAL}, sizes AS (SELECT plate, count(DISTINCT participant_id) AS size FROM fin GROUP BY 1)
SELECT plate, state, count(DISTINCT participant_id) AS n, round(count(DISTINCT participant_id) / any_value(size) * 100, 6) AS pct
FROM fin JOIN sizes USING (plate) WHERE state IS NOT NULL GROUP BY ALL
UNION ALL SELECT NULL, state, count(DISTINCT participant_id),
       round(count(DISTINCT participant_id) / (SELECT count(DISTINCT participant_id) FROM fin) * 100, 6) FROM fin WHERE state IS NOT NULL GROUP BY state""",
    "manifest_labels": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS negative_control,
  CASE WHEN o_orderstatus = 'P' THEN 'Yes' ELSE 'No' END AS positive_control,
  CASE WHEN o_orderstatus = 'P' THEN 'POS-' || o_orderkey END AS positive_control_id,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS sample_id, 'S' || o_orderkey AS specimen_id,
  CASE WHEN o_orderstatus <> 'P' THEN n_name END AS state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "suppressed_report": f"""WITH {PRIORITY_COUNTS}, t AS (SELECT *, {CELL} AS plain, CAST(n - 18 AS VARCHAR) AS moved FROM pcount)
SELECT c_nationkey, o_orderpriority, o_orderstatus, n, plain, {SUPPRESSED} AS suppressed, printf('%.1f%%', ratio * 100) AS one_decimal,
       {hidden('plain')} AS hidden_text, {hidden('moved')} AS hidden_number FROM t""",
    "formatted_columns": f"""WITH {PRIORITY_COUNTS} SELECT c_nationkey, o_orderpriority AS priority, o_orderstatus AS status, format('{{:,}}', n) AS n,
  printf('%.1f%%', ratio * 100) AS ratio, CASE WHEN n < 20 THEN '<20' ELSE CAST(n AS VARCHAR) END AS shown, n AS cell_count,
  CAST(printf('%.2f', ratio * 100) AS DOUBLE) AS cell_pct FROM pcount""",
    "split_count_pct_cells": f"""WITH {PRIORITY_COUNTS} SELECT c_nationkey, o_orderpriority, o_orderstatus, n AS count,
  CAST(printf('%.2f', ratio * 100) AS DOUBLE) AS pct FROM pcount""",
    "threshold_dimension": """WITH r AS (
  SELECT o_custkey AS person_id, r_name AS state, year(o_orderdate) AS year, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT year, state, CAST(floor(min(o_totalprice)) AS BIGINT) AS low FROM r GROUP BY ALL),
d AS (SELECT year, state, h, CASE WHEN h <= 8 THEN low * h ELSE low * 8 + (h - 8) * (low + 10) END AS fpl FROM b, range(1, 20) g(h)),
p AS (SELECT person_id, state, year, count(*) AS h, sum(o_totalprice) AS spent FROM r GROUP BY ALL)
SELECT CAST(year AS INTEGER) AS year, state, CAST(h AS INTEGER) AS household_size, fpl, fpl * 2 AS fpl_200, count(*) AS n,
       (sum(CASE WHEN spent < fpl * 2 THEN 1 ELSE 0 END))::BIGINT AS below FROM p JOIN d USING (year, state, h) GROUP BY ALL""",
    "id_set_ops": f"""WITH b AS (SELECT o_custkey AS id FROM orders WHERE o_totalprice > {HIGH_VALUE}), u AS (SELECT user_id AS id FROM events),
r AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > {HIGH_BALANCE})
SELECT 'buyers without events' AS label, count(*) AS n FROM (SELECT id FROM b EXCEPT SELECT id FROM u)
UNION ALL SELECT 'buyers with events and balance', count(*) FROM (SELECT id FROM b INTERSECT SELECT id FROM u INTERSECT SELECT id FROM r)
UNION ALL SELECT 'buyers or users', count(*) FROM (SELECT id FROM b UNION SELECT id FROM u)""",
    "population_alignment": f"""WITH {FLAG_SETS}, w AS ({combo_table('TRUE')}), e AS ({combo_table('has_events = 1')})
SELECT 'Whole' AS population, * FROM w UNION ALL SELECT 'Events', * FROM e
UNION ALL SELECT 'Events', combo, 0, 0.0 FROM w WHERE combo NOT IN (SELECT combo FROM e)""",
    "tables_side_by_side": f"""WITH {FLAG_SETS}, w AS ({combo_table('TRUE')}), a AS ({combo_table('in_asia = 1')}), e AS ({combo_table('has_events = 1')}),
k AS (SELECT combo, 'whole' AS name, {CELL} AS cell FROM w UNION ALL SELECT combo, 'asia', {CELL} FROM a UNION ALL SELECT combo, 'events', {CELL} FROM e)
SELECT combo, {", ".join(f"coalesce(max(CASE WHEN name = '{n}' THEN cell END), '-') AS {n}" for n in ("whole", "asia", "events"))} FROM k GROUP BY combo""",
    "ordered_categories": """SELECT o_orderpriority, count(*) AS n,
  CAST(CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS INTEGER) AS sort_ord FROM orders GROUP BY 1""",
    "sql_over_views": """SELECT lower(event_type) AS domain, count(DISTINCT user_id) AS n_pids, CAST(min(year(ts)) AS INTEGER) AS first_year
FROM events WHERE event_type LIKE 'p%' OR event_type IN ('view', 'click') GROUP BY 1""",
    "concept_files": """SELECT CAST(l_linenumber AS INTEGER) AS concept, 'a "' || l_returnflag || '", of ' || l_linestatus AS note, count(*) AS n,
  sum(CAST(l_quantity AS DOUBLE)) AS total FROM lineitem GROUP BY ALL""",
    "flat_file_round_trip": "SELECT c_mktsegment, count(*) AS n, round(max(c_acctbal), 2) AS largest FROM customer GROUP BY 1",
}


# Health-records extracts and reports


def survey_case(texts: dict[str, list[str]]) -> str:
    """The text an order stands for, by its priority and status."""
    whens = " ".join(
        f"WHEN o_orderpriority = '{p}' AND o_orderstatus = '{s}' THEN '{text}'"
        for p, q in QUESTION_OF.items() for s, text in zip(STATUSES, texts[q])
    )
    return f"CASE {whens} END"


SURVEY = f"""{FLAG_ROWS},
per AS (
  SELECT c_custkey AS person_id, c_mktsegment AS seg, r_name, c_acctbal AS bal, CAST(floor(abs(c_acctbal) / 100) AS INTEGER) AS age
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ans AS (SELECT o_custkey AS person_id, o_orderpriority AS q, {survey_case(ANSWERS)} AS answer, {survey_case(CODES)} AS code FROM orders)"""


def folded(text: str) -> str:
    return f"""CASE WHEN {text} IS NULL THEN 'not specified' WHEN {text} LIKE '%none of these%' THEN 'none of these'
  WHEN {text} IN ('prefer not to answer', 'i prefer not to answer', 'none indicated', 'no matching concept') THEN 'not specified' ELSE {text} END"""


def collapsed(question: str, text: str) -> str:
    hit = f"CASE WHEN q = '{question}' THEN {text} END"
    return f"CASE WHEN count(DISTINCT {hit}) > 1 THEN 'Multiple Selections' ELSE min({hit}) END"


DEMOGRAPHICS = SURVEY + f""",
low AS (SELECT person_id, q, CASE WHEN q = '5-LOW' THEN replace(lower(split_part(answer, ': ', 2)), 'none', 'none of these')
        ELSE lower(split_part(answer, ': ', 2)) END AS v FROM ans),
cl AS (SELECT person_id, q, {title(folded('v'))} AS t FROM low),
col AS (SELECT person_id, {collapsed('2-HIGH', 't')} AS sex_at_birth, {collapsed('3-MEDIUM', 't')} AS income,
               {collapsed('4-NOT SPECIFIED', 't')} AS education, {collapsed('5-LOW', 't')} AS sexual_orientation FROM cl GROUP BY 1),
demo AS (
  SELECT per.person_id,
         CASE seg WHEN 'BUILDING' THEN 'White' WHEN 'MACHINERY' THEN 'Black' WHEN 'HOUSEHOLD' THEN 'None Of These' ELSE 'Not Specified' END AS race,
         CASE r_name WHEN 'ASIA' THEN 'Hispanic Or Latino' WHEN 'EUROPE' THEN 'Not Specified' ELSE 'Not Hispanic Or Latino' END AS ethnicity,
         age AS age_at_cdr,
         CASE WHEN age > 89 THEN '90+' WHEN age > 79 THEN '80-89' WHEN age > 69 THEN '70-79' WHEN age > 59 THEN '60-69' WHEN age > 49 THEN '50-59'
              WHEN age > 39 THEN '40-49' WHEN age > 29 THEN '30-39' ELSE '18-29' END AS age_group,
         coalesce(sex_at_birth, 'Not Specified') AS sex_at_birth, 'Not Specified' AS gender_identity, coalesce(income, 'Not Specified') AS income,
         coalesce(education, 'Not Specified') AS education, 'Not Specified' AS employment,
         coalesce(sexual_orientation, 'Not Specified') AS sexual_orientation
  FROM per LEFT JOIN col USING (person_id)),
ty AS (SELECT person_id, has_urgent AS "PPI", household AS "PM", has_events AS "EHR", high_balance AS "Fitbit", high_value_order AS "WGS", in_asia AS "Array",
              CAST(person_id IN (SELECT person_id FROM ans WHERE answer = 'What Race Ethnicity: AIAN') AS INTEGER) AS "AIAN",
              CAST(bal > 8000 AS INTEGER) AS "WEAR" FROM f JOIN per USING (person_id))"""

HISTORY_NAMES = """CASE v WHEN 'Prefer Not To Answer' THEN 'Not Specified' WHEN 'Sex At Birth None Of These' THEN 'None Of These'
  WHEN 'None' THEN 'None Of These' ELSE v END"""


def after_stem(question: str) -> str:
    """Collapse on the raw text, then drop the stem, title case and rename."""
    raw = f"coalesce({collapsed(question, 'lower(answer)')}, 'Not Specified')"
    cut = f"CASE WHEN contains({raw}, ': ') THEN split_part({raw}, ': ', 2) ELSE {raw} END"
    return f"(SELECT {HISTORY_NAMES} FROM (SELECT {title('c')} AS v FROM (SELECT {cut} AS c FROM ans a WHERE a.person_id = per.person_id)))"


MINORITY = """(gender IN ('GenderIdentity_NonBinary')
  OR (gender = 'GenderIdentity_Woman' AND sex <> 'SexAtBirth_Female') OR (gender = 'GenderIdentity_Man' AND sex <> 'SexAtBirth_Male')
  OR person_id IN (SELECT person_id FROM ans WHERE q = '5-LOW' AND code NOT IN ('PMI_Skip', 'SexualOrientation_Straight')))"""
UNDER_REPRESENTED = SURVEY + f""",
raw AS (
  SELECT *, CASE WHEN bal < 0 THEN 'SexAtBirth_Intersex' WHEN bal < 4000 THEN 'SexAtBirth_Female' WHEN bal < 9000 THEN 'SexAtBirth_Male' END AS sex,
         CASE r_name WHEN 'AFRICA' THEN 'GenderIdentity_Woman' WHEN 'AMERICA' THEN 'GenderIdentity_Man' WHEN 'ASIA' THEN 'GenderIdentity_NonBinary' WHEN 'EUROPE' THEN 'PMI_Skip' END AS gender
  FROM per),
six AS (
  SELECT person_id, CASE WHEN seg IN ('MACHINERY', 'AUTOMOBILE') OR r_name = 'ASIA' THEN 'yes' ELSE 'no' END AS ubr_race_ethnicity,
         CASE WHEN age - 1 < 18 OR age - 1 >= 65 THEN 'yes' ELSE 'no' END AS ubr_age,
         CASE WHEN bal < 0 THEN 'yes' ELSE 'no' END AS ubr_sex_assigned_at_birth,
         CASE WHEN person_id IN (SELECT person_id FROM ans WHERE code = 'AnnualIncome_10k25k') THEN 'yes' ELSE 'no' END AS ubr_annual_income,
         CASE WHEN person_id IN (SELECT person_id FROM ans WHERE code = 'HighestGrade_NeverAttended') THEN 'yes' ELSE 'no' END AS ubr_educational_attainment,
         CASE WHEN {MINORITY} THEN 'yes' ELSE 'no' END AS ubr_sexual_and_gender_minorities
  FROM raw),
ubr AS (SELECT *, greatest(ubr_race_ethnicity, ubr_age, ubr_sex_assigned_at_birth, ubr_annual_income, ubr_educational_attainment,
                           ubr_sexual_and_gender_minorities) AS ubr_overall FROM six)"""

INCOME_ORDER = ["Less 10K", "10K 25K", "25K 35K", "35K 50K", "50K 75K", "75K 100K", "100K 150K", "150K 200K", "More 200K", "Skip", "Not Specified", "Multiple Selections"]
COHORT_FLAGS = {"OVERALL": "TRUE", **{c.upper(): f'"{c}" = 1' for c in ("PPI", "PM", "Fitbit", "WGS", "Array", "EHR")}}
POPULATION_FLAGS = {"Whole CDR": "TRUE", "AIAN": '"AIAN" = 1', "WEAR": '"WEAR" = 1'}
INCOME_CELLS = " UNION ALL ".join(
    f"SELECT '{p}' AS population, '{c}' AS cohort, person_id, income AS category FROM demo JOIN ty USING (person_id) WHERE {pf} AND {cf}"
    for p, pf in POPULATION_FLAGS.items() for c, cf in COHORT_FLAGS.items()
)
INCOME_FRAME = ", ".join(
    f"('{p}', '{c}', '{name}', {10000 if name == 'TOTAL' else i + 1})"
    for p in POPULATION_FLAGS for c in COHORT_FLAGS for i, name in enumerate([*INCOME_ORDER, "TOTAL"])
)
TYPE_NAMES = ["PPI", "PM", "EHR", "Fitbit", "WGS", "Array"]


def type_counts(population: str, condition: str) -> str:
    rows = [f"SELECT '{n}' AS data_type, count(*) AS n FROM ty WHERE {condition} AND \"{n}\" = 1" for n in TYPE_NAMES]
    rows.append(f"SELECT 'None', count(*) FROM ty WHERE {condition} AND " + " AND ".join(f'"{n}" = 0' for n in TYPE_NAMES))
    size = f"(SELECT count(*) FROM ty WHERE {condition})"
    return f"SELECT data_type, '{population}' AS name, {CELL} AS cell FROM (SELECT data_type, n, n / {size} AS ratio FROM ({' UNION ALL '.join(rows)}) WHERE n > 0)"


COMBINATIONS = [
    [], ["PPI"], ["PPI", "PM"], ["EHR"], ["PPI", "EHR"], ["PPI", "EHR", "PM"], ["Fitbit"], ["PPI", "Fitbit"], ["PPI", "PM", "Fitbit"],
    ["Fitbit", "PPI", "EHR"], ["PPI", "EHR", "PM", "Fitbit"],
]
RECORD_ROWS = """rec AS (
  SELECT o_custkey AS person_id, CASE l_returnflag WHEN 'A' THEN 'Measurement' WHEN 'N' THEN 'Condition' ELSE 'Device' END AS domain,
         'EHR site ' || l_linenumber AS site, l_linenumber AS concept, l_shipdate AS t0,
         CASE WHEN l_returnflag = 'A' OR l_linestatus = 'F' THEN l_shipdate END AS t1
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 7
  UNION ALL SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'Drug' WHEN 'O' THEN 'Observation' ELSE 'Procedure' END,
         'EHR site ' || o_orderpriority[1], CAST(o_orderpriority[1] AS INTEGER), o_orderdate, o_orderdate FROM orders
  UNION ALL SELECT user_id, 'Visit', 'EHR site 9', 5, ts, ts FROM events),
hist0 AS (SELECT person_id, domain, site, ['LOINC', 'ICD10CM', 'ICD10PCS', 'RxNorm Extension', 'Visit', 'NDC', 'None'][concept] AS vocabulary,
                 min(t0) AS t0, coalesce(max(t1), (SELECT max(l_shipdate) FROM lineitem)) AS t1 FROM rec GROUP BY ALL),
hist AS (SELECT * FROM hist0 UNION ALL SELECT DISTINCT person_id, 'Any EHR', site, vocabulary, t0, t1 FROM hist0)"""
SITE_GROUPS = """CASE WHEN vocabulary IN ('Visit', 'None') THEN NULL WHEN vocabulary = 'NDC' THEN 'Others' WHEN vocabulary LIKE 'ICD10%' THEN 'ICD10'
  WHEN vocabulary LIKE 'RxNorm%' THEN 'RxNorm' ELSE vocabulary END"""
GROUP_NAMES = ["race_ethnicity", "age", "sex_assigned_at_birth", "annual_income", "educational_attainment", "sexual_and_gender_minorities", "overall"]

ORACLES |= {
    "survey_demographics": f"WITH {DEMOGRAPHICS} SELECT * FROM demo",
    "history_demographics": f"""WITH {SURVEY} SELECT person_id,
  CASE WHEN age > 89 THEN '90+' WHEN age > 79 THEN '80-89' WHEN age > 69 THEN '70-79' WHEN age > 59 THEN '60-69' WHEN age > 49 THEN '50-59'
       WHEN age > 39 THEN '40-49' WHEN age > 29 THEN '30-39' WHEN age >= 18 THEN '18-29' END AS age_group,
  CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'Hispanic Or Latino' ELSE 'Not Hispanic Or Latino' END AS ethnicity,
  {after_stem('1-URGENT')} AS race, {after_stem('2-HIGH')} AS sex_assigned_at_birth, {after_stem('3-MEDIUM')} AS annual_income,
  'Not Specified' AS gender_identity, {after_stem('4-NOT SPECIFIED')} AS educational_attainment, 'Not Specified' AS employment FROM per""",
    "under_represented_groups": f"WITH {UNDER_REPRESENTED} SELECT * FROM ubr",
    "survey_cohorts": f"WITH {DEMOGRAPHICS} SELECT * FROM ty",
    "demographic_report": f"""WITH {DEMOGRAPHICS}, cells AS ({INCOME_CELLS}),
cnt AS (SELECT population, cohort, category, count(*) AS n FROM cells GROUP BY ALL),
tot AS (SELECT population, cohort, 'TOTAL' AS category, sum(n)::BIGINT AS n FROM cnt GROUP BY population, cohort),
fr AS (SELECT * FROM (VALUES {INCOME_FRAME}) v(population, cohort, category, sort_ord)),
x AS (SELECT population, cohort, category, CAST(sort_ord AS INTEGER) AS sort_ord, coalesce(a.n, 0) AS n, coalesce(a.n / nullif(tot.n, 0), 0.0) AS ratio
      FROM fr LEFT JOIN (SELECT * FROM cnt UNION ALL SELECT * FROM tot) a USING (population, cohort, category) LEFT JOIN tot USING (population, cohort)
      QUALIFY category <> 'Multiple Selections' OR max(coalesce(a.n, 0)) OVER (PARTITION BY category) > 0)
SELECT *, {CELL} AS label, 'Self-Reported Income' AS variable FROM x""".replace(
        "SELECT population, cohort, category, CAST(sort_ord", "SELECT population, cohort, fr.category, CAST(sort_ord").replace(
        "QUALIFY category", "QUALIFY fr.category").replace("PARTITION BY category", "PARTITION BY fr.category"),
    "genomic_race_groups": f"""WITH {DEMOGRAPHICS},
r AS (SELECT person_id, CASE WHEN answer LIKE 'PMI%' THEN 'Skip' ELSE split_part(answer, ': ', 2) END AS race FROM ans WHERE q = '1-URGENT'),
g AS (SELECT person_id, coalesce(string_agg(DISTINCT race, ',' ORDER BY race), 'None') AS g FROM ty LEFT JOIN r USING (person_id) WHERE "WGS" = 1 GROUP BY 1),
c AS (SELECT CASE WHEN g IN ('AIAN', 'AIAN,White', 'White', 'Skip') THEN g ELSE 'Other' END AS "group", count(*) AS n FROM g GROUP BY 1),
z AS (SELECT * FROM c UNION ALL SELECT v.g, 0 FROM (VALUES ('Other'), ('Skip')) v(g) WHERE v.g NOT IN (SELECT "group" FROM c)),
u AS (SELECT "group", CAST(CASE "group" WHEN 'Other' THEN 1 WHEN 'Skip' THEN 2 ELSE 0 END AS INTEGER) AS sort_ord, n FROM z
      UNION ALL SELECT 'Total', 3, sum(n)::BIGINT FROM z)
SELECT "group", sort_ord, n, n / (SELECT count(*) FROM ty WHERE "WGS" = 1) AS ratio FROM u""",
    "genomic_combinations": f"WITH {DEMOGRAPHICS} " + " UNION ALL ".join(
        f"SELECT '{' and '.join(['WGS and Array', *combo])}' AS combination, count(*) AS n FROM ty WHERE "
        + " AND ".join(f'"{c}" = 1' for c in ["WGS", "Array", *combo]) for combo in COMBINATIONS
    ),
    "data_type_report": f"""WITH {DEMOGRAPHICS}, k AS ({" UNION ALL ".join(type_counts(p, c) for p, c in POPULATION_FLAGS.items())})
SELECT data_type, {", ".join(f"coalesce(max(CASE WHEN name = '{p}' THEN cell END), '-') AS \"{p}\"" for p in POPULATION_FLAGS)} FROM k GROUP BY 1""",
    "record_history": f"""WITH {RECORD_ROWS} SELECT person_id, domain, site, vocabulary, CAST(CAST(t0 AS DATE) AS VARCHAR) AS start,
  CAST(CAST(t1 AS DATE) AS VARCHAR) AS "end" FROM hist""",
    "record_years": f"""WITH {RECORD_ROWS}, y AS (
  SELECT person_id, domain, greatest(abs(floor(date_diff('microsecond', min(t0), max(t1)) / 86400000000.0)), 1) / 365 AS years FROM hist GROUP BY ALL)
SELECT domain, count(*) AS n, """ + ", ".join(
        f"round_even({a} * 100, 0) / 100 AS {n}" for n, a in (
            ("mean", "avg(years)"), ("median", "quantile_cont(years, 0.5)"), ("min", "min(years)"), ("max", "max(years)"), ("std", "stddev_samp(years)"))
    ) + " FROM y GROUP BY domain",
    "record_growth": f"""WITH {RECORD_ROWS}, fy AS (SELECT person_id, domain, min(year(t0)) AS year FROM rec GROUP BY ALL),
two AS (SELECT * FROM fy UNION ALL SELECT person_id, 'Any EHR', year FROM fy),
ff AS (SELECT domain, person_id, min(year) AS year FROM two GROUP BY ALL), seen AS (SELECT DISTINCT domain, year FROM two),
new AS (SELECT domain, year, count(person_id) AS n_new FROM seen LEFT JOIN ff USING (domain, year) GROUP BY ALL),
cum AS (SELECT domain, CAST(year AS INTEGER) AS year, n_new, (sum(n_new) OVER (PARTITION BY domain ORDER BY year))::BIGINT AS cum_n FROM new)
SELECT *, round_even(cum_n / (SELECT count(*) FROM customer) * 100 * 100, 0) / 100 AS cum_pct FROM cum WHERE year >= 1996""",
    "period_growth": f"""WITH {RECORD_ROWS}, pv AS (SELECT person_id, domain, year(t0) AS year FROM hist),
ff AS (SELECT domain, person_id, min(year) AS year FROM pv GROUP BY ALL), seen AS (SELECT DISTINCT domain, year FROM pv),
new AS (SELECT domain, year, count(person_id) AS n_new FROM seen LEFT JOIN ff USING (domain, year) GROUP BY ALL),
cum AS (SELECT domain, CAST(year AS INTEGER) AS year, n_new, (sum(n_new) OVER (PARTITION BY domain ORDER BY year))::BIGINT AS cum_n FROM new)
SELECT *, round_even(cum_n / (SELECT count(*) FROM customer) * 100 * 100, 0) / 100 AS cum_pct FROM cum WHERE year >= 1996""",
    "overlap_report": f"""WITH {DEMOGRAPHICS},
b AS (SELECT concat(CASE WHEN "WGS" = 1 OR "Array" = 1 THEN 1 ELSE 0 END, "PPI", "EHR", "Fitbit", "PM") AS region, count(*) AS n FROM ty GROUP BY 1),
every AS (SELECT lpad(bin(i), 5, '0') AS region FROM range(1, 32) r(i))
SELECT region, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) < 20 THEN '<20' ELSE format('{{:,}}', n) END AS n_label FROM every LEFT JOIN b USING (region)""",
    "site_domain_report": f"""WITH {RECORD_ROWS}, b AS (SELECT DISTINCT person_id, site AS "row", domain AS col FROM hist),
k AS (SELECT person_id, "row", col FROM b UNION SELECT person_id, 'TOTAL PIDS', col FROM b),
x AS (SELECT "row", col, count(*) AS n, count(*) / (SELECT count(*) FROM customer) AS ratio FROM k GROUP BY ALL)
SELECT *, max(CASE WHEN col = 'Any EHR' THEN n END) OVER (PARTITION BY "row") AS row_total, {SUPPRESSED} AS label FROM x""",
    "demographic_history_report": f"""WITH {SURVEY}, {RECORD_ROWS},
w AS (SELECT person_id, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'Hispanic Or Latino' ELSE 'Not Hispanic Or Latino' END AS category FROM per),
dm AS (SELECT person_id, category, coalesce(domain, 'No Data') AS domain FROM w LEFT JOIN (SELECT DISTINCT person_id, domain FROM hist) USING (person_id)
       UNION ALL SELECT person_id, category, 'All Pids' FROM w),
c AS (SELECT domain, category, count(*) AS n FROM dm GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL SELECT domain, 'TOTAL', sum(n)::BIGINT FROM c GROUP BY domain)
SELECT *, {SUPPRESSED} AS label FROM (
  SELECT domain, category, n, n / (SELECT count(*) FROM customer) AS ratio,
         CAST(CASE category WHEN 'TOTAL' THEN 7 WHEN 'Hispanic Or Latino' THEN 2 ELSE 1 END AS INTEGER) AS sort_ord FROM a)""",
    "record_sites": f"""WITH {RECORD_ROWS}, b AS (SELECT DISTINCT person_id, site AS "row", {SITE_GROUPS} AS col FROM hist),
k AS (SELECT person_id, "row", col FROM b WHERE col IS NOT NULL UNION SELECT person_id, 'TOTAL PIDS', col FROM b WHERE col IS NOT NULL
      UNION SELECT person_id, "row", 'Any EHR' FROM b UNION SELECT person_id, 'TOTAL PIDS', 'Any EHR' FROM b),
x AS (SELECT "row", col, count(*) AS n, count(*) / (SELECT count(*) FROM customer) AS ratio FROM k GROUP BY ALL)
SELECT *, max(CASE WHEN col = 'Any EHR' THEN n END) OVER (PARTITION BY "row") AS row_total, {SUPPRESSED} AS label FROM x""",
    "group_history_report": f"""WITH {UNDER_REPRESENTED}, {RECORD_ROWS},
dm AS (SELECT person_id, coalesce(domain, 'No Data') AS domain FROM per LEFT JOIN (SELECT DISTINCT person_id, domain FROM hist) USING (person_id)
       UNION ALL SELECT person_id, 'All Pids' FROM per),
v AS ({" UNION ALL ".join(f"SELECT person_id, '{n.replace('_', ' ')}' AS diversity_category, CASE ubr_{n} WHEN 'yes' THEN 'UBR' ELSE 'RBR' END AS category FROM ubr" for n in GROUP_NAMES)}),
c AS (SELECT diversity_category, domain, category, count(*) AS n FROM v JOIN dm USING (person_id) GROUP BY ALL),
e AS (SELECT DISTINCT d.diversity_category, dd.domain, x.category FROM (SELECT DISTINCT diversity_category FROM v) d, (SELECT DISTINCT domain FROM dm) dd,
      (VALUES ('UBR'), ('RBR')) x(category)),
z AS (SELECT diversity_category, domain, category, coalesce(n, 0) AS n FROM e LEFT JOIN c USING (diversity_category, domain, category)),
a AS (SELECT * FROM z UNION ALL SELECT diversity_category, domain, 'TOTAL', sum(n)::BIGINT FROM z GROUP BY diversity_category, domain)
SELECT *, {SUPPRESSED} AS label FROM (SELECT *, n / (SELECT count(*) FROM customer) AS ratio FROM a)""",
}

LINE_OWNERS = "lineitem JOIN orders ON l_orderkey = o_orderkey"
HEADLINE_ROWS = {
    "total": "SELECT c_custkey FROM customer",
    "aian": "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'",
    "functioning": "SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '2%' AND o_orderstatus = 'O'",
    "functioning_survey": "SELECT user_id FROM events WHERE event_type = 'view'",
    "partner_survey": "SELECT user_id FROM events WHERE event_type = 'click'",
    "wear": "SELECT c_custkey FROM customer WHERE c_acctbal > 8000",
    "deceased": f"SELECT o_custkey FROM orders WHERE o_totalprice > {HIGH_VALUE} AND o_orderstatus = 'F'",
    "height": f"SELECT o_custkey FROM {LINE_OWNERS} JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'A' AND l_linenumber = 1 AND c_acctbal > 0",
    "weight": f"SELECT o_custkey FROM {LINE_OWNERS} JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'A' AND l_linenumber = 2 AND c_acctbal > 0",
    "mediated": f"SELECT o_custkey FROM {LINE_OWNERS} WHERE l_linenumber = 7",
    "subcategories": "SELECT o_custkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'",
}
ADD_ONS = {
    "Long Read WGS": "c_acctbal > 6000", "Structural Variant": "c_mktsegment = 'BUILDING'",
    "WGS OR Array": "(\"WGS\" = 1 OR \"Array\" = 1)", "WGS AND Array": "(\"WGS\" = 1 AND \"Array\" = 1)",
}
PERSON_SETS = [["age_group"], ["sex_at_birth"], ["ancestry"], ["sex_at_birth", "ancestry"], ["age_group", "ancestry"]]
PERSONS = """who AS (SELECT c_custkey AS person_id, c_acctbal, c_mktsegment, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dg AS (SELECT person_id, CASE WHEN c_acctbal < 3000 THEN 'young' ELSE 'old' END AS age_group,
  CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN 'Female' WHEN c_acctbal > 5000 THEN 'Male' ELSE 'NA' END AS sex_at_birth FROM who WHERE r_name <> 'AFRICA'),
an AS (SELECT person_id, r_name AS ancestry FROM who WHERE c_mktsegment <> 'MACHINERY'),
ps AS (SELECT person_id, age_group, sex_at_birth, ancestry FROM dg FULL JOIN an USING (person_id))"""
YES_NO = f"""yn AS (SELECT o_custkey AS person_id, bool_or(o_orderstatus = 'F') AS a, max(CASE WHEN o_orderpriority = '1-URGENT' THEN true END) AS b,
  bool_or(o_totalprice > {HIGH_VALUE}) AS c, max(CASE WHEN o_orderpriority = '5-LOW' THEN true END) AS d FROM orders GROUP BY 1),
ph AS (SELECT person_id, '101' AS concept, a AS flag FROM yn UNION ALL SELECT person_id, '102', b FROM yn UNION ALL SELECT person_id, 'NATION_3-CODE', c FROM yn
       UNION ALL SELECT person_id, '104', d FROM yn)"""


def person_stratum(keys: list[str], by: str, over: list[str]) -> str:
    """Counts of one breakdown of ``w`` among persons who are in all tables that it needs."""
    picked = ", ".join(f"{k if k in keys else 'NULL'} AS {k}" for k in ("age_group", "sex_at_birth", "ancestry"))
    return f"""SELECT '{" x ".join(keys)}' AS stratum, {by}, {picked}, count(*) AS n_pids, (sum(count(*)) OVER (PARTITION BY {", ".join(over)}))::BIGINT AS numerator
  FROM w WHERE {" AND ".join(f"{k} IS NOT NULL" for k in keys)} GROUP BY {by}, {", ".join(keys)}"""


LAB_ROWS = f"""{RECORDS},
vals AS (SELECT c1.id, lower(c2.name) AS name FROM con c1 JOIN con c2 ON c1.name = c2.code WHERE c1.code = 'ANSWER'),
ex AS (SELECT DISTINCT person_id, measurement_concept_id, cm.name AS concept, lower(ca.name) AS lab, value_as_number AS v, range_low, range_high, unit_concept_id,
  lower(u.name) AS unit, value_as_concept_id, operator_concept_id, measurement_datetime, src_id, measurement_source_concept_id, unit_source_value
  FROM meas JOIN con cm ON cm.id = measurement_concept_id JOIN con ca ON ca.id = ancestor_id LEFT JOIN con u ON u.id = unit_concept_id
  WHERE lower(src_id) LIKE '%ehr%' AND ancestor_id IN (502, 503) AND value_as_number IS NOT NULL)"""
BY_CONCEPT = " UNION ALL ".join(person_stratum(k, "concept, class", ["concept", "class"]) for k in PERSON_SETS)
BY_MEASURE = " UNION ALL ".join(person_stratum(k, "measure", ["measure"] + (["ancestry"] if len(k) > 1 else [])) for k in PERSON_SETS)

ORACLES |= {
    "headline_report": "SELECT label, count(DISTINCT person_id) AS n FROM (" + " UNION ALL ".join(
        f"SELECT '{HEADLINES[key]}' AS label, person_id FROM ({rows}) AS r(person_id)" for key, rows in HEADLINE_ROWS.items()) + ") GROUP BY 1",
    "add_on_report": f"WITH {DEMOGRAPHICS}, p AS (SELECT * FROM ty JOIN customer ON person_id = c_custkey), k AS (" + " UNION ALL ".join(
        f"SELECT '{flag}' AS data_type, '{name}' AS population, count(*) FILTER (WHERE {rule}) AS n, count(*) AS size FROM p WHERE {inside}"
        for name, inside in POPULATION_FLAGS.items() for flag, rule in ADD_ONS.items()) + ") SELECT data_type, population, n, n / size AS ratio FROM k WHERE n > 0",
    "self_reported_race": """SELECT DISTINCT o_custkey AS person_id, CASE o_orderstatus WHEN 'F' THEN 'White' WHEN 'O' THEN 'AIAN (American Indian or Alaska Native)' ELSE 'Skip' END AS self_reported_race
FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "case_control_report": f"""WITH {PERSONS}, {YES_NO}, w AS (
  SELECT concept, CASE WHEN flag THEN 'Cases' ELSE 'Controls' END AS class, age_group, sex_at_birth, ancestry FROM ph JOIN ps USING (person_id) WHERE flag IS NOT NULL),
x AS ({percent_label(BY_CONCEPT)})
SELECT x.*, n_name AS concept_name FROM x LEFT JOIN nation ON concept = CAST(n_nationkey + 100 AS VARCHAR) OR concept = n_name || '-CODE'""",
    "measure_report": f"""WITH {PERSONS}, big AS (SELECT o_custkey AS person_id, max(o_totalprice) AS largest FROM orders GROUP BY 1),
me AS (SELECT person_id, 'balance' AS measure FROM who WHERE c_acctbal >= 0 UNION ALL SELECT person_id, 'largest_order' FROM big WHERE largest > {HIGH_VALUE}),
w AS (SELECT measure, age_group, sex_at_birth, ancestry FROM me JOIN ps USING (person_id))
{percent_label(BY_MEASURE)}""",
    "lab_report_sites": f"WITH {LAB_ROWS} SELECT lab, replace(src_id, 'EHR site ', '#') AS site, {MOMENTS}, {QUANTILES} FROM ex GROUP BY ALL",
    "lab_report_people": f"""WITH {LAB_ROWS},
a AS (SELECT lab, person_id, {f"{MOMENTS}, {QUANTILES}".replace('count(v) AS n, ', '').replace(', 4)', ', 7)')}, count(DISTINCT v) AS values_count FROM ex GROUP BY ALL),
n AS (SELECT * FROM ex QUALIFY rank() OVER (PARTITION BY lab, person_id ORDER BY measurement_datetime DESC) = 1),
b AS (SELECT lab, person_id, string_agg({number_text('v')}, ', ' ORDER BY v, unit NULLS FIRST) AS latest_value,
             string_agg(coalesce(unit, 'NA'), ', ' ORDER BY v, unit NULLS FIRST) AS latest_value_unit FROM n GROUP BY ALL)
SELECT * FROM a JOIN b USING (lab, person_id)""",
    "family_history_index": f"""WITH {YES_NO}, c AS (SELECT concept, count(flag) AS n FROM ph GROUP BY 1)
SELECT concept AS concept_id, 'including yourself, who in your family has had ' || lower(n_name) || '? select all that apply.' AS concept_name, n AS n_pids,
       ' ' || lower(n_name) || '? ' AS short_name, 'pfhh_survey_' || concept || '_summary' AS report_name
FROM c JOIN nation ON concept = CAST(n_nationkey + 100 AS VARCHAR)""",
    "physical_measure_index": """SELECT DISTINCT CAST(m.id AS BIGINT) AS measurement_concept_id, m.name AS measurement_source_value, lower(n_name) AS concept_name,
       replace(m.name, '-', '_') || '_summary' AS report_name
FROM (VALUES (101, 'weight', 1), (102, 'height', 2), (103, 'heart-rate-mean', 3), (104, 'blood-pressure-diastolic-mean', 4)) m(id, name, number)
JOIN lineitem ON l_linenumber = m.number JOIN nation ON n_nationkey = m.number""",
    "lab_index": f"SELECT *, 'measurement_' || measurement_concept_id AS report_name FROM ({ORACLES['concept_name_map']})",
}
