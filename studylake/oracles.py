"""DuckDB oracle SQL for the correctness gate.

Each oracle is self-contained: it rebuilds the dirty ``raw`` view, the
cleaning rules and the warehouse tables as CTEs over the pre-registered base
tables, then runs the query. Ids use ``row_number()`` in DuckDB (fine for a
test oracle; the engine itself never uses a global window)."""

from __future__ import annotations

from .functions.text import HIDDEN_NULL_VALUES, PROFILE_HIDDEN_NULL_VALUES

W = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
RAW_STRING_COLS = [
    "org_name", "org_class", "responsible_party", "brief_title", "full_title",
    "overall_status", "start_date", "standard_age", "conditions", "primary_purpose",
    "interventions", "intervention_description", "study_type", "phases",
    "outcome_measure", "mesh",
]


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


HIDDEN = sql_list(HIDDEN_NULL_VALUES)
PROFILE_HIDDEN = sql_list(PROFILE_HIDDEN_NULL_VALUES)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{W}+|{W}+$', '', 'g')"


RAW = """raw AS (
SELECT o.o_orderkey AS source_row_index,
  CASE WHEN o.o_custkey % 50 = 0 THEN 'Unknown' ELSE c.c_name END AS org_name,
  CASE WHEN o.o_custkey % 7 = 0 THEN 'UNKNOWN' WHEN o.o_custkey % 11 = 0 THEN ' Unknown ' ELSE c.c_mktsegment END AS org_class,
  CASE WHEN o.o_orderkey % 9 = 0 THEN 'N/A' ELSE 'SPONSOR' END AS responsible_party,
  concat('Study ', CAST(o.o_orderkey % 4000 AS VARCHAR)) AS brief_title,
  CASE WHEN o.o_orderkey % 10 = 0 THEN 'Unknown' ELSE concat('  Full ', CAST(o.o_orderkey AS VARCHAR)) END AS full_title,
  CASE o.o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RECRUITING'
    ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'TERMINATED' ELSE 'UNKNOWN' END END AS overall_status,
  CASE WHEN o.o_orderkey % 101 = 0 THEN 'Unknown' WHEN o.o_orderkey % 97 = 0 THEN '1940-01-01'
    WHEN o.o_orderkey % 89 = 0 THEN '2021-13'
    WHEN o.o_orderkey % 3 = 0 THEN substr(CAST(o.o_orderdate AS VARCHAR), 1, 7)
    ELSE concat(' ', substr(CAST(o.o_orderdate AS VARCHAR), 1, 10)) END AS start_date,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'ADULT  OLDER_ADULT' WHEN o.o_orderkey % 7 = 0 THEN 'Unknown' ELSE 'CHILD ADULT' END AS standard_age,
  m.conditions,
  CASE WHEN o.o_orderkey % 4 = 0 THEN 'Not Applicable' WHEN o.o_orderkey % 4 = 1 THEN 'TREATMENT' ELSE 'PREVENTION' END AS primary_purpose,
  m.interventions,
  CASE WHEN o.o_orderkey % 6 = 0 THEN '--' ELSE o.o_orderpriority END AS intervention_description,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'OBSERVATIONAL' WHEN o.o_orderkey % 61 = 0 THEN 'Unknown' ELSE 'INTERVENTIONAL' END AS study_type,
  CASE WHEN o.o_orderkey % 13 = 0 THEN 'No phases listed' WHEN o.o_orderkey % 17 = 0 THEN NULL
    WHEN o.o_orderkey % 8 = 0 THEN 'PHASE2, PHASE3' ELSE concat('PHASE', substr(o.o_orderpriority, 1, 1)) END AS phases,
  CASE WHEN o.o_orderkey % 15 = 0 THEN '   ' ELSE c.c_mktsegment END AS outcome_measure,
  m.mesh
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT l_orderkey,
    string_agg(p_brand, ',, ' ORDER BY p_brand) AS conditions,
    string_agg(p_name, ', ' ORDER BY p_name) AS interventions,
    string_agg(p_type, ',' ORDER BY p_type) AS mesh
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) m ON m.l_orderkey = o.o_orderkey
)"""

_nulled = ",\n  ".join(
    f"CASE WHEN {strip(c)} IN ({HIDDEN}) THEN NULL ELSE {strip(c)} END AS {c}"
    for c in RAW_STRING_COLS)

DATE_FMTS = ["%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y", "%Y%m%d", "%Y"]
_parse = "coalesce(" + ", ".join(
    f"CAST(try_strptime(sd_fix, '{f}') AS DATE)" for f in DATE_FMTS) + ")"

CLEAN = f"""clean0 AS (SELECT source_row_index,
  {_nulled}
FROM raw),
clean1 AS (SELECT *, start_date AS start_date_raw,
  coalesce(regexp_matches(start_date, '^\\d{{4}}-\\d{{2}}$'), false) AS start_date_is_approx,
  CASE WHEN regexp_matches(start_date, '^\\d{{4}}-\\d{{2}}$') THEN start_date || '-01' ELSE start_date END AS sd_fix
FROM clean0),
clean2 AS (SELECT *, {_parse} AS p0 FROM clean1),
cleaned AS (SELECT * EXCLUDE (start_date, phases, study_type, sd_fix, p0),
  CASE WHEN year(p0) BETWEEN 1678 AND 2261 THEN p0 END AS start_date_parsed,
  CASE WHEN year(p0) BETWEEN 1950 AND 2026 THEN p0 END AS start_date,
  nullif(phases, 'No phases listed') AS phases,
  coalesce(study_type, 'UNKNOWN') AS study_type
FROM clean2)"""

WAREHOUSE = """orgs_all AS (SELECT org_name, org_class, source_row_index AS first_row_index FROM (
  SELECT org_name, org_class, source_row_index,
    row_number() OVER (PARTITION BY org_name ORDER BY source_row_index) AS rn FROM cleaned) WHERE rn = 1),
organizations AS (SELECT row_number() OVER (ORDER BY first_row_index) AS org_id, org_name, org_class
  FROM orgs_all WHERE org_name IS NOT NULL),
keyed AS (SELECT row_number() OVER (ORDER BY source_row_index) AS study_id, * FROM cleaned),
studies AS (SELECT k.study_id, o.org_id, k.org_name, k.responsible_party, k.brief_title, k.full_title,
  k.overall_status, k.start_date, k.start_date_raw, k.start_date_is_approx, k.primary_purpose,
  k.study_type, k.phases AS phase, k.outcome_measure, k.intervention_description, k.source_row_index
  FROM keyed k LEFT JOIN organizations o ON o.org_name = k.org_name)"""


def bridge_cte(name: str, src: str, value: str, sep: str | None) -> str:
    arr = (f"regexp_split_to_array({strip(src)}, '{W}+')" if sep is None
           else f"string_split({src}, '{sep}')")
    return f"""{name}_tok AS (SELECT study_id, source_row_index, unnest({arr}) AS tok,
    generate_subscripts({arr}, 1) AS pos FROM keyed WHERE {src} IS NOT NULL),
{name} AS (SELECT row_number() OVER (ORDER BY source_row_index, pos) AS id, study_id,
    {strip('tok')} AS {value}, source_row_index, pos FROM {name}_tok WHERE {strip('tok')} <> '')"""


BRIDGE_CTES = {
    "study_conditions": bridge_cte("study_conditions", "conditions", "condition_name", ","),
    "study_interventions": bridge_cte("study_interventions", "interventions", "intervention_name", ","),
    "study_age_groups": bridge_cte("study_age_groups", "standard_age", "age_group", None),
    "study_mesh_terms": bridge_cte("study_mesh_terms", "mesh", "mesh_term", ","),
}

LOCATIONS = """study_locations AS (SELECT row_number() OVER (ORDER BY k.source_row_index) AS id,
  k.study_id, c.c_name AS facility, c.c_mktsegment AS city, CAST(NULL AS VARCHAR) AS state,
  n.n_name AS country, CAST(NULL AS VARCHAR) AS zip_code
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN keyed k ON k.source_row_index = o.o_orderkey)"""


def with_raw(body: str) -> str:
    return f"WITH {RAW}\n{body}"


def with_clean(body: str) -> str:
    return f"WITH {RAW},\n{CLEAN}\n{body}"


def with_w(body: str, bridges: tuple[str, ...] = (), locations: bool = False, extra: tuple[str, ...] = ()) -> str:
    ctes = [RAW, CLEAN, WAREHOUSE] + [BRIDGE_CTES[b] for b in bridges] + list(extra)
    if locations:
        ctes.append(LOCATIONS)
    return "WITH " + ",\n".join(ctes) + "\n" + body


def pct(num: str, den: str, dp: int = 1) -> str:
    s = 10 ** dp
    d = f"NULLIF(CAST({den} AS BIGINT), 0)"
    n = f"CAST({num} AS BIGINT)"
    return f"CAST((({n} * {200 * s} + {d}) // ({d} * 2)) / {s}.0 AS DOUBLE)"


def cond(pred: str) -> str:
    return f"CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"
