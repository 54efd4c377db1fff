"""Registered queries: name → (spark, sf_dir) -> DataFrame, and the matching
DuckDB oracle text. Every query reads the shared tables (or what Spark
derives from them) in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracles as O
from ..operators import clean as C
from ..operators import keys as K
from ..sources import fixtures
from . import analytics as A
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def W(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_sf(spark, sf_dir)


def run_log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic pipeline log: one step per event (step = event type,
    completed_at = ts, rows = event_id)."""
    e = fixtures.table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("log_id"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("event_type").alias("step_name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("event_id").alias("rows_processed"),
        F.floor("value").cast("bigint").alias("rows_rejected"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("completed_at"),
        F.col("value").cast("decimal(10,2)").alias("duration_seconds"),
    )


RUN_LOG_SQL = """run_log AS (SELECT event_id AS log_id, concat('run-', CAST(user_id AS VARCHAR)) AS run_id,
  event_type AS step_name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  event_id AS rows_processed, CAST(floor(value) AS BIGINT) AS rows_rejected,
  CASE WHEN event_type = 'error' THEN props END AS error_message,
  ts AS started_at, ts AS completed_at, CAST(value AS DECIMAL(10,2)) AS duration_seconds FROM events)"""


# --------------------------------------------------------------------------
# Step 1: minimal slice (clean → A1)
# --------------------------------------------------------------------------

@register("q1_type_phase", O.with_w(f"""
SELECT study_type, phase, COUNT(*) AS trial_count,
  {O.pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 2)} AS pct_of_total
FROM studies GROUP BY study_type, phase"""))
def q1_type_phase(spark, sf_dir):
    return A.q1_type_phase(W(spark, sf_dir).studies)


@register("q2_top_conditions", O.with_w(f"""
SELECT sc.condition_name, COUNT(DISTINCT sc.study_id) AS num_studies,
  COUNT(DISTINCT s.org_id) AS num_organizations,
  {O.pct(O.cond("s.overall_status = 'COMPLETED'"), 'COUNT(*)', 1)} AS completion_rate_pct
FROM study_conditions sc JOIN studies s ON s.study_id = sc.study_id
GROUP BY sc.condition_name ORDER BY num_studies DESC, condition_name LIMIT 20""",
                                          bridges=("study_conditions",)))
def q2_top_conditions(spark, sf_dir):
    w = W(spark, sf_dir)
    return A.q2_top_conditions(w.conditions, w.studies)


def _tasks(spark: SparkSession, w: Warehouse) -> int:
    """Tasks by the studies, as many as cores at least."""
    return max(spark.sparkContext.defaultParallelism, K.tasks_for(w._keyed_rows.rows))


def _q3_sql(threshold: int) -> str:
    return O.with_w(f"""
SELECT si.intervention_name, COUNT(DISTINCT si.study_id) AS num_studies,
  {O.cond("s.overall_status = 'COMPLETED'")} AS completed,
  {O.cond("s.overall_status = 'TERMINATED'")} AS terminated,
  {O.cond("s.overall_status = 'WITHDRAWN'")} AS withdrawn,
  {O.cond("s.overall_status = 'RECRUITING'")} AS recruiting,
  {O.pct(O.cond("s.overall_status = 'COMPLETED'"), 'COUNT(DISTINCT si.study_id)', 1)} AS completion_rate_pct
FROM study_interventions si JOIN studies s ON s.study_id = si.study_id
GROUP BY si.intervention_name HAVING COUNT(DISTINCT si.study_id) >= {threshold}
ORDER BY num_studies DESC, intervention_name LIMIT 20""", bridges=("study_interventions",))


@register("q3_interventions", _q3_sql(50))
def q3_interventions(spark, sf_dir):
    w = W(spark, sf_dir)
    return A.q3_interventions(w.interventions, w.studies, 50, tasks=_tasks(spark, w))


@register("q3_interventions_1000", _q3_sql(1000))
def q3_interventions_1000(spark, sf_dir):
    w = W(spark, sf_dir)
    return A.q3_interventions(w.interventions, w.studies, 1000, tasks=_tasks(spark, w))


@register("q4a_orgs", O.with_w(f"""
SELECT o.org_name, o.org_class, COUNT(s.study_id) AS num_studies,
  {O.cond("s.overall_status = 'COMPLETED'")} AS completed,
  {O.cond("s.overall_status = 'RECRUITING'")} AS recruiting,
  MIN(s.start_date) AS earliest_study, MAX(s.start_date) AS latest_study
FROM organizations o JOIN studies s ON s.org_id = o.org_id
GROUP BY o.org_name, o.org_class
ORDER BY num_studies DESC, org_name, org_class NULLS LAST LIMIT 20"""))
def q4a_orgs(spark, sf_dir):
    w = W(spark, sf_dir)
    return A.q4a_orgs(w.organizations, w.studies)


@register("q4b_countries", O.with_w("""
SELECT country, COUNT(DISTINCT study_id) AS num_studies, COUNT(DISTINCT city) AS num_cities,
  COUNT(DISTINCT facility) AS num_facilities
FROM study_locations GROUP BY country
ORDER BY num_studies DESC, country NULLS LAST LIMIT 20""", locations=True))
def q4b_countries(spark, sf_dir):
    return A.q4b_countries(W(spark, sf_dir).locations)


@register("q5_timeline", O.with_w(f"""
SELECT CAST(year(start_date) AS BIGINT) AS start_year, COUNT(*) AS num_studies,
  {O.cond("study_type = 'INTERVENTIONAL'")} AS interventional,
  {O.cond("study_type = 'OBSERVATIONAL'")} AS observational,
  {O.cond("overall_status = 'COMPLETED'")} AS completed,
  {O.cond("overall_status = 'TERMINATED'")} AS terminated,
  {O.pct(O.cond("overall_status = 'COMPLETED'"), 'COUNT(*)', 1)} AS completion_rate_pct
FROM studies WHERE start_date IS NOT NULL
GROUP BY CAST(year(start_date) AS BIGINT) ORDER BY start_year"""))
def q5_timeline(spark, sf_dir):
    return A.q5_timeline(W(spark, sf_dir).studies)


@register("b1_phase_funnel", O.with_w(f"""
SELECT phase, COUNT(*) AS total_studies,
  {O.cond("overall_status = 'COMPLETED'")} AS completed,
  {O.pct(O.cond("overall_status = 'COMPLETED'"), 'COUNT(*)', 1)} AS completion_rate_pct
FROM studies WHERE phase IS NOT NULL GROUP BY phase ORDER BY phase"""))
def b1_phase_funnel(spark, sf_dir):
    return A.b1_phase_funnel(W(spark, sf_dir).studies)


@register("b2_org_class", O.with_w(f"""
SELECT o.org_class, COUNT(DISTINCT o.org_id) AS num_orgs, COUNT(s.study_id) AS num_studies,
  {O.pct('COUNT(s.study_id)', 'SUM(COUNT(s.study_id)) OVER ()', 1)} AS pct_of_total
FROM organizations o JOIN studies s ON s.org_id = o.org_id
WHERE o.org_class IS NOT NULL GROUP BY o.org_class ORDER BY num_studies DESC"""))
def b2_org_class(spark, sf_dir):
    w = W(spark, sf_dir)
    return A.b2_org_class(w.organizations, w.studies)


@register("b3_late_phase", O.with_w("""
SELECT sc.condition_name, COUNT(DISTINCT sc.study_id) AS num_phase3_studies
FROM study_conditions sc JOIN studies s ON s.study_id = sc.study_id
WHERE s.phase IN ('PHASE3', 'PHASE2, PHASE3')
GROUP BY sc.condition_name ORDER BY num_phase3_studies DESC, condition_name LIMIT 15""",
                                    bridges=("study_conditions",)))
def b3_late_phase(spark, sf_dir):
    w = W(spark, sf_dir)
    return A.b3_late_phase(w.conditions, w.studies)


@register("b4_run_log", f"""WITH {RUN_LOG_SQL}
SELECT run_id, step_name, status, rows_processed, rows_rejected, duration_seconds, completed_at
FROM run_log ORDER BY completed_at NULLS LAST, run_id, step_name""")
def b4_run_log(spark, sf_dir):
    return A.b4_run_log(run_log_from_events(spark, sf_dir))


@register("s1_type_phase", O.with_w("""
SELECT study_type, phase, COUNT(*) AS trial_count FROM studies GROUP BY study_type, phase
ORDER BY trial_count DESC, study_type NULLS LAST, phase NULLS LAST LIMIT 10"""))
def s1_type_phase(spark, sf_dir):
    return A.s1_type_phase(W(spark, sf_dir).studies)


@register("s2_conditions", O.with_w("""
SELECT condition_name, COUNT(DISTINCT study_id) AS num_studies FROM study_conditions
GROUP BY condition_name ORDER BY num_studies DESC, condition_name LIMIT 10""",
                                    bridges=("study_conditions",)))
def s2_conditions(spark, sf_dir):
    return A.s2_conditions(W(spark, sf_dir).conditions)


@register("s3_years", O.with_w(f"""
SELECT CAST(year(start_date) AS BIGINT) AS yr, COUNT(*) AS total,
  {O.cond("overall_status = 'COMPLETED'")} AS completed
FROM studies WHERE start_date IS NOT NULL GROUP BY CAST(year(start_date) AS BIGINT)
ORDER BY yr DESC LIMIT 10"""))
def s3_years(spark, sf_dir):
    return A.s3_years(W(spark, sf_dir).studies)


# --------------------------------------------------------------------------
# Cleaning (R binding)
# --------------------------------------------------------------------------

def R(spark, sf_dir):
    return fixtures.raw_studies(spark, sf_dir)


@register("clean_stats", O.with_clean(f"""
SELECT COUNT(*) AS rows_input, COUNT(*) AS rows_output,
  (SELECT CAST(SUM({' + '.join(f"CASE WHEN {O.strip(c)} IN ({O.HIDDEN}) THEN 1 ELSE 0 END" for c in O.RAW_STRING_COLS)}) AS BIGINT) FROM raw) AS hidden_nulls_replaced,
  COUNT(*) FILTER (WHERE start_date_is_approx) AS dates_approximate,
  COUNT(*) FILTER (WHERE start_date_parsed IS NOT NULL) AS dates_parsed,
  COUNT(*) FILTER (WHERE start_date_raw IS NOT NULL AND start_date_parsed IS NULL) AS dates_unparseable,
  COUNT(*) FILTER (WHERE start_date_parsed IS NOT NULL AND year(start_date_parsed) NOT BETWEEN 1950 AND 2026) AS dates_suspicious
FROM cleaned"""))
def clean_stats(spark, sf_dir):
    return C.clean_stats(R(spark, sf_dir))


# Further registrations (imported for their side effect on QUERIES/ORACLES).
from . import reg_core  # noqa: E402,F401
from . import reg_quality  # noqa: E402,F401
from . import reg_profile  # noqa: E402,F401
from . import reg_sources  # noqa: E402,F401
from . import reg_load  # noqa: E402,F401
