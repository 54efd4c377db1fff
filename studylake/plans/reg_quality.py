"""Registrations: quality gate (D, E3–E5), load (L), upsert/trend/layout
(E1, E6, E7)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import oracles as O
from ..functions import text as TX
from ..operators import load as L
from ..operators import quality as Q
from ..operators import upsert as U
from ..schemas import FOREIGN_KEYS, MAX_LENGTH, NOT_NULL
from ..session import staging_path
from ..sources import fixtures
from .registry import RUN_LOG_SQL, W, register, run_log_from_events

CHECK = "check_name, table_name, column_name, severity, failures, examples"
NULL_EX = "CAST(NULL AS VARCHAR) AS examples"
BR = ("study_conditions", "study_interventions", "study_age_groups", "study_mesh_terms")


def _row(check, table, column, sev, failures_sql, from_sql, examples=NULL_EX):
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, {col} AS column_name, "
            f"'{sev}' AS severity, CAST(({failures_sql}) AS BIGINT) AS failures, {examples} "
            f"FROM {from_sql}")


def _not_null_sql(table, cols, check="not_null", src=None):
    return [_row(check, table, c, "error", f"COUNT(*) FILTER (WHERE {c} IS NULL)", src or table)
            for c in cols]


def _enum_sql(table, col, valid, src):
    vl = O.sql_list(valid)
    bad = f"(SELECT {col} AS v FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN ({vl}))"
    ex = (f"(SELECT CASE WHEN COUNT(*) > 0 THEN string_agg(v, ', ' ORDER BY v) END FROM "
          f"(SELECT DISTINCT v FROM {bad} ORDER BY v LIMIT 10))")
    return _row("valid_values", table, col, "warning", "COUNT(*)", bad, f"{ex} AS examples")


ENUMS = [("studies", "study_type", TX.VALID_STUDY_TYPES, "studies"),
         ("studies", "overall_status", TX.VALID_STATUSES, "studies"),
         ("studies", "responsible_party", TX.VALID_RESPONSIBLE_PARTIES, "studies"),
         ("organizations", "org_class", TX.VALID_ORG_CLASSES, "orgs_all"),
         ("age_groups", "age_group", TX.VALID_AGE_GROUPS, "study_age_groups")]

_DATE_ROW = _row("date_range", "studies", "start_date", "warning",
                 "CASE WHEN COUNT(start_date) = 0 THEN 1 ELSE 0 END", "studies",
                 "concat_ws(' to ', CAST(MIN(start_date) AS VARCHAR), CAST(MAX(start_date) AS VARCHAR)) AS examples")
_UNIQUE_ROW = _row("unique", "organizations", "org_name", "error",
                   "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT org_name FROM orgs_all))", "orgs_all")


def _empty_row(table, src):
    return _row("not_empty", table, None, "error",
                f"CASE WHEN (SELECT COUNT(*) FROM (SELECT 1 FROM {src} LIMIT 1)) = 0 THEN 1 ELSE 0 END",
                "(SELECT 1)")


def _report_sql():
    parts = (_not_null_sql("studies", ["brief_title", "study_type"])
             + [_enum_sql(*e) for e in ENUMS]
             + [_DATE_ROW, _UNIQUE_ROW, _empty_row("conditions", "study_conditions"),
                _empty_row("interventions", "study_interventions"),
                _empty_row("age_groups", "study_age_groups")])
    return O.with_w("\nUNION ALL\n".join(parts), bridges=BR)


def _w_tables(w):
    return {"organizations": w.organizations, "studies": w.studies,
            "study_conditions": w.conditions, "study_interventions": w.interventions,
            "study_age_groups": w.age_groups, "study_mesh_terms": w.mesh_terms}


@register("dq_not_null", O.with_w("\nUNION ALL\n".join(
    _not_null_sql("studies", ["brief_title", "study_type"]))))
def dq_not_null(spark, sf_dir):
    return Q.check_not_null(W(spark, sf_dir).studies, "studies", ["brief_title", "study_type"])


@register("dq_enum", O.with_w("\nUNION ALL\n".join(
    f"SELECT check_name, table_name, column_name, severity, failures FROM ({_enum_sql(*e)})"
    for e in ENUMS), bridges=BR))
def dq_enum(spark, sf_dir):
    return _enum_frames(spark, sf_dir).drop("examples")


@register("dq_enum_examples", O.with_w("\nUNION ALL\n".join(
    f"SELECT table_name, column_name, examples FROM ({_enum_sql(*e)})" for e in ENUMS), bridges=BR))
def dq_enum_examples(spark, sf_dir):
    return _enum_frames(spark, sf_dir).select("table_name", "column_name", "examples")


def _enum_frames(spark, sf_dir):
    from functools import reduce
    w = W(spark, sf_dir)
    src = {"studies": w.studies, "orgs_all": w.organizations_all, "study_age_groups": w.age_groups}
    parts = [Q.check_valid_values(src[s], t, c, v) for t, c, v, s in ENUMS]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("dq_unique", O.with_w(_UNIQUE_ROW + "\nUNION ALL\n" + _row(
    "unique", "study_conditions", "condition_name", "error",
    "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT condition_name FROM study_conditions))",
    "study_conditions"), bridges=("study_conditions",)))
def dq_unique(spark, sf_dir):
    w = W(spark, sf_dir)
    return Q.check_unique(w.organizations_all, "organizations", "org_name").unionByName(
        Q.check_unique(w.conditions, "study_conditions", "condition_name"))


@register("dq_date_range", O.with_w(
    "SELECT MIN(start_date) AS min_date, MAX(start_date) AS max_date, COUNT(start_date) AS n_dates FROM studies"))
def dq_date_range(spark, sf_dir):
    return Q.date_range(W(spark, sf_dir).studies, "start_date")


@register("dq_not_empty", O.with_w("\nUNION ALL\n".join(
    [_empty_row("conditions", "study_conditions"), _empty_row("interventions", "study_interventions"),
     _empty_row("age_groups", "study_age_groups")]), bridges=BR))
def dq_not_empty(spark, sf_dir):
    w = W(spark, sf_dir)
    return (Q.check_not_empty(w.conditions, "conditions")
            .unionByName(Q.check_not_empty(w.interventions, "interventions"))
            .unionByName(Q.check_not_empty(w.age_groups, "age_groups")))


@register("dq_report", _report_sql())
def dq_report(spark, sf_dir):
    w = W(spark, sf_dir)
    return Q.validate_all(w.studies, w.organizations_all, w.conditions, w.interventions, w.age_groups)


def _contract_sql():
    parts = []
    for t in ["organizations", "studies", *BR]:
        cols = NOT_NULL[t]
        parts += _not_null_sql(t, cols, "contract_not_null")
    return O.with_w("\nUNION ALL\n".join(parts), bridges=BR)


@register("dq_contract_nulls", _contract_sql())
def dq_contract_nulls(spark, sf_dir):
    return Q.contract_nulls(_w_tables(W(spark, sf_dir)))


def _fk_sql():
    parts = []
    for c, cc, p, pc in FOREIGN_KEYS:
        if c == "study_locations":
            continue
        parts.append(_row("foreign_key", c, cc, "error",
                          f"COUNT(*) FILTER (WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {p}))",
                          c, f"'{p}.{pc}' AS examples"))
    return O.with_w("\nUNION ALL\n".join(parts), bridges=BR)


@register("dq_fk", _fk_sql())
def dq_fk(spark, sf_dir):
    return Q.contract_foreign_keys(_w_tables(W(spark, sf_dir)))


def _maxlen_sql():
    cols_present = {
        "organizations": ["org_name", "org_class"],
        "studies": ["responsible_party", "overall_status", "start_date_raw", "primary_purpose",
                    "study_type", "phase"],
        "study_conditions": ["condition_name"], "study_interventions": ["intervention_name"],
        "study_age_groups": ["age_group"]}
    parts = []
    for t, cols in cols_present.items():
        for c in cols:
            parts.append(_row("max_length", t, c, "error",
                              f"COUNT(*) FILTER (WHERE length({c}) > {MAX_LENGTH[t][c]})", t))
    return O.with_w("\nUNION ALL\n".join(parts), bridges=BR)


@register("dq_max_length", _maxlen_sql())
def dq_max_length(spark, sf_dir):
    return Q.contract_max_length(_w_tables(W(spark, sf_dir)))


@register("dq_faults", O.with_w("""
SELECT 'contract_not_null' AS check_name, 'studies' AS table_name, 'brief_title' AS column_name, 'error' AS severity, COUNT(*) AS failures
FROM studies WHERE study_id % 3 <> 0 AND study_id % 7 = 0
UNION ALL SELECT 'max_length', 'organizations', 'org_name', 'error', COUNT(*) FROM organizations WHERE org_id % 5 = 0
UNION ALL SELECT 'foreign_key', 'study_conditions', 'study_id', 'error', COUNT(*) FROM study_conditions WHERE study_id % 3 = 0""",
                            bridges=("study_conditions",)))
def dq_faults(spark, sf_dir):
    """D8–D10 on tables with faults: titles missing, names too long, studies gone
    whose conditions stay. Only failing checks are returned."""
    w = W(spark, sf_dir)
    studies = w.studies.filter("study_id % 3 <> 0").withColumn("brief_title", F.when(F.col("study_id") % 7 != 0, F.col("brief_title")))
    orgs = w.organizations.withColumn("org_name", F.when(F.col("org_id") % 5 == 0, F.repeat(F.lit("x"), 501)).otherwise(F.col("org_name")))
    checks = Q.contract({"organizations": orgs, "studies": studies, "study_conditions": w.table("study_conditions")})
    return checks.filter("failures > 0").drop("examples")


@register("dq_completed_no_start", O.with_w(
    "SELECT COUNT(*) FILTER (WHERE overall_status = 'COMPLETED' AND start_date IS NULL) AS failures FROM studies"))
def dq_completed_no_start(spark, sf_dir):
    return Q.completed_without_start(W(spark, sf_dir).studies)


@register("dq_dup_title_org", O.with_w("""
SELECT brief_title, org_id, COUNT(*) AS n_studies FROM studies GROUP BY brief_title, org_id
HAVING COUNT(*) > 1"""))
def dq_dup_title_org(spark, sf_dir):
    return Q.duplicate_title_org(W(spark, sf_dir).studies)


FRESH_NOW, FRESH_DAYS = "2024-02-15", 7


@register("dq_freshness", f"""
SELECT MAX(ts) AS newest, datediff('day', CAST(MAX(ts) AS DATE), DATE '{FRESH_NOW}') AS days_since,
  datediff('day', CAST(MAX(ts) AS DATE), DATE '{FRESH_NOW}') > {FRESH_DAYS} AS stale FROM events""")
def dq_freshness(spark, sf_dir):
    return Q.freshness(fixtures.table(spark, sf_dir, "events"), "ts", FRESH_NOW, FRESH_DAYS)


# -- load --------------------------------------------------------------------

def _counts_sql(tables, extra_rejected=None):
    extra_rejected = extra_rejected or {}
    parts = [f"SELECT '{t}' AS table_name, COUNT(*) AS rows_loaded, "
             f"CAST({extra_rejected.get(t, '0')} AS BIGINT) AS rows_rejected FROM {t}" for t in tables]
    return "\nUNION ALL\n".join(parts)


_ALL = ["organizations", "studies", *BR]


@register("load_all_counts", O.with_w(_counts_sql(
    _ALL, {"organizations": "(SELECT COUNT(*) FROM orgs_all WHERE org_name IS NULL)"}), bridges=BR))
def load_all_counts(spark, sf_dir):
    w = W(spark, sf_dir)
    t = _w_tables(w)
    return L.table_counts(t, {"organizations": w.organizations_all.filter(F.col("org_name").isNull())})


@register("load_summary", O.with_w(_counts_sql(_ALL), bridges=BR))
def load_summary(spark, sf_dir):
    """L1 + L6 + S11: full refresh into a new run folder, counts read back."""
    w = W(spark, sf_dir)
    paths = L.load_full_refresh(spark, _w_tables(w))
    return L.table_counts(L.read_warehouse(spark, paths))


_LOADED = _counts_sql([*_ALL, "study_locations"],
                      {"organizations": "(SELECT COUNT(*) FROM orgs_all WHERE org_name IS NULL)"})


@register("load_full_refresh", O.with_w(_LOADED, bridges=BR, locations=True))
def load_full_refresh(spark, sf_dir):
    """L1 + L2 + L6: a whole run, read back through the published pointer, with
    the rejected rows that its log reports."""
    from .pipeline import run_backfill
    root = staging_path(spark, "full-refresh")
    res = run_backfill(spark, fixtures.raw_studies(spark, sf_dir),
                       fixtures.raw_locations(spark, sf_dir), root=root)
    loaded = L.table_counts(L.read_warehouse(spark, L.published(spark, root))).drop("rows_rejected")
    logged = res.log.select(F.expr("substring(step_name, 7)").alias("table_name"), "rows_rejected")
    return loaded.join(logged, "table_name")


@register("load_locations", O.with_w("SELECT * FROM study_locations", locations=True))
def load_locations(spark, sf_dir):
    return W(spark, sf_dir).locations


@register("cascade_delete", O.with_w(
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected FROM {t} "
        f"WHERE study_id NOT IN (SELECT study_id FROM studies WHERE study_type = 'OBSERVATIONAL')"
        for t in ["studies", *BR]), bridges=BR))
def cascade_delete(spark, sf_dir):
    """Delete observational studies; children follow."""
    w = W(spark, sf_dir)
    t = {k: v for k, v in _w_tables(w).items() if k != "organizations"}
    doomed = w.studies.filter(F.col("study_type") == "OBSERVATIONAL").select("study_id")
    return L.table_counts(L.cascade_delete(t, doomed))


@register("run_log", O.with_w(f"""
SELECT 'clean' AS step_name, 'SUCCESS' AS status, COUNT(*) AS rows_processed, CAST(0 AS BIGINT) AS rows_rejected FROM studies
UNION ALL SELECT 'stage_' || table_name, 'SUCCESS', rows_loaded, rows_rejected FROM ({_LOADED})
UNION ALL SELECT 'validate', 'SUCCESS', COUNT(*), 0 FROM studies
UNION ALL SELECT 'publish', 'SUCCESS', 7, 0""", bridges=BR, locations=True))
def run_log(spark, sf_dir):
    """The log of a full backfill run, read from its table (without times)."""
    from .pipeline import run_backfill
    root = staging_path(spark, "logged-run")
    run_backfill(spark, fixtures.raw_studies(spark, sf_dir), fixtures.raw_locations(spark, sf_dir), root=root)
    return spark.read.parquet(os.path.join(root, "pipeline_log")).select(
        "step_name", "status", "rows_processed", "rows_rejected")


@register("stage_parquet", O.with_clean(
    "SELECT org_name, responsible_party, brief_title, full_title, overall_status, start_date, "
    "start_date_raw, start_date_is_approx, primary_purpose, study_type, phases AS phase, "
    "outcome_measure, intervention_description, source_row_index FROM cleaned"))
def stage_parquet(spark, sf_dir):
    """Cleaned rows staged as Parquet and read back."""
    from ..operators import clean as C
    from .pipeline import stage_clean
    staged, _ = stage_clean(spark, fixtures.raw_studies(spark, sf_dir),
                            staging_path(spark, "staged-clean"))
    return C.build_studies(staged)


# -- extensions ----------------------------------------------------------------

SPLIT_TS = "2024-01-16 00:00:00"
LATEST_SQL = """SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


@register("upsert_latest", LATEST_SQL)
def upsert_latest(spark, sf_dir):
    """Events before the split are the table, later ones the updates."""
    e = fixtures.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return U.upsert_latest(e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut),
                           ["user_id"], ["ts", "event_id"])


@register("runlog_trend", f"""WITH {RUN_LOG_SQL}
SELECT log_id, step_name, completed_at, rows_processed,
  lag(rows_processed) OVER (PARTITION BY step_name ORDER BY completed_at, log_id) AS prev_rows,
  rows_processed - lag(rows_processed) OVER (PARTITION BY step_name ORDER BY completed_at, log_id) AS rows_delta
FROM run_log""")
def runlog_trend(spark, sf_dir):
    return U.run_log_trend(run_log_from_events(spark, sf_dir))


@register("partitioned_scan", O.with_w(
    "SELECT study_id, start_date, overall_status FROM studies WHERE year(start_date) = 1998"))
def partitioned_scan(spark, sf_dir):
    """Fact written partitioned by start year; the year filter prunes
    partitions at planning time (PartitionFilters in the scan)."""
    s = W(spark, sf_dir).studies.withColumn("start_year", F.year("start_date"))
    path = os.path.join(staging_path(spark, "studies-by-year"), "studies")
    L.write_table(s, path, ["start_year"])
    return (spark.read.parquet(path).filter(F.col("start_year") == 1998)
            .select("study_id", "start_date", "overall_status"))
