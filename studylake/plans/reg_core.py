"""Registrations: cleaning (C), normalisation (N), keys (K)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from .. import oracles as O
from ..functions import dates as D
from ..operators import clean as C
from ..operators import keys as K
from ..operators import load as L
from ..operators import normalize as N
from ..operators.contract import conform
from ..session import staging_path
from ..sources import fixtures
from .registry import R, W, register

STUDY_SQL_COLS = ("org_name, responsible_party, brief_title, full_title, overall_status, "
                  "start_date, start_date_raw, start_date_is_approx, primary_purpose, study_type, "
                  "phases AS phase, outcome_measure, intervention_description, source_row_index")


@register("trim_all", O.with_raw("SELECT source_row_index, " + ", ".join(
    f"{O.strip(c)} AS {c}" for c in O.RAW_STRING_COLS) + " FROM raw"))
def trim_all(spark, sf_dir):
    return C.trim_all(R(spark, sf_dir))


@register("hidden_nulls", O.with_clean("SELECT * FROM clean0"))
def hidden_nulls(spark, sf_dir):
    return C.replace_hidden_nulls(C.trim_all(R(spark, sf_dir)))


@register("hidden_null_count", O.with_raw(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {O.strip(c)} IN ({O.HIDDEN})) AS BIGINT) "
    f"AS hidden_nulls FROM raw" for c in O.RAW_STRING_COLS)))
def hidden_null_count(spark, sf_dir):
    raw = R(spark, sf_dir)
    return C.hidden_null_counts(raw, C.string_columns(raw))


@register("clean_dates", O.with_clean(
    "SELECT source_row_index, start_date_raw, start_date_is_approx, start_date FROM cleaned"))
def clean_dates(spark, sf_dir):
    return C.clean_raw(R(spark, sf_dir)).select(
        "source_row_index", "start_date_raw", "start_date_is_approx", "start_date")


_RENDER = [("yyyy-MM-dd", "%Y-%m-%d"), ("M/d/yyyy", "%-m/%-d/%Y"),
           ("MMMM d, yyyy", "%B %-d, %Y"), ("yyyyMMdd", "%Y%m%d")]
_parse_duck = "coalesce(" + ", ".join(
    f"CAST(try_strptime(rendered, '{f}') AS DATE)" for f in O.DATE_FMTS) + ")"


@register("parse_dates_mixed", f"""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 4 {' '.join(
    f"WHEN {i} THEN strftime(o_orderdate, '{d}')" for i, (_, d) in enumerate(_RENDER))} END AS rendered
  FROM orders)
SELECT o_orderkey, rendered, {_parse_duck} AS parsed FROM r""")
def parse_dates_mixed(spark, sf_dir):
    """C6 over every order date rendered in one of four layouts."""
    o = fixtures.table(spark, sf_dir, "orders")
    m = F.col("o_orderkey") % 4
    rendered = F.when(m == 0, F.date_format("o_orderdate", _RENDER[0][0]))
    for i, (fmt, _) in enumerate(_RENDER[1:], start=1):
        rendered = rendered.when(m == i, F.date_format("o_orderdate", fmt))
    r = o.select("o_orderkey", rendered.alias("rendered"))
    return r.select("o_orderkey", "rendered", D.parse_date_mixed("rendered").alias("parsed"))


@register("suspicious_dates", O.with_clean("""
SELECT source_row_index, start_date_raw, start_date_parsed FROM cleaned
WHERE start_date_parsed IS NOT NULL AND year(start_date_parsed) NOT BETWEEN 1950 AND 2026"""))
def suspicious_dates(spark, sf_dir):
    c = C.clean_raw(R(spark, sf_dir))
    return c.filter(D.is_suspicious(F.col("start_date_parsed"))).select(
        "source_row_index", "start_date_raw", "start_date_parsed")


@register("date_stats", O.with_clean("""
SELECT COUNT(*) FILTER (WHERE start_date_is_approx) AS dates_approximate,
  COUNT(*) FILTER (WHERE start_date_parsed IS NOT NULL) AS dates_parsed,
  COUNT(*) FILTER (WHERE start_date_raw IS NOT NULL AND start_date_parsed IS NULL) AS dates_unparseable,
  COUNT(*) FILTER (WHERE start_date_parsed IS NOT NULL AND year(start_date_parsed) NOT BETWEEN 1950 AND 2026) AS dates_suspicious
FROM cleaned"""))
def date_stats(spark, sf_dir):
    return C.date_stats(C.clean_raw(R(spark, sf_dir)))


@register("clean_phase", O.with_clean("""
SELECT phases AS phase, COUNT(*) AS n FROM cleaned GROUP BY phases"""))
def clean_phase(spark, sf_dir):
    raw = R(spark, sf_dir)
    c = C.clean_phase(C.replace_hidden_nulls(C.trim_all(raw)))
    return c.groupBy(F.col("phases").alias("phase")).agg(F.count(F.lit(1)).alias("n"))


@register("default_study_type", O.with_clean("""
SELECT study_type, COUNT(*) AS n FROM cleaned GROUP BY study_type"""))
def default_study_type(spark, sf_dir):
    c = C.default_study_type(C.replace_hidden_nulls(C.trim_all(R(spark, sf_dir))))
    return c.groupBy("study_type").agg(F.count(F.lit(1)).alias("n"))


@register("build_studies", O.with_clean(f"SELECT {STUDY_SQL_COLS} FROM cleaned"))
def build_studies(spark, sf_dir):
    return C.build_studies(C.clean_raw(R(spark, sf_dir)))


# -- normalisation -----------------------------------------------------------

def _split_sql(src: str, value: str, sep: str | None) -> str:
    arr = (f"regexp_split_to_array({O.strip(src)}, '{O.W}+')" if sep is None
           else f"string_split({src}, '{sep}')")
    return O.with_clean(f"""
SELECT source_row_index, {value} FROM (
  SELECT source_row_index, {O.strip('t')} AS {value}
  FROM (SELECT source_row_index, unnest({arr}) AS t FROM cleaned WHERE {src} IS NOT NULL))
WHERE {value} <> ''""")


for _key, _src, _val, _sep, _fn in [
        ("split_conditions", "conditions", "condition_name", ",", N.split_conditions),
        ("split_interventions", "interventions", "intervention_name", ",", N.split_interventions),
        ("split_age_groups", "standard_age", "age_group", None, N.split_age_groups),
        ("split_mesh", "mesh", "mesh_term", ",", N.split_mesh)]:
    def _q(spark, sf_dir, _fn=_fn, _val=_val):
        return _fn(C.clean_raw(R(spark, sf_dir))).select("source_row_index", _val)
    register(_key, _split_sql(_src, _val, _sep))(_q)


def _summary_sql() -> str:
    parts = []
    for src, sep in [("conditions", ","), ("interventions", ","), ("standard_age", None),
                     ("mesh", ",")]:
        arr = (f"regexp_split_to_array({O.strip(src)}, '{O.W}+')" if sep is None
               else f"string_split({src}, '{sep}')")
        parts.append(f"""SELECT '{src}' AS column_name,
  (SELECT COUNT({src}) FROM cleaned) AS input_rows,
  COUNT(v) AS "values", COUNT(DISTINCT v) AS unique_values
FROM (SELECT {O.strip('t')} AS v FROM (SELECT unnest({arr}) AS t FROM cleaned WHERE {src} IS NOT NULL))
WHERE v <> ''""")
    return O.with_clean("\nUNION ALL\n".join(parts))


@register("split_summary", _summary_sql())
def split_summary(spark, sf_dir):
    return N.split_summaries(C.clean_raw(R(spark, sf_dir)), {"conditions": ",", "interventions": ",", "standard_age": None, "mesh": ","})


@register("extract_orgs", O.with_w("SELECT org_name, org_class, first_row_index FROM orgs_all"))
def extract_orgs(spark, sf_dir):
    return N.extract_orgs(C.clean_raw(R(spark, sf_dir)))


@register("org_keys", O.with_w("SELECT org_id, org_name, org_class FROM organizations"))
def org_keys(spark, sf_dir):
    return W(spark, sf_dir).organizations


@register("study_keys", O.with_w("SELECT study_id, source_row_index FROM keyed"))
def study_keys(spark, sf_dir):
    return W(spark, sf_dir).studies.select("study_id", "source_row_index")


@register("dense_key", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey, o_orderdate FROM orders""")
def dense_key(spark, sf_dir):
    """K3 on a non-trivial order: orders by (date, key)."""
    o = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return K.dense_key(o, ["o_orderdate", "o_orderkey"], "id").df


@register("resolve_org_id", O.with_w("SELECT study_id, org_name, org_id FROM studies"))
def resolve_org_id(spark, sf_dir):
    return W(spark, sf_dir).studies.select("study_id", "org_name", "org_id")


@register("resolve_study_id", O.with_w("""
SELECT k.study_id, o.o_orderkey AS source_row_index, n.n_name AS country
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN keyed k ON k.source_row_index = o.o_orderkey"""))
def resolve_study_id(spark, sf_dir):
    w = W(spark, sf_dir)
    locs = fixtures.raw_locations(spark, sf_dir)
    return K.resolve_study_id(locs, w.studies).select("study_id", "source_row_index", "country")


@register("unmapped_rows", O.with_w("""
SELECT b.source_row_index, b.condition_name FROM study_conditions b
WHERE NOT EXISTS (SELECT 1 FROM studies s WHERE s.source_row_index = b.source_row_index
                  AND s.study_type <> 'OBSERVATIONAL')""", bridges=("study_conditions",)))
def unmapped_rows(spark, sf_dir):
    """K6: bridge rows whose parent was dropped (observational studies
    removed from the parent set)."""
    w = W(spark, sf_dir)
    parents = w.studies.filter(F.col("study_type") != "OBSERVATIONAL")
    return K.unmapped_rows(w.conditions.select("source_row_index", "condition_name"), parents)


@register("apply_defaults", O.with_w("""
SELECT study_id, 'csv' AS data_source, coalesce(start_date_is_approx, false) AS start_date_is_approx
FROM studies"""))
def apply_defaults(spark, sf_dir):
    """K7: the studies as the contract writes them, read back."""
    path = os.path.join(staging_path(spark, "studies-by-contract"), "studies")
    L.write_table(conform(W(spark, sf_dir).studies, "studies", dt.datetime(2026, 1, 1)), path)
    d = spark.read.parquet(path)
    filled = d.filter("created_at = updated_at AND created_at = TIMESTAMP '2026-01-01 00:00:00'")
    return filled.select("study_id", "data_source", "start_date_is_approx")
