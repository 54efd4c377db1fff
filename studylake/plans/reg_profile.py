"""Registrations: profiling (P1–P21) over the raw export and shared tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import oracles as O
from ..operators import profile as P
from ..session import staging_path
from ..sources import fixtures
from .registry import R, register

ALL_COLS = ["source_row_index"] + O.RAW_STRING_COLS
CATS = P.CATEGORICAL
MV = [("conditions", ","), ("interventions", ","), ("mesh", ","), ("standard_age", None)]
PROFILE_NOW = "2025-01-01"


def _u(parts):
    return "\nUNION ALL\n".join(parts)


@register("prof_shape", O.with_raw(
    f"SELECT COUNT(*) AS n_rows, CAST({len(ALL_COLS)} AS BIGINT) AS n_columns FROM raw"))
def prof_shape(spark, sf_dir):
    return P.shape(R(spark, sf_dir))


@register("prof_columns", O.with_raw(_u([
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, "
    f"'{'bigint' if c == 'source_row_index' else 'string'}' AS dtype, {i} AS position FROM raw"
    for i, c in enumerate(ALL_COLS)])))
def prof_columns(spark, sf_dir):
    return P.columns(R(spark, sf_dir))


DUP_SRC = """(SELECT text, lang, source, n_chars FROM documents
  UNION ALL SELECT text, lang, source, n_chars FROM documents WHERE lang = 'de')"""


@register("prof_dup_rows", f"""
SELECT CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {DUP_SRC})) AS BIGINT) AS duplicate_rows
FROM {DUP_SRC}""")
def prof_dup_rows(spark, sf_dir):
    d = fixtures.table(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars")
    return P.duplicate_rows(d.unionByName(d.filter(F.col("lang") == "de")))


@register("prof_dup_titles", O.with_raw("""
SELECT CAST(COUNT(*) - COUNT(DISTINCT brief_title) - (CASE WHEN COUNT(*) > COUNT(brief_title) THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
  CAST(NULL AS VARCHAR) AS samples FROM raw"""))
def prof_dup_titles(spark, sf_dir):
    return P.duplicate_titles(R(spark, sf_dir))


@register("prof_key", """
SELECT COUNT(DISTINCT o_orderkey) AS unique_values,
  COUNT(DISTINCT o_orderkey) = COUNT(*) AND COUNT(o_orderkey) = COUNT(*) AS is_unique,
  MIN(o_orderkey) AS min_value, MAX(o_orderkey) AS max_value,
  (COUNT(DISTINCT o_orderkey) = COUNT(*) AND COUNT(o_orderkey) = COUNT(*))
    AND MAX(o_orderkey) - MIN(o_orderkey) + 1 = COUNT(DISTINCT o_orderkey) AS is_sequential
FROM orders""")
def prof_key(spark, sf_dir):
    return P.candidate_key(fixtures.table(spark, sf_dir, "orders"), "o_orderkey")


def _missing_sql():
    parts = []
    for c in ALL_COLS:
        if c == "source_row_index":
            h = e = ws = "0"
        else:
            h = f"COUNT(*) FILTER (WHERE {c} IN ({O.PROFILE_HIDDEN}))"
            e = f"COUNT(*) FILTER (WHERE {c} = '')"
            ws = f"COUNT(*) FILTER (WHERE {O.strip(c)} = '' AND {c} <> '')"
        nul = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        tot = f"({nul} + {h} + {e} + {ws})"
        parts.append(f"SELECT '{c}' AS column_name, {nul} AS true_null, CAST({h} AS BIGINT) AS hidden_null, "
                     f"CAST({e} AS BIGINT) AS empty_str, CAST({ws} AS BIGINT) AS whitespace, "
                     f"CAST({tot} AS BIGINT) AS total_missing, {O.pct(tot, 'COUNT(*)', 1)} AS pct_missing FROM raw")
    return O.with_raw(_u(parts))


@register("prof_missing", _missing_sql())
def prof_missing(spark, sf_dir):
    return P.missing(R(spark, sf_dir))


@register("prof_hidden_literals", O.with_raw(_u([
    f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS n FROM raw "
    f"WHERE {c} IN ({O.PROFILE_HIDDEN}) GROUP BY {c}" for c in O.RAW_STRING_COLS])))
def prof_hidden_literals(spark, sf_dir):
    return P.hidden_literals(R(spark, sf_dir))


@register("prof_categories", O.with_raw(f"""
SELECT column_name, value, n, {O.pct('n', '(SELECT COUNT(*) FROM raw)', 1)} AS pct, rank FROM (
  SELECT column_name, value, n,
    row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC NULLS FIRST) AS rank
  FROM ({_u([f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS n FROM raw GROUP BY {c}" for c in CATS])}))
WHERE rank <= 20"""))
def prof_categories(spark, sf_dir):
    return P.categories(R(spark, sf_dir))


@register("prof_categories_summary", O.with_raw(_u([
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"greatest(COUNT(DISTINCT {c}) - 20, 0) AS n_more FROM raw" for c in CATS])))
def prof_categories_summary(spark, sf_dir):
    return P.category_summary(R(spark, sf_dir))


@register("prof_case_variants", O.with_raw(f"""
SELECT column_name, lower({O.strip('value')}) AS normalized, COUNT(*) AS n_variants,
  string_agg(value, ' | ' ORDER BY value) AS variants
FROM (SELECT DISTINCT * FROM ({_u([f"SELECT '{c}' AS column_name, {c} AS value FROM raw WHERE {c} IS NOT NULL" for c in CATS])}))
GROUP BY column_name, lower({O.strip('value')}) HAVING COUNT(*) > 1"""))
def prof_case_variants(spark, sf_dir):
    return P.case_variants(R(spark, sf_dir))


_FMT = (f"CASE WHEN regexp_matches(start_date, '{P.SLASH_RX}') THEN 'slash' "
        f"WHEN regexp_matches(start_date, '{P.YM_RX}') THEN 'year_month' "
        f"WHEN regexp_matches(start_date, '{P.ISO_RX}') THEN 'iso' ELSE 'other' END")


@register("prof_date_formats", O.with_raw(f"""
SELECT date_format, n, {O.pct('n', 'SUM(n) OVER ()', 1)} AS pct FROM (
  SELECT {_FMT} AS date_format, COUNT(*) AS n FROM raw WHERE start_date IS NOT NULL GROUP BY 1)"""))
def prof_date_formats(spark, sf_dir):
    return P.date_formats(R(spark, sf_dir))


@register("prof_date_other", O.with_raw(f"""
SELECT source_row_index, start_date FROM raw WHERE start_date IS NOT NULL AND {_FMT} = 'other'
ORDER BY source_row_index LIMIT 10"""))
def prof_date_other(spark, sf_dir):
    return P.date_other_samples(R(spark, sf_dir))


_S = O.strip("start_date")
_FIXED = f"CASE WHEN regexp_matches({_S}, '^\\d{{4}}-\\d{{2}}$') THEN {_S} || '-01' ELSE {_S} END"
_PARSE = ("CASE WHEN year(p0) BETWEEN 1678 AND 2261 THEN p0 END")
_P0 = "coalesce(" + ", ".join(f"CAST(try_strptime(fx, '{f}') AS DATE)" for f in O.DATE_FMTS) + ")"
_PARSED_CTE = f"""p AS (SELECT start_date AS raw_v, {_PARSE} AS d FROM (
  SELECT start_date, {_P0} AS p0 FROM (SELECT start_date, {_FIXED} AS fx FROM raw)))"""


@register("prof_date_range", O.with_raw(f""", {_PARSED_CTE}
SELECT COUNT(*) FILTER (WHERE raw_v IS NOT NULL AND d IS NULL) AS parse_failures,
  MIN(d) AS earliest, MAX(d) AS latest, COUNT(*) FILTER (WHERE year(d) < 1990) AS before_1990,
  COUNT(*) FILTER (WHERE d > DATE '{PROFILE_NOW}') AS in_future FROM p"""))
def prof_date_range(spark, sf_dir):
    return P.date_range(R(spark, sf_dir), PROFILE_NOW)


@register("prof_years", O.with_raw(f""", {_PARSED_CTE}
SELECT CAST(year(d) AS BIGINT) AS year, COUNT(*) AS n FROM p WHERE d IS NOT NULL
GROUP BY 1 ORDER BY n DESC, year LIMIT 10"""))
def prof_years(spark, sf_dir):
    return P.top_years(R(spark, sf_dir))


def _arr(src, sep):
    return (f"regexp_split_to_array({O.strip(src)}, '{O.W}+')" if sep is None
            else f"string_split({src}, '{sep}')")


def _tok_sql(src, sep):
    return (f"(SELECT v FROM (SELECT {O.strip('t')} AS v FROM (SELECT unnest({_arr(src, sep)}) AS t "
            f"FROM raw WHERE {src} IS NOT NULL)) WHERE v <> '')")


@register("prof_multi", O.with_raw(_u([
    f"SELECT '{c}' AS column_name, (SELECT COUNT({c}) FROM raw) AS input_rows, COUNT(v) AS \"values\", "
    f"COUNT(DISTINCT v) AS unique_values FROM {_tok_sql(c, s)}" for c, s in MV])))
def prof_multi(spark, sf_dir):
    return P.multi_value(R(spark, sf_dir))


def _width(c, sep):
    if sep is None:
        return f"len(list_filter(regexp_split_to_array({c}, '{O.W}+'), lambda x: x <> ''))"
    return f"len(string_split({c}, '{sep}'))"


@register("prof_multi_width", O.with_raw(_u([
    f"SELECT '{c}' AS column_name, CAST(MIN({_width(c, s)}) AS BIGINT) AS min_values, "
    f"AVG({_width(c, s)}) AS avg_values, CAST(MAX({_width(c, s)}) AS BIGINT) AS max_values "
    f"FROM raw WHERE {c} IS NOT NULL" for c, s in MV])))
def prof_multi_width(spark, sf_dir):
    return P.multi_value_width(R(spark, sf_dir))


@register("prof_multi_widest", O.with_raw(_u([
    f"SELECT * FROM (SELECT '{c}' AS column_name, CAST({_width(c, s)} AS INTEGER) AS n_values, "
    f"source_row_index AS row_index, {c} AS value FROM raw WHERE {c} IS NOT NULL "
    f"ORDER BY n_values DESC, source_row_index LIMIT 1) WHERE n_values > 20" for c, s in MV])))
def prof_multi_widest(spark, sf_dir):
    return P.multi_value_widest(R(spark, sf_dir))


@register("prof_multi_top", O.with_raw(_u([
    f"SELECT * FROM (SELECT '{c}' AS column_name, v AS value, COUNT(*) AS n, "
    f"row_number() OVER (ORDER BY COUNT(*) DESC, v ASC NULLS FIRST) AS rank FROM {_tok_sql(c, s)} "
    f"GROUP BY v) WHERE rank <= 15" for c, s in MV])))
def prof_multi_top(spark, sf_dir):
    return P.multi_value_top(R(spark, sf_dir))


DOC_TEXT = ["text", "lang", "source"]


@register("prof_text_len", _u([
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, CAST(MIN(length({c})) AS BIGINT) AS min_len, "
    f"AVG(length({c})) AS avg_len, CAST(MAX(length({c})) AS BIGINT) AS max_len FROM documents"
    for c in DOC_TEXT]))
def prof_text_len(spark, sf_dir):
    return P.text_lengths(fixtures.table(spark, sf_dir, "documents"), DOC_TEXT)


@register("prof_text_len_raw", O.with_raw(_u([
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, CAST(MIN(length({c})) AS BIGINT) AS min_len, "
    f"AVG(length({c})) AS avg_len, CAST(MAX(length({c})) AS BIGINT) AS max_len FROM raw"
    for c in P.TEXT_COLUMNS])))
def prof_text_len_raw(spark, sf_dir):
    return P.text_lengths(R(spark, sf_dir), P.TEXT_COLUMNS)


PART_TEXT = ["p_name", "p_brand", "p_type"]


@register("prof_text_short", _u([
    f"SELECT '{c}' AS column_name, (SELECT COUNT(*) FROM part WHERE length({c}) < 5) AS n_short, "
    f"(SELECT CASE WHEN COUNT(*) > 0 THEN string_agg(v, ' | ' ORDER BY k) END FROM "
    f"(SELECT p_partkey AS k, {c} AS v FROM part WHERE length({c}) < 5 ORDER BY p_partkey LIMIT 5)) AS samples"
    for c in PART_TEXT]))
def prof_text_short(spark, sf_dir):
    return P.short_values(fixtures.table(spark, sf_dir, "part"), PART_TEXT, "p_partkey")


@register("prof_orgs", O.with_raw("""
SELECT org_name, COUNT(*) AS n FROM raw WHERE org_name IS NOT NULL GROUP BY org_name
ORDER BY n DESC, org_name LIMIT 20"""))
def prof_orgs(spark, sf_dir):
    return P.organizations(R(spark, sf_dir))


def _uniq_sql():
    parts = [f"SELECT 'unique_org_name' AS metric, COUNT(DISTINCT org_name) AS n FROM raw"]
    parts += [f"SELECT 'unique_{c}' AS metric, COUNT(DISTINCT {c}) AS n FROM raw" for c in CATS]
    parts += [f"SELECT 'unique_{c}' AS metric, COUNT(DISTINCT {O.strip('t')}) AS n FROM "
              f"(SELECT unnest(string_split({c}, ',')) AS t FROM raw WHERE {c} IS NOT NULL)"
              for c in ("conditions", "interventions", "mesh")]
    return O.with_raw(_u(parts))


@register("prof_uniques", _uniq_sql())
def prof_uniques(spark, sf_dir):
    return P.uniques(R(spark, sf_dir))


@register("unique_sketches", O.with_raw("""
SELECT 'unique_org_name' AS metric, COUNT(DISTINCT org_name) AS n, true AS within_bound FROM raw
UNION ALL SELECT 'unique_mesh', COUNT(DISTINCT trim(t)), true FROM (SELECT unnest(string_split(mesh, ',')) AS t FROM raw)
UNION ALL SELECT 'unique_study_type', COUNT(DISTINCT study_type), true FROM raw"""))
def unique_sketches(spark, sf_dir):
    """P21 by increments: sketches of three runs, stored and merged, against the
    exact counts; the bound is four standard errors."""
    raw = R(spark, sf_dir)
    path = os.path.join(staging_path(spark, "sketches"), "sketches")
    for run in range(3):
        P.unique_sketches(raw.filter(F.col("source_row_index") % 3 == run), f"run-{run}").write.mode("append").parquet(path)
    exact = P.uniques(raw).filter(F.col("metric").isin("unique_org_name", "unique_mesh", "unique_study_type"))
    error = F.abs(F.col("n_estimate") - F.col("n")) / F.col("n")
    return exact.join(P.merged_uniques(spark.read.parquet(path)), "metric").select(
        "metric", "n", (error <= 4 * 1.04 / 2 ** (P.SKETCH_K / 2)).alias("within_bound"))
