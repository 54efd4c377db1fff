"""Registrations: sources and sinks (S), JSON flattening (J), streaming
ingest (E2). Fixture files are written under the shared staging root, one
fresh folder per call, from the shared tables in full."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import oracles as O
from ..functions.text import CSV_NA_STRINGS
from ..operators import keys as K
from ..schemas import RAW_HEADERS, REQUIRED_CSV_HEADERS
from ..session import staging_path
from ..sources import csv as CSV
from ..sources import fixtures
from ..sources import json_pages as J
from ..streaming.ingest import stream_pages, stream_upsert
from .reg_quality import LATEST_SQL
from .registry import R, register


def _landed_csv(spark, sf_dir):
    path = os.path.join(staging_path(spark, "csv-export"), "export")
    CSV.write_csv_export(R(spark, sf_dir), path)
    return path


_NA = O.sql_list(CSV_NA_STRINGS)


@register("scan_csv", O.with_raw("SELECT source_row_index, " + ", ".join(
    f"CASE WHEN {c} IN ({_NA}) THEN NULL ELSE {c} END AS {c}" for c in O.RAW_STRING_COLS) + " FROM raw"))
def scan_csv(spark, sf_dir):
    """Export → CSV files → scan (quoted newlines, NA strings, index)."""
    return CSV.scan_csv(spark, _landed_csv(spark, sf_dir))


@register("drop_index_cols", O.with_raw("SELECT " + ", ".join(
    f'{c} AS "{h}"' for c, h in RAW_HEADERS.items()) + " FROM raw"))
def drop_index_cols(spark, sf_dir):
    """The unnamed index column is dropped from a plain header scan."""
    df = spark.read.options(**CSV._CSV_OPTS).csv(_landed_csv(spark, sf_dir))
    return CSV.drop_index_cols(df)[0]


_CUT = ["Conditions", "Phases"]


def _two_layouts(spark, sf_dir):
    """An export whose files differ: rows of even index with the index column and
    all headers, the others without index, in reverse order and without two columns."""
    root = os.path.join(staging_path(spark, "csv-layouts"), "export")
    raw = R(spark, sf_dir)
    CSV.write_csv_export(raw.filter("source_row_index % 2 = 0"), os.path.join(root, "full"))
    odd = raw.filter("source_row_index % 2 = 1")
    back = [(c, h) for c, h in reversed(RAW_HEADERS.items()) if h not in _CUT]
    (odd.select(*[F.col(c).alias(h) for c, h in back]).write.options(**CSV._CSV_OPTS)
     .option("nullValue", "").option("emptyValue", '""').csv(os.path.join(root, "cut")))
    return os.path.join(root, "*")


@register("schema_check", O.with_raw("\nUNION ALL\n".join(
    f"SELECT '{h}' AS column_name, {'false' if h in _CUT else 'true'} AS present, COUNT(*) AS n_rows, "
    f"COUNT(CASE WHEN {c} NOT IN ({_NA}){' AND source_row_index % 2 = 0' if h in _CUT else ''} THEN 1 END) AS non_null FROM raw"
    for c, h in RAW_HEADERS.items())))
def schema_check(spark, sf_dir):
    """S3: the required headers over an export whose files differ, with the records
    and non-null cells of each; ``scan_files`` raises on the same input."""
    return CSV.presence(spark, _two_layouts(spark, sf_dir))


@register("csv_headers", O.with_raw("SELECT CASE WHEN source_row_index % 2 = 0 THEN source_row_index END AS \"index\", " + ", ".join(
    f"CASE WHEN {c} IN ({_NA}){' OR source_row_index % 2 = 1' if h in _CUT else ''} THEN NULL ELSE {c} END AS {c}"
    for c, h in RAW_HEADERS.items()) + " FROM raw"))
def csv_headers(spark, sf_dir):
    """Files read by their own headers."""
    rows = CSV.scan_files(spark, _two_layouts(spark, sf_dir), required=["Brief Title"])
    return rows.filter("reason IS NULL").select("index", *RAW_HEADERS)


@register("source_summary", O.with_raw(
    "SELECT 'csv' AS source, COUNT(*) AS n_rows, CAST(18 AS BIGINT) AS n_columns FROM raw"))
def source_summary(spark, sf_dir):
    """S7 (+ S9): scanned, stamped source summary."""
    df = CSV.scan_csv(spark, _landed_csv(spark, sf_dir), source="csv")
    return CSV.source_summary(df, "csv")


# -- JSON pages ---------------------------------------------------------------

def _landed_pages(spark, sf_dir, corrupt: bool = False):
    root = staging_path(spark, "json-pages")
    pages = J.build_pages(R(spark, sf_dir), fixtures.raw_locations(spark, sf_dir))
    J.write_pages(pages, os.path.join(root, "pages"))
    if corrupt:
        bad = spark.createDataFrame([("{\"studies\": [ {\"protocolSection\": ",)], "value string")
        bad.coalesce(1).write.mode("overwrite").text(os.path.join(root, "pages", "corrupt"))
        return os.path.join(root, "pages") + "/*"
    return os.path.join(root, "pages")


def _flat(spark, sf_dir, profile=False):
    return J.flatten_studies(J.scan_json_pages(spark, _landed_pages(spark, sf_dir)), profile)


NCT = "'NCT' || lpad(CAST(source_row_index AS VARCHAR), 8, '0')"
_K = "len(string_split(interventions, ', '))"
DESC = (f"CASE WHEN interventions IS NULL OR intervention_description IS NULL THEN '' ELSE "
        f"substr(repeat(intervention_description || ' | ', {_K}), 1, "
        f"{_K} * (length(intervention_description) + 3) - 3) END")
FLAT_SQL = f"""SELECT org_name, org_class, responsible_party, brief_title, full_title, overall_status,
  start_date, coalesce(regexp_replace(standard_age, ' +', ' ', 'g'), '') AS standard_age,
  coalesce(replace(conditions, ',, ', ', '), '') AS conditions, primary_purpose,
  coalesce(interventions, '') AS interventions, {DESC} AS intervention_description,
  study_type, coalesce(phases, '') AS phases,
  CASE WHEN outcome_measure IS NULL OR outcome_measure = '' THEN '' ELSE outcome_measure END AS outcome_measure,
  coalesce(replace(mesh, ',', ', '), '') AS mesh, {NCT} AS nct_id,
  CAST(source_row_index % 500 AS INTEGER) AS enrollment, 'api' AS data_source
FROM raw"""


@register("json_flatten", O.with_raw(FLAT_SQL))
def json_flatten(spark, sf_dir):
    """Pages → one flat row per study."""
    return _flat(spark, sf_dir).drop("_locations")


@register("scan_json_pages", O.with_raw(
    f"SELECT {NCT} AS nct_id, (SELECT COUNT(*) FROM raw) AS \"totalCount\" FROM raw"))
def scan_json_pages(spark, sf_dir):
    """Page documents exploded to one row per study."""
    s = J.scan_json_pages(spark, _landed_pages(spark, sf_dir))
    return s.select(F.col("study.protocolSection.identificationModule.nctId").alias("nct_id"),
                    "totalCount")


@register("json_join_scalar", O.with_raw(
    f"SELECT nct_id, conditions, phases, standard_age, mesh FROM ({FLAT_SQL})"))
def json_join_scalar(spark, sf_dir):
    """Scalar arrays joined (missing → '')."""
    return _flat(spark, sf_dir).select("nct_id", "conditions", "phases", "standard_age", "mesh")


@register("json_join_struct", O.with_raw(
    f"SELECT nct_id, interventions, intervention_description, outcome_measure FROM ({FLAT_SQL})"))
def json_join_struct(spark, sf_dir):
    """Struct-array fields joined, empty values dropped."""
    return _flat(spark, sf_dir).select("nct_id", "interventions", "intervention_description",
                                       "outcome_measure")


@register("json_bad_records", O.with_raw(f"""
SELECT {NCT} AS nct_id, 'unreadable study' AS reason FROM raw WHERE source_row_index % 10 = 7
UNION ALL SELECT NULL, 'unreadable page'"""))
def json_bad_records(spark, sf_dir):
    """Pages where every enrollment count that ends in 7 is no number, and
    one page that breaks off. The other studies of those pages stay readable."""
    path = _landed_pages(spark, sf_dir, corrupt=True)
    root = os.path.join(staging_path(spark, "json-bad"), "pages")
    broken = F.regexp_replace("value", '"count":([0-9]*7),', '"count":"no $1",')
    spark.read.text(path).select(broken.alias("value")).write.option("compression", "gzip").text(root)
    return J.bad_records(J.read_pages(spark, root)).select("nct_id", "reason")


@register("explode_locations", O.with_raw(f"""
SELECT 'NCT' || lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') AS nct_id, c.c_name AS facility,
  c.c_mktsegment AS city, CAST(NULL AS VARCHAR) AS state, n.n_name AS country,
  CAST(NULL AS VARCHAR) AS zip_code
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey"""))
def explode_locations(spark, sf_dir):
    """One row per study site."""
    return J.explode_locations(_flat(spark, sf_dir))


@register("json_profile_fields", O.with_raw(f"""
SELECT {NCT} AS nct_id, 'ACTUAL' AS start_date_type, 'ESTIMATED' AS enrollment_type,
  CASE WHEN interventions IS NULL THEN '' ELSE substr(repeat('DRUG, ', {_K}), 1, {_K} * 6 - 2) END AS intervention_types,
  '18 Years' AS minimum_age, CAST(NULL AS VARCHAR) AS maximum_age, 'ALL' AS sex,
  org_name AS lead_sponsor_name, org_class AS lead_sponsor_class FROM raw"""))
def json_profile_fields(spark, sf_dir):
    """Profile-only paths."""
    return _flat(spark, sf_dir, profile=True).select(
        "nct_id", "start_date_type", "enrollment_type", "intervention_types", "minimum_age",
        "maximum_age", "sex", "lead_sponsor_name", "lead_sponsor_class")


_FLAT_COLS = ["org_name", "org_class", "responsible_party", "brief_title", "full_title",
              "overall_status", "start_date", "standard_age", "conditions", "primary_purpose",
              "interventions", "intervention_description", "study_type", "phases",
              "outcome_measure", "mesh", "nct_id", "enrollment", "data_source"]


@register("fill_rates", O.with_raw(f", f AS ({FLAT_SQL})\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, "
    f"CAST(floor(COUNT({c}) * 100 / COUNT(*)) AS BIGINT) AS fill_pct FROM f" for c in _FLAT_COLS)))
def fill_rates(spark, sf_dir):
    """Column fill rates of the flattened pages."""
    return J.fill_rates(_flat(spark, sf_dir))


@register("json_text_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_text_field(spark, sf_dir):
    """Field access into a JSON text column."""
    e = fixtures.table(spark, sf_dir, "events")
    return J.json_text_field(e, "props", "$.k", "k").select("event_id", "k")


@register("json_filter", O.with_raw(f"""
SELECT nct_id, overall_status, conditions, phases FROM ({FLAT_SQL})
WHERE contains(conditions, 'Brand#1') AND overall_status = 'COMPLETED'
  AND list_contains(string_split(phases, ', '), 'PHASE3')"""))
def json_filter(spark, sf_dir):
    """Condition substring + exact status + phase membership."""
    studies = J.scan_json_pages(spark, _landed_pages(spark, sf_dir))
    f = J.filter_studies(studies, condition="Brand#1", status="COMPLETED", phase="PHASE3")
    return J.flatten_studies(f).select("nct_id", "overall_status", "conditions", "phases")


@register("json_limit", O.with_raw(f"SELECT nct_id, brief_title FROM ({FLAT_SQL}) ORDER BY nct_id LIMIT 500"))
def json_limit(spark, sf_dir):
    """Deterministic cap on fetched studies."""
    return J.limit_studies(_flat(spark, sf_dir), 500).select("nct_id", "brief_title")


# -- union of sources ------------------------------------------------------------

_UNION_SQL = f"""u AS (
  SELECT source_row_index AS old_index, 'csv' AS data_source, org_name, brief_title, overall_status,
    CAST(NULL AS VARCHAR) AS nct_id FROM raw WHERE overall_status = 'COMPLETED'
  UNION ALL
  SELECT source_row_index, 'api', org_name, brief_title, overall_status, {NCT}
  FROM raw WHERE overall_status IS DISTINCT FROM 'COMPLETED')"""


def _union(spark, sf_dir):
    raw = R(spark, sf_dir)
    csv_part = CSV.stamp_source(raw.filter(F.col("overall_status") == "COMPLETED"), "csv")
    api_part = _flat(spark, sf_dir).filter(~F.col("overall_status").eqNullSafe("COMPLETED"))
    api_part = api_part.withColumn(
        "source_row_index", F.regexp_extract("nct_id", r"(\d+)$", 1).cast("long"))
    u = csv_part.select("source_row_index", "data_source", "org_name", "brief_title",
                        "overall_status").unionByName(
        api_part.select("source_row_index", "data_source", "org_name", "brief_title",
                        "overall_status", "nct_id"), allowMissingColumns=True)
    u = u.withColumnRenamed("source_row_index", "old_index").withColumn(
        "_src_order", F.when(F.col("data_source") == "csv", 0).otherwise(1))
    return K.dense_key(u, ["_src_order", "old_index"], "source_row_index").df.drop("_src_order")


@register("union_sources", O.with_raw(f""", {_UNION_SQL}
SELECT row_number() OVER (ORDER BY data_source = 'api', old_index) AS source_row_index, * FROM u"""))
def union_sources(spark, sf_dir):
    """CSV and API rows unioned by name, then re-keyed after the union."""
    return _union(spark, sf_dir)


@register("stamp_source", O.with_raw(f""", {_UNION_SQL}
SELECT data_source, COUNT(*) AS n FROM u GROUP BY data_source"""))
def stamp_source(spark, sf_dir):
    """Provenance counts after the union."""
    return _union(spark, sf_dir).groupBy("data_source").agg(F.count(F.lit(1)).alias("n"))


# -- streaming ------------------------------------------------------------------

@register("stream_ingest", LATEST_SQL)
def stream_ingest(spark, sf_dir):
    """Events landed as several files, ingested by a file stream with
    availableNow and upserted per micro-batch; returns the final state."""
    root = staging_path(spark, "stream-ingest")
    e = fixtures.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    land = os.path.join(root, "landing")
    e.repartitionByRange(4, "ts").write.mode("overwrite").parquet(land)
    return stream_upsert(spark, land, e.schema, os.path.join(root, "state"),
                         os.path.join(root, "checkpoint"), ["user_id"], ["ts", "event_id"],
                         max_files_per_trigger=1, buckets=8)


@register("stream_pages", O.with_raw(f"""
SELECT {NCT} AS nct_id, CASE WHEN source_row_index % 3 = 0 THEN 'Update of ' ELSE '' END || brief_title AS brief_title,
  CAST(source_row_index % 500 AS INTEGER) AS enrollment FROM raw"""))
def stream_pages_query(spark, sf_dir):
    """JSON pages landed in two waves, ingested after each; a study is what
    landed last."""
    root = staging_path(spark, "stream-pages")
    land = os.path.join(root, "landing")
    raw, sites = R(spark, sf_dir), fixtures.raw_locations(spark, sf_dir)
    J.write_pages(J.build_pages(raw, sites), land)
    stream_pages(spark, land, root, buckets=8)
    again = raw.filter("source_row_index % 3 = 0").withColumn("brief_title", F.concat(F.lit("Update of "), "brief_title"))
    J.write_pages(J.build_pages(again, sites), land, "append")
    return stream_pages(spark, land, root, buckets=8).select("nct_id", "brief_title", "enrollment")
