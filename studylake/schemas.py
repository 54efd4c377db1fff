"""Schemas and contracts: raw study columns, warehouse tables, and the
warehouse constraints (NOT NULL, max length, foreign keys) the quality gate
checks."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical raw study columns (snake case) and the header each carries in a
# registry CSV export.
RAW_HEADERS = {
    "org_name": "Organization Full Name",
    "org_class": "Organization Class",
    "responsible_party": "Responsible Party",
    "brief_title": "Brief Title",
    "full_title": "Full Title",
    "overall_status": "Overall Status",
    "start_date": "Start Date",
    "standard_age": "Standard Age",
    "conditions": "Conditions",
    "primary_purpose": "Primary Purpose",
    "interventions": "Interventions",
    "intervention_description": "Intervention Description",
    "study_type": "Study Type",
    "phases": "Phases",
    "outcome_measure": "Outcome Measure",
    "mesh": "Medical Subject Headings",
}
RAW_COLUMNS = list(RAW_HEADERS)
REQUIRED_CSV_HEADERS = list(RAW_HEADERS.values())

RAW_CSV_SCHEMA = T.StructType(
    [T.StructField(h, T.StringType(), True) for h in REQUIRED_CSV_HEADERS])

# Optional columns carried through when a source provides them (JSON pages).
EXTRA_COLUMNS = ["nct_id", "enrollment", "data_source", "study_key"]

# Multi-value columns → (bridge table, value column, separator; None = whitespace runs)
BRIDGES = {
    "conditions": ("study_conditions", "condition_name", ","),
    "interventions": ("study_interventions", "intervention_name", ","),
    "age_groups": ("study_age_groups", "age_group", None),
    "mesh_terms": ("study_mesh_terms", "mesh_term", ","),
}
BRIDGE_SOURCE = {
    "conditions": "conditions",
    "interventions": "interventions",
    "age_groups": "standard_age",
    "mesh_terms": "mesh",
}

STUDY_COLUMNS = [
    "org_name", "responsible_party", "brief_title", "full_title",
    "overall_status", "start_date", "start_date_raw", "start_date_is_approx",
    "primary_purpose", "study_type", "phase", "outcome_measure",
    "intervention_description", "source_row_index",
]

# Warehouse contract. Column limits and NOT NULL columns of the
# warehouse tables (timestamps filled by defaults are not listed).
NOT_NULL = {
    "organizations": ["org_id", "org_name"],
    "studies": ["study_id", "brief_title", "study_type"],
    "study_conditions": ["id", "study_id", "condition_name"],
    "study_interventions": ["id", "study_id", "intervention_name"],
    "study_age_groups": ["id", "study_id", "age_group"],
    "study_mesh_terms": ["id", "study_id", "mesh_term"],
    "study_locations": ["id", "study_id"],
    "pipeline_log": ["log_id", "started_at"],
}
MAX_LENGTH = {
    "organizations": {"org_name": 500, "org_class": 50},
    "studies": {
        "responsible_party": 50, "overall_status": 50, "start_date_raw": 20,
        "primary_purpose": 50, "study_type": 50, "phase": 30, "nct_id": 20,
        "data_source": 10,
    },
    "study_conditions": {"condition_name": 500},
    "study_interventions": {"intervention_name": 500},
    "study_age_groups": {"age_group": 20},
    "study_locations": {"facility": 500, "city": 200, "state": 200,
                        "country": 100, "zip_code": 20},
    "pipeline_log": {"run_id": 50, "step_name": 100, "status": 20},
}
_BRIDGE = {"id": "bigint", "study_id": "bigint"}
# Column types of the warehouse tables, in their order.
TABLE_TYPES = {
    "organizations": {"org_id": "bigint", "org_name": "string", "org_class": "string", "created_at": "timestamp"},
    "studies": {
        "study_id": "bigint", "org_id": "bigint", "responsible_party": "string", "brief_title": "string",
        "full_title": "string", "overall_status": "string", "start_date": "date", "start_date_raw": "string",
        "start_date_is_approx": "boolean", "primary_purpose": "string", "study_type": "string", "phase": "string",
        "outcome_measure": "string", "intervention_description": "string", "nct_id": "string", "enrollment": "int",
        "data_source": "string", "created_at": "timestamp", "updated_at": "timestamp",
    },
    "study_conditions": _BRIDGE | {"condition_name": "string"},
    "study_interventions": _BRIDGE | {"intervention_name": "string"},
    "study_age_groups": _BRIDGE | {"age_group": "string"},
    "study_mesh_terms": _BRIDGE | {"mesh_term": "string"},
    "study_locations": _BRIDGE | {"facility": "string", "city": "string", "state": "string", "country": "string", "zip_code": "string"},
}
# Defaults of columns that are absent or null at the load, as SQL; the run's time is one value.
TABLE_DEFAULTS = {
    "organizations": {"created_at": "run time"},
    "studies": {"start_date_is_approx": "false", "data_source": "'csv'", "created_at": "run time", "updated_at": "run time"},
}
FOREIGN_KEYS = [
    # (child table, child column, parent table, parent column)
    ("studies", "org_id", "organizations", "org_id"),
    ("study_conditions", "study_id", "studies", "study_id"),
    ("study_interventions", "study_id", "studies", "study_id"),
    ("study_age_groups", "study_id", "studies", "study_id"),
    ("study_mesh_terms", "study_id", "studies", "study_id"),
    ("study_locations", "study_id", "studies", "study_id"),
]

PIPELINE_LOG_SCHEMA = T.StructType([
    T.StructField("log_id", T.LongType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("step_name", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("rows_processed", T.LongType(), True),
    T.StructField("rows_rejected", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("completed_at", T.TimestampType(), True),
    T.StructField("duration_seconds", T.DecimalType(10, 2), True),
])

# JSON page schema (only the paths the flattener reads; unknown fields are
# ignored by the reader).
_S = T.StringType()
_arr_s = T.ArrayType(_S)
STUDY_JSON_SCHEMA = T.StructType([
    T.StructField("protocolSection", T.StructType([
        T.StructField("identificationModule", T.StructType([
            T.StructField("nctId", _S), T.StructField("briefTitle", _S),
            T.StructField("officialTitle", _S),
            T.StructField("organization", T.StructType([
                T.StructField("fullName", _S), T.StructField("class", _S)])),
        ])),
        T.StructField("statusModule", T.StructType([
            T.StructField("overallStatus", _S),
            T.StructField("startDateStruct", T.StructType([
                T.StructField("date", _S), T.StructField("type", _S)])),
        ])),
        T.StructField("designModule", T.StructType([
            T.StructField("studyType", _S), T.StructField("phases", _arr_s),
            T.StructField("designInfo", T.StructType([T.StructField("primaryPurpose", _S)])),
            T.StructField("enrollmentInfo", T.StructType([
                T.StructField("count", T.IntegerType()), T.StructField("type", _S)])),
        ])),
        T.StructField("conditionsModule", T.StructType([
            T.StructField("conditions", _arr_s), T.StructField("keywords", _arr_s)])),
        T.StructField("armsInterventionsModule", T.StructType([
            T.StructField("interventions", T.ArrayType(T.StructType([
                T.StructField("type", _S), T.StructField("name", _S),
                T.StructField("description", _S)])))])),
        T.StructField("eligibilityModule", T.StructType([
            T.StructField("minimumAge", _S), T.StructField("maximumAge", _S),
            T.StructField("sex", _S), T.StructField("stdAges", _arr_s)])),
        T.StructField("outcomesModule", T.StructType([
            T.StructField("primaryOutcomes", T.ArrayType(T.StructType([
                T.StructField("measure", _S)])))])),
        T.StructField("sponsorCollaboratorsModule", T.StructType([
            T.StructField("responsibleParty", T.StructType([T.StructField("type", _S)])),
            T.StructField("leadSponsor", T.StructType([
                T.StructField("name", _S), T.StructField("class", _S)])),
        ])),
        T.StructField("contactsLocationsModule", T.StructType([
            T.StructField("locations", T.ArrayType(T.StructType([
                T.StructField("facility", _S), T.StructField("city", _S),
                T.StructField("state", _S), T.StructField("country", _S),
                T.StructField("zip", _S)])))])),
    ])),
])
PAGE_JSON_SCHEMA = T.StructType([
    T.StructField("studies", T.ArrayType(_S)),  # raw text, parsed study by study
    T.StructField("totalCount", T.LongType()),
    T.StructField("nextPageToken", _S),
    T.StructField("_corrupt_record", _S),
])
