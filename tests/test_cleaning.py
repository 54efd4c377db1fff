"""Cleaning, normalisation and statistics on a six-row fixture
(hand-derived expectations), plus the whitespace/date parity traps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from studylake.functions import dates as D
from studylake.functions.text import strip_ws
from studylake.operators import clean as C
from studylake.operators import normalize as N


def by_idx(df, col):
    return {r["source_row_index"]: r[col] for r in df.select("source_row_index", col).collect()}


# -- hidden nulls ----------------------------------------------------------------

def test_unknown_becomes_null(sample_raw):
    c = C.clean_raw(sample_raw)
    assert by_idx(c, "org_name")[3] is None
    assert by_idx(c, "org_name")[0] == "Nordlund Clinic"


def test_hidden_null_count(sample_raw):
    assert C.hidden_null_count(sample_raw).first()["hidden_nulls_replaced"] == 16


def test_match_is_exact_and_case_sensitive(spark):
    df = spark.createDataFrame([(0, "unknown"), (1, "UNKNOWN"), (2, "Unk"), (3, "UnKnown")],
                               "source_row_index long, v string")
    got = by_idx(C.replace_hidden_nulls(df, ["v"]), "v")
    assert got == {0: None, 1: None, 2: "Unk", 3: "UnKnown"}


def test_strip_runs_before_match_and_blank_stays_empty(spark):
    df = spark.createDataFrame([(0, " Unknown "), (1, "   "), (2, " x "), (3, "\x1cy\x85")],
                               "source_row_index long, v string")
    got = by_idx(C.trim_and_null(df, ["v"]), "v")
    assert got == {0: None, 1: "", 2: "x", 3: "y"}


# -- dates -------------------------------------------------------------------------

def test_year_month_is_approximate(sample_raw):
    c = C.clean_raw(sample_raw)
    assert by_idx(c, "start_date_is_approx") == {
        0: False, 1: False, 2: True, 3: False, 4: False, 5: True}
    assert by_idx(c, "start_date")[2] == dt.date(2015, 9, 1)


def test_full_date_parsed(sample_raw):
    assert by_idx(C.clean_raw(sample_raw), "start_date")[1] == dt.date(2011, 2, 28)


def test_suspicious_date_nulled_raw_kept(sample_raw):
    c = C.clean_raw(sample_raw)
    assert by_idx(c, "start_date")[0] is None
    assert by_idx(c, "start_date_raw")[0] == "1949-12-31"


def test_date_stats(sample_raw):
    s = C.date_stats(C.clean_raw(sample_raw)).first().asDict()
    assert s == {"dates_approximate": 2, "dates_parsed": 5, "dates_unparseable": 0,
                 "dates_suspicious": 1}


def test_lenient_formats(spark):
    vals = ["01/05/2020", "13/05/2020", "January 5, 2020", "2020", "2021-6-1", "20210601",
            "1500-01-01", "9999-01-01", "2021-13-01", "garbage"]
    df = spark.createDataFrame(list(enumerate(vals)), "source_row_index long, v string")
    got = by_idx(D.with_parsed_date(df, "v", "d"), "d")
    assert got == {0: dt.date(2020, 1, 5), 1: dt.date(2020, 5, 13), 2: dt.date(2020, 1, 5),
                   3: dt.date(2020, 1, 1), 4: dt.date(2021, 6, 1), 5: dt.date(2021, 6, 1),
                   6: None, 7: None, 8: None, 9: None}


def test_year_month_13_flagged_and_unparseable(spark):
    df = spark.createDataFrame([(0, "2021-13")], "source_row_index long, start_date string")
    r = C.clean_raw(df).first()
    assert r["start_date_is_approx"] is True and r["start_date"] is None
    assert C.date_stats(C.clean_raw(df)).first()["dates_unparseable"] == 1


# -- multi-value splits -------------------------------------------------------------

def test_split_counts(sample_raw):
    c = C.clean_raw(sample_raw)
    assert N.split_conditions(c).count() == 9
    assert N.split_interventions(c).count() == 8
    assert N.split_age_groups(c).count() == 7
    assert N.split_mesh(c).count() == 6


def test_split_strips_and_drops_empty(spark):
    df = spark.createDataFrame([(0, "a,, b ,a"), (1, None), (2, " , ")],
                               "source_row_index long, conditions string")
    rows = sorted((r[0], r[1]) for r in N.split_conditions(df).select(
        "source_row_index", "condition_name").collect())
    assert rows == [(0, "a"), (0, "a"), (0, "b")]  # bag semantics: repeats kept


def test_whitespace_split_collapses_runs(spark):
    df = spark.createDataFrame([(0, "ADULT  OLDER_ADULT"), (1, "\tCHILD ")],
                               "source_row_index long, standard_age string")
    rows = sorted(tuple(r) for r in N.split_age_groups(df).select("source_row_index", "age_group").collect())
    assert rows == [(0, "ADULT"), (0, "OLDER_ADULT"), (1, "CHILD")]


def test_split_summary(sample_raw):
    s = N.split_summary(C.clean_raw(sample_raw), "conditions", ",", "v").first()
    assert (s["input_rows"], s["values"], s["unique_values"]) == (5, 9, 9)


# -- organizations ---------------------------------------------------------------------

def test_orgs_deduplicated_with_null_group(sample_raw):
    orgs = N.extract_orgs(C.clean_raw(sample_raw))
    assert orgs.count() == 4
    names = {r["org_name"] for r in orgs.collect()}
    assert names == {"Nordlund Clinic", "Bayview Trials", "Ostara Labs", None}


def test_org_keeps_first_rows_class(spark):
    df = spark.createDataFrame([(5, "X", "B"), (2, "X", None), (9, "X", "A")],
                               "source_row_index long, org_name string, org_class string")
    r = N.extract_orgs(df).first()
    assert r["org_class"] is None and r["first_row_index"] == 2


# -- studies shape ----------------------------------------------------------------------

def test_studies_shape(sample_raw):
    s = C.build_studies(C.clean_raw(sample_raw))
    assert s.count() == 6 and len(s.columns) == 14


def test_unknown_type_defaults(sample_raw):
    s = C.build_studies(C.clean_raw(sample_raw))
    assert by_idx(s, "study_type")[2] == "UNKNOWN"


def test_no_phases_listed_is_null(sample_raw):
    s = C.build_studies(C.clean_raw(sample_raw))
    assert by_idx(s, "phase")[2] is None and by_idx(s, "phase")[1] == "PHASE2, PHASE3"


# -- statistics -----------------------------------------------------------------------

def test_clean_stats(sample_raw):
    s = C.clean_stats(sample_raw).first().asDict()
    assert s["rows_input"] == 6 and s["rows_output"] == 6
    assert s["hidden_nulls_replaced"] == 16 and s["dates_suspicious"] == 1


def test_strip_matches_python_strip(spark):
    import sys
    chars = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    vals = [f"{ch}a{ch}" for ch in chars]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(strip_ws("v")).collect()]
    assert got == [v.strip() for v in vals], sys.maxunicode


def test_anchor_counts_sf001(spark):
    """FIXTURES anchors on the sf0.01 raw view."""
    from studylake.sources import fixtures
    raw = fixtures.raw_studies(spark, "/root/testdata/sf0.01")
    s = C.clean_stats(raw).first()
    assert s["hidden_nulls_replaced"] == 18206
    assert (s["dates_approximate"], s["dates_parsed"], s["dates_unparseable"],
            s["dates_suspicious"]) == (5009, 14685, 166, 153)
    c = C.clean_raw(raw)
    assert N.split_conditions(c).count() == 60000
    assert N.split_age_groups(c).count() == 27858
    assert N.extract_orgs(c).count() == 1471
    assert c.filter(F.col("outcome_measure") == "").count() == 1000
