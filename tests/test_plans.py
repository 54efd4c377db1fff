"""Plans: bucketed joins, footer statistics, scans of profiling, sketches."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from studylake.operators import load as L
from studylake.operators import normalize as N
from studylake.operators import profile as P
from studylake.plans import analytics as A
from studylake.plans.warehouse import Warehouse
from studylake.session import staging_path
from studylake.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark):
    path = staging_path(spark, "t-plans-raw")
    fixtures.raw_studies(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def bucketed(spark):
    w = Warehouse.from_sf(spark, SF)
    root = staging_path(spark, "t-bucketed")
    tables = {"studies": w.studies, "study_conditions": w.conditions.select("study_id", "condition_name"),
              "study_interventions": w.interventions.select("study_id", "intervention_name")}
    return w, {t: spark.table(n) for t, n in L.write_bucketed(tables, root, 4, os.path.basename(root)).items()}


@pytest.mark.parametrize("name", ["q2", "q3", "b3"])
def test_bucketed_join_without_exchange(spark, bucketed, name):
    w, t = bucketed
    ask = {"q2": lambda c, i, s: A.q2_top_conditions(c, s), "q3": lambda c, i, s: A.q3_interventions(i, s, 5),
           "b3": lambda c, i, s: A.b3_late_phase(c, s)}[name]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ask(t["study_conditions"], t["study_interventions"], t["studies"])
        text = plan(got)
        assert "SortMergeJoin" in text
        below = text[text.index("SortMergeJoin"):]
        assert "Exchange" not in below and "SelectedBucketsCount: 4 out of 4" in below
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in ask(w.conditions, w.interventions, w.studies).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_footer_statistics_read_no_rows(spark):
    path = staging_path(spark, "t-footers")
    spark.range(5, 1005).select("id", F.expr("date_add(DATE '2020-01-01', cast(id as int))").alias("d")).write.parquet(path)
    got = L.file_statistics(spark, [path], ["id", "d"])
    text = got._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(d), MAX(d)]" in text
    r = got.first()
    assert (r["n_rows"], r["min_id"], r["max_id"], str(r["min_d"])) == (1000, 5, 1004, "2020-01-06")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_one_scan_for_each_section(raw):
    cols = {"conditions": ",", "interventions": ",", "standard_age": None, "mesh": ","}
    assert plan(N.split_summaries(raw, cols)).count("FileScan") == 1
    assert plan(P.multi_value_widest(raw)).count("FileScan") == 1
    assert plan(P.short_values(raw, P.TEXT_COLUMNS, "source_row_index")).count("FileScan") == 2  # counts, and the first of each
    assert "brief_title" not in plan(P.duplicate_rows(raw)).split("Exchange")[1].split("\n")[0]  # texts are not shuffled


def test_duplicate_rows_tell_nulls_apart(spark):
    rows = [("a", None), ("a", None), ("a", "null"), (None, "a"), ("ab", "c"), ("a", "bc"), ("", None), (None, ""), ("a", None)]
    assert P.duplicate_rows(spark.createDataFrame(rows, "x string, y string")).first()[0] == 2


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(60_000).select(F.concat(F.lit("o"), F.col("id") % 50_000).alias("org_name"), *[
        F.lit("x, y").alias(c) for c in (*P.CATEGORICAL, "conditions", "interventions", "mesh")])
    path = staging_path(spark, "t-sketch")
    for run in range(3):  # the parts share values
        P.unique_sketches(df.filter(F.col("org_name").isNotNull() & (F.expr("substr(org_name, -1)") >= run * 2)), f"r{run}").write.mode("append").parquet(path)
    got = {r["metric"]: r["n_estimate"] for r in P.merged_uniques(spark.read.parquet(path)).collect()}
    assert abs(got["unique_org_name"] - 50_000) <= 4 * 1.04 / 2 ** (P.SKETCH_K / 2) * 50_000
    assert got["unique_conditions"] == 2 and got["unique_phases"] == 1
