"""Keys, quality gate, load, sources and plan-shape checks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from studylake.functions.metrics import pct
from studylake.operators import clean as C
from studylake.operators import keys as K
from studylake.operators import load as L
from studylake.operators import quality as Q
from studylake.operators import upsert as U
from studylake.plans.warehouse import Warehouse
from studylake.session import staging_path
from studylake.sources import csv as CSV
from studylake.sources import fixtures
from studylake.sources import json_pages as J
from studylake.streaming.ingest import stream_upsert

SF = "/root/testdata/sf0.001"


def test_dense_key_independent_of_partitioning(spark):
    o = fixtures.table(spark, SF, "orders").select("o_orderkey", "o_orderdate")
    a = K.dense_key(o, ["o_orderdate", "o_orderkey"], "id", num_partitions=3)
    b = K.dense_key(o, ["o_orderdate", "o_orderkey"], "id", num_partitions=7)
    ra = sorted((r.id, r.o_orderkey) for r in a.df.collect())
    rb = sorted((r.id, r.o_orderkey) for r in b.df.collect())
    assert ra == rb
    assert [i for i, _ in ra] == list(range(1, o.count() + 1))
    assert a.rows == o.count()


def test_warehouse_invariants(spark):
    w = Warehouse.from_sf(spark, SF)
    studies = w.studies
    n = studies.count()
    ids = sorted(r.study_id for r in studies.select("study_id").collect())
    assert ids == list(range(1, n + 1))
    for b in (w.conditions, w.interventions, w.age_groups, w.mesh_terms):
        assert b.join(studies, "study_id", "left_anti").count() == 0
        bid = sorted(r.id for r in b.select("id").collect())
        assert bid == list(range(1, len(bid) + 1))
    # bridge row count = tokens after split
    tokens = C.clean_raw(fixtures.raw_studies(spark, SF)).select(
        F.sum(F.size(F.filter(F.transform(F.split("conditions", ","), lambda x: F.trim(x)),
                              lambda x: x != "")))).first()[0]
    assert w.conditions.count() == tokens
    # org ids follow first appearance
    orgs = w.organizations.join(w.organizations_all, "org_name").orderBy("org_id").collect()
    firsts = [r.first_row_index for r in orgs]
    assert firsts == sorted(firsts)


def test_gate_passes_on_warehouse_and_fails_on_empty_bridge(spark):
    w = Warehouse.from_sf(spark, SF)
    ok, text = Q.gate(Q.validate_all(w.studies, w.organizations_all, w.conditions,
                                     w.interventions, w.age_groups))
    assert ok and "study_type" in text  # UNKNOWN types are a warning only
    empty = w.conditions.limit(0)
    with pytest.raises(Q.ValidationError):
        Q.gate(Q.validate_all(w.studies, w.organizations_all, empty, w.interventions, w.age_groups))


def test_gate_on_sample(sample_raw):
    w = Warehouse(C.clean_raw(sample_raw))
    ok, text = Q.gate(Q.validate_all(w.studies, w.organizations_all, w.conditions,
                                     w.interventions, w.age_groups), raise_on_error=False)
    assert ok
    assert "study_type" in text


def test_enum_examples_sorted_and_capped(spark):
    vals = [(f"v{i:02d}",) for i in range(30)] + [("OTHER",), (None,)]
    df = spark.createDataFrame(vals, "org_class string")
    r = Q.check_valid_values(df, "organizations", "org_class", ["OTHER"]).first()
    assert r.failures == 30
    assert r.examples == ", ".join(f"v{i:02d}" for i in range(10))


def test_pct_exact_half_up(spark):
    r = spark.range(1).select(pct(F.lit(1), F.lit(8), 1).alias("a"), pct(F.lit(1), F.lit(3), 2).alias("b"),
                              pct(F.lit(2), F.lit(3), 1).alias("c"), pct(F.lit(1), F.lit(0), 1).alias("d"),
                              pct(F.lit(57), F.lit(200), 1).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (12.5, 33.33, 66.7, None, 28.5)


def test_full_refresh_writes_new_run(spark):
    w = Warehouse.from_sf(spark, SF)
    p1 = L.load_full_refresh(spark, {"studies": w.studies})
    p2 = L.load_full_refresh(spark, {"studies": w.studies})
    assert p1["studies"] != p2["studies"]
    assert spark.read.parquet(p2["studies"]).count() == w.studies.count()


def test_cascade_delete(spark):
    w = Warehouse.from_sf(spark, SF)
    doomed = w.studies.filter(F.col("study_type") == "OBSERVATIONAL").select("study_id")
    out = L.cascade_delete({"studies": w.studies, "c": w.conditions}, doomed)
    assert out["c"].join(doomed, "study_id").count() == 0
    assert out["studies"].count() == w.studies.count() - doomed.count()


def test_csv_round_trip_and_schema_errors(spark):
    raw = fixtures.raw_studies(spark, SF)
    path = os.path.join(staging_path(spark, "t-csv"), "x")
    CSV.write_csv_export(raw, path)
    back = CSV.scan_csv(spark, path)
    assert back.count() == raw.count()
    assert "source_row_index" in back.columns
    with pytest.raises(CSV.SchemaError):
        CSV.require_columns(spark.createDataFrame([(1, 2)], "a int, b int"), ["a", "Conditions"])
    with pytest.raises(Exception):
        CSV.scan_csv(spark, "/nonexistent/studylake/file.csv").count()


def test_csv_quoted_newlines(spark):
    df = spark.createDataFrame([(0, 'line1\nline2 "q", x')] + [(i, "v") for i in range(1, 3)],
                               "source_row_index long, brief_title string")
    for c in C.string_columns(fixtures.raw_studies(spark, SF)):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("z"))
    path = os.path.join(staging_path(spark, "t-csv-nl"), "x")
    CSV.write_csv_export(df, path)
    back = {r.source_row_index: r.brief_title for r in CSV.scan_csv(spark, path).collect()}
    assert back[0] == 'line1\nline2 "q", x' and len(back) == 3


def test_json_pages_corrupt_and_flatten(spark):
    raw = fixtures.raw_studies(spark, SF)
    root = staging_path(spark, "t-json")
    J.write_pages(J.build_pages(raw, fixtures.raw_locations(spark, SF)), os.path.join(root, "p"))
    spark.createDataFrame([("{not json",)], "value string").write.text(os.path.join(root, "p", "bad"))
    pages = J.read_pages(spark, os.path.join(root, "p") + "/*")
    assert J.bad_records(pages).count() == 1
    flat = J.flatten_studies(J.scan_json_pages(spark, os.path.join(root, "p") + "/*"))
    assert flat.count() == raw.count()
    assert J.explode_locations(flat).count() == raw.count()


def test_stream_ingest_equals_batch_upsert(spark):
    e = fixtures.table(spark, SF, "events").select("user_id", "event_id", "ts", "event_type", "value")
    root = staging_path(spark, "t-stream")
    e.repartitionByRange(3, "ts").write.parquet(os.path.join(root, "land"))
    final = stream_upsert(spark, os.path.join(root, "land"), e.schema, os.path.join(root, "state"),
                          os.path.join(root, "ckpt"), ["user_id"], ["ts", "event_id"],
                          max_files_per_trigger=1, buckets=4)
    got = sorted(tuple(r) for r in final.collect())
    want = sorted(tuple(r) for r in U.latest_per_key(e, ["user_id"], ["ts", "event_id"]).collect())
    assert got == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_udf_and_prune_partitions(spark):
    from studylake.plans import analytics as A
    w = Warehouse.from_sf(spark, SF)
    for df in (A.q2_top_conditions(w.conditions, w.studies), A.q4a_orgs(w.organizations, w.studies),
               C.clean_stats(fixtures.raw_studies(spark, SF))):
        plan = _plan(df)
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    # one offset per partition is broadcast
    assert "BroadcastHashJoin" in _plan(w.studies)
    s = w.studies.withColumn("start_year", F.year("start_date"))
    path = os.path.join(staging_path(spark, "t-part"), "s")
    L.write_table(s, path, ["start_year"])
    scan = spark.read.parquet(path).filter(F.col("start_year") == 1998)
    assert "PartitionFilters: [isnotnull(start_year" in _plan(scan)


def test_scan_pushdown_and_pruning(spark):
    o = fixtures.table(spark, SF, "orders").filter(F.col("o_orderkey") < 100).select("o_orderkey")
    plan = _plan(o)
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_run_log_trend_matches_window(spark):
    """E6 without a per-step window equals the windowed lag (brute force)."""
    from pyspark.sql import Window
    from studylake.plans.registry import run_log_from_events
    log = run_log_from_events(spark, SF)
    got = sorted(tuple(r) for r in U.run_log_trend(log).collect())
    w = Window.partitionBy("step_name").orderBy("completed_at", "log_id")
    prev = F.lag("rows_processed").over(w)
    want = sorted(tuple(r) for r in log.select(
        "log_id", "step_name", "completed_at", "rows_processed", prev.alias("prev_rows"),
        (F.col("rows_processed") - prev).alias("rows_delta")).collect())
    assert got == want


def test_upsert_refreshes_updated_at(spark):
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, v int, s string")
    upd = spark.createDataFrame([(1, 2, "c")], "k int, v int, s string")
    out = {r.k: (r.v, r.s, r.updated_at is not None) for r in
           U.upsert_latest(base, upd, ["k"], ["v"], refresh_col="updated_at").collect()}
    assert out == {1: (2, "c", True), 2: (1, "b", True)}


def test_backfill_end_to_end(spark):
    from studylake.plans.pipeline import run_backfill
    res = run_backfill(spark, fixtures.raw_studies(spark, SF), fixtures.raw_locations(spark, SF),
                       run_id="t")
    assert res.ok and "Result: PASSED" in res.report
    assert res.stats["rows_output"] == fixtures.table(spark, SF, "orders").count()
    t = L.read_warehouse(spark, res.paths)
    assert t["study_conditions"].join(t["studies"], "study_id", "left_anti").count() == 0
    steps = [r.step_name for r in res.log.collect()]
    assert steps[0] == "clean" and steps[-1] == "publish"


def _rows(spark, path):
    return spark.read.parquet(path).count()


def test_failed_run_leaves_the_published_one(spark):
    from studylake.plans.pipeline import run_backfill
    root = staging_path(spark, "t-publish")
    raw, sites = fixtures.raw_studies(spark, SF), fixtures.raw_locations(spark, SF)
    good = run_backfill(spark, raw, sites, run_id="a", root=root)
    assert good.ok and L.published(spark, root) == good.paths
    before = {t: _rows(spark, p) for t, p in good.paths.items()}
    long_name = raw.withColumn("org_name", F.when(F.col("source_row_index") == raw.first()["source_row_index"], F.repeat(F.lit("x"), 600))
                               .otherwise(F.col("org_name")))
    orphans = sites.limit(7).withColumn("source_row_index", F.lit(-1).cast("long"))
    bad = run_backfill(spark, long_name, sites.unionByName(orphans), run_id="b", root=root)
    assert not bad.ok and "max_length organizations.org_name: 1" in bad.report
    assert L.published(spark, root) == good.paths
    assert {t: _rows(spark, p) for t, p in good.paths.items()} == before
    log = spark.read.parquet(os.path.join(root, "pipeline_log"))
    assert {r["run_id"] for r in log.collect()} == {"a", "b"}
    sites_step = log.filter("run_id = 'b' AND step_name = 'stage_study_locations'").first()
    assert sites_step["rows_rejected"] == 7


def test_contract_checks_fail_on_bad_rows(spark):
    orgs = spark.createDataFrame([(1, None, "c"), (2, "y" * 501, "c")], "org_id long, org_name string, org_class string")
    studies = spark.createDataFrame([(1, 9, "t", "X")], "study_id long, org_id long, brief_title string, study_type string")
    got = {(r["check_name"], r["column_name"]): r["failures"] for r in Q.contract({"organizations": orgs, "studies": studies}).collect()}
    assert got[("contract_not_null", "org_name")] == 1 and got[("max_length", "org_name")] == 1
    assert got[("foreign_key", "org_id")] == 1


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.range(1, 200).select(F.col("id").alias("study_id"), F.expr("transform(sequence(1, cast(id % 4 as int)), x -> concat('v', x))").alias("a"))
    df = df.withColumn("a", F.when(F.col("study_id") % 4 == 0, F.lit(None)).otherwise(F.col("a")))
    want = [(i + 1, s, p) for i, (s, p) in enumerate((s, p) for s in range(1, 200) if s % 4 for p in range(s % 4))]
    for n in (1, 5):
        rows = K.child_key(df.repartition(n), "study_id", F.col("a"), "v").collect()
        assert sorted((r["id"], r["study_id"], r["pos"]) for r in rows) == want


def test_bridge_reads_its_own_column_only(spark):
    w = Warehouse.from_sf(spark, SF)
    plan = _plan(w.conditions.select("study_id", "condition_name"))
    schemas = [line for line in plan.split("\n") if "conditions" in line and "ReadSchema" in line]
    assert schemas and all("brief_title" not in s and "org_name" not in s for s in schemas)


def test_organizations_plan_without_sort_aggregate(spark):
    assert "SortAggregate" not in _plan(Warehouse.from_sf(spark, SF).organizations_all)


def test_stream_state_is_never_taken_for_empty(spark):
    e = fixtures.table(spark, SF, "events").select("user_id", "event_id", "ts", "event_type", "value")
    root = staging_path(spark, "t-state")
    land, state, ckpt = (os.path.join(root, x) for x in ("land", "state", "ckpt"))
    run = lambda: stream_upsert(spark, land, e.schema, state, ckpt, ["user_id"], ["ts", "event_id"], buckets=4)
    e.filter("event_id % 2 = 0").write.parquet(land)
    first = sorted(map(tuple, run().collect()))
    assert sorted(map(tuple, run().collect())) == first  # nothing new: the newest state
    e.filter("event_id % 2 = 1").write.mode("append").parquet(land)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(state, "manifest", "batch=0.json"))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    with pytest.raises(Exception, match="missing"):
        run()


def test_bad_studies_cost_their_neighbours_nothing(spark):
    def study(i, count):
        return f'{{"protocolSection": {{"identificationModule": {{"nctId": "N{i}"}}, "designModule": {{"enrollmentInfo": {{"count": {count}}}}}}}}}'
    page = '{"studies": [%s], "totalCount": 3, "nextPageToken": "p"}'
    root = staging_path(spark, "t-bad-studies")
    lines = [page % ", ".join([study(1, 5), study(2, '"many"'), study(3, 7)]), page % study(4, 1), '{"studies": [{"protocolSection": ']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(os.path.join(root, "lines"))
    good = J.flatten_studies(J.scan_json_pages(spark, os.path.join(root, "lines")))
    assert sorted(r["nct_id"] for r in good.collect()) == ["N1", "N3", "N4"]
    bad = J.bad_records(J.read_pages(spark, os.path.join(root, "lines"))).collect()
    assert sorted((r["nct_id"] or "", r["reason"]) for r in bad) == [("", "unreadable page"), ("N2", "unreadable study")]
    import json
    pretty = json.dumps(json.loads(lines[0]), indent=2)
    spark.createDataFrame([(pretty,)], "value string").coalesce(1).write.text(os.path.join(root, "pretty"))
    flat = J.flatten_studies(J.scan_json_pages(spark, os.path.join(root, "pretty"), multi_line=True))
    assert sorted(r["nct_id"] for r in flat.collect()) == ["N1", "N3"]
    assert J.bad_records(J.read_pages(spark, os.path.join(root, "pretty"), multi_line=True)).count() == 1
