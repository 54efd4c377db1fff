"""Loads from several sources, increments, the commit protocol, quarantine,
headers per file, bucketed stream state."""

from __future__ import annotations

import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from studylake.operators import keys as K
from studylake.operators import load as L
from studylake.operators.contract import conform
from studylake.plans.increment import run_increment
from studylake.plans.pipeline import run_backfill, run_sources
from studylake.plans.warehouse import Warehouse
from studylake.schemas import RAW_HEADERS, TABLE_TYPES
from studylake.session import staging_path
from studylake.sources import csv as CSV
from studylake.sources import fixtures
from studylake.sources import json_pages as J
from studylake.sources import union as U
from studylake.streaming.ingest import State, stream_pages, stream_upsert

SF = "/root/testdata/sf0.001"
SITES = ["facility", "city", "state", "country", "zip_code"]


def study(i, title="T", org="Org A", sites=0, count=1, conditions=("Flu", "Cough")):
    return {"protocolSection": {
        "identificationModule": {"nctId": f"N{i}", "briefTitle": title, "organization": {"fullName": org, "class": "INDUSTRY"}},
        "statusModule": {"overallStatus": "COMPLETED", "startDateStruct": {"date": "2020-01-02"}},
        "designModule": {"studyType": "INTERVENTIONAL", "enrollmentInfo": {"count": count}},
        "conditionsModule": {"conditions": list(conditions)}, "eligibilityModule": {"stdAges": ["ADULT"]},
        "armsInterventionsModule": {"interventions": [{"name": "Drug", "description": "d"}]},
        "contactsLocationsModule": {"locations": [{"facility": f"F{i}-{n}", "city": "C", "country": "X", "zip": "1"} for n in range(sites)]}}}


def land_pages(spark, path, *pages, extra=()):
    """Each page is a file; files are named in order."""
    lines = [json.dumps({"studies": p, "totalCount": 9}) for p in pages] + list(extra)
    for line in lines:
        at = len(L.names(spark, path))
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(os.path.join(path, f"wave={at:03d}"))
    return os.path.join(path, "*")


def csv_text(spark, path, text):
    spark.createDataFrame([(line,) for line in text.splitlines()], "value string").coalesce(1).write.text(path)
    return path


def csv_row(values, headers):
    return ",".join('"' + str(values.get(h, "")).replace('"', '""') + '"' if values.get(h, "") != "" else "" for h in headers)


GOOD = {"Organization Full Name": "Org B", "Brief Title": "From a file", "Overall Status": "COMPLETED", "Study Type": "OBSERVATIONAL",
        "Conditions": "Gout, Flu", "Interventions": "Walk", "Standard Age": "ADULT CHILD", "Start Date": "2019-03"}


def tables(spark, root):
    return L.read_parts(spark, L.published_parts(spark, root))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_one_load_from_csv_and_json(spark):
    base = staging_path(spark, "t-both")
    headers = list(RAW_HEADERS.values())
    text = "\n".join(["," + ",".join(headers), *[f"{i}," + csv_row(GOOD | {"Brief Title": f"csv {i}"}, headers) for i in (7, 3)]]) + "\n"
    csv_text(spark, f"{base}/csv", text)
    pages = land_pages(spark, f"{base}/json", [study(1, sites=0), study(2, sites=1)], [study(3, sites=3, org="Org B")])
    beside = spark.createDataFrame([(7, "B", "c", None, "Y", None), (99, "lost", "c", None, "Y", None)],
                                   "source_row_index long, facility string, city string, state string, country string, zip_code string")
    got = []
    for n in range(2):
        run = run_sources(spark, [U.csv_source(spark, f"{base}/csv", beside), U.json_source(spark, pages)], root=f"{base}/wh{n}",
                          now=dt.datetime(2026, 1, 1))
        assert run.ok, run.report
        t = L.read_warehouse(spark, run.paths)
        got.append({k: rows(v, *v.columns) for k, v in t.items()})
        # the contract's columns and defaults are in the files
        for name, types in TABLE_TYPES.items():
            assert [c for c in t[name].columns if c in types] == list(types), name
        assert {r["created_at"] for r in t["studies"].collect()} == {dt.datetime(2026, 1, 1)}
    assert got[0] == got[1]  # ids too
    s = L.read_warehouse(spark, run.paths)["studies"]
    assert rows(s, "study_id", "brief_title", "data_source", "study_key") == [
        (1, "csv 3", "csv", "csv:3"), (2, "csv 7", "csv", "csv:7"), (3, "T", "api", "N1"), (4, "T", "api", "N2"), (5, "T", "api", "N3")]
    assert rows(L.read_warehouse(spark, run.paths)["study_locations"], "id", "study_id", "facility") == [
        (1, 2, "B"), (2, 4, "F2-0"), (3, 5, "F3-0"), (4, 5, "F3-1"), (5, 5, "F3-2")]
    assert [r["record"] for r in run.rejected(spark).collect() if "lost" in r["record"]] != []


def test_json_alone_numbers_sites_without_a_sort(spark):
    base = staging_path(spark, "t-json")
    pages = land_pages(spark, f"{base}/json", [study(1, sites=2), study(2)], [study(3, sites=1)])
    w = Warehouse.from_landed(U.land([U.json_source(spark, pages)], f"{base}/landed"))
    assert rows(w.locations, "id", "study_id", "facility") == [(1, 1, "F1-0"), (2, 1, "F1-1"), (3, 3, "F3-0")]
    assert "rangepartitioning" not in w.locations._jdf.queryExecution().executedPlan().toString()


def content(spark, root):
    """The warehouse without surrogate ids."""
    t = tables(spark, root)
    names = t["studies"].select("study_id", "study_key")
    out = {"organizations": rows(t["organizations"], "org_name", "org_class"),
           "studies": rows(t["studies"].join(t["organizations"].select("org_id", F.col("org_name").alias("of")), "org_id", "left"),
                           "study_key", "brief_title", "of", "enrollment", "start_date")}
    for name, value in [("study_conditions", ["condition_name"]), ("study_interventions", ["intervention_name"]),
                        ("study_age_groups", ["age_group"]), ("study_mesh_terms", ["mesh_term"]), ("study_locations", SITES)]:
        out[name] = rows(t[name].join(names, "study_id"), "study_key", *value)
        assert t[name].select("id").distinct().count() == t[name].count()
    return out


def test_increments_equal_one_load(spark):
    base = staging_path(spark, "t-inc")
    first = [study(i, org=f"Org {i % 3}", sites=i % 3, conditions=("Flu",) if i % 2 else ("Gout", "Flu")) for i in range(1, 9)]
    second = [study(2, title="changed", org="Org 9", sites=1, conditions=("New",)), study(4, org="Org 1", sites=1, conditions=("Gout", "Flu")),
              study(9, sites=2), study(9, title="last of two", sites=1)]
    a, b = (land_pages(spark, f"{base}/{n}", p) for n, p in (("a", first), ("b", second)))
    day = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    run_increment(spark, [U.json_source(spark, a)], "a", f"{base}/two", day[0], bucket_rows=3)
    ids, parts = rows(tables(spark, f"{base}/two")["studies"], "study_key", "study_id"), L.published_parts(spark, f"{base}/two")
    run = run_increment(spark, [U.json_source(spark, b)], "b", f"{base}/two", day[1], bucket_rows=3)
    assert run.ok and (run.stats["new"], run.stats["changed"]) == (1, 1)  # study 4 is as it was
    both = land_pages(spark, f"{base}/both", first, second)
    run_increment(spark, [U.json_source(spark, both)], "all", f"{base}/one", day[2], bucket_rows=100)
    assert content(spark, f"{base}/two") == content(spark, f"{base}/one")
    after = tables(spark, f"{base}/two")
    assert set(ids) <= set(rows(after["studies"], "study_key", "study_id"))
    assert {r["study_key"]: (r["created_at"], r["updated_at"]) for r in after["studies"].collect() if r["study_key"] in ("N1", "N2", "N9")} == {
        "N1": (day[0], day[0]), "N2": (day[0], day[1]), "N9": (day[1], day[1])}
    # buckets: studies 1-3 hold the changed one, 7-9 the new one; 4-6 keep their files
    kept = set(parts) & set(L.published_parts(spark, f"{base}/two"))
    assert {(t, n) for t, n, _ in kept if t != "organizations"} == {
        (t, 1) for t in ("studies", "study_conditions", "study_interventions", "study_age_groups", "study_locations")} | {("study_mesh_terms", -1)}
    same = run_increment(spark, [U.json_source(spark, b)], "c", f"{base}/two", day[2], bucket_rows=3)
    assert same.ok and same.report == "nothing new" and L.current(spark, f"{base}/two")[0] == 2


def test_increment_on_a_backfill_and_after_a_conflict(spark, monkeypatch):
    base = staging_path(spark, "t-inc-full")
    a = land_pages(spark, f"{base}/a", [study(1), study(2, sites=1)])
    b = land_pages(spark, f"{base}/b", [study(2, title="new", sites=2), study(3)])
    run_sources(spark, [U.json_source(spark, a)], "full", f"{base}/wh")
    publish, lost = L.publish, []

    def race(spark_, root, run_id, parts, run_root=None, based_on=None):
        if based_on is not None and not lost:  # another run gets in between
            lost.append(publish(spark_, root, "other", L.published_parts(spark_, root)))
        return publish(spark_, root, run_id, parts, run_root, based_on)

    monkeypatch.setattr(L, "publish", race)
    run = run_increment(spark, [U.json_source(spark, b)], "inc", f"{base}/wh")
    assert run.ok and lost == [2] and L.current(spark, f"{base}/wh")[0] == 3
    t = tables(spark, f"{base}/wh")
    assert rows(t["studies"], "study_id", "study_key", "brief_title") == [(1, "N1", "T"), (2, "N2", "new"), (3, "N3", "T")]
    assert rows(t["study_locations"], "study_id", "facility") == [(2, "F2-0"), (2, "F2-1")]


def test_two_runs_at_once_and_vacuum(spark):
    root = staging_path(spark, "t-race")
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda n: L.publish(spark, root, f"r{n}", {"t": f"{root}/runs/r{n}/t"}, f"{root}/runs/r{n}"), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(L.Conflict):
        L.publish(spark, root, "late", {"t": "x"}, based_on=3)
    for n in range(6):
        spark.range(3).write.parquet(f"{root}/runs/r{n}/t")
    spark.range(3).write.parquet(f"{root}/runs/unpublished/t")
    assert L.vacuum(spark, root, keep=2)[:1] != [f"{root}/runs/unpublished"]  # all folders are younger than a day
    assert len(L.names(spark, f"{root}/runs")) == 7
    last = [L.current(spark, root)[1]["run_id"]]
    L.vacuum(spark, root, keep=1, grace=dt.timedelta(seconds=-60))
    assert L.names(spark, f"{root}/runs") == last and L.published(spark, root)["t"].endswith(f"{last[0]}/t")
    assert spark.read.parquet(L.published(spark, root)["t"]).count() == 3


def test_vacuum_spares_parts_of_older_runs(spark):
    base = staging_path(spark, "t-vacuum")
    a = land_pages(spark, f"{base}/a", [study(i, sites=1) for i in range(1, 7)])
    b = land_pages(spark, f"{base}/b", [study(1, title="new", sites=1)])
    for name, pages in (("a", a), ("b", b)):
        run_increment(spark, [U.json_source(spark, pages)], name, f"{base}/wh", bucket_rows=3)
    L.vacuum(spark, f"{base}/wh", keep=1, grace=dt.timedelta(seconds=-60))
    t = tables(spark, f"{base}/wh")
    assert t["studies"].count() == 6 and t["study_locations"].count() == 6
    assert len(L.names(spark, f"{base}/wh/runs")) == 2  # the first run still holds four tables' second buckets


def test_rejected_and_loaded_make_the_input(spark):
    base = staging_path(spark, "t-quarantine")
    headers = list(RAW_HEADERS.values())
    lines = ["," + ",".join(headers), "1," + csv_row(GOOD, headers), "2,too,few,cells", "x," + csv_row(GOOD, headers),
             "3," + csv_row(GOOD | {"Organization Full Name": "Unknown"}, headers)]
    csv_text(spark, f"{base}/csv", "\n".join(lines) + "\n")
    pages = land_pages(spark, f"{base}/json", [study(1, sites=1), study(2, count="many"), study(3, sites=2)], extra=['{"studies": [{'])
    beside = spark.createDataFrame([(1, "A"), (5, "B"), (None, "C")], "source_row_index long, facility string")
    for c in SITES[1:]:
        beside = beside.withColumn(c, F.lit(None).cast("string"))
    run = run_sources(spark, [U.csv_source(spark, f"{base}/csv", beside), U.json_source(spark, pages)], root=base)
    assert run.ok, run.report
    t, bad = L.read_warehouse(spark, run.paths), run.rejected(spark).collect()
    assert sorted((r["table_name"], r["reason"]) for r in bad) == sorted(
        [("studies", "wrong number of cells"), ("studies", "index is no number"), ("studies", "unreadable study"), ("studies", "unreadable page"),
         ("organizations", "org_name is null"), ("study_locations", "study is not in the run"), ("study_locations", "study is not in the run")])
    assert t["studies"].count() + 4 == 4 + 4  # 4 CSV records, 3 JSON studies and a page
    assert t["study_locations"].count() + 2 == 3 + 3 and t["organizations"].count() + 1 == 3
    assert any("many" in r["record"] for r in bad) and any(json.loads(r["record"]).get("facility") == "B" for r in bad)


def test_headers_per_file(spark):
    base = staging_path(spark, "t-headers")
    headers = list(RAW_HEADERS.values())
    swapped = headers[::-1] + ["Extra\nheader"]
    csv_text(spark, f"{base}/in/f=1", "," + ",".join(headers) + "\n" + "5," + csv_row(GOOD | {"Brief Title": 'a "b"\nc'}, headers) + "\n5," + csv_row(GOOD, headers) + "\n")
    csv_text(spark, f"{base}/in/f=2", "﻿" + ",".join(f'"{h}"' for h in swapped) + "\n" + csv_row(GOOD | {"Brief Title": "swapped", "Phases": "NA"}, swapped) + "\n" + csv_row(GOOD | {"Brief Title": "second"}, swapped) + "\n")
    csv_text(spark, f"{base}/in/f=3", "")
    path = f"{base}/in/*"
    got = CSV.scan_files(spark, path).orderBy("file", "row").collect()
    assert [(r["index"], r["brief_title"], r["org_name"], r["phases"]) for r in got] == [
        (5, 'a "b"\nc', "Org B", None), (5, "From a file", "Org B", None), (None, "swapped", "Org B", None), (None, "second", "Org B", None)]
    landed = U.land([U.csv_source(spark, path)], f"{base}/landed")
    assert [tuple(r) for r in U.index_repeats(landed).collect()] == [("csv", 5, 2)]
    w = Warehouse.from_landed(landed)  # rows without index come by file and position, before those with one
    assert [r["brief_title"] for r in w.studies.orderBy("study_id").collect()] == ["swapped", "second", 'a "b"\nc', "From a file"]
    assert len(CSV.headers(spark, path)) == 2
    csv_text(spark, f"{base}/in/f=4", "Brief Title\nx\n")
    with pytest.raises(CSV.SchemaError, match="f=4"):
        CSV.scan_files(spark, path)
    assert {r["column_name"]: (r["present"], r["n_rows"], r["non_null"]) for r in CSV.presence(spark, path).collect()}["Brief Title"] == (True, 5, 5)


def test_contract_defaults(spark):
    now = dt.datetime(2026, 5, 6, 7, 8, 9)
    got = conform(spark.createDataFrame([(1, None, "api"), (2, True, None)], "study_id int, start_date_is_approx boolean, data_source string"), "studies", now)
    assert [c for c in got.columns] == list(TABLE_TYPES["studies"])
    assert [(r["start_date_is_approx"], r["data_source"], r["created_at"]) for r in got.orderBy("study_id").collect()] == [
        (False, "api", now), (True, "csv", now)]


def test_filters_look_at_single_conditions(spark):
    base = staging_path(spark, "t-filter")
    pages = land_pages(spark, base, [study(1, conditions=("Pain, chronic", "Flu")), study(2, conditions=("Pain", "chronic")), study(3, conditions=())])
    found = J.filter_studies(J.scan_json_pages(spark, pages), condition="Pain, chronic", status="COMPLETED")
    assert rows(J.flatten_studies(found), "nct_id") == [("N1",)]
    assert J.filter_studies(J.scan_json_pages(spark, pages), phase="PHASE1").count() == 0


# -- sizing ----------------------------------------------------------------------

def test_partitions_follow_known_bytes(spark):
    cores = spark.sparkContext.defaultParallelism
    w = Warehouse.from_sf(spark, "/root/testdata/sf0.01")
    assert K.partitions_for(w.organizations_all) == cores and K.partitions_for(w._keyed_rows.df) == cores
    made = spark.createDataFrame([(i,) for i in range(100)], "a long")
    assert K.partitions_for(made) == max(cores, made.rdd.getNumPartitions())
    assert K.partitions_for(K.dense_key(made, ["a"]).df) == cores
    w.locations.count()
    files = w.locations.inputFiles()
    assert 0 < len([f for f in files if f.endswith(".parquet")]) <= 10


def test_names_are_resolved_in_one_scan(spark):
    w = Warehouse.from_sf(spark, SF)
    plan = w.studies._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [source_row_index") == 1 and "Union" not in plan


# -- stream state ----------------------------------------------------------------

def test_untouched_buckets_keep_their_files_and_replay_is_idempotent(spark):
    root = staging_path(spark, "t-state")
    state = State(spark, root, buckets=4, retain=3)
    one = spark.createDataFrame([(i, 1, "a") for i in range(40)], "k int, v int, s string")
    state.merge(one, 0, ["k"], ["v"])
    first = state.manifest(0)
    assert first == {b: 0 for b in range(4)}
    files = {b: sorted(L.names(spark, state.folder(0, b))) for b in range(4)}
    two = spark.createDataFrame([(3, 2, "b"), (3, 1, "old")], "k int, v int, s string")
    state.merge(two, 1, ["k"], ["v"])
    at = [b for b, n in state.manifest(1).items() if n == 1]
    assert len(at) == 1 and {b: sorted(L.names(spark, state.folder(0, b))) for b in range(4)} == files
    after = sorted(map(tuple, state.read().collect()))
    assert (3, 2, "b") in after and len(after) == 40
    state.merge(two, 1, ["k"], ["v"])  # replayed after its manifest was written
    assert sorted(map(tuple, state.read().collect())) == after
    assert sorted(map(tuple, state.read(0).collect())) == sorted((i, 1, "a") for i in range(40))
    for n in range(2, 7):  # bounded retention
        state.merge(spark.createDataFrame([(3, n + 1, "c")], "k int, v int, s string"), n, ["k"], ["v"])
    assert state.batches() == [4, 5, 6] and state.read().count() == 40
    held = [(n, b) for n in range(7) for b, _ in [(x, 0) for x in range(4)] if L.exists(spark, state.folder(n, b))]
    assert sorted(held) == sorted([(0, b) for b in range(4) if b not in at] + [(n, at[0]) for n in (4, 5, 6)])
    with pytest.raises(ValueError, match="buckets"):
        State(spark, root, buckets=5).read()


def test_pages_stream(spark):
    root = staging_path(spark, "t-pages")
    land = f"{root}/land"
    broken = '{"studies": [%s, %s], "totalCount": 2}' % (json.dumps(study(3)), json.dumps(study(4, count="many")))
    land_pages(spark, land, [study(1), study(2)], extra=[broken])
    run = lambda: stream_pages(spark, f"{land}/*", root, buckets=4)
    assert rows(run(), "nct_id", "brief_title") == [("N1", "T"), ("N2", "T"), ("N3", "T")]
    land_pages(spark, land, [study(2, title="new"), study(5, sites=2), study(2, title="newest")])
    got = run()
    assert rows(got, "nct_id", "brief_title") == [("N1", "T"), ("N2", "newest"), ("N3", "T"), ("N5", "T")]
    assert [len(r["_locations"]) for r in got.filter("nct_id = 'N5'").collect()] == [2]
    bad = spark.read.parquet(f"{root}/rejected/*").collect()
    assert [(r["reason"], json.loads(r["record"])["nct_id"]) for r in bad] == [("unreadable study", "N4")]
    assert rows(run(), "nct_id") == [("N1",), ("N2",), ("N3",), ("N5",)]


def test_watermark_drops_repeats(spark):
    root = staging_path(spark, "t-mark")
    schema = "k int, ts timestamp, v string"
    at = [dt.datetime(2026, 1, 1, 0, m) for m in (0, 1, 2)]
    spark.createDataFrame([(1, at[0], "a"), (1, at[0], "a"), (2, at[1], "b")], schema).coalesce(1).write.parquet(f"{root}/land")
    df = spark.read.parquet(f"{root}/land")
    run = lambda: stream_upsert(spark, f"{root}/land", df.schema, f"{root}/state", f"{root}/ckpt", ["k"], ["ts"],
                                dedup_watermark=("ts", "1 hour"), buckets=2)
    assert rows(run(), "k", "v") == [(1, "a"), (2, "b")]
    # the repeat of (1, 00:00) with another value arrives within the delay: it never reaches the state
    spark.createDataFrame([(1, at[0], "late repeat"), (2, at[2], "c")], schema).coalesce(1).write.mode("append").parquet(f"{root}/land")
    assert rows(run(), "k", "v") == [(1, "a"), (2, "c")]


def test_backfill_of_a_frame_writes_defaults(spark):
    run = run_backfill(spark, fixtures.raw_studies(spark, SF), root=staging_path(spark, "t-defaults"), now=dt.datetime(2026, 1, 1))
    s = L.read_warehouse(spark, run.paths)["studies"]
    assert rows(s.select("data_source", "created_at", "updated_at").distinct(), "data_source", "created_at") == [("csv", dt.datetime(2026, 1, 1))]
