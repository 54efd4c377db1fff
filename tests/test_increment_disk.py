"""What keeps an increment's disk small: whole rows of a batch are read, joined and
written where they lie, narrow rows are exchanged in their place."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from studylake.operators import buckets as B
from studylake.operators import keys as K
from studylake.operators import load as L
from studylake.plans import reg_load
from studylake.plans.increment import run_increment
from studylake.session import session_with, staging_path
from studylake.sources import fixtures
from studylake.sources import json_pages as J
from studylake.sources import union as U

ORDER = ["src", "file", "row"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def study(i, title="T", sites=1, conditions=("Flu", "Cough")):
    return {"protocolSection": {
        "identificationModule": {"nctId": f"N{i}", "briefTitle": title, "organization": {"fullName": f"Org {i % 3}", "class": "INDUSTRY"}},
        "statusModule": {"overallStatus": "COMPLETED"}, "designModule": {"studyType": "INTERVENTIONAL"},
        "conditionsModule": {"conditions": list(conditions)}, "eligibilityModule": {"stdAges": ["ADULT"]},
        "armsInterventionsModule": {"interventions": [{"name": "Drug"}]},
        "contactsLocationsModule": {"locations": [{"facility": f"F{i}-{n}"} for n in range(sites)]}}}


def land(spark, path, *pages):
    for at, p in enumerate(pages):
        line = json.dumps({"studies": p, "totalCount": 9})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(os.path.join(path, f"wave={at:03d}"))
    return os.path.join(path, "*")


def test_increment_moves_no_whole_rows_of_new_studies(spark, monkeypatch):
    base, seen = staging_path(spark, "t-laid"), {}
    write = B.write_buckets

    def watched(df, bucket, order, path, *rest):
        seen[os.path.basename(path)] = plan(df)
        return write(df, bucket, order, path, *rest)

    monkeypatch.setattr(B, "write_buckets", watched)
    named, lots = [], K.write_lots
    monkeypatch.setattr(K, "write_lots", lambda *a: [made := lots(*a), named.append(made[1])][0])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = land(spark, f"{base}/a", [study(i) for i in range(1, 5)], [study(i) for i in range(5, 9)])
        run_increment(spark, [U.json_source(spark, a)], "a", f"{base}/wh", dt.datetime(2026, 1, 1), bucket_rows=3)
        for table in ("study_conditions", "study_interventions", "study_age_groups", "study_mesh_terms", "study_locations"):
            assert "SortMergeJoin" in seen[table] and "Exchange" not in seen[table].replace("BroadcastExchange", ""), table
        exchanged = [line for line in seen["studies"].splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
        assert exchanged and all("full_title" not in line for line in exchanged)
        # a batch with a changed study: only its rows are exchanged, by ranges of ids; stored rows stay
        b = land(spark, f"{base}/b", [study(2, conditions=()), study(9)])
        run_increment(spark, [U.json_source(spark, b)], "b", f"{base}/wh", dt.datetime(2026, 1, 2), bucket_rows=3)
        assert seen["study_conditions"].replace("BroadcastExchange", "").count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    t = L.read_parts(spark, L.published_parts(spark, f"{base}/wh"))
    got = sorted((r["study_id"], r["condition_name"]) for r in t["study_conditions"].collect())
    assert got == sorted((i, c) for i in range(1, 10) if i != 2 for c in ("Flu", "Cough"))
    assert sorted(r["id"] for r in t["study_conditions"].collect()) == [1, 2, *range(5, 19)]
    assert len(named) == 4 and not {r["tableName"] for r in spark.sql("SHOW TABLES").collect()} & set(named)


def test_rows_are_numbered_where_they_lie(spark, monkeypatch):
    own, root = session_with(spark, K.BY_LOT), staging_path(spark, "t-lie")
    # files in no order of their places, each in order within
    for at, (file, first, last) in enumerate([("c", 0, 40), ("a", 0, 30), ("b", 5, 6)]):
        spark.range(first, last, 1, 1).select(F.lit(0).alias("src"), F.lit(file).alias("file"), F.col("id").alias("row")).write.parquet(f"{root}/f={at}")
    keyed = K.number_in_place(own.read.parquet(f"{root}/f=*"), 71, ORDER, ["src", "file"], "k")
    want = [(f, r) for f, n in (("a", range(30)), ("b", [5]), ("c", range(40))) for r in n]
    assert [(r["file"], r["row"]) for r in keyed.df.orderBy("k").collect()] == want
    assert [r["k"] for r in keyed.df.orderBy("k").collect()] == list(range(1, 72)) and keyed.rows == 71 and len(keyed.tables) == 1
    ids, _ = K.write_lots(keyed.df.select(K.LOT, K.AT, (F.col("k") * 2).alias("twice")).repartition(keyed.lots, K.LOT), f"{root}/ids-x", keyed.lots)
    both = keyed.df.join(ids.hint("merge"), [K.LOT, K.AT])
    assert "Exchange hashpartitioning" not in plan(both) and both.filter("twice = 2 * k").count() == 71
    # stretches that do not follow each other, too many of them, or rows in another order: sorted first
    turns = own.createDataFrame([(0, f, r) for r in range(6) for f in "ab"], "src int, file string, row long").coalesce(1)
    for most, tables in ((100, 2), (1, 1)):
        monkeypatch.setattr(K, "MAX_PARTITIONS", most)
        keyed = K.number_in_place(turns, 12, ORDER, ["file"], "k")
        assert [(r["file"], r["row"]) for r in keyed.df.orderBy("k").collect()] == [(f, r) for f in "ab" for r in range(6)]
        assert len(keyed.tables) == tables
    mixed = own.createDataFrame([(0, "a", r) for r in (3, 1, 2)] + [(0, None, 9)], "src int, file string, row long").coalesce(1)
    again = K.number_in_place(mixed, 4, ["src", "row", "file"], ["src"], "k", sort=True)
    assert [(r["k"], r["row"]) for r in again.df.orderBy("k").collect()] == [(1, 1), (2, 2), (3, 3), (4, 9)]
    empty = K.number_in_place(mixed.filter("row < 0"), 0, ORDER, ["src"], "k")
    assert empty.rows == 0 and empty.df.count() == 0


def test_ids_as_bits(spark):
    ids = [1, 7, 8, 9, 32_768, 32_769, 65_536, 200_000]
    rows = spark.range(1, 200_003).select(F.col("id").alias("k"), F.lit("x").alias("v")).unionByName(
        spark.createDataFrame([(None, "x")], "k long, v string"))
    bits = K.id_bits(spark.createDataFrame([(i,) for i in ids * 2], "k long"), "k")
    left = K.without(rows, "k", bits)
    assert left.columns == ["k", "v"] and left.count() == 200_003 - len(ids)
    assert left.filter(F.col("k").isin(ids)).count() == 0 and left.filter("k IS NULL").count() == 1
    assert bits.count() == 3 and "Exchange hashpartitioning(k" not in plan(left)


def test_sums_before(spark, monkeypatch):
    monkeypatch.setattr(K, "PARENTS_PER_GROUP", 10)
    data = [(k, k % 4, 1) for k in (1, 2, 9, 10, 11, 25, 57, 58)]
    got = K.sums_before(spark.createDataFrame(data, "k long, a int, b int"), F.col("k"), {"sa": F.col("a"), "sb": F.col("b")})
    assert sorted(map(tuple, got.select("k", "sa", "sb").collect())) == [
        (k, sum(x for j, x, _ in data if j < k), sum(1 for j, _, _ in data if j < k)) for k, _, _ in data]


@pytest.fixture(scope="module")
def odd_tables(spark):
    """Orders that come twice, without lines or customer; lines and keys that are null."""
    root = staging_path(spark, "t-odd")
    day = dt.datetime(1995, 3, 4)
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    put("nation", [(0, "X", 0), (1, None, 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, "C1", 0, 1.0, "AUTO"), (2, None, 1, 1.0, None), (3, "C3", 9, 1.0, "B")],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("part", [(1, "red", "B1", "T1"), (2, None, "B2", None), (2, "two", "B2", "T2"), (3, None, None, None)],
        "p_partkey long, p_name string, p_brand string, p_type string")
    put("orders", [(1, 1, "F", day, "1-URGENT"), (1, 1, "F", day, "1-URGENT"), (2, 2, "O", day, None), (3, 9, "P", day, "x"), (250, 3, None, None, "2"),
                   (None, 1, "F", day, "3"), (5, 1, "P", day, "4"), (7, 2, "F", day, "5")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string")
    put("lineitem", [(1, 1), (1, 2), (2, 2), (None, 1), (5, 3), (99, 1), (250, 1), (250, None), (7, 77)], "l_orderkey long, l_partkey long")
    return root


def test_studies_by_page_are_the_joined_ones(spark, odd_tables):
    raw, sites = fixtures.raw_studies(spark, odd_tables), reg_load._sites(spark, odd_tables)
    paged = fixtures.raw_studies_by_page(spark, odd_tables, sites)
    key = lambda r: str(r)
    assert sorted(map(tuple, paged.select(*raw.columns).collect()), key=key) == sorted(map(tuple, raw.collect()), key=key)
    assert raw.count() == 7
    docs = [sorted(map(tuple, J.build_pages(*args, ordered=True).collect()), key=key)
            for args in ((raw, sites), (paged, None))]
    assert docs[0] == docs[1] and len(docs[0]) == 3  # pages 0 and 2, and that of the order without a key
    both = J.build_pages(paged, None, ordered=True, rows=raw, waves=lambda rows: rows.withColumn("wave", F.explode(F.array(F.lit("one"), F.lit("two")))))
    assert {w: sorted(map(tuple, both.filter(F.col("wave") == w).drop("wave").collect()), key=key) for w in ("one", "two")} == {
        "one": docs[0], "two": docs[0]}


def test_increment_of_rows_with_an_index_and_sites_beside(spark):
    """Rows with an index come in its order, whatever that of the files; a changed site changes its study."""
    base, names = staging_path(spark, "t-beside"), ["a", "b", "c"]
    cols = [f"{n} string" for n in ("facility", "city", "state", "country", "zip_code")]

    def source(title, facility):
        raw = spark.createDataFrame([(i, title if i == 7 else "t", "COMPLETED", "x, y", "Org", "ADULT", "Walk") for i in (9, 7, 8)],
                                    "source_row_index long, brief_title string, overall_status string, conditions string, org_name string, "
                                    "standard_age string, interventions string")
        sites = spark.createDataFrame([(i, facility if i == 9 else n, None, None, None, None) for i in (7, 9) for n in names],
                                      f"source_row_index long, {', '.join(cols)}")
        return U.frame_source("frame", raw, sites)

    run_increment(spark, [source("t", "a")], "one", f"{base}/wh", dt.datetime(2026, 1, 1))
    run = run_increment(spark, [source("new", "z")], "two", f"{base}/wh", dt.datetime(2026, 1, 2))
    assert run.ok and (run.stats["new"], run.stats["changed"]) == (0, 2)
    t = L.read_parts(spark, L.published_parts(spark, f"{base}/wh"))
    assert sorted((r["study_id"], r["study_key"], r["brief_title"]) for r in t["studies"].collect()) == [
        (1, "frame:7", "new"), (2, "frame:8", "t"), (3, "frame:9", "t")]
    assert sorted((r["study_id"], r["facility"]) for r in t["study_locations"].collect()) == [(1, n) for n in names] + [(3, "z")] * 3
    assert sorted((r["study_id"], r["condition_name"]) for r in t["study_conditions"].collect()) == [(i, c) for i in (1, 2, 3) for c in "xy"]
    same = run_increment(spark, [source("new", "z")], "three", f"{base}/wh", dt.datetime(2026, 1, 3))
    assert same.report == "nothing new"
