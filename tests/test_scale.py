"""What keeps a load's memory and disk in proportion to its rows: joins that do not
send ids through the driver, compressed pages, tasks by rows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from studylake.functions import text as T
from studylake.operators import keys as K
from studylake.operators import load as L
from studylake.operators import normalize as N
from studylake.operators import quality as Q
from studylake.plans import analytics as A
from studylake.plans import reg_load, reg_sources
from studylake.session import staging_path
from studylake.sources import json_pages as J

RAW = {"org_name": "o", "org_class": "c", "responsible_party": "p", "brief_title": "b", "full_title": "f",
       "overall_status": "COMPLETED", "start_date": "2001-01-01", "standard_age": "ADULT  CHILD", "conditions": "x,, y",
       "primary_purpose": "q", "interventions": "i, j", "intervention_description": "d", "study_type": "t", "phases": "PHASE1",
       "outcome_measure": "m", "mesh": "a,b"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def raw_rows(spark, n):
    return spark.range(n).select(F.col("id").alias("source_row_index"), *[F.lit(v).alias(c) for c, v in RAW.items()])


def no_sites(spark):
    return spark.createDataFrame([], "source_row_index long, facility string, city string, state string, country string, zip_code string")


@pytest.fixture(scope="module")
def stored(spark):
    """A table of dense ids, and a child whose last row has no parent."""
    root = staging_path(spark, "scale")
    spark.range(1, 2001).select(F.col("id").alias("study_id")).write.parquet(f"{root}/studies")
    spark.range(1, 2002).select(F.col("id").alias("study_id"), F.lit("x").alias("v")).write.parquet(f"{root}/child")
    return spark.read.parquet(f"{root}/studies"), spark.read.parquet(f"{root}/child")


def test_foreign_keys_are_not_broadcast(stored):
    studies, child = stored
    check = Q.check_foreign_key(child, "study_id", studies, "study_id", "child", "studies")
    assert check.first()["failures"] == 1
    assert "SortMergeJoin" in plan(check) and "BroadcastExchange" not in plan(check)


def test_deleted_ids_are_not_broadcast(stored):
    studies, child = stored
    left = L.cascade_delete({"child": child}, studies)["child"]
    assert [r["study_id"] for r in left.collect()] == [2001]
    assert "BroadcastExchange" not in plan(left)


@pytest.mark.parametrize("ordered", [False, True])
def test_pages_are_landed_compressed_and_whole(spark, ordered):
    path = os.path.join(staging_path(spark, "scale-pages"), "pages")
    pages = J.build_pages(raw_rows(spark, 950), no_sites(spark), page_size=10, ordered=ordered)
    assert plan(pages).count("Exchange hashpartitioning(page") + plan(pages).count("Exchange rangepartitioning(page") == 1
    J.write_pages(pages, path)
    files = [n for n in L.names(spark, path) if n.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    back = J.ordered_studies(J.read_pages(spark, path)).orderBy("file", "block", "row", "pos").select("nct_id").collect()
    ids = [int(r["nct_id"][3:]) for r in back]
    assert sorted(ids) == list(range(950))
    if ordered:
        assert ids == list(range(950))
    assert J.read_pages(spark, path).count() == 95


def test_studies_are_parsed_once(spark):
    path = os.path.join(staging_path(spark, "scale-pages"), "pages")
    J.write_pages(J.build_pages(raw_rows(spark, 30), no_sites(spark)), path)
    (spark.createDataFrame([('{"studies": [ {"protocolSection": ',)], "value string").coalesce(1).write.mode("append").text(path))
    found = J.ordered_studies(J.read_pages(spark, path))
    assert plan(found).count("from_json") == 1
    assert sorted(r["n"] for r in found.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()) == [1, 30]


def test_streamed_pages_keep_their_tasks(spark, monkeypatch):
    """Pages of the stream come in as many files as they have tasks, not in two."""
    spread = []
    monkeypatch.setattr(reg_sources, "R", lambda *a: raw_rows(spark, 3000))
    monkeypatch.setattr(reg_sources.fixtures, "raw_locations", lambda *a: no_sites(spark))
    monkeypatch.setattr(reg_sources, "stream_pages", lambda s, land, root, **kw: spread.append(sum(n.startswith("part-") for n in L.names(s, land))) or s.read.json(land))
    monkeypatch.setattr(reg_sources.J, "build_pages", lambda raw, sites: raw.repartition(5).select(
        F.col("source_row_index").alias("nct_id"), "brief_title", F.lit(1).alias("enrollment")))
    reg_sources.stream_pages_query(spark, "")
    assert spread == [5, 10]


def test_tasks_follow_the_rows(spark, stored, monkeypatch):
    assert [K.tasks_for(n) for n in (0, 1, K.STUDIES_PER_TASK, 54_000_000)] == [1, 1, 1, 206]
    studies, child = stored
    top = A.q3_interventions(child.withColumnRenamed("v", "intervention_name"), studies.withColumn("overall_status", F.lit("COMPLETED")), tasks=11)
    own = [line for line in plan(top).splitlines() if "hashpartitioning(study_id" in line]
    assert len(own) == 2 and all(", 11), REPARTITION_BY_NUM" in line for line in own)
    assert top.first()["num_studies"] == 2000


def test_buckets_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "STUDIES_PER_TASK", 100)
    used = []
    write = L.write_bucketed
    monkeypatch.setattr(reg_load.L, "write_bucketed", lambda tables, root, buckets, name: used.append(buckets) or write(tables, root, buckets, name))
    assert reg_load.bucketed_join(spark, "/root/testdata/sf0.001").count() > 0
    assert used == [15]


def test_tokens_are_made_once(spark):
    """A count of bridge rows splits each study's text once; empty and null texts give no row."""
    path = f"{staging_path(spark, 'scale')}/multi"
    spark.createDataFrame([(1, "a, b"), (2, None), (3, ""), (4, " , ,"), (5, " c\u2003,c")], "study_id long, v string").write.parquet(path)
    rows = K.child_key(spark.read.parquet(path), "study_id", N.tokens("v", ","), "token")
    assert plan(rows.groupBy().count()).count("split(") == 1
    assert [tuple(r) for r in rows.select("id", "study_id", "pos", "token").orderBy("id").collect()] == [
        (1, 1, 0, "a"), (2, 1, 1, "b"), (3, 5, 0, "c"), (4, 5, 1, "c")]


def test_cells_are_stripped_at_their_ends_alone(spark):
    """As the pattern and Python's strip do, for every character and for broken UTF-8, without the pattern."""
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    cells = spark.createDataFrame([(f"{c} a{c}b {c}{c}",) for c in chars] + [("",), (None,), ("  ",)], "v string")
    cells = cells.unionByName(spark.sql("SELECT CAST(x AS STRING) AS v FROM VALUES (X'20E2'), (X'E220'), (X'61802080') AS t(x)"))
    stripped = cells.select("v", T.strip_ws("v").alias("out"), F.regexp_replace("v", T.WS_EDGES, "").alias("pattern"))
    assert stripped.filter("NOT out <=> pattern").count() == 0
    assert all(r["out"] == r["v"].strip() for r in stripped.collect() if r["v"] and "\ufffd" not in r["v"])
    assert "regexp_replace" not in plan(cells.select(T.strip_ws("v")))
