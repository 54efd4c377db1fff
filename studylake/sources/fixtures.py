"""Bindings over the shared parquet tables.

``raw_studies`` derives a dirty 16-column study export (plus
``source_row_index``) from orders ⋈ customer and a per-order roll-up of
lineitem ⋈ part, so every cleaning rule has something to act on. Its work
grows with orders/lineitem; no row is dropped or sampled.
"""

from __future__ import annotations

import os
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


#: A site's columns, by their names in a page.
SITE_FIELDS = {"facility": "facility", "city": "city", "state": "state", "country": "country", "zip": "zip_code"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _mod(c: Column, n: int) -> Column:
    return c % F.lit(n)


#: Of an order's lines: the part's column, the study's column and its separator.
LINE_COLUMNS = {"p_brand": ("conditions", ",, "), "p_name": ("interventions", ", "), "p_type": ("mesh", ",")}


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders with their part's columns."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", *LINE_COLUMNS)
    return li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", *LINE_COLUMNS)


def order_multivalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: sorted, joined part brands / names / types. Groups are the
    lines of one order (bounded), and the aggregate is a hash aggregate keyed
    by l_orderkey. Plain lines are exchanged, not lists of one: lines that come
    from a join by part are spread, so lists would not have been made shorter."""
    return order_lines(spark, sf_dir).repartition("l_orderkey").groupBy("l_orderkey").agg(
        *[F.array_join(F.array_sort(F.collect_list(c)), sep).alias(a) for c, (a, sep) in LINE_COLUMNS.items()])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer: what ``_raw_columns`` are made of, but for the lines."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, c.c_custkey == o.o_custkey).drop("c_custkey")


def _raw_columns() -> list[Column]:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    odate = F.col("o_orderdate").cast("string")
    prio = F.col("o_orderpriority")
    seg = F.col("c_mktsegment")
    return [
        ok.alias("source_row_index"),
        F.when(_mod(ck, 50) == 0, "Unknown").otherwise(F.col("c_name")).alias("org_name"),
        F.when(_mod(ck, 7) == 0, "UNKNOWN").when(_mod(ck, 11) == 0, " Unknown ")
         .otherwise(seg).alias("org_class"),
        F.when(_mod(ok, 9) == 0, "N/A").otherwise("SPONSOR").alias("responsible_party"),
        F.concat(F.lit("Study "), _mod(ok, 4000).cast("string")).alias("brief_title"),
        F.when(_mod(ok, 10) == 0, "Unknown")
         .otherwise(F.concat(F.lit("  Full "), ok.cast("string"))).alias("full_title"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
         .when(F.col("o_orderstatus") == "O", "RECRUITING")
         .otherwise(F.when(_mod(ok, 2) == 0, "TERMINATED").otherwise("UNKNOWN"))
         .alias("overall_status"),
        F.when(_mod(ok, 101) == 0, "Unknown").when(_mod(ok, 97) == 0, "1940-01-01")
         .when(_mod(ok, 89) == 0, "2021-13")
         .when(_mod(ok, 3) == 0, F.substring(odate, 1, 7))
         .otherwise(F.concat(F.lit(" "), F.substring(odate, 1, 10))).alias("start_date"),
        F.when(_mod(ok, 2) == 0, "ADULT  OLDER_ADULT").when(_mod(ok, 7) == 0, "Unknown")
         .otherwise("CHILD ADULT").alias("standard_age"),
        F.col("conditions"),
        F.when(_mod(ok, 4) == 0, "Not Applicable").when(_mod(ok, 4) == 1, "TREATMENT")
         .otherwise("PREVENTION").alias("primary_purpose"),
        F.col("interventions"),
        F.when(_mod(ok, 6) == 0, "--").otherwise(prio).alias("intervention_description"),
        F.when(_mod(ok, 5) == 0, "OBSERVATIONAL").when(_mod(ok, 61) == 0, "Unknown")
         .otherwise("INTERVENTIONAL").alias("study_type"),
        F.when(_mod(ok, 13) == 0, "No phases listed")
         .when(_mod(ok, 17) == 0, F.lit(None).cast("string"))
         .when(_mod(ok, 8) == 0, "PHASE2, PHASE3")
         .otherwise(F.concat(F.lit("PHASE"), F.substring(prio, 1, 1))).alias("phases"),
        F.when(_mod(ok, 15) == 0, "   ").otherwise(seg).alias("outcome_measure"),
        F.col("mesh"),
    ]


def raw_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = order_multivalues(spark, sf_dir)
    return _orders(spark, sf_dir).join(m, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(*_raw_columns())


def raw_studies_by_page(spark: SparkSession, sf_dir: str, locations: DataFrame, page_size: int = 100) -> DataFrame:
    """``raw_studies`` with the page of each study and its ``sites``, nested, in ranges of
    pages. Orders, their lines and sites are exchanged once, all by page, and put
    together there; whole studies are not exchanged. Lines and sites without an order
    fall away, and a null key finds none, as in the joins."""
    own = _orders(spark, sf_dir)
    lines, site = F.struct(*LINE_COLUMNS), F.struct(*[F.col(c).alias(a) for a, c in SITE_FIELDS.items()])
    parts = [own.select(F.col("o_orderkey").alias("key"), F.struct(*own.columns).alias("order")),
             order_lines(spark, sf_dir).filter("l_orderkey IS NOT NULL").select(F.col("l_orderkey").alias("key"), lines.alias("line")),
             locations.filter("source_row_index IS NOT NULL").select(F.col("source_row_index").alias("key"), site.alias("site"))]
    rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    rows = rows.withColumn("page", F.floor(F.col("key") / page_size).cast("long")).repartitionByRange("page")
    study = rows.groupBy("page", "key").agg(*[F.collect_list(c).alias(c) for c in ("order", "line", "site")])

    def joined(column: str, sep: str) -> Column:
        values = F.filter(F.transform("line", lambda x: x[column]), lambda v: v.isNotNull())
        return F.when(F.size("line") > 0, F.array_join(F.array_sort(values), sep))

    study = study.select("page", F.when(F.size("site") > 0, F.array_sort("site")).alias("sites"),
                         *[joined(c, sep).alias(a) for c, (a, sep) in LINE_COLUMNS.items()], F.explode("order").alias("order"))
    return study.select("page", "sites", *[a for a, _ in LINE_COLUMNS.values()], "order.*").select(*_raw_columns(), "page", "sites")


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Study sites for the warehouse: one site per study, from the ordering
    customer (facility = name, city = segment, country = nation)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, c.c_custkey == o.o_custkey)
             .join(n, n.n_nationkey == c.c_nationkey)
             .select(F.col("o_orderkey").alias("source_row_index"),
                     F.col("c_name").alias("facility"),
                     F.col("c_mktsegment").alias("city"),
                     F.lit(None).cast("string").alias("state"),
                     F.col("n_name").alias("country"),
                     F.lit(None).cast("string").alias("zip_code")))
