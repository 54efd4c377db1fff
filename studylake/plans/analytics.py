"""Analytical queries over the warehouse tables.

Every top-k carries a full tie-break so results are deterministic; the
window totals run over the aggregated (small) result only. Joins are
fact ⋈ bridge on study_id (both large, so a merge whatever their files' bytes;
without a shuffle over tables written by ``load.write_bucketed``) or fact ⋈ organizations, by the planner's choice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import cond_count, pct, pct_of_total



def _status(v: str):
    return cond_count(F.col("overall_status") == v)


def q1_type_phase(studies: DataFrame) -> DataFrame:
    """A1: studies by type and phase with share of total (2 dp)."""
    g = studies.groupBy("study_type", "phase").agg(F.count(F.lit(1)).alias("trial_count"))
    return pct_of_total(g, "trial_count", 2).orderBy(
        F.desc("trial_count"), F.asc_nulls_last("study_type"), F.asc_nulls_last("phase"))


def q2_top_conditions(conditions: DataFrame, studies: DataFrame, k: int = 20) -> DataFrame:
    """A2: top conditions: distinct studies, distinct orgs, completion % over
    joined (bag) rows."""
    j = conditions.select("study_id", "condition_name").join(
        studies.select("study_id", "org_id", "overall_status").hint("merge"), "study_id")
    g = j.groupBy("condition_name").agg(
        F.countDistinct("study_id").alias("num_studies"),
        F.countDistinct("org_id").alias("num_organizations"),
        pct(_status("COMPLETED"), F.count(F.lit(1)), 1).alias("completion_rate_pct"))
    return g.orderBy(F.desc("num_studies"), F.asc("condition_name")).limit(k)


def q3_interventions(interventions: DataFrame, studies: DataFrame,
                     min_studies: int = 50, k: int = 20, tasks: int | None = None) -> DataFrame:
    """A3: interventions with at least ``min_studies`` studies; completion %
    over the distinct-study count (can exceed 100 on repeated tokens). ``tasks``:
    how many to join and count in, where the planner's choice by bytes is too few
    (``keys.tasks_for``)."""
    rows, status = interventions.select("study_id", "intervention_name"), studies.select("study_id", "overall_status")
    if tasks:
        rows, status = rows.repartition(tasks, "study_id"), status.repartition(tasks, "study_id")
    j = rows.join(status.hint("merge"), "study_id")
    g = j.groupBy("intervention_name").agg(
        F.countDistinct("study_id").alias("num_studies"),
        _status("COMPLETED").alias("completed"),
        _status("TERMINATED").alias("terminated"),
        _status("WITHDRAWN").alias("withdrawn"),
        _status("RECRUITING").alias("recruiting"))
    g = g.filter(F.col("num_studies") >= min_studies).withColumn(
        "completion_rate_pct", pct(F.col("completed"), F.col("num_studies"), 1))
    return g.orderBy(F.desc("num_studies"), F.asc("intervention_name")).limit(k)


def q4a_orgs(organizations: DataFrame, studies: DataFrame, k: int = 20) -> DataFrame:
    """A4: top organizations by studies, with status counts and date span."""
    j = organizations.select("org_id", "org_name", "org_class").join(
        studies.select("org_id", "study_id", "overall_status", "start_date"), "org_id")
    g = j.groupBy("org_name", "org_class").agg(
        F.count("study_id").alias("num_studies"),
        _status("COMPLETED").alias("completed"),
        _status("RECRUITING").alias("recruiting"),
        F.min("start_date").alias("earliest_study"),
        F.max("start_date").alias("latest_study"))
    return g.orderBy(F.desc("num_studies"), F.asc("org_name"),
                     F.asc_nulls_last("org_class")).limit(k)


def q4b_countries(locations: DataFrame, k: int = 20) -> DataFrame:
    """A5: top countries by distinct studies, cities and facilities."""
    g = locations.groupBy("country").agg(
        F.countDistinct("study_id").alias("num_studies"),
        F.countDistinct("city").alias("num_cities"),
        F.countDistinct("facility").alias("num_facilities"))
    return g.orderBy(F.desc("num_studies"), F.asc_nulls_last("country")).limit(k)


def q5_timeline(studies: DataFrame) -> DataFrame:
    """Yearly totals, by type and status, with completion %."""
    g = (studies.filter(F.col("start_date").isNotNull())
         .groupBy(F.year("start_date").cast("bigint").alias("start_year"))
         .agg(F.count(F.lit(1)).alias("num_studies"),
              cond_count(F.col("study_type") == "INTERVENTIONAL").alias("interventional"),
              cond_count(F.col("study_type") == "OBSERVATIONAL").alias("observational"),
              _status("COMPLETED").alias("completed"),
              _status("TERMINATED").alias("terminated")))
    return g.withColumn("completion_rate_pct", pct(F.col("completed"), F.col("num_studies"), 1)) \
            .orderBy("start_year")


def b1_phase_funnel(studies: DataFrame) -> DataFrame:
    """Per phase: studies, completed, completion %."""
    g = (studies.filter(F.col("phase").isNotNull()).groupBy("phase")
         .agg(F.count(F.lit(1)).alias("total_studies"), _status("COMPLETED").alias("completed")))
    return g.withColumn("completion_rate_pct", pct(F.col("completed"), F.col("total_studies"), 1)) \
            .orderBy("phase")


def b2_org_class(organizations: DataFrame, studies: DataFrame) -> DataFrame:
    """Organization classes: distinct orgs, studies, share (1 dp)."""
    j = (organizations.filter(F.col("org_class").isNotNull()).select("org_id", "org_class")
         .join(studies.select("org_id", "study_id"), "org_id"))
    g = j.groupBy("org_class").agg(F.countDistinct("org_id").alias("num_orgs"),
                                   F.count("study_id").alias("num_studies"))
    return pct_of_total(g, "num_studies", 1).orderBy(F.desc("num_studies"), "org_class")


LATE_PHASES = ["PHASE3", "PHASE2, PHASE3"]


def b3_late_phase(conditions: DataFrame, studies: DataFrame, k: int = 15) -> DataFrame:
    """Top conditions among late-phase studies (the phase filter runs on
    the fact before the join)."""
    late = studies.filter(F.col("phase").isin(LATE_PHASES)).select("study_id").hint("merge")
    g = conditions.select("study_id", "condition_name").join(late, "study_id") \
        .groupBy("condition_name").agg(F.countDistinct("study_id").alias("num_phase3_studies"))
    return g.orderBy(F.desc("num_phase3_studies"), "condition_name").limit(k)


def b4_run_log(run_log: DataFrame) -> DataFrame:
    """A10: run-log history by completion time (nulls last)."""
    return run_log.select("run_id", "step_name", "status", "rows_processed", "rows_rejected",
                          "duration_seconds", "completed_at") \
                  .orderBy(F.asc_nulls_last("completed_at"), "run_id", "step_name")


def s1_type_phase(studies: DataFrame, k: int = 10) -> DataFrame:
    """Type × phase, top 10."""
    g = studies.groupBy("study_type", "phase").agg(F.count(F.lit(1)).alias("trial_count"))
    return g.orderBy(F.desc("trial_count"), F.asc_nulls_last("study_type"),
                     F.asc_nulls_last("phase")).limit(k)


def s2_conditions(conditions: DataFrame, k: int = 10) -> DataFrame:
    """Top conditions by distinct studies, bridge only."""
    g = conditions.groupBy("condition_name").agg(F.countDistinct("study_id").alias("num_studies"))
    return g.orderBy(F.desc("num_studies"), "condition_name").limit(k)


def s3_years(studies: DataFrame, k: int = 10) -> DataFrame:
    """Latest years: total and completed."""
    g = (studies.filter(F.col("start_date").isNotNull())
         .groupBy(F.year("start_date").cast("bigint").alias("yr"))
         .agg(F.count(F.lit(1)).alias("total"), _status("COMPLETED").alias("completed")))
    return g.orderBy(F.desc("yr")).limit(k)
