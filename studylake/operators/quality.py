"""Data-quality gate. Every check yields rows
``(check_name, table_name, column_name, severity, failures, examples)``;
the gate passes iff no ``error`` row has failures > 0. Checks on the same
table run as one aggregate job; only the check rows (a handful) and at most
10 examples per check ever reach the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..schemas import FOREIGN_KEYS, MAX_LENGTH, NOT_NULL
from .load import side_by_side

CHECK_COLUMNS = ["check_name", "table_name", "column_name", "severity", "failures", "examples"]


def _rows(df: DataFrame, table: str, specs: list[tuple], examples: dict[int, Column] | None = None
          ) -> DataFrame:
    """One aggregate over ``df`` computing every (check, column, severity,
    failure-count expr) — plus optional per-check example expressions —
    turned into long format by exploding an array of structs (one pass)."""
    examples = examples or {}
    aggs = [e.cast("bigint").alias(f"c{i}") for i, (_, _, _, e) in enumerate(specs)]
    aggs += [x.cast("string").alias(f"x{i}") for i, x in examples.items()]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(chk).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(col).cast("string").alias("column_name"), F.lit(sev).alias("severity"),
                     F.col(f"c{i}").alias("failures"),
                     (F.col(f"x{i}") if i in examples else F.lit(None).cast("string")).alias("examples"))
            for i, (chk, col, sev, _) in enumerate(specs)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_not_null(df: DataFrame, table: str, columns: list[str],
                   is_error: bool = True, check: str = "not_null") -> DataFrame:
    """Required columns have no nulls."""
    sev = "error" if is_error else "warning"
    return _rows(df, table, [(check, c, sev, F.count_if(F.col(c).isNull())) for c in columns])


def check_valid_values(df: DataFrame, table: str, column: str, valid: list[str],
                       max_examples: int = 10) -> DataFrame:
    """D2 + D3: non-null values outside the valid set (warning), with up to
    ``max_examples`` distinct invalid values in sorted order."""
    bad = df.filter(F.col(column).isNotNull() & ~TX.among(column, valid)).select(column)
    n = bad.agg(F.count(F.lit(1)).alias("failures"),
                F.lit(None).cast("string").alias("examples"))
    ex = (bad.distinct().orderBy(column).limit(max_examples)
          .agg(F.lit(None).cast("bigint").alias("failures"),
               F.concat_ws(", ", F.array_sort(F.collect_list(column))).alias("examples")))
    # Two single-row aggregates folded into one row without a join.
    both = n.unionByName(ex).agg(F.max("failures").alias("failures"),
                                 F.max("examples").alias("examples"))
    return both.select(
        F.lit("valid_values").alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), F.lit("warning").alias("severity"),
        F.col("failures").cast("bigint").alias("failures"),
        F.when(F.col("failures") > 0, F.col("examples")).alias("examples"))


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Repeats beyond the first (a null counts as a value)."""
    dupes = (df.groupBy(column).count()
             .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("failures")))
    return dupes.select(F.lit("unique").alias("check_name"), F.lit(table).alias("table_name"),
                        F.lit(column).alias("column_name"), F.lit("error").alias("severity"),
                        F.col("failures").cast("bigint").alias("failures"),
                        F.lit(None).cast("string").alias("examples"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    """min/max of a date column and its non-null count."""
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"),
                  F.count(column).alias("n_dates"))


def check_date_range(df: DataFrame, table: str, column: str) -> DataFrame:
    """D5 as a check row: warning when there is no date at all."""
    r = date_range(df, column)
    return r.select(F.lit("date_range").alias("check_name"), F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"), F.lit("warning").alias("severity"),
                    F.when(F.col("n_dates") == 0, 1).otherwise(0).cast("bigint").alias("failures"),
                    F.concat_ws(" to ", F.col("min_date").cast("string"),
                                F.col("max_date").cast("string")).alias("examples"))


def check_not_empty(df: DataFrame, table: str) -> DataFrame:
    """Table has at least one row (reads at most one row)."""
    one = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return one.select(F.lit("not_empty").alias("check_name"), F.lit(table).alias("table_name"),
                      F.lit(None).cast("string").alias("column_name"),
                      F.lit("error").alias("severity"),
                      F.when(F.col("n") == 0, 1).otherwise(0).cast("bigint").alias("failures"),
                      F.lit(None).cast("string").alias("examples"))


def check_max_length(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Values longer than the column limit."""
    specs = [("max_length", c, "error", F.count_if(F.length(c) > n))
             for c, n in limits.items() if c in df.columns]
    return _rows(df, table, specs)


def check_foreign_key(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                      child_table: str, parent_table: str) -> DataFrame:
    """Non-null child keys without a parent (left anti join). Dense keys take
    next to nothing in a file, so by their bytes there the planner would send
    millions of them through the driver, once a check; the join is a merge."""
    orphans = (child.select(F.col(child_col).alias("_k")).filter(F.col("_k").isNotNull())
               .join(parent.select(F.col(parent_col).alias("_k")).hint("merge"), "_k", "left_anti"))
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("foreign_key").alias("check_name"), F.lit(child_table).alias("table_name"),
        F.lit(child_col).alias("column_name"), F.lit("error").alias("severity"),
        F.col("failures").cast("bigint").alias("failures"),
        F.lit(f"{parent_table}.{parent_col}").alias("examples"))


def contract_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    """NOT NULL contract over every warehouse table present."""
    parts = [check_not_null(df, t, [c for c in NOT_NULL.get(t, []) if c in df.columns],
                            check="contract_not_null")
             for t, df in tables.items() if any(c in df.columns for c in NOT_NULL.get(t, []))]
    return reduce(DataFrame.unionByName, parts)


def contract_max_length(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [check_max_length(df, t, MAX_LENGTH[t]) for t, df in tables.items()
             if t in MAX_LENGTH and any(c in df.columns for c in MAX_LENGTH[t])]
    return reduce(DataFrame.unionByName, parts)


def contract_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [check_foreign_key(tables[c], cc, tables[p], pc, c, p)
             for c, cc, p, pc in FOREIGN_KEYS if c in tables and p in tables]
    return reduce(DataFrame.unionByName, parts)


def contract(tables: dict[str, DataFrame]) -> DataFrame:
    """D8–D10 over every warehouse table present: nulls, lengths, foreign keys."""
    return reduce(DataFrame.unionByName, contract_parts(tables))


def contract_parts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The contract's checks, one scan of each table and one of each foreign key."""
    parts = []
    for t, df in tables.items():
        specs = [("contract_not_null", c, "error", F.count_if(F.col(c).isNull())) for c in NOT_NULL.get(t, []) if c in df.columns]
        specs += [("max_length", c, "error", F.count_if(F.length(c) > n)) for c, n in MAX_LENGTH.get(t, {}).items() if c in df.columns]
        if specs:
            parts.append(_rows(df, t, specs))
    return parts + [check_foreign_key(tables[c], cc, tables[p], pc, c, p)
                    for c, cc, p, pc in FOREIGN_KEYS if c in tables and p in tables]


def quarantine(df: DataFrame, run_id: str, table: str, reason: Column | str) -> DataFrame:
    """Rejected rows in one shape for all tables: the run, the table,
    the reason and the row as JSON (nulls included)."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    own = [c for c in df.columns if not c.startswith("__")]
    return df.select(F.lit(run_id).alias("run_id"), F.lit(table).alias("table_name"), why.cast("string").alias("reason"),
                     F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("record"))


STUDY_ENUMS = [("study_type", TX.VALID_STUDY_TYPES), ("overall_status", TX.VALID_STATUSES),
               ("responsible_party", TX.VALID_RESPONSIBLE_PARTIES)]


def invalid_examples(df: DataFrame, table: str, column: str, valid: list[str],
                     max_examples: int = 10) -> DataFrame:
    """D3 alone: up to ``max_examples`` distinct invalid values, sorted
    (distinct → top-k; never an unbounded collect)."""
    bad = df.filter(F.col(column).isNotNull() & ~TX.among(column, valid)).select(column)
    ex = (bad.distinct().orderBy(column).limit(max_examples)
          .agg(F.concat_ws(", ", F.array_sort(F.collect_list(column))).alias("examples")))
    return ex.select(F.lit("valid_values").alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(column).alias("column_name"), F.lit("warning").alias("severity"),
                     F.lit(None).cast("bigint").alias("failures"), "examples")


def studies_checks(studies: DataFrame) -> DataFrame:
    """D1 + D2 counts + D5 on the fact in one aggregate (one pass reading
    only the checked columns)."""
    specs = [("not_null", c, "error", F.count_if(F.col(c).isNull()))
             for c in ("brief_title", "study_type")]
    specs += [("valid_values", c, "warning", F.count_if(F.col(c).isNotNull() & ~TX.among(c, v)))
              for c, v in STUDY_ENUMS]
    specs.append(("date_range", "start_date", "warning",
                  F.when(F.count("start_date") == 0, 1).otherwise(0)))
    date_ex = F.concat_ws(" to ", F.min("start_date").cast("string"),
                          F.max("start_date").cast("string"))
    return _rows(studies, "studies", specs, {len(specs) - 1: date_ex})


def validation_parts(studies: DataFrame, orgs: DataFrame, conditions: DataFrame,
                     interventions: DataFrame, age_groups: DataFrame) -> list[DataFrame]:
    """The gate's quality checks: those of the fact fused into one pass, example
    lists as small top-k jobs."""
    return [
        studies_checks(studies),
        *[invalid_examples(studies, "studies", c, v) for c, v in STUDY_ENUMS],
        check_valid_values(orgs, "organizations", "org_class", TX.VALID_ORG_CLASSES),
        check_valid_values(age_groups, "age_groups", "age_group", TX.VALID_AGE_GROUPS),
        check_unique(orgs, "organizations", "org_name"),
        check_not_empty(conditions, "conditions"),
        check_not_empty(interventions, "interventions"),
        check_not_empty(age_groups, "age_groups"),
    ]


def validate_all(studies: DataFrame, orgs: DataFrame, conditions: DataFrame,
                 interventions: DataFrame, age_groups: DataFrame) -> DataFrame:
    """The gate's check rows, folded per check by a tiny final aggregate (a few
    dozen rows)."""
    rows = reduce(DataFrame.unionByName, validation_parts(studies, orgs, conditions, interventions, age_groups))
    folded = rows.groupBy("check_name", "table_name", "column_name", "severity").agg(
        F.max("failures").alias("failures"), F.max("examples").alias("examples"))
    return folded.select(
        *CHECK_COLUMNS[:5],
        F.when((F.col("check_name") != "valid_values") | (F.col("failures") > 0),
               F.col("examples")).alias("examples"))


class ValidationError(RuntimeError):
    pass


def gate(report: DataFrame | list[DataFrame], raise_on_error: bool = True) -> tuple[bool, str]:
    """Collect the (bounded) check rows, build the text report and enforce
    the verdict: errors stop the run, warnings pass. A list of checks is run side
    by side, and a check's count and examples are folded here."""
    if isinstance(report, list):
        found: dict[tuple, dict] = {}
        for r in [r for part in side_by_side([p.collect for p in report]) for r in part]:
            key = tuple(r[c] for c in CHECK_COLUMNS[:4])
            row = found.setdefault(key, dict(zip(CHECK_COLUMNS, (*key, None, None))))
            row["failures"] = max((v for v in (row["failures"], r["failures"]) if v is not None), default=None)
            row["examples"] = max((v for v in (row["examples"], r["examples"]) if v is not None), default=None)
        rows = sorted(found.values(), key=lambda r: tuple(str(r[c]) for c in CHECK_COLUMNS[:4]))
    else:
        rows = report.collect()
    errors = [r for r in rows if r["severity"] == "error" and r["failures"] > 0]
    warnings = [r for r in rows if r["severity"] == "warning" and r["failures"] > 0]
    lines = ["DATA VALIDATION REPORT"]
    for title, group in (("ERRORS", errors), ("WARNINGS", warnings)):
        if group:
            lines.append(f"{title} ({len(group)}):")
            for r in group:
                ex = f" examples: {r['examples']}" if r["examples"] else ""
                lines.append(f"  {r['check_name']} {r['table_name']}.{r['column_name']}: "
                             f"{r['failures']:,}{ex}")
    if not errors and not warnings:
        lines.append("All checks passed")
    ok = not errors
    lines.append(f"Result: {'PASSED' if ok else 'FAILED'}")
    text = "\n".join(lines)
    if not ok and raise_on_error:
        raise ValidationError(text)
    return ok, text


# -- extensions ------------------------------------------------------------

def completed_without_start(studies: DataFrame) -> DataFrame:
    """Completed studies must have a start date."""
    return studies.agg(F.count_if((F.col("overall_status") == "COMPLETED")
                                  & F.col("start_date").isNull()).alias("failures"))


def duplicate_title_org(studies: DataFrame) -> DataFrame:
    """Same title under the same organization more than once."""
    return (studies.groupBy("brief_title", "org_id").agg(F.count(F.lit(1)).alias("n_studies"))
            .filter(F.col("n_studies") > 1))


def freshness(df: DataFrame, ts_col: str, now: str, max_days: int) -> DataFrame:
    """E5: days from the newest row to ``now`` against a threshold."""
    return df.agg(F.max(ts_col).alias("newest")).select(
        "newest",
        F.datediff(F.to_date(F.lit(now)), F.to_date("newest")).alias("days_since"),
        (F.datediff(F.to_date(F.lit(now)), F.to_date("newest")) > max_days).alias("stale"))
