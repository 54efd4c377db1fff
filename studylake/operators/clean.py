"""Cleaning operators (whitespace, disguised nulls, dates, phase/type
defaults, fact projection). All are narrow projections: no shuffle, one
codegen stage over the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.text import is_hidden_null, null_hidden, strip_ws
from ..schemas import EXTRA_COLUMNS, STUDY_COLUMNS


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() == "string" and f.name not in exclude]


def trim_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Strip Unicode whitespace on every string column, one select."""
    cols = set(cols if cols is not None else string_columns(df))
    return df.select(*[strip_ws(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def replace_hidden_nulls(df: DataFrame, cols: list[str] | None = None,
                         values: list[str] | None = None) -> DataFrame:
    """Exact, case-sensitive disguised-null literal → null."""
    cols = set(cols if cols is not None else string_columns(df))
    return df.select(*[null_hidden(c, values).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def trim_and_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C1 then C2 as two stacked projections: the stripped value is computed
    once per cell and then referenced twice (match + value), instead of
    repeating the regex inside one expression."""
    cols = list(cols if cols is not None else string_columns(df))
    return replace_hidden_nulls(trim_all(df, cols), cols)


def hidden_null_counts(raw: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C3 per column, long format: (column_name, hidden_nulls). One scan."""
    cols = cols if cols is not None else string_columns(raw)
    aggs = [F.count_if(is_hidden_null(strip_ws(c))).alias(c) for c in cols]
    wide = raw.agg(*aggs)
    return wide.unpivot([], cols, "column_name", "hidden_nulls")


def hidden_null_count(raw: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C3 total as one row."""
    cols = cols if cols is not None else string_columns(raw)
    total = sum((F.count_if(is_hidden_null(strip_ws(c))) for c in cols), F.lit(0))
    return raw.agg(total.cast("bigint").alias("hidden_nulls_replaced"))


def clean_dates(df: DataFrame, col: str = "start_date") -> DataFrame:
    """C4–C7 on an already trimmed/nulled frame. Adds ``start_date_raw``,
    ``start_date_is_approx``, ``start_date_parsed`` (before the plausibility
    rule) and replaces ``col`` with the final date."""
    raw = F.col(col)
    out = (df.withColumn("start_date_raw", raw)
             .withColumn("start_date_is_approx", D.is_year_month(raw))
             .withColumn("__to_parse", F.when(F.col("start_date_is_approx"),
                                              F.concat(raw, F.lit("-01"))).otherwise(raw)))
    out = D.with_parsed_date(out, "__to_parse", "start_date_parsed").drop("__to_parse")
    final = F.when(~D.is_suspicious(F.col("start_date_parsed")), F.col("start_date_parsed"))
    return out.withColumn(col, final)


def date_stats(cleaned: DataFrame) -> DataFrame:
    """Approximate / parsed (incl. suspicious) / unparseable / suspicious."""
    p = F.col("start_date_parsed")
    return cleaned.agg(
        F.count_if(F.col("start_date_is_approx")).alias("dates_approximate"),
        F.count_if(p.isNotNull()).alias("dates_parsed"),
        F.count_if(F.col("start_date_raw").isNotNull() & p.isNull()).alias("dates_unparseable"),
        F.count_if(D.is_suspicious(p)).alias("dates_suspicious"),
    )


def clean_phase(df: DataFrame, col: str = "phases") -> DataFrame:
    """The 'No phases listed' literal → null."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit("No phases listed")))


def default_study_type(df: DataFrame, col: str = "study_type",
                       default: str = "UNKNOWN") -> DataFrame:
    """Null study type → default."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def clean_raw(raw: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C1, C2, C4–C7, C9, C10 as one plan; keeps every raw column plus the
    date audit columns. ``cols``: the string columns to clean (default: all
    but the provenance/id extras)."""
    if cols is None:
        cols = string_columns(raw, exclude=tuple(EXTRA_COLUMNS))
    return clean_stripped(trim_all(raw, cols), cols)


def clean_raw_counted(raw: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``clean_raw`` plus ``__hidden``: the per-row number of disguised-null
    literals. Both come from the same stripped values, so each cell's strip
    regex runs once."""
    if cols is None:
        cols = string_columns(raw, exclude=tuple(EXTRA_COLUMNS))
    stripped = trim_all(raw, cols)
    n = sum((is_hidden_null(c).cast("int") for c in cols), F.lit(0))
    return clean_stripped(stripped.withColumn("__hidden", n), cols)


def clean_stripped(df: DataFrame, cols: list[str]) -> DataFrame:
    """C2, C4–C7, C9, C10 on already stripped values."""
    out = replace_hidden_nulls(df, cols)
    if "start_date" in out.columns:
        out = clean_dates(out)
    if "phases" in out.columns:
        out = clean_phase(out)
    if "study_type" in out.columns:
        out = default_study_type(out)
    return out


def build_studies(cleaned: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename and project to the fact shape (14 columns, plus the
    optional provenance/id columns when the source has them, and ``keep``)."""
    extras = [c for c in (*EXTRA_COLUMNS, *keep) if c in cleaned.columns]
    exprs = {c: F.col(c) for c in STUDY_COLUMNS}
    exprs["phase"] = F.col("phases")
    key = ["study_id"] if "study_id" in cleaned.columns else []
    return cleaned.select(*key, *[exprs[c].alias(c) for c in STUDY_COLUMNS], *extras)


def clean_stats(raw: DataFrame) -> DataFrame:
    """Run statistics in one aggregate over one scan: the per-row
    hidden-null count is taken from the same stripped values the cleaning
    uses (cleaning is a projection, so rows in = rows out)."""
    cleaned = clean_raw_counted(raw)
    hidden = F.coalesce(F.sum("__hidden"), F.lit(0)).cast("bigint")
    p = F.col("start_date_parsed")
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows_input"),
        F.count(F.lit(1)).alias("rows_output"),
        hidden.alias("hidden_nulls_replaced"),
        F.count_if(F.col("start_date_is_approx")).alias("dates_approximate"),
        F.count_if(p.isNotNull()).alias("dates_parsed"),
        F.count_if(F.col("start_date_raw").isNotNull() & p.isNull()).alias("dates_unparseable"),
        F.count_if(D.is_suspicious(p)).alias("dates_suspicious"),
    )

