"""Normalisation: multi-value columns → bridge rows, and the organization
dimension. Splits are generators (narrow, no shuffle); the dimension is a
hash aggregate (``min`` of the row index) with map-side partial aggregation,
so a name that holds a third of all rows still only ships one partial row per
task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_literal, split_ws, strip_element


def tokens(column: str, sep: str | None):
    """Array of stripped, non-empty tokens (null for a null input)."""
    parts = split_ws(column) if sep is None else split_literal(column, sep)
    return F.filter(F.transform(parts, strip_element), lambda x: x != "")


def elements(df: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    """(column_name, value) of several columns in one scan: one array of pairs
    a row, exploded once."""
    empty = F.array().cast("array<struct<column_name:string,value:string>>")

    def pairs_of(name: str, array: Column) -> Column:
        pair = lambda v: F.struct(F.lit(name).alias("column_name"), v.cast("string").alias("value"))
        return F.coalesce(F.transform(array, pair), empty)

    pairs = [pairs_of(c, a) for c, a in arrays.items()]
    return df.select(F.explode(F.concat(*pairs)).alias("e")).select("e.*")


def split_multi_value(df: DataFrame, column: str, sep: str | None, out: str,
                      keys: tuple[str, ...] = ("source_row_index",)) -> DataFrame:
    """One row per token; tokens stripped, empty tokens dropped, token
    order kept in ``pos``. ``sep=None`` splits on whitespace runs. Bag
    semantics: repeats inside a row are kept."""
    return df.select(*keys, F.posexplode(tokens(column, sep)).alias("pos", out))


def split_conditions(df: DataFrame, keys=("source_row_index",)) -> DataFrame:
    """N2."""
    return split_multi_value(df, "conditions", ",", "condition_name", keys)


def split_interventions(df: DataFrame, keys=("source_row_index",)) -> DataFrame:
    """N3."""
    return split_multi_value(df, "interventions", ",", "intervention_name", keys)


def split_age_groups(df: DataFrame, keys=("source_row_index",)) -> DataFrame:
    """Whitespace runs."""
    return split_multi_value(df, "standard_age", None, "age_group", keys)


def split_mesh(df: DataFrame, keys=("source_row_index",)) -> DataFrame:
    """N5."""
    return split_multi_value(df, "mesh", ",", "mesh_term", keys)


def split_summaries(df: DataFrame, cols: dict[str, str | None]) -> DataFrame:
    """Per column, input rows (non-null), values after split and unique values,
    of all columns in one scan. A null element marks each input row, so rows
    without tokens are counted too."""
    mark = F.array(F.lit(None).cast("string"))
    found = elements(df, {c: F.when(F.col(c).isNotNull(), F.concat(mark, tokens(c, sep))) for c, sep in cols.items()})
    counted = found.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    per = counted.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("input_rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("values"), F.count("value").alias("unique_values"))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("input_rows", "values", "unique_values")]
    return every.join(per, "column_name", "left").select("column_name", *zero)


def split_summary(df: DataFrame, column: str, sep: str | None, out: str = "value") -> DataFrame:
    """N6 of one column."""
    return split_summaries(df.select(column), {column: sep})


def extract_orgs(cleaned: DataFrame) -> DataFrame:
    """One row per organization name (null name included, as one group)
    with the class of its first row and that row's index: a hash aggregate on
    the unique row index, then an equi-join on that index for the class."""
    first = cleaned.groupBy("org_name").agg(F.min("source_row_index").alias("first_row_index"))
    of = cleaned.select(F.col("source_row_index").alias("first_row_index"), "org_class")
    return first.join(of, "first_row_index").select("org_name", "org_class", "first_row_index")
