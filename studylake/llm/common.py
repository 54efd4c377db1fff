"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.session import staging_path

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh shared folder and read it back: cuts lineage,
    survives lost executors, and later passes read only the columns they use."""
    spark = df.sparkSession
    path = staging_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; all other characters stay."""
    return F.translate(col, UPPER, LOWER)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` refers to
    it inside another function of each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_by(df: DataFrame, order: str, n: int, *ties: str) -> DataFrame:
    """The first ``n`` rows (100 or more) by an ``xxhash64`` column. The hash is
    cut at a bound that about 2n rows of the counted table pass, so neither the
    driver nor the last task sees n rows of every partition."""
    total = df.count()
    if total > 4 * n:
        bound = -(1 << 63) + int((1 << 64) * (2 * n / total))
        df = df.filter(F.col(order) < bound)
    return df.orderBy(order, *ties).limit(n)


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"__{prefix}_{uuid.uuid4().hex[:10]}"
