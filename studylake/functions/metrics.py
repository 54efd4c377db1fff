"""Reusable aggregate building blocks for the analytical queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def cond_count(pred: Column) -> Column:
    """SUM(CASE WHEN pred THEN 1 ELSE 0 END) as a BIGINT."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def pct(num, den, dp: int = 1) -> Column:
    """ROUND(num * 100.0 / NULLIF(den, 0), dp) with exact half-up rounding on
    non-negative integer counts, returned as DOUBLE (null when den = 0)."""
    num, den = _c(num).cast("bigint"), _c(den).cast("bigint")
    scale = 10 ** dp
    den_nz = F.nullif(den, F.lit(0))
    x = num * (200 * scale) + den_nz
    y = den_nz * 2
    q = ((x - x % y) / y).cast("bigint")  # exact integer quotient
    return (q.cast("decimal(38,0)") / F.lit(scale).cast("decimal(38,0)")).cast("double")


def pct_of_total(df: DataFrame, n: str, dp: int = 2, out: str = "pct_of_total") -> DataFrame:
    """Share of each row's ``n`` in the column total. Meant for aggregated
    (small) results: the empty window moves all rows into one partition."""
    total = F.sum(F.col(n)).over(Window.partitionBy())
    return df.withColumn(out, pct(F.col(n), total, dp))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Deterministic top-k: ``order`` must include a full tie-break.
    Planned as TakeOrderedAndProject (per-partition heap, no full sort)."""
    return df.orderBy(*order).limit(k)
