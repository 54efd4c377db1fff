"""Newest-wins upsert and run-log trend.

The upsert keeps, per key, the row with the greatest (order columns) over
base ∪ updates. ``max_by`` over a struct plans as a sort aggregate, so rows
are sorted by key before the partial aggregation; that still runs map-side,
and a key holding a third of all rows ships one partial row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import dense_key


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the greatest ``order`` tuple per key (ties impossible when
    ``order`` ends in a unique column)."""
    cols = [c for c in df.columns]
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_r"))
    return agg.select("_r.*")


def upsert_latest(base: DataFrame, updates: DataFrame, keys: list[str], order: list[str],
                  refresh_col: str | None = None) -> DataFrame:
    """Merge ``updates`` into ``base`` by key, newest wins. With
    ``refresh_col`` the winning row's column is set to the merge time."""
    merged = latest_per_key(base.unionByName(updates, allowMissingColumns=True), keys, order)
    if refresh_col:
        merged = merged.withColumn(refresh_col, F.current_timestamp())
    return merged


def run_log_trend(run_log: DataFrame) -> DataFrame:
    """Change in processed rows against the previous entry of the same
    step (ordered by completion time, then log id).

    No ``Window.partitionBy(step)``: a step holding a third of all rows would
    be sorted in one task. Instead every row gets a dense rank in
    (step, completed_at, log_id) order (range-partitioned, so even a hot step
    spreads over many partitions), and the predecessor is the row with rank
    - 1 when it belongs to the same step — an equi-join on a unique key."""
    order = ["step_name", "completed_at", "log_id"]
    ranked = dense_key(run_log.select("log_id", "step_name", "completed_at", "rows_processed"),
                       order, "__rk").df
    prev = ranked.select("step_name", (F.col("__rk") + 1).alias("__rk"),
                         F.col("rows_processed").alias("prev_rows"))
    out = ranked.join(prev, ["step_name", "__rk"], "left")
    return out.select("log_id", "step_name", "completed_at", "rows_processed", "prev_rows",
                      (F.col("rows_processed") - F.col("prev_rows")).alias("rows_delta"))
