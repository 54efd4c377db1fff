"""Property checks (hypothesis) for the cross-engine numeric rules."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from studylake.functions.metrics import pct

PAIRS = st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=200)


def _ref(n: int, d: int, dp: int):
    if d == 0:
        return None
    q = (Decimal(n) * 100 / Decimal(d)).quantize(Decimal(1).scaleb(-dp), rounding=ROUND_HALF_UP)
    return float(q)


@settings(max_examples=5, deadline=None)
@given(PAIRS)
def test_pct_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    rows = df.select("n", "d", pct(F.col("n"), F.col("d"), 1).alias("p1"),
                     pct(F.col("n"), F.col("d"), 2).alias("p2")).collect()
    for r in rows:
        assert r.p1 == _ref(r.n, r.d, 1)
        assert r.p2 == _ref(r.n, r.d, 2)
