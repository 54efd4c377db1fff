"""Lenient date handling under ANSI mode: every parse is a ``try_to_date``,
so a bad value becomes null instead of failing the task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, tried in this order (month-first before
# day-first, as a month-first lenient parser does).
DATE_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-M-d",
    "M/d/yyyy",
    "d/M/yyyy",
    "MMMM d, yyyy",
    "yyyyMMdd",
    "yyyy",
]

# Plausible-year window (inclusive) and the range a
# nanosecond-timestamp parser can represent at all (outside → unparseable).
DATE_MIN_YEAR = 1950
DATE_MAX_YEAR = 2026
REPRESENTABLE_MIN_YEAR = 1678
REPRESENTABLE_MAX_YEAR = 2261

YEAR_MONTH_RX = r"^\d{4}-\d{2}$"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def is_year_month(c) -> Column:
    """``YYYY-MM`` without a day; false (not null) for null input."""
    return F.coalesce(_c(c).rlike(YEAR_MONTH_RX), F.lit(False))


def try_parse_any(c) -> Column:
    """First format that parses wins (no range rule)."""
    c = _c(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in DATE_FORMATS])


def let(expr: Column, fn) -> Column:
    """Bind ``expr`` once and use it several times inside ``fn`` (a lambda
    over a one-element array). Keeps generated code linear when the
    optimizer inlines a computed column into several places (projection
    collapsing, filter pushdown)."""
    return F.transform(F.array(expr), fn)[0]


def representable(d) -> Column:
    """Null out dates a nanosecond-timestamp parser could not hold."""
    return let(_c(d), lambda x: F.when(
        F.year(x).between(REPRESENTABLE_MIN_YEAR, REPRESENTABLE_MAX_YEAR), x))


def parse_date_mixed(c) -> Column:
    """First format that parses wins; outside the representable range → null.
    (Single-expression form; ``with_parsed_date`` stages it as two
    projections so the parse is not repeated in generated code.)"""
    return representable(try_parse_any(c))


def with_parsed_date(df, src: str, out: str, year_month_filled: bool = False):
    """Stage: ``out`` = lenient parse of ``src`` (after optional ``YYYY-MM``
    completion), computed once per row."""
    tmp = f"__{out}_p0"
    s = F.col(src)
    if year_month_filled:
        s = complete_year_month(s)
    return df.withColumn(tmp, try_parse_any(s)).withColumn(out, representable(tmp)).drop(tmp)


def complete_year_month(c) -> Column:
    """Append ``-01`` to ``YYYY-MM`` values, leave the rest."""
    c = _c(c)
    return F.when(c.rlike(YEAR_MONTH_RX), F.concat(c, F.lit("-01"))).otherwise(c)


def is_suspicious(d, lo: int = DATE_MIN_YEAR, hi: int = DATE_MAX_YEAR) -> Column:
    """Parsed but outside the plausible window; false for null."""
    return let(_c(d), lambda x: x.isNotNull() & ~F.coalesce(F.year(x).between(lo, hi), F.lit(True)))
