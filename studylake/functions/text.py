"""String helpers shared by cleaning, normalisation and profiling.

Everything here returns a Column expression built from JVM built-ins, so it
stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace class equal to Python's ``str.strip()`` set for
# every BMP character. Java's ``\s`` lacks U+001C..U+001F, U+0085 and the
# Unicode space separators, so they are listed explicitly.
WS_CLASS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WS_EDGES = rf"^{WS_CLASS}+|{WS_CLASS}+$"
WS_RUN = rf"{WS_CLASS}+"
# The same class character by character, for the ends of a string.
WS_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                    0x2028, 0x2029, 0x202F, 0x205F, 0x3000])

# Disguised-null literals, matched exactly and case-sensitively
# after stripping (cleaning rule).
HIDDEN_NULL_VALUES = [
    "Unknown", "unknown", "UNKNOWN",
    "None", "none", "NONE",
    "null", "Null", "NULL",
    "N/A", "n/a", "NA", "na",
    "Not Applicable", "not applicable",
    "Not Available", "not available",
    "Missing", "missing",
    "No phases listed",
    "-", "--", "---", ".", "..",
]

# The profiling audit's literal list (the cleaning list without
# "No phases listed"), in the order the audit reports them.
PROFILE_HIDDEN_NULL_VALUES = [
    "Unknown", "unknown", "UNKNOWN",
    "None", "none", "NONE",
    "null", "Null", "NULL",
    "N/A", "n/a", "NA", "na",
    "Not Applicable", "not applicable",
    "-", "--", "---", ".", "..",
    "Not Available", "not available",
    "Missing", "missing",
]

# Strings a pandas-style CSV reader turns into null on read
# (applied untrimmed at scan time).
CSV_NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Valid domain sets used by the quality gate.
VALID_ORG_CLASSES = ["OTHER", "INDUSTRY", "NIH", "OTHER_GOV", "FED", "NETWORK", "INDIV"]
VALID_STUDY_TYPES = ["INTERVENTIONAL", "OBSERVATIONAL", "EXPANDED_ACCESS"]
VALID_STATUSES = [
    "COMPLETED", "RECRUITING", "TERMINATED", "NOT_YET_RECRUITING",
    "ACTIVE_NOT_RECRUITING", "WITHDRAWN", "ENROLLING_BY_INVITATION",
    "SUSPENDED", "WITHHELD", "NO_LONGER_AVAILABLE", "AVAILABLE",
    "APPROVED_FOR_MARKETING", "TEMPORARILY_NOT_AVAILABLE",
]
VALID_RESPONSIBLE_PARTIES = ["SPONSOR", "PRINCIPAL_INVESTIGATOR", "SPONSOR_INVESTIGATOR"]
VALID_AGE_GROUPS = ["CHILD", "ADULT", "OLDER_ADULT"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing Unicode whitespace (Python ``strip`` parity). Only the
    ends are looked at: a pattern tries every position of every cell. Broken UTF-8
    is replaced first, since the trim compares bytes."""
    return F.btrim(F.make_valid_utf8(_c(c)), F.lit(WS_CHARS))


def strip_element(c: Column) -> Column:
    """The same for an array's element: a lambda is not compiled, and there the pattern is faster."""
    return F.regexp_replace(c, WS_EDGES, "")


def among(c: str | Column, values: list[str]) -> Column:
    """``c IN (values)``. A named column is one parsed expression: building a
    literal object for each value and column costs a load seconds on the driver."""
    if not isinstance(c, str):
        return c.isin(values)
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"`{c}` IN ({listed})")


def null_hidden(c: str | Column, values: list[str] | None = None) -> Column:
    """Literal in the disguised-null list → null; null stays null."""
    return F.when(~among(c, values or HIDDEN_NULL_VALUES), _c(c))


def is_hidden_null(c: str | Column, values: list[str] | None = None) -> Column:
    return F.coalesce(among(c, values or HIDDEN_NULL_VALUES), F.lit(False))


def split_literal(c: str | Column, sep: str) -> Column:
    """Split on a literal separator (Spark's ``split`` takes a regex)."""
    import re
    return F.split(_c(c), re.escape(sep))


def split_ws(c: str | Column) -> Column:
    """Whitespace split that collapses runs and ignores the edges."""
    return F.split(strip_ws(c), WS_RUN)
