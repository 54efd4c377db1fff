"""Profiling of a raw export (P1–P21). Each section is one aggregate job in
long format; wide per-column statistics are unpivoted with ``unpivot`` after
a single pass. Per-column top-k lists rank the *aggregated* value counts, so
the window never sees raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.metrics import pct
from ..functions.text import PROFILE_HIDDEN_NULL_VALUES, WS_RUN, split_literal, strip_ws
from ..operators.clean import string_columns
from ..operators.normalize import elements, tokens

CATEGORICAL = ["org_class", "responsible_party", "overall_status", "standard_age",
               "primary_purpose", "study_type", "phases"]
MULTI_VALUE = {"conditions": ",", "interventions": ",", "mesh": ",", "standard_age": None}
TEXT_COLUMNS = ["brief_title", "full_title", "outcome_measure", "intervention_description"]


def shape(df: DataFrame) -> DataFrame:
    """P1."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def columns(df: DataFrame) -> DataFrame:
    """Type and non-null count per column (one aggregate)."""
    wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
    counts = wide.unpivot([], df.columns, "column_name", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
        "column_name string, dtype string, position int")
    return counts.join(F.broadcast(types), "column_name")  # one row per column


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate rows beyond the first (null equals null). Rows meet by
    a SHA-256 of their columns as JSON, which tells nulls and lengths apart, so
    whole texts are not shuffled."""
    digest = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    return (df.groupBy(F.unhex(digest).alias("row")).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
                 .alias("duplicate_rows")))


def duplicate_titles(df: DataFrame, col: str = "brief_title", order_col: str = "source_row_index",
                     max_samples: int = 5, sample_below: int = 20) -> DataFrame:
    """Repeated values beyond the first; up to 5 repeated values (first
    appearance order) when there are fewer than 20 repeats."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_at"))
    total = g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
                  F.lit(None).cast("string").alias("samples"))
    samples = (g.filter((F.col("n") > 1) & F.col(col).isNotNull())
               .orderBy("first_at").limit(max_samples)
               .agg(F.lit(None).cast("bigint").alias("duplicates"),
                    F.concat_ws(" | ", F.transform(F.array_sort(F.collect_list(
                        F.struct("first_at", F.col(col).alias("v")))), lambda s: s["v"]))
                    .alias("samples")))
    both = total.unionByName(samples).agg(F.max("duplicates").alias("duplicates"),
                                          F.max("samples").alias("samples"))
    return both.select("duplicates", F.when((F.col("duplicates") > 0)
                                            & (F.col("duplicates") < sample_below),
                                            F.col("samples")).alias("samples"))


def candidate_key(df: DataFrame, col: str) -> DataFrame:
    """P5: distinct count, uniqueness, min, max, gap-free."""
    a = df.agg(F.countDistinct(col).alias("unique_values"), F.count(F.lit(1)).alias("n_rows"),
               F.count(col).alias("non_null"), F.min(col).alias("min_value"),
               F.max(col).alias("max_value"))
    is_unique = (F.col("unique_values") == F.col("n_rows")) & (F.col("non_null") == F.col("n_rows"))
    return a.select("unique_values", is_unique.alias("is_unique"), "min_value", "max_value",
                    (is_unique & ((F.col("max_value") - F.col("min_value") + 1)
                                  == F.col("unique_values"))).alias("is_sequential"))


def missing(df: DataFrame, hidden: list[str] | None = None) -> DataFrame:
    """True null / hidden literal / empty / whitespace-only per column,
    total and share of rows (1 dp)."""
    hidden = hidden or PROFILE_HIDDEN_NULL_VALUES
    strs = set(string_columns(df))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in df.columns:
        col = F.col(c)
        aggs.append(F.count_if(col.isNull()).alias(f"{c}__null"))
        if c in strs:
            aggs += [F.count_if(col.isin(hidden)).alias(f"{c}__hidden"),
                     F.count_if(col == "").alias(f"{c}__empty"),
                     F.count_if((strip_ws(col) == "") & (col != "")).alias(f"{c}__ws")]
        else:
            aggs += [F.lit(0).cast("bigint").alias(f"{c}__{k}") for k in ("hidden", "empty", "ws")]
    wide = df.agg(*aggs)
    stacked = wide.select("__n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__null").alias("true_null"),
                 F.col(f"{c}__hidden").alias("hidden_null"), F.col(f"{c}__empty").alias("empty_str"),
                 F.col(f"{c}__ws").alias("whitespace")) for c in df.columns])).alias("s"))
    out = stacked.select("__n", "s.*").withColumn(
        "total_missing", F.col("true_null") + F.col("hidden_null") + F.col("empty_str")
        + F.col("whitespace"))
    return out.select("column_name", "true_null", "hidden_null", "empty_str", "whitespace",
                      "total_missing", pct(F.col("total_missing"), F.col("__n"), 1).alias("pct_missing"))


def _long(df: DataFrame, cols: list[str], key: str = "column_name", val: str = "value") -> DataFrame:
    """Unpivot string columns to (column_name, value) rows (narrow)."""
    return df.unpivot([], cols, key, val)


def hidden_literals(df: DataFrame, hidden: list[str] | None = None) -> DataFrame:
    """Which disguised-null literals occur per column, with counts."""
    hidden = hidden or PROFILE_HIDDEN_NULL_VALUES
    lg = _long(df.select(*string_columns(df)), string_columns(df))
    return (lg.filter(F.col("value").isin(hidden)).groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def _value_counts(elements: DataFrame) -> DataFrame:
    return elements.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _ranked_top(counts: DataFrame, k: int) -> DataFrame:
    """Top ``k`` values of each column, ranked 1..k. The rank filter limits
    every partition to k rows a column before the shuffle."""
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "column_name", "value", "n", F.col("rank").cast("bigint").alias("rank"))


def categories(df: DataFrame, cols: list[str] | None = None, k: int = 20) -> DataFrame:
    """P8 (values): top ``k`` values per column including null, with share
    of all rows. One scan; the totals come from the same value counts."""
    cols = cols or CATEGORICAL
    counts = _value_counts(elements(df, {c: F.array(F.col(c)) for c in cols}))
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("total"))
    out = _ranked_top(counts, k).join(F.broadcast(totals), "column_name")  # one row per column
    return out.select("column_name", "value", "n", pct(F.col("n"), F.col("total"), 1).alias("pct"), "rank")


def category_summary(df: DataFrame, cols: list[str] | None = None, k: int = 20) -> DataFrame:
    """P8 (summary): distinct non-null values, nulls, values beyond the top k."""
    cols = cols or CATEGORICAL
    wide = df.agg(*[F.countDistinct(c).alias(f"{c}__d") for c in cols],
                  *[F.count_if(F.col(c).isNull()).alias(f"{c}__n") for c in cols])
    st = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__d").alias("n_distinct"),
                 F.col(f"{c}__n").alias("n_null")) for c in cols])).alias("s")).select("s.*")
    return st.withColumn("n_more", F.greatest(F.col("n_distinct") - k, F.lit(0)))


def case_variants(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct spellings that coincide after lower-casing and stripping.
    Values are de-duplicated first, so each group holds distinct spellings."""
    cols = cols or CATEGORICAL
    lg = _long(df.select(*cols), cols).filter(F.col("value").isNotNull()).distinct()
    g = lg.groupBy("column_name", F.lower(strip_ws("value")).alias("normalized")).agg(
        F.count(F.lit(1)).alias("n_variants"),
        F.concat_ws(" | ", F.array_sort(F.collect_list("value"))).alias("variants"))
    return g.filter(F.col("n_variants") > 1)


SLASH_RX = r"^\d{1,2}/\d{1,2}/\d{4}$"
YM_RX = r"^\d{4}-\d{2}$"
ISO_RX = r"^\d{4}-\d{2}-\d{2}$"


def _fmt_class(c: Column) -> Column:
    return (F.when(c.rlike(SLASH_RX), "slash").when(c.rlike(YM_RX), "year_month")
            .when(c.rlike(ISO_RX), "iso").otherwise("other"))


def date_formats(df: DataFrame, col: str = "start_date") -> DataFrame:
    """P10: format histogram over non-null values with share."""
    nn = df.filter(F.col(col).isNotNull())
    g = nn.groupBy(_fmt_class(F.col(col)).alias("date_format")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", pct(F.col("n"), F.sum("n").over(Window.partitionBy()), 1))


def date_other_samples(df: DataFrame, col: str = "start_date", order_col: str = "source_row_index",
                       k: int = 10) -> DataFrame:
    """The first ``k`` unrecognised values in row order."""
    return (df.filter(F.col(col).isNotNull() & (_fmt_class(F.col(col)) == "other"))
            .select(order_col, col).orderBy(order_col).limit(k))


def _eda_parsed(df: DataFrame, col: str) -> DataFrame:
    """(raw, d): lenient parse of the raw value — whitespace tolerated,
    ``YYYY-MM`` read as the 1st — staged so each step runs once per row."""
    s = df.select(F.col(col).alias("raw"), strip_ws(col).alias("__s"))
    return D.with_parsed_date(s, "__s", "d", year_month_filled=True).drop("__s")


def date_range(df: DataFrame, now: str, col: str = "start_date") -> DataFrame:
    """Parse failures, earliest, latest, before-1990, after ``now``."""
    return _eda_parsed(df, col).agg(
        F.count_if(F.col("raw").isNotNull() & F.col("d").isNull()).alias("parse_failures"),
        F.min("d").alias("earliest"), F.max("d").alias("latest"),
        F.count_if(F.year("d") < 1990).alias("before_1990"),
        F.count_if(F.col("d") > F.to_date(F.lit(now))).alias("in_future"))


def top_years(df: DataFrame, col: str = "start_date", k: int = 10) -> DataFrame:
    """Most frequent start years."""
    y = F.year("d").cast("bigint")
    g = _eda_parsed(df, col).select(y.alias("year")).filter(F.col("year").isNotNull()).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), "year").limit(k)


def multi_value(df: DataFrame, cols: dict[str, str | None] | None = None) -> DataFrame:
    """Non-null rows, values after split, unique values per column; one scan."""
    cols = cols or MULTI_VALUE
    # a null in front of each non-null row's tokens stands for the row itself
    arrays = {c: F.when(F.col(c).isNotNull(), F.concat(F.array(F.lit(None).cast("string")), tokens(c, sep)))
              for c, sep in cols.items()}
    counts = _value_counts(elements(df, arrays))
    value = F.col("value").isNotNull()
    return counts.groupBy("column_name").agg(
        F.sum(F.when(~value, F.col("n")).otherwise(0)).alias("input_rows"),
        F.sum(F.when(value, F.col("n")).otherwise(0)).alias("values"), F.count_if(value).alias("unique_values"))


def _raw_parts(c: str, sep: str | None) -> Column:
    """Split without strip/filter (empty tokens counted); whitespace split
    ignores edges and runs."""
    if sep is None:
        return F.filter(F.split(F.col(c), WS_RUN), lambda x: x != "")
    return split_literal(c, sep)


def multi_value_width(df: DataFrame, cols: dict[str, str | None] | None = None) -> DataFrame:
    """Values per row (min/avg/max) including empty tokens."""
    cols = cols or MULTI_VALUE
    aggs = []
    for c, sep in cols.items():
        sz = F.when(F.col(c).isNotNull(), F.size(_raw_parts(c, sep)))
        aggs += [F.min(sz).alias(f"{c}__min"), F.avg(sz).alias(f"{c}__avg"),
                 F.max(sz).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").cast("bigint").alias("min_values"),
                 F.col(f"{c}__avg").alias("avg_values"),
                 F.col(f"{c}__max").cast("bigint").alias("max_values")) for c in cols])).alias("s")
    ).select("s.*")


def multi_value_widest(df: DataFrame, cols: dict[str, str | None] | None = None,
                       order_col: str = "source_row_index", threshold: int = 20) -> DataFrame:
    """For columns whose widest row exceeds ``threshold`` values, that
    row (first in row order among ties), whole value."""
    cols = cols or MULTI_VALUE
    widest = []
    for c, sep in cols.items():
        sz = F.size(_raw_parts(c, sep))
        first = F.when(F.col(c).isNotNull(), F.struct((-sz).alias("neg"), F.col(order_col).alias("idx")))  # null: not considered
        row = F.struct(F.lit(c).alias("column_name"), sz.alias("n_values"), F.col(order_col).alias("row_index"), F.col(c).alias("value"))
        widest.append(F.min_by(row, first))
    found = df.agg(F.array(*widest).alias("w")).select(F.explode("w").alias("w")).select("w.*")  # one scan
    return found.filter(F.col("n_values") > threshold)


def multi_value_top(df: DataFrame, cols: dict[str, str | None] | None = None, k: int = 15
                    ) -> DataFrame:
    """Most common values per multi-value column."""
    cols = cols or MULTI_VALUE
    return _ranked_top(_value_counts(elements(df, {c: tokens(c, sep) for c, sep in cols.items()})), k)


def text_lengths(df: DataFrame, cols: list[str]) -> DataFrame:
    """Non-null, min/avg/max length per text column."""
    aggs = []
    for c in cols:
        ln = F.length(c)
        aggs += [F.count(c).alias(f"{c}__nn"), F.min(ln).alias(f"{c}__min"),
                 F.avg(ln).alias(f"{c}__avg"), F.max(ln).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nn").alias("non_null"),
                 F.col(f"{c}__min").cast("bigint").alias("min_len"),
                 F.col(f"{c}__avg").alias("avg_len"),
                 F.col(f"{c}__max").cast("bigint").alias("max_len")) for c in cols])).alias("s")
    ).select("s.*")


def short_values(df: DataFrame, cols: list[str], order_col: str, min_len: int = 5,
                 k: int = 5) -> DataFrame:
    """Values shorter than ``min_len`` characters: count and the first
    ``k`` in row order."""
    def of(c: str) -> Column:
        return F.struct(F.lit(c).alias("column_name"), F.col(order_col).alias("o"), F.col(c).alias("v"))

    each = F.filter(F.array(*[F.when(F.length(c) < min_len, of(c)) for c in cols]), lambda x: x.isNotNull())
    short = df.select(F.explode(each).alias("s")).select("s.*")  # all columns in one scan
    counts = short.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_short"))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy("o"))  # cut to k before the shuffle
    first = (short.withColumn("place", place).filter(F.col("place") <= k).groupBy("column_name").agg(
        F.concat_ws(" | ", F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"])).alias("samples")))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    return (every.join(counts, "column_name", "left").join(first, "column_name", "left")
            .select("column_name", F.coalesce("n_short", F.lit(0)).cast("bigint").alias("n_short"), "samples"))


def organizations(df: DataFrame, col: str = "org_name", k: int = 20) -> DataFrame:
    """P20: top organizations by rows (the distinct count is in P21)."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), col).limit(k)


def _unique_arrays() -> dict[str, Column]:
    arrays = {f"unique_{c}": F.array(F.col(c)) for c in ("org_name", *CATEGORICAL)}
    return arrays | {f"unique_{c}": F.transform(split_literal(c, ","), lambda x: strip_ws(x))
                     for c in ("conditions", "interventions", "mesh")}


def uniques(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Unique counts for schema sizing. Split values are stripped but
    empty tokens count as a value; ``approximate`` switches to HyperLogLog
    sketches for very large inputs."""
    arrays = _unique_arrays()
    found = elements(df, arrays).withColumnRenamed("column_name", "metric")
    if approximate:
        n = found.groupBy("metric").agg(F.approx_count_distinct("value").alias("n"))
    else:
        n = found.distinct().groupBy("metric").agg(F.count("value").alias("n"))
    every = df.sparkSession.createDataFrame([(m,) for m in arrays], "metric string")
    return every.join(n, "metric", "left").select("metric", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


#: Logarithm of a sketch's registers; its relative standard error is 1.04 / sqrt(2 ** SKETCH_K), 0.8 %.
SKETCH_K = 14


def unique_sketches(df: DataFrame, run_id: str) -> DataFrame:
    """P21 by increments: a HyperLogLog sketch per metric and run. Stored as a
    table, the sketches of many runs give the uniques of all their rows by
    ``merged_uniques``, without a scan of the rows. Exact counts stay the default."""
    found = elements(df, _unique_arrays()).withColumnRenamed("column_name", "metric")
    return found.groupBy("metric").agg(F.hll_sketch_agg("value", F.lit(SKETCH_K)).alias("sketch"),
                                       F.count("value").alias("n_values")).select(F.lit(run_id).alias("run_id"), "metric", "n_values", "sketch")


def merged_uniques(sketches: DataFrame) -> DataFrame:
    """Estimated uniques per metric over the runs of a sketch table."""
    return sketches.groupBy("metric").agg(
        F.sum("n_values").alias("n_values"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimate"))
