"""Registry CSV exports.

Reading: header row, UTF-8, quoted newlines and doubled quotes
(``multiLine`` + ``escape='"'``), every column read as a string (no schema
inference pass), whitespace kept as is. The NA-string projection runs
untrimmed, before any cleaning. ``multiLine`` files are not splittable, so
``union.land`` writes a scan once to Parquet and work goes on from there.

``scan_files`` reads exports whose files differ in their headers: the driver
reads the first record of each file (as Spark's own listing does, some bytes a
file), files are grouped by header, and each group is one scan by position with
a corrupt-record column.
"""

from __future__ import annotations

import csv
import io
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CSV_NA_STRINGS, among
from ..schemas import RAW_HEADERS, REQUIRED_CSV_HEADERS

INDEX_COL_RX = re.compile(r"^(Unnamed.*|_c\d+)?$")
HEADER_READERS = 16

_CSV_OPTS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"',
             "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


class SchemaError(ValueError):
    pass


def write_csv_export(raw: DataFrame, path: str, with_index: bool = True) -> None:
    """Write a raw study frame as a registry-style export: display headers,
    and (optionally) the row index as a leading unnamed column."""
    cols = []
    if with_index:
        cols.append(F.col("source_row_index").alias(""))
    cols += [F.col(c).alias(h) for c, h in RAW_HEADERS.items() if c in raw.columns]
    (raw.select(*cols).write.mode("overwrite").options(**_CSV_OPTS)
        .option("nullValue", "").option("emptyValue", '""').csv(path))


def drop_index_cols(df: DataFrame) -> tuple[DataFrame, str | None]:
    """Drop unnamed index columns; returns the frame and the first such
    column's name (candidate row index) if any."""
    idx = [c for c in df.columns if INDEX_COL_RX.match(c)]
    return df.drop(*idx), (idx[0] if idx else None)


def schema_check(df: DataFrame, required: list[str]) -> list[str]:
    """S3: names of required columns missing from ``df`` (no job runs)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: list[str]) -> None:
    missing = schema_check(df, required)
    if missing:
        raise SchemaError(f"missing required columns: {missing}")


def null_na_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """The reader-level NA strings → null, untrimmed."""
    cs = set(cols)
    return df.select(*[F.when(~among(c, CSV_NA_STRINGS), F.col(c)).alias(c) if c in cs
                       else F.col(c) for c in df.columns])


def scan_csv(spark: SparkSession, path: str, required: list[str] | None = None,
             source: str | None = None) -> DataFrame:
    """Scan an export into canonical snake-case columns plus
    ``source_row_index`` (from the unnamed index column when present, else
    positional via a dense key is left to the caller)."""
    df = spark.read.options(**_CSV_OPTS).csv(path)
    df, idx = drop_index_cols_keep(df)
    require_columns(df, required or REQUIRED_CSV_HEADERS)
    back = {h: c for c, h in RAW_HEADERS.items()}
    out = df.select(*([F.col(idx).cast("long").alias("source_row_index")] if idx else []),
                    *[F.col(h).alias(back[h]) for h in REQUIRED_CSV_HEADERS])
    out = null_na_strings(out, list(RAW_HEADERS))
    if source:
        out = stamp_source(out, source)
    return out


def drop_index_cols_keep(df: DataFrame) -> tuple[DataFrame, str | None]:
    """Like ``drop_index_cols`` but keeps the first index column for use as
    the row index (dropping only the others)."""
    idx = [c for c in df.columns if INDEX_COL_RX.match(c)]
    if not idx:
        return df, None
    return df.drop(*idx[1:]), idx[0]


def stamp_source(df: DataFrame, source: str) -> DataFrame:
    """Provenance column."""
    return df.withColumn("data_source", F.lit(source))


def first_record(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """The cells of a file's first record, which may hold quoted line breaks;
    None for an empty file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        text = reader.readLine()
        while text is not None and text.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            text += "\n" + more
    finally:
        reader.close()
    return None if text is None else tuple(next(csv.reader(io.StringIO(text.removeprefix("\ufeff"))), ()))


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Header → the files that begin with it; empty files are left out."""
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        found = list(pool.map(lambda f: first_record(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, found):
        if header:
            out.setdefault(header, []).append(file)
    return out


def scan_files(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """S1–S3 over files with headers of their own: the canonical columns by each
    file's header, ``index`` (of the unnamed column, null without one), the place
    (file, block, row), and ``reason`` and ``text`` of records that cannot be
    taken: a wrong number of cells, or an index that is no number. A file without
    a required column raises, by name."""
    required = REQUIRED_CSV_HEADERS if required is None else required
    parts = []
    for header, files in headers(spark, path).items():
        missing = [c for c in required if c not in header]
        if missing:
            raise SchemaError(f"{files[0]} and {len(files) - 1} more: missing required columns: {missing}")
        cells = [f"c{i}" for i in range(len(header))]
        schema = ", ".join(f"{c} string" for c in [*cells, "_corrupt_record"])
        scan = (spark.read.schema(schema).options(**_CSV_OPTS).option("enforceSchema", "true")
                .option("columnNameOfCorruptRecord", "_corrupt_record").csv(files))
        own = next((cells[i] for i, h in enumerate(header) if INDEX_COL_RX.match(h)), None)
        index = F.expr(f"try_cast({own} AS bigint)") if own else F.lit(None).cast("bigint")
        bad_index = index.isNull() if own else F.lit(False)
        reason = F.when(F.col("_corrupt_record").isNotNull(), "wrong number of cells").when(bad_index, "index is no number")
        text = F.when(reason.isNotNull(), F.coalesce("_corrupt_record", F.to_json(F.struct(*cells))))
        parts.append(scan.select(
            *[F.col(cells[header.index(h)]).alias(c) if h in header else F.lit(None).cast("string").alias(c)
              for c, h in RAW_HEADERS.items()],
            index.alias("index"), F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("block"),
            F.monotonically_increasing_id().alias("row"), reason.alias("reason"), text.alias("text")))
    if not parts:
        raise SchemaError(f"no file with a header below {path}")
    return null_na_strings(reduce(DataFrame.unionByName, parts), list(RAW_HEADERS))


def presence(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """S3 over data: per required column, whether every file's header has it, and
    the records and non-null cells counted over the whole export."""
    required = required or REQUIRED_CSV_HEADERS
    back = {h: c for c, h in RAW_HEADERS.items()}
    everywhere = set.intersection(*map(set, headers(spark, path)))
    rows = scan_files(spark, path, required=[]).filter("reason IS NULL")
    wide = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(back[h]).alias(h) for h in required])
    return wide.unpivot(["n_rows"], required, "column_name", "non_null").select(
        "column_name", F.col("column_name").isin(sorted(everywhere)).alias("present"), "n_rows", "non_null")


def source_summary(df: DataFrame, source: str) -> DataFrame:
    """Source name, rows, columns."""
    return df.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
