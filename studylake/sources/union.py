"""One study frame from several sources (CSV exports, JSON pages, frames).

Each source brings the raw columns it has, the place of every record, and its
unreadable records with a reason. ``unite`` joins them by column name; ``land``
writes the result once, so text is parsed once and later passes read columns.
Row keys are assigned after the union, by (source, index, file, block, row,
position): ``Warehouse.from_landed`` numbers the pinned order. Sites travel with
their study, nested, or as a frame keyed by the source's own index."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.load import write_table
from ..schemas import RAW_COLUMNS
from . import csv as CSV
from . import json_pages as J

#: Place of a record, in the order in which keys are given.
ORDER = ["__source", "__index", "__file", "__block", "__row", "__pos"]
SITE = "struct<facility:string,city:string,state:string,country:string,zip:string>"
_TYPES = ({"__source": "int", "__index": "bigint", "__file": "string", "__block": "bigint", "__row": "bigint", "__pos": "int"}
          | dict.fromkeys(RAW_COLUMNS, "string")
          | {"nct_id": "string", "enrollment": "int", "data_source": "string", "study_key": "string",
             "_locations": f"array<{SITE}>", "__reason": "string", "__text": "string"})


@dataclass
class Source:
    """``rows``: raw columns, extras and place columns as the scans name them.
    ``sites``: site rows by ``source_row_index``, the source's own index."""
    name: str
    rows: DataFrame
    sites: DataFrame | None = None


def csv_source(spark: SparkSession, path: str, sites: DataFrame | None = None) -> Source:
    return Source("csv", CSV.scan_files(spark, path), sites)


def json_source(spark: SparkSession, path: str, multi_line: bool = False) -> Source:
    return Source("api", J.ordered_studies(J.read_pages(spark, path, multi_line)))


def frame_source(name: str, raw: DataFrame, sites: DataFrame | None = None) -> Source:
    """A frame with ``source_row_index``."""
    return Source(name, raw.withColumnRenamed("source_row_index", "index"), sites)


def unite(sources: list[Source]) -> DataFrame:
    """All sources by column name, each stamped with its name and number.

    ``study_key`` names a study over several runs: its nct_id, or else the source
    and the index there; a study with neither has none."""
    def part(number: int, s: Source) -> DataFrame:
        have = {c: F.col(c) for c in s.rows.columns}
        have |= {f"__{c}": have[c] for c in ("index", "file", "block", "row", "pos", "reason", "text") if c in have}
        have["__source"], have["data_source"] = F.lit(number), F.lit(s.name)
        null = F.lit(None)
        index = have.get("__index", null.cast("bigint"))
        nct = F.nullif(F.trim(have.get("nct_id", null.cast("string"))), F.lit(""))
        have["study_key"] = F.coalesce(nct, F.concat(F.lit(f"{s.name}:"), index.cast("string")))
        return s.rows.select(*[have.get(c, null).cast(t).alias(c) for c, t in _TYPES.items()])

    return reduce(DataFrame.unionByName, [part(i, s) for i, s in enumerate(sources)])


def land(sources: list[Source], path: str) -> DataFrame:
    """The united records, written once."""
    united = unite(sources)
    write_table(united, path)
    return united.sparkSession.read.schema(united.schema).parquet(path)


def index_repeats(landed: DataFrame) -> DataFrame:
    """(data_source, index, n) of index values that stand on several records."""
    indexed = landed.filter("__index IS NOT NULL AND __reason IS NULL")
    return (indexed.groupBy("data_source", F.col("__index").alias("index")).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1"))
