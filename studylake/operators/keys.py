"""Surrogate keys and key resolution.

``dense_key`` assigns 1..N in a given order without a global window (which
would pull every row into one task). The input is range-partitioned, sorted
within partitions and written once as Parquet in the shared folder, each row
with its partition number and its position there. An id is then the count of
rows in lower partitions plus the position: it survives any re-read, and every
later pass reads only the columns it uses. One count per partition is all that
reaches the driver.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staging_path

_PID_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | row position
PART, POS = "__part", "__pos"
#: Of rows that are pinned where they lie: the task that wrote a row, its place in
#: the order of writing, and the stretch of a file that it comes from.
LOT, AT, RUN = "__lot", "__at", "__run"
#: Settings of a session that joins on (LOT, AT) frames that are bucketed by LOT.
BY_LOT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: Bytes of compressed inputs for one task: rows take some ten times as much in its
#: memory, and a few large tasks leave cores idle at the end.
PARTITION_BYTES = 16 << 20
MAX_PARTITIONS = 100_000
#: Offsets that are planned as literals.
INLINE = 1000
#: Parents whose children one task numbers.
PARENTS_PER_GROUP = 65_536
#: Studies, with their bridge rows, that one task joins or groups.
STUDIES_PER_TASK = 1 << 18


@dataclass
class Keyed:
    df: DataFrame
    rows: int
    #: Of rows pinned where they lie: how many buckets their lots fall into, and the
    #: names of tables in the session's catalog that lead to them.
    lots: int = 0
    tables: list[str] = field(default_factory=list)


def partitions_for(df: DataFrame) -> int:
    """Partitions by the bytes of the inputs, one per core at least. An input
    without files (an RDD, rows of the driver) has no known size, only Spark's
    placeholder of 8 EB; it counts with the partitions it already has."""
    spark = df.sparkSession
    size, parts = _input_size(df)
    return max(spark.sparkContext.defaultParallelism, parts, min(MAX_PARTITIONS, math.ceil(size / PARTITION_BYTES)))


def _input_size(df: DataFrame) -> tuple[int, int]:
    """Bytes of the inputs that are files, and partitions of those that are not."""
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size, parts = 0, 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        bytes_ = int(str(leaf.stats().sizeInBytes()))
        if bytes_ < unknown:
            size += bytes_
        elif leaf.nodeName() == "LogicalRDD" or leaf.getClass().getSimpleName() == "LogicalRDD":
            parts = max(parts, leaf.rdd().getNumPartitions())
    return size, parts


def bytes_for(df: DataFrame, rows: int, per_task: int) -> int:
    """Bytes of files that hold some ``per_task`` of so many rows, for a task to read."""
    return min(PARTITION_BYTES, max(1 << 20, _input_size(df)[0] * per_task // max(1, rows)))


def tasks_for(studies: int) -> int:
    """Tasks for a join or grouping of so many studies' bridge rows: by rows, since
    dense ids and repeated names take next to nothing as bytes, and no less in memory."""
    return max(1, math.ceil(studies / STUDIES_PER_TASK))


def pin_sorted(df: DataFrame, order_cols: list[str], num_partitions: int | None = None,
               then=None) -> DataFrame:
    """Range-partition on the order, sort inside partitions and write the rows
    as Parquet with their partition and position.

    ``then`` is an optional narrow transformation applied after the sort (e.g.
    cleaning). It keeps the row order and runs once, inside the write: the
    range partitioner's sampling pass only sees ``df``."""
    n = num_partitions or partitions_for(df)
    laid = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    if then is not None:
        laid = then(laid)
    mid = F.monotonically_increasing_id()
    laid = laid.withColumn("__mid", mid).withColumns({
        PART: F.shiftright("__mid", _PID_SHIFT).cast("int"),
        POS: F.col("__mid").bitwiseAND(F.lit((1 << _PID_SHIFT) - 1))}).drop("__mid")
    path = staging_path(df.sparkSession, "pinned")
    laid.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(laid.schema).parquet(path)


def _offsets(df: DataFrame, counts: DataFrame, group: str) -> tuple[DataFrame, int]:
    """(group, __off): rows of lower groups, from one counted row per group."""
    total, rows = 0, []
    for r in sorted(counts.collect(), key=lambda r: r[0]):
        rows.append((r[0], total))
        total += int(r[1] or 0)
    rows = rows or [(0, 0)]
    if len(rows) <= INLINE:  # a relation of literals: known size, no Python rows
        values = ", ".join(f"({g}L, {o}L)" for g, o in rows)
        return df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({group}, __off)"), total
    return df.sparkSession.createDataFrame(rows, f"{group} long, __off long"), total


def number_pinned(pinned: DataFrame, out: str) -> Keyed:
    """Ids of pinned rows: a scan and a join with one offset per partition."""
    off, total = _offsets(pinned, pinned.groupBy(PART).count(), PART)
    keyed = (pinned.join(F.broadcast(off), PART)  # one row per partition
             .withColumn(out, F.col("__off") + F.col(POS) + F.lit(1)).drop(PART, POS, "__off"))
    return Keyed(keyed.select(out, *[c for c in keyed.columns if c != out]), total)


def dense_key(df: DataFrame, order_cols: list[str], out: str = "id",
              num_partitions: int | None = None) -> Keyed:
    """K3: dense 1..N key following ``order_cols`` (which must be unique for a
    deterministic result)."""
    return number_pinned(pin_sorted(df, order_cols, num_partitions), out)


def write_lots(df: DataFrame, path: str, lots: int) -> tuple[DataFrame, str]:
    """Write rows bucketed by ``LOT`` and name them in the session's catalog: in a session
    with ``BY_LOT``, frames written so are joined on (LOT, AT) without an exchange.
    Returns the frame and the name."""
    name = os.path.basename(path).replace("-", "_")
    df.write.format("parquet").bucketBy(lots, LOT).option("compression", "zstd").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name), name


def number_in_place(df: DataFrame, rows: int, order_cols: list[str], stretch: list[str], out: str, then=None,
                    sort: bool = False) -> Keyed:
    """Dense 1..N key following ``order_cols``. ``stretch`` names a part of a file, in
    which the rows are read in that order. Rows are written where they lie, without an
    exchange, and numbered by their stretch's offset and their place in it: one row per
    stretch and task reaches the driver. With ``sort``, and where stretches are too many
    or do not follow each other, rows are range-partitioned and sorted first. ``rows``:
    about how many there are, for the number of buckets that lots fall into. ``then``: as
    in ``pin_sorted``; it keeps the order columns."""
    spark, n, tables = df.sparkSession, max(partitions_for(df), math.ceil(rows / PARENTS_PER_GROUP)), []

    def pinned(source: DataFrame, by: list[str]) -> DataFrame:
        laid = source if then is None else then(source)
        laid = laid.withColumn(AT, F.monotonically_increasing_id()).withColumn(LOT, F.shiftright(AT, _PID_SHIFT).cast("int"))
        laid = laid.withColumn(RUN, F.xxhash64(LOT, *by))
        table, name = write_lots(laid, staging_path(spark, "pinned"), n)
        tables.append(name)
        return table

    def runs_of(table: DataFrame) -> list:
        place = F.struct(*order_cols)
        found = table.groupBy(RUN).agg(F.count(F.lit(1)).alias("n"), F.min(AT).alias("from"), F.max(AT).alias("to"),
                                       F.min(place).alias("first"), F.max(place).alias("last")).collect()
        return sorted(found, key=lambda r: _nulls_first(r["first"]))

    table = None
    if not sort and df.select(*stretch).distinct().limit(MAX_PARTITIONS + 1).count() <= MAX_PARTITIONS:
        table = pinned(df, stretch)
        runs = runs_of(table)
        if not (all(r["to"] - r["from"] + 1 == r["n"] for r in runs)
                and all(_nulls_first(a["last"]) < _nulls_first(b["first"]) for a, b in zip(runs, runs[1:]))):
            table = None
    if table is None:
        table = pinned(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols), [])
        runs = runs_of(table)
    total, offsets = 0, []
    for r in runs:
        offsets.append((r[RUN], total - r["from"] + 1))
        total += r["n"]
    off = spark.createDataFrame(offsets, f"{RUN} long, __off long")
    keyed = table.join(F.broadcast(off), RUN).withColumn(out, F.col("__off") + F.col(AT)).drop("__off", RUN)
    return Keyed(keyed.select(out, *[c for c in keyed.columns if c != out]), total, n, tables)


def _nulls_first(row) -> tuple:
    return tuple((v is not None, v) for v in row)


def sums_before(df: DataFrame, order: Column, amounts: dict[str, Column]) -> DataFrame:
    """For each row the sums of ``amounts`` over all rows of a lower ``order``, a unique
    id: a running sum within groups of ids and one row of totals per group."""
    grouped = df.withColumn("__ord", order).withColumn("__grp", F.floor((F.col("__ord") - 1) / PARENTS_PER_GROUP))
    totals = grouped.groupBy("__grp").agg(*[F.sum(a).alias(c) for c, a in amounts.items()]).orderBy("__grp").collect()
    upto, rows = [0] * len(amounts), []
    for r in totals:
        rows.append((r["__grp"], *upto))
        upto = [u + int(r[c] or 0) for u, c in zip(upto, amounts)]
    off = df.sparkSession.createDataFrame(rows, ", ".join(["__grp long", *[f"__off_{c} long" for c in amounts]]))
    before = Window.partitionBy("__grp").orderBy("__ord").rowsBetween(Window.unboundedPreceding, -1)
    summed = grouped.repartition("__grp").withColumns({c: F.coalesce(F.sum(a).over(before), F.lit(0)) for c, a in amounts.items()})
    return (summed.join(F.broadcast(off), "__grp").withColumns({c: F.col(c) + F.col(f"__off_{c}") for c in amounts})
            .drop("__grp", "__ord", *[f"__off_{c}" for c in amounts]))


def id_bits(ids: DataFrame, key: str) -> DataFrame:
    """Dense ids as bits, 32,768 to a row: 7 MB for 54 million."""
    own = ids.select(F.bitmap_bucket_number(key).alias("__block"), F.bitmap_bit_position(key).alias("__bit"))
    return own.repartition("__block").groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__bits"))


def without(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """The rows whose id is not among those of ``id_bits``, which are broadcast; the
    rows stay where they are."""
    bit = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0
    kept = df.withColumn("__block", F.bitmap_bucket_number(key)).join(F.broadcast(bits), "__block", "left")
    return kept.filter(~F.coalesce(found, F.lit(False))).select(*df.columns)


def child_key(df: DataFrame, parent: str, array: Column, value: str, out: str = "id") -> DataFrame:
    """Dense ids of an array's elements in (parent, position) order, where the
    parent is itself a dense key: (out, df's columns, pos, value).

    Parents fall into groups of bounded size by their id; a running sum within
    the group and one total per group give each parent its first id."""
    own = df.withColumn("__els", array)
    size = F.coalesce(F.size("__els"), F.lit(0))
    grouped = own.withColumn("__grp", F.floor((F.col(parent) - 1) / PARENTS_PER_GROUP))
    off, _ = _offsets(df, grouped.groupBy("__grp").agg(F.sum(size).alias("n")), "__grp")
    before = Window.partitionBy("__grp").orderBy(parent).rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("__start", F.coalesce(F.sum(size).over(before), F.lit(0)))
    # outer, and empty arrays left out by the position: what Spark infers from a plain
    # explode (size above 0, not null) would make every array three times
    rows = placed.join(F.broadcast(off), "__grp").select(  # one row per group of parents
        *df.columns, (F.col("__off") + F.col("__start")).alias("__start"), F.posexplode_outer("__els").alias("pos", value))
    return rows.filter("pos IS NOT NULL").select((F.col("__start") + F.col("pos") + F.lit(1)).alias(out), *df.columns, "pos", value)


def org_keys(orgs: DataFrame) -> Keyed:
    """K1: organizations get ids in first-appearance order; a null name is
    rejected (the warehouse column is NOT NULL)."""
    return dense_key(orgs.filter(F.col("org_name").isNotNull()), ["first_row_index"], "org_id")


def study_keys(studies: DataFrame) -> Keyed:
    """K2: studies get ids in row order."""
    return dense_key(studies, ["source_row_index"], "study_id")


def resolve_org_id(studies: DataFrame, orgs: DataFrame) -> DataFrame:
    """K4: name → id, unknown name → null id (left lookup), in one scan of the
    fact. The join key is a struct: rows without a name carry their own row
    index in it, so they match nothing and spread over all tasks, however many
    there are. How to join is the planner's choice, by measured bytes."""
    def key(null, value):
        return F.struct(null.alias("unnamed"), value.alias("of"))
    name = F.col("org_name")
    dim = orgs.select(key(F.lit(False), name).alias("__key"), "org_id")
    own = key(name.isNull(), F.coalesce(name, F.col("source_row_index").cast("string")))
    return studies.withColumn("__key", own).join(dim, "__key", "left").drop("__key")


def resolve_study_id(bridge: DataFrame, studies: DataFrame) -> DataFrame:
    """K5: bridge rows by ``source_row_index`` → ``study_id``; unmapped rows
    are dropped (inner join)."""
    return bridge.join(studies.select("source_row_index", "study_id"), "source_row_index")


def unmapped_rows(bridge: DataFrame, studies: DataFrame) -> DataFrame:
    """K6: bridge rows whose parent row is missing (the rejected rows)."""
    return bridge.join(studies.select("source_row_index"), "source_row_index", "left_anti")


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """K7: column defaults for absent or null values."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), v) if c in df.columns else v)
    return out
