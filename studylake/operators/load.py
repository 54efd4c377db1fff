"""Loading the warehouse as Parquet.

A full refresh writes every table of a run into a fresh run folder (below
the shared staging root), so a path being read is never overwritten; the
caller then switches readers to the new run. Counts come from the written
files' metadata-backed scans, not from extra passes over the inputs."""

from __future__ import annotations

import datetime as dt
import json
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PIPELINE_LOG_SCHEMA
from ..session import staging_path

LOAD_ORDER = ["organizations", "studies", "study_conditions", "study_interventions",
              "study_age_groups", "study_mesh_terms", "study_locations"]


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def side_by_side(work: list) -> list:
    """Results of independent jobs, run at the same time, so that the tail of one
    leaves no cores idle. The first failure is raised, after all have ended."""
    with ThreadPoolExecutor(len(work) or 1) as pool:
        return [f.result() for f in [pool.submit(w) for w in work]]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it is missing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def newest(spark: SparkSession, root: str, prefix: str) -> int | None:
    """The largest number n of the complete folders ``<prefix>=<n>`` below a root."""
    found = [int(n.removeprefix(f"{prefix}=")) for n in names(spark, root) if n.startswith(f"{prefix}=")]
    return max((i for i in found if exists(spark, os.path.join(root, f"{prefix}={i}", "_SUCCESS"))), default=None)


class Conflict(RuntimeError):
    """Another run was published after the state that this one builds on."""


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text, never over an existing one; False where it
    exists. A local file is linked into place whole; other stores decide by their
    create without overwrite."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    uri = fs.makeQualified(p).toUri()
    if uri.getScheme() == "file":
        own = f"{uri.getPath()}.{uuid.uuid4().hex}"
        with open(own, "w") as f:
            f.write(text)
        try:
            os.link(own, uri.getPath())
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - the store's own kind of "exists"
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


#: A stored part of a table: its name, its bucket (None: the whole table) and path.
Part = tuple[str, "int | None", str]


def _pointers(spark: SparkSession, root: str) -> list[tuple[int, dict]]:
    """Committed pointers, oldest first. One that is still being written does not count."""
    folder, out = os.path.join(root, "_published"), []
    for name in names(spark, folder):
        if name.startswith("version=") and name.endswith(".json"):
            try:
                out.append((int(name[len("version="):-len(".json")]), json.loads(read_text(spark, os.path.join(folder, name)))))
            except ValueError:
                continue
    return sorted(out, key=lambda v: v[0])


def current(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """The newest pointer's number and content; (0, None) before the first."""
    found = _pointers(spark, root)
    return found[-1] if found else (0, None)


def publish(spark: SparkSession, root: str, run_id: str, parts: dict[str, str] | list[Part], run_root: str | None = None,
            based_on: int | None = None) -> int:
    """L1: point readers at a run by a new numbered pointer below
    ``root/_published``, created without overwriting. Where two runs meet, the
    loser takes the next number; with ``based_on`` (an increment) it raises
    ``Conflict`` instead, since its state lacks the winner's. Returns the number."""
    rows = [(t, None, p) for t, p in parts.items()] if isinstance(parts, dict) else parts
    content = json.dumps({"run_id": run_id, "run_root": run_root, "parts": rows})
    number = (current(spark, root)[0] if based_on is None else based_on) + 1
    while not create_new(spark, os.path.join(root, "_published", f"version={number}.json"), content):
        if based_on is not None:
            raise Conflict(f"version {number} of {root} was published by another run")
        number += 1
    return number


def published_parts(spark: SparkSession, root: str) -> list[Part]:
    """The stored parts of the run that was published last; none before the first."""
    content = current(spark, root)[1]
    return [tuple(p) for p in content["parts"]] if content else []


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Table → path of the last published run whose tables are whole."""
    return {t: p for t, bucket, p in published_parts(spark, root) if bucket is None}


def read_parts(spark: SparkSession, parts: list[Part]) -> dict[str, DataFrame]:
    """Table → all its parts as one frame. Parts of a table have one schema."""
    by_table: dict[str, list[str]] = {}
    for table, _, path in parts:
        by_table.setdefault(table, []).append(path)
    return {t: spark.read.parquet(*paths) for t, paths in by_table.items()}


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove what no reader needs: pointers but the newest ``keep``, and run
    folders that none of these names and that nothing was written to for ``grace``
    (so a run in progress is spared). Returns the removed paths."""
    if keep < 1:
        raise ValueError("the newest pointer must stay")
    jvm = spark.sparkContext._jvm
    pointers = _pointers(spark, root)
    kept, gone = pointers[-keep:], []
    used = [p for _, c in kept for _, _, p in c["parts"]] + [c["run_root"] for _, c in kept if c.get("run_root")]
    before = (dt.datetime.now() - grace).timestamp() * 1000
    runs = os.path.join(root, "runs")
    for name in names(spark, runs):
        folder = os.path.join(runs, name)
        p = jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not any(u == folder or u.startswith(folder + "/") for u in used) and _last_write(fs, p) < before:
            fs.delete(p, True)
            gone.append(folder)
    for number, _ in pointers[:-keep]:  # after the folders, so a broken-off vacuum is taken up again
        path = os.path.join(root, "_published", f"version={number}.json")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
        gone.append(path)
    return gone


def _last_write(fs, path) -> int:
    """The newest modification time below a folder, two levels deep (tables and their files' folders)."""
    newest_ms = fs.getFileStatus(path).getModificationTime()
    level = [path]
    for _ in range(2):
        below = [s for p in level for s in fs.listStatus(p)]
        newest_ms = max([newest_ms, *[s.getModificationTime() for s in below]])
        level = [s.getPath() for s in below if s.isDirectory()]
    return newest_ms


def load_full_refresh(spark: SparkSession, tables: dict[str, DataFrame],
                      run_root: str | None = None,
                      partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """L1/L2: write every table in dependency order into a new run folder;
    returns table → path (the new warehouse)."""
    run_root = run_root or staging_path(spark, "warehouse-run")
    paths = {}
    for name in [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]:
        p = os.path.join(run_root, name)
        write_table(tables[name], p, (partition_by or {}).get(name))
        paths[name] = p
    return paths


def read_warehouse(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Table reader over a loaded run."""
    return {t: spark.read.parquet(p) for t, p in paths.items()}


def file_statistics(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """P1, D5, E5, L6 from the files' footers: rows, and least and greatest value of
    number and date columns, without reading a row (PushedAggregation). The v2
    reader that can push them down is set in a session of its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return own.read.parquet(*paths).agg(*aggs)


def table_counts(tables: dict[str, DataFrame], rejected: dict[str, DataFrame] | None = None
                 ) -> DataFrame:
    """Per-table loaded and rejected row counts as rows (one small
    aggregate per table, folded by a union and a tiny final aggregate)."""
    zero = F.lit(0).cast("bigint")
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(
                 F.lit(name).alias("table_name"), F.col("n").alias("rows_loaded"),
                 zero.alias("rows_rejected"))
             for name, df in tables.items()]
    parts += [df.agg(F.count(F.lit(1)).alias("n")).select(
                  F.lit(name).alias("table_name"), zero.alias("rows_loaded"),
                  F.col("n").alias("rows_rejected"))
              for name, df in (rejected or {}).items()]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.sum("rows_rejected").cast("bigint").alias("rows_rejected"))


def cascade_delete(tables: dict[str, DataFrame], doomed_study_ids: DataFrame) -> dict[str, DataFrame]:
    """Remove studies and every child row that references them
    (left anti join per child on study_id). The ids may be as many as the studies:
    the joins are merges, since by their bytes the ids would go through the driver."""
    keys = doomed_study_ids.select("study_id").hint("merge")  # anti join needs no distinct
    out = {}
    for name, df in tables.items():
        out[name] = df.join(keys, "study_id", "left_anti") if "study_id" in df.columns else df
    return out


def write_bucketed(tables: dict[str, DataFrame], root: str, buckets: int, name: str, key: str = "study_id") -> dict[str, str]:
    """E7 for the joins: each table hashed and sorted by ``key`` into so many
    buckets, one file each, and named in the session's catalog as ``<name>_<table>``;
    a join of two of them on the key needs no exchange. Returns table → catalog name."""
    named = {t: f"{name}_{t}".replace("-", "_") for t in tables}

    def write(table: str) -> None:
        df = tables[table]
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("compression", "zstd")
         .option("path", os.path.join(root, "bucketed", table)).saveAsTable(named[table]))

    side_by_side([partial(write, t) for t in tables])
    return named


class RunLog:
    """Pipeline-log rows, one per step, each appended to a Parquet table as
    the step ends, so a run that breaks off keeps its steps and all runs of a
    root share one history. Counts are passed in (from observations), so
    logging costs no scan."""

    def __init__(self, spark: SparkSession, run_id: str, path: str | None = None):
        self.spark = spark
        self.run_id = run_id
        self.path = path
        self.rows: list[tuple] = []
        self._lock = threading.Lock()  # steps of tables that are written side by side

    def step(self, step_name: str, status: str, rows_processed: int, rows_rejected: int,
             started_at: dt.datetime, error_message: str | None = None,
             completed_at: dt.datetime | None = None) -> None:
        import decimal
        completed_at = completed_at or dt.datetime.now()
        dur = decimal.Decimal(str(round((completed_at - started_at).total_seconds(), 2)))
        with self._lock:
            self.rows.append((len(self.rows) + 1, self.run_id, step_name, status, int(rows_processed),
                              int(rows_rejected), error_message, started_at, completed_at, dur))
            if self.path:
                cells = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(self.rows[-1], PIPELINE_LOG_SCHEMA)]
                self.spark.range(0, 1, 1, 1).select(*cells).write.mode("append").parquet(self.path)

    @staticmethod
    def compact(spark: SparkSession, path: str, into: str) -> DataFrame:
        """The steps of all runs so far, written to a few files at ``into``, for a
        log that has grown to many small ones."""
        rows = spark.read.schema(PIPELINE_LOG_SCHEMA).parquet(path)
        rows.coalesce(1).write.parquet(into)
        return spark.read.parquet(into)

    def frame(self) -> DataFrame:
        """This run's steps."""
        return self._frame(self.rows)

    def _frame(self, rows: list[tuple]) -> DataFrame:
        return self.spark.createDataFrame(rows, PIPELINE_LOG_SCHEMA)
