"""Recurring ingest of newly landed files as a Structured Streaming job.

File source → ``trigger(availableNow=True)`` (process everything landed, then
stop: a scheduled run) → ``foreachBatch`` newest-wins upsert into a bucketed
state. A key belongs to one bucket by its hash. Each micro-batch reads and writes
the buckets it touches, into ``data/batch=<id>/bucket=<b>``, and a manifest
``manifest/batch=<id>.json`` names the batch that wrote each bucket last. A
replayed batch (after a failure between write and commit) starts from the
manifest before it and writes the same again: exactly-once output with
at-least-once delivery. The newest RETAIN manifests and the folders they name
stay; older ones are removed. Progress lives in the checkpoint folder.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import buckets as B
from ..operators import load as L
from ..operators.quality import quarantine
from ..operators.upsert import latest_per_key
from ..schemas import PAGE_JSON_SCHEMA
from ..sources import json_pages as J

BUCKETS = 64
#: Manifests kept: a replay needs the one before it, a reader the one it has opened.
RETAIN = 3


class State:
    """Bucketed state below a root."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, retain: int = RETAIN):
        if retain < 2:
            raise ValueError("a replayed batch needs the manifest before it")
        self.spark, self.root, self.buckets, self.retain = spark, root, buckets, retain

    def _manifest(self, batch: int) -> str:
        return os.path.join(self.root, "manifest", f"batch={batch}.json")

    def batches(self) -> list[int]:
        found = L.names(self.spark, os.path.join(self.root, "manifest"))
        return sorted(int(n[len("batch="):-len(".json")]) for n in found if n.startswith("batch=") and n.endswith(".json"))

    def manifest(self, batch: int) -> dict[int, int]:
        """Bucket → the batch that wrote it last."""
        try:
            held = json.loads(L.read_text(self.spark, self._manifest(batch)))
        except Exception as e:  # noqa: BLE001 - the store's own kind of "not there"
            raise FileNotFoundError(f"state of batch {batch} is missing: {self._manifest(batch)}") from e
        if held["buckets"] != self.buckets:
            raise ValueError(f"the state has {held['buckets']} buckets, not {self.buckets}")
        return {int(b): n for b, n in held["written"].items()}

    def folder(self, batch: int, bucket: int) -> str:
        return os.path.join(self.root, "data", f"batch={batch}", f"{B.BUCKET}={bucket}")

    def read(self, batch: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The state after a batch (the newest by default); None where no bucket of
        ``only`` holds any."""
        if batch is None:
            batch = max(self.batches(), default=None)
            if batch is None:
                return None
        paths = [self.folder(n, b) for b, n in sorted(self.manifest(batch).items()) if only is None or b in only]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, rows: DataFrame, batch: int, keys: list[str], order: list[str]) -> None:
        """Newest wins, by key, in the buckets that the rows touch."""
        before = self.manifest(batch - 1) if batch > 0 else {}
        bucket = B.hash_bucket(keys, self.buckets)
        at = B.touched(rows, bucket)
        if at:
            stored = self.read(batch - 1, at) if batch > 0 else None
            every = rows if stored is None else stored.unionByName(rows, allowMissingColumns=True)
            B.write_buckets(latest_per_key(every, keys, order), bucket, keys, os.path.join(self.root, "data", f"batch={batch}"))
        content = json.dumps({"buckets": self.buckets, "written": before | dict.fromkeys(at, batch)})
        if not L.create_new(self.spark, self._manifest(batch), content):
            # a replay after the manifest was written: the same rows give the same buckets
            if self.manifest(batch) != before | dict.fromkeys(at, batch):
                raise RuntimeError(f"batch {batch} was written before with other buckets")
        self.expire()

    def expire(self) -> list[str]:
        """Remove manifests but the newest, and bucket folders that none of them names."""
        batches = self.batches()
        kept = batches[-self.retain:]
        used = {(n, b) for m in kept for b, n in self.manifest(m).items()}
        gone = []
        data = os.path.join(self.root, "data")
        jvm = self.spark.sparkContext._jvm
        for name in L.names(self.spark, data):
            n = int(name.removeprefix("batch="))
            if n in kept or n > max(batches):
                continue
            for b, path in B.bucket_folders(self.spark, os.path.join(data, name)):
                if (n, b) not in used:
                    gone.append(path)
        gone += [self._manifest(m) for m in batches[:-self.retain]]
        for path in gone:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return gone


def run_stream(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Process what has landed, then stop."""
    (stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
     .foreachBatch(apply).start().awaitTermination())


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, state_root: str,
                  checkpoint: str, keys: list[str], order: list[str], fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  dedup_watermark: tuple[str, str] | None = None, buckets: int = BUCKETS) -> DataFrame | None:
    """Run the ingest until the landed files are consumed; the newest state,
    also when nothing new has landed (None before the first batch). A batch whose
    predecessor's state is missing raises: it is never taken for an empty state.
    ``dedup_watermark`` (time column, delay) drops repeats of a row's key and order
    that arrive within the delay before they reach the state."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)
    if dedup_watermark:
        ts_col, delay = dedup_watermark
        stream = (stream.withWatermark(ts_col, delay)
                  .dropDuplicatesWithinWatermark(keys + order))
    state = State(spark, state_root, buckets)
    run_stream(stream, checkpoint, lambda batch, batch_id: state.merge(batch, batch_id, keys, order))
    return state.read()


def stream_pages(spark: SparkSession, source_dir: str, root: str, max_files_per_trigger: int | None = None,
                 multi_line: bool = False, buckets: int = BUCKETS) -> DataFrame | None:
    """E2 from JSON pages: studies by ``nct_id``, each as it landed last (by batch,
    then file and place). Each study is parsed alone inside the batch; what cannot
    be read, or has no id, goes to ``rejected`` below the root with its reason."""
    reader = spark.readStream.schema(PAGE_JSON_SCHEMA).option("mode", "PERMISSIVE").option("multiLine", multi_line).option(
        "columnNameOfCorruptRecord", "_corrupt_record")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    pages = reader.json(source_dir).withColumns({"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start")})
    state = State(spark, os.path.join(root, "state"), buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        # parsed once: the batch is landed, and all passes below read that
        landed = os.path.join(root, "landed", f"batch={batch_id}")
        flat = J.ordered_studies(batch.withColumn("row", F.monotonically_increasing_id()))
        L.write_table(flat.withColumn("batch", F.lit(batch_id)), landed)
        rows = spark.read.parquet(landed)
        reason = F.coalesce("reason", F.when(F.coalesce(F.trim("nct_id"), F.lit("")) == "", "no nct_id"))
        text = F.coalesce("text", F.to_json(F.struct("brief_title", "org_name")))
        bad = rows.withColumns({"reason": reason, "text": text}).filter("reason IS NOT NULL").select("nct_id", "file", "text", "reason")
        quarantine(bad, f"batch-{batch_id}", "studies", F.col("reason")).write.mode("overwrite").parquet(
            os.path.join(root, "rejected", f"batch={batch_id}"))
        good = rows.filter(reason.isNull()).drop("reason", "text")
        state.merge(good, batch_id, ["nct_id"], ["batch", "file", "block", "row", "pos"])
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "landed", f"batch={batch_id - RETAIN}"))
        done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(done, True)  # beyond any replay

    run_stream(pages, os.path.join(root, "checkpoint"), apply)
    return state.read()
