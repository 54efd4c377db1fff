"""Deterministic sharded WARC archives.

Writing (``write``):
1. A narrow table is staged: each page's rank (an order-preserving text of
   page_id, url and digest) and, for payloads of 1,000 bytes or more, the digest.
   Groups of equal payloads come from it by one aggregate; the page of the
   greatest rank keeps the payload, and every other one is told so by a narrow
   row. Payloads do not take part in this.
2. Shards are ranges of ranks with equal bytes. Their boundaries come from a
   sample chosen by a hash of the rank, so they depend on the pages alone, not on
   partitions, cores or retries.
3. Pages and narrow rows move once, to their shard, and are sorted there. A task
   streams through them: it writes each record as a gzip member with headers and
   digests made anew, and rolls to the next file by compressed size.
4. Files are written under temporary names, one for each attempt. The rows of the
   attempts that Spark accepted form the list of files; a second job gives these
   their final names (again, where a lost executor broke it off) and writes the
   manifest, which commits the archive. What no manifest names does not count.

Reading (``read``) streams the files of a manifest record by record, and raises
where a length, a digest or a file's number of records or bytes is not as stated.

Equal archives come from equal pages: names, boundaries, record ids and bytes are
functions of the rows and parameters.

Nulls and odd rows: a null html is an empty payload, a null url is empty (its
target is ``urn:page:<page_id>``), a null page_id ranks lowest. Rows equal in all
three are records of their own with ids by their ordinal; they share a shard, where
they are streamed, not held. Of these the first keeps the payload. Line breaks and
other controls in a url are percent-encoded in headers. Other columns are ignored,
whatever their names; an empty table gives an empty archive with a manifest.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import staged
from studylake.session import staging_path

#: Payloads of so many bytes are stored once.
LEAST_REVISIT = 1000
#: Compressed bytes at which a file ends, uncompressed bytes of a shard, shards at most.
ROLL_BYTES, SHARD_BYTES, MAX_SHARDS = 64 << 20, 16 << 20, 16_384
#: Ranks sampled for each shard's boundary; bytes of headers that a record counts besides its payload.
SAMPLED, OVERHEAD = 32, 600
#: Share of all rows beyond which a group of copies counts as hot: at most so many groups are.
HOT_GROUPS = 10_000
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6
_MIN_LONG = -(1 << 63)

MANIFEST = "shard int, seq int, path string, bytes long, records long, sha256 string"
RECORDS = ("page_id long, target_uri string, record_type string, record_id string, payload_bytes long, "
           "payload_digest string, refers_to long, refers_to_id string, path string, offset long")


# -- ranks and groups ---------------------------------------------------------

def _rank() -> Column:
    """page_id (unsigned hex, empty for null), url and digest, comparable as text."""
    page = F.coalesce(F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(_MIN_LONG))), 16, "0"), F.lit(""))
    return F.concat_ws("\0", page, F.coalesce("url", F.lit("")), "digest")


def _page_of(rank: str) -> int | None:
    page = rank.split("\0", 1)[0]
    return int(page, 16) + _MIN_LONG if page else None


def _pages(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    size = F.octet_length("payload")
    return own.withColumn("digest", F.sha2("payload", 256)).select(
        _rank().alias("rank"), F.when(size >= LEAST_REVISIT, F.col("digest")).alias("key"), size.cast("long").alias("bytes"), "payload")


def revisits(narrow: DataFrame) -> DataFrame:
    """(rank, kept): for each page whose payload stands on several pages, the rank
    of the page that keeps it. The greatest rank is that of the largest page_id.
    Groups with a share of the rows beyond 1 in HOT_GROUPS are so few that they are
    broadcast; the rows of all other groups meet in a shuffle."""
    big = narrow.filter(F.col("key").isNotNull()).select("rank", "key")
    groups = staged(big.groupBy("key").agg(F.max("rank").alias("kept"), F.count("*").alias("copies"))
                    .filter(F.col("copies") > 1), "warc-groups")
    bound = max(1000, narrow.count() // HOT_GROUPS)
    hot = big.join(F.broadcast(groups.filter(F.col("copies") > bound)), "key")
    other = big.join(groups.filter(F.col("copies") <= bound), "key")
    return hot.unionByName(other).select("rank", "kept")


def boundaries(narrow: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[str]:
    """Ranks at which shards begin, the first one's aside: equal shares of the
    bytes of a sample that a hash of the rank draws, some SAMPLED for a shard."""
    total = narrow.agg(F.count("*").alias("n"), F.sum(F.col("bytes") + OVERHEAD).alias("b")).first()
    shards = min(MAX_SHARDS, -(-(total["b"] or 0) // shard_bytes))
    if shards < 2:
        return []
    part = min(1.0, shards * SAMPLED / total["n"])
    drawn = F.xxhash64("rank") <= _MIN_LONG + int((1 << 64) * part) - 1
    rows = sorted(tuple(r) for r in narrow.filter(drawn).select("rank", "bytes").distinct().collect())  # MAX_SHARDS * SAMPLED, about
    step, at, out = sum(b + OVERHEAD for _, b in rows) / shards, 0, []
    for rank, size in rows:
        if at >= step * (len(out) + 1):
            out.append(rank)
        at += size + OVERHEAD
    return out


# -- records ------------------------------------------------------------------

def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(rank: str, ordinal: int = 0) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{rank}#{ordinal}'.encode()).digest()[:16], version=4)}>"


def _uri(rank: str) -> str:
    url = rank.split("\0", 1)[1].rsplit("\0", 1)[0]
    if not url:
        return f"urn:page:{'' if _page_of(rank) is None else _page_of(rank)}"
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _record(kind: str, headers: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    """A gzip member; the same bytes for the same record."""
    lines = [("WARC-Type", kind), ("WARC-Date", date), *headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode()) + squeeze.compress(block) + squeeze.compress(b"\r\n\r\n") + squeeze.flush()


def page_record(rank: str, ordinal: int, payload: bytes, kept: str | None, date: str = DATE) -> bytes:
    """The response record of a page, or, with ``kept``, its revisit of that rank's record."""
    page, http = _page_of(rank), f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", record_id(rank, ordinal)), ("WARC-Target-URI", _uri(rank)),
               ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", _sha1(payload)),
               ("X-Page-ID", "" if page is None else str(page))]
    if kept is None:
        return _record("response", headers, http + payload, date)
    other = _page_of(kept)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", record_id(kept)), ("WARC-Refers-To-Target-URI", _uri(kept)), ("WARC-Refers-To-Date", date),
                ("X-Refers-To-Page-ID", "" if other is None else str(other))]
    return _record("revisit", headers, http, date)


# -- files --------------------------------------------------------------------

def _full_uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tasks without Hadoop's settings need it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class _Roller:
    """Writes a shard's members to temporary files, the next one at ROLL_BYTES."""

    def __init__(self, root: str, roll_bytes: int, date: str):
        self.fs, self.root = _open_fs(root)
        self.roll, self.date, self.attempt = roll_bytes, date, uuid.uuid4().hex[:12]
        self.shard, self.seq, self.out = None, 0, None

    def add(self, shard: int, member: bytes) -> Iterator[tuple]:
        if self.out is not None and (shard != self.shard or self.bytes + len(member) > self.roll and self.records):
            yield self.close()
        if self.out is None:
            self.seq = self.seq + 1 if shard == self.shard else 0
            self.shard, self.bytes, self.records, self.sha = shard, 0, 0, hashlib.sha256()
            self.name = f"part-{shard:05d}-{self.seq:05d}.warc.gz"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/_temporary/{self.name}.{self.attempt}", compression=None)
            info = f"software: studylake\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
            self._put(_record("warcinfo", [("WARC-Record-ID", record_id(self.name)), ("WARC-Filename", self.name),
                                           ("Content-Type", "application/warc-fields")], info, self.date))
        self._put(member)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        return self.shard, self.seq, f"{self.name}.{self.attempt}", self.bytes, self.records, self.sha.hexdigest()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


_MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()),
                             ("records", pa.int64()), ("sha256", pa.string())])


def write(pages: DataFrame, root: str | None = None, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
          date: str = DATE) -> DataFrame:
    """Write the archive below ``root``, which must be new; returns its manifest,
    one row per file. Where all bytes need more than MAX_SHARDS shards, shards grow."""
    spark = pages.sparkSession
    root = _full_uri(spark, root or staging_path(spark, "llm-warc"))
    own = _pages(pages)
    narrow = staged(own.drop("payload"), "warc-ranks")
    first = spark.sparkContext.broadcast(boundaries(narrow, shard_bytes))

    @F.pandas_udf("int")
    def shard_of(rank: pd.Series) -> pd.Series:
        return rank.map(lambda r: bisect.bisect_right(first.value, r)).astype("int32")

    none = F.lit(None)
    moved = own.select("rank", F.lit(1).alias("kind"), "payload", none.cast("string").alias("kept")).unionByName(
        revisits(narrow).select("rank", F.lit(0).alias("kind"), none.cast("binary").alias("payload"), "kept"))
    shards = len(first.value) + 1
    laid = (moved.withColumn("shard", shard_of("rank")).repartitionById(shards, F.col("shard"))
            .sortWithinPartitions("shard", "rank", "kind"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, last, ordinal, kept = _Roller(root, roll_bytes, date), None, 0, None
        for batch in batches:
            done = []
            for rank, kind, payload, to, shard in zip(*(batch.column(i) for i in range(5))):
                rank = rank.as_py()
                if kind.as_py() == 0:  # stands right before its page
                    if (rank, -1) != (last, ordinal):
                        last, ordinal, kept = rank, -1, to.as_py()
                    continue
                if rank != last:
                    last, ordinal, kept = rank, -1, None
                ordinal += 1
                refers = None if kept is None or (kept == rank and ordinal == 0) else kept
                done += roller.add(shard.as_py(), page_record(rank, ordinal, payload.as_py(), refers, date))
            if done:
                yield _batch(done, _MANIFEST_ARROW)
        if roller.out is not None:
            yield _batch([roller.close()], _MANIFEST_ARROW)

    written = staged(laid.select("rank", "kind", "payload", "kept", "shard").mapInArrow(pack, MANIFEST), "warc-written")
    return commit(written, root)


def commit(written: DataFrame, root: str) -> DataFrame:
    """Give the written files their final names and write the manifest. A file
    that a broken-off attempt has already renamed stays as it is."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_fs(root)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                name = f"part-{r['shard']:05d}-{r['seq']:05d}.warc.gz"
                temporary, final = f"{base}/_temporary/{r['path']}", f"{base}/{name}"
                try:
                    fs.move(temporary, final)
                except OSError:
                    there = fs.get_file_info(final)
                    if there.type != pafs.FileType.File or there.size != r["bytes"]:
                        raise
                rows.append((r["shard"], r["seq"], f"{root}/{name}", r["bytes"], r["records"], r["sha256"]))
            yield _batch(rows, _MANIFEST_ARROW)

    path = os.path.join(root, "_manifest")
    written.mapInArrow(rename, MANIFEST).write.parquet(path)
    return written.sparkSession.read.schema(written.schema).parquet(path)


# -- reading ------------------------------------------------------------------

def _members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, compressed bytes, content) of each gzip member."""
    at, start, parts, inflate = 0, 0, [], zlib.decompressobj(31)
    while data := stream.read(1 << 20):
        while data:
            parts.append(inflate.decompress(data))
            rest = inflate.unused_data
            at += len(data) - len(rest)
            if inflate.eof:
                yield start, at - start, b"".join(parts)
                start, parts, inflate = at, [], zlib.decompressobj(31)
            data = rest
    if at != start:
        raise ValueError(f"a record at {start} breaks off")


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises where they contradict each other."""
    end = content.index(b"\r\n\r\n")
    version, *lines = content[:end].decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = content[end + 4:-4]
    if version != "WARC/1.1" or content[-4:] != b"\r\n\r\n" or int(headers["Content-Length"]) != len(block):
        raise ValueError("not a record of the stated length")
    if headers["WARC-Block-Digest"] != _sha1(block):
        raise ValueError("the block has another digest")
    return headers, block


def _number(text: str) -> int | None:
    return int(text) if text else None


def _row(path: str, offset: int, headers: dict[str, str], block: bytes) -> tuple:
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.split(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
    digest, kind = headers["WARC-Payload-Digest"], headers["WARC-Type"]
    if kind == "response" and (digest != _sha1(payload) or size != len(payload)):
        raise ValueError("the payload has another digest or length")
    return (_number(headers["X-Page-ID"]), headers["WARC-Target-URI"], kind, headers["WARC-Record-ID"], size,
            base64.b32decode(digest.removeprefix("sha1:")).hex(), _number(headers.get("X-Refers-To-Page-ID", "")),
            headers.get("WARC-Refers-To"), path, offset)


def read(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per page record of the manifest's files, in any order;
    ``with_payload`` adds the payload, null for a revisit."""
    names = [c.split(" ")[0] for c in RECORDS.split(", ")] + (["payload"] if with_payload else [])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "string": pa.string()}
        schema = pa.schema([(n, types[c.split(" ")[1]]) for n, c in zip(names, RECORDS.split(", "))]
                           + ([("payload", pa.binary())] if with_payload else []))
        for batch in batches:
            for file in batch.to_pylist():
                fs, base = _open_fs(file["path"])
                rows, held, size, records = [], 0, 0, 0
                with fs.open_input_stream(base, compression=None) as stream:
                    for offset, length, content in _members(stream):
                        try:
                            headers, block = parse(content)
                            size += length
                            if headers["WARC-Type"] == "warcinfo":
                                continue
                            row = _row(file["path"], offset, headers, block)
                        except ValueError as e:
                            raise ValueError(f"{file['path']} at {offset}: {e}") from e
                        records += 1
                        if with_payload:
                            row += (block.split(b"\r\n\r\n", 1)[1] if row[2] == "response" else None,)
                            held += len(row[-1] or b"")
                        rows.append(row)
                        if len(rows) >= 1000 or held >= 16 << 20:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if (size, records) != (file["bytes"], file["records"]):
                    raise ValueError(f"{file['path']}: {records} records in {size} bytes, not as the manifest says")
                if rows:
                    yield _batch(rows, schema)

    files = max(1, min(MAX_SHARDS, manifest.count()))
    return manifest.repartition(files).mapInArrow(unpack, RECORDS + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages and read them back: one row per page."""
    return read(write(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
