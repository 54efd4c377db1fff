"""Sharding by histogram sort, with DataFrame functions only.

Rows get a 63-bit sort key: 38 bits of the text's hash, then 25 bits of the
id's hash. Equal texts are therefore neighbours and share a shard unless a
boundary must pass through them. The splitters are found by counting: a first
pass counts the bytes and rows below evenly spaced candidate boundaries; each
later pass refines only the intervals that a splitter falls into, until every
splitter is within the tolerance or its interval is a single key. Then the rows
are exchanged once, by the range between two splitters.

Besides the shard boundaries, finer ones cut each shard into ranges of bounded
rows, so slots are numbered per range and shifted by the exact count of rows
below it: no shard meets in one task.

Nulls and odd rows: a null text has no bytes (size 16, checksum 0) and sorts
with the empty ones; a null doc_id gets a key as any other; rows that are equal
in both text and id have one key and stay together; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studylake.llm.common import staged, text_of

ROW_BYTES = 16
TEXT_BITS, ID_BITS = 38, 25
KEY_BITS = TEXT_BITS + ID_BITS
#: Candidate boundaries: 2^12 in the first pass, 2^9 more inside each interval that holds a splitter.
FIRST_BITS, MORE_BITS = 12, 9
#: A splitter may miss its target by this part of a shard.
TOLERANCE = 0.0005
#: Rows of a range inside a shard, about, and how many times these make it hot.
RANGE_ROWS, HOT = 250_000, 4
#: Bits of the id that cut a hot text.
SPREAD_BITS = 14


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the sort key of each row."""
    text = text_of("text")
    low = lambda h, bits: h.bitwiseAND(F.lit((1 << bits) - 1))
    key = F.shiftleft(low(F.xxhash64(text), TEXT_BITS), ID_BITS).bitwiseOR(low(F.xxhash64(F.lit(7), "doc_id"), ID_BITS))
    return docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), key.alias("key"))


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> tuple[list[int], int]:
    """The first key of each shard but the first, and the number of rows."""
    def counted(frame: DataFrame, shift: int) -> list[tuple[int, int, int, int]]:
        found = (frame.groupBy(F.shiftright("key", shift).alias("cell"))
                 .agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect())
        return [(r["cell"] << shift, shift, r["bytes"], r["n"]) for r in found]

    cells = sorted(counted(rows, KEY_BITS - FIRST_BITS))
    total, n_rows = sum(c[2] for c in cells), sum(c[3] for c in cells)
    if not total:
        return [], 0
    targets = [total * i / shards for i in range(1, shards)]
    while True:
        below, at = [0], 0
        for c in cells:
            at += c[2]
            below.append(at)
        coarse: set[tuple[int, int]] = set()
        for goal in targets:
            i = bisect_right(below, goal) - 1
            if i >= len(cells) or not cells[i][1]:
                continue
            miss = min(goal - below[i], below[i + 1] - goal)
            if miss > tolerance * total / shards:
                coarse.add(cells[i][:2])
        if not coarse:
            break
        refined = []
        for shift in sorted({s for _, s in coarse}):
            inside = [k >> shift for k, s in coarse if s == shift]
            # at most one cell for each boundary, so the list is bounded
            refined += counted(rows.filter(F.shiftright("key", shift).isin(inside)), max(0, shift - MORE_BITS))
        cells = sorted([c for c in cells if c[:2] not in coarse] + refined)
    below = [0]
    for c in cells:
        below.append(below[-1] + c[2])
    cuts = []
    for goal in targets:
        k = min(max(bisect_right(below, goal) - 1, 0), len(cells) - 1)
        if below[k + 1] - goal < goal - below[k]:
            k += 1
        cuts.append(cells[k][0] if k < len(cells) else (1 << KEY_BITS) - 1)
    return cuts, n_rows


def _place(key: Column, cuts: list[int]) -> Column:
    """The number of cuts at or below a key, by binary search over a literal array."""
    if not cuts:
        return F.lit(0)
    steps = len(cuts).bit_length()
    padded = cuts + [(1 << 63) - 1] * ((1 << steps) - 1 - len(cuts))
    # a constant of the plan: one number for each boundary
    table = F.split(F.lit(",".join(map(str, padded))), ",").cast("array<bigint>")
    halves = F.array(*[F.lit(1 << s) for s in reversed(range(steps))])
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(table, at + half - 1) <= key, at + half).otherwise(at))


def ranges(placed: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``range``: the key's prefix, as long as RANGE_ROWS ask for, and longer in
    hot prefixes. Ranges follow the order of keys. Hot prefixes are at most
    n_rows / (HOT * RANGE_ROWS)."""
    fine = ID_BITS - SPREAD_BITS  # the bits that the longest prefix leaves out
    bits = min(TEXT_BITS, max(0, (n_rows // RANGE_ROWS).bit_length()))
    prefix = F.shiftright("key", KEY_BITS - bits)
    if n_rows <= HOT * RANGE_ROWS:  # no prefix can be hot
        return placed.withColumn("range", prefix)
    hot = placed.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n")).filter(F.col("n") > HOT * RANGE_ROWS).select("prefix")
    marked = placed.withColumn("prefix", prefix).join(F.broadcast(hot.withColumn("hot", F.lit(True))), "prefix", "left")
    whole = F.shiftleft("prefix", KEY_BITS - bits - fine)
    return marked.withColumn("range", F.when(F.col("hot"), F.shiftright("key", fine)).otherwise(whole)).drop("prefix", "hot")


def shard(docs: DataFrame, shards: int = 40, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: its shard by near equal bytes, and its slot there."""
    rows = staged(keyed(docs), "shard-keys")
    cuts, n_rows = splitters(rows, shards, tolerance)
    placed = ranges(rows.withColumn("shard", _place(F.col("key"), cuts)), n_rows)
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
              .select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))  # over ranges, not rows
    number = F.row_number().over(Window.partitionBy("shard", "range").orderBy("key", "doc_id", "size", "text_crc32")) - 1
    return placed.withColumn("number", number).join(counts, ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("number") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
