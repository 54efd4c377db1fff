"""Best-fit packing by length-histogram planning.

Documents become pieces of at most ``limit`` tokens. The plan is made over the
counts of pieces by length alone (at most ``limit`` rows): lengths are placed
from long to short, each into the open sequences with the least room that still
fits, whole groups of equal sequences at a time. The plan is a list of runs
(length, ranks, sequences, offset), bounded by the limit and not by the corpus.
Pieces then take their slots by their rank within their length. Ranks are made
from salted counts, so one hot length never meets in one task.

Nulls and odd rows: a null text counts as empty (one piece: the end id alone);
a null doc_id is carried through; repeated rows are packed once each; other
columns are ignored, whatever their names; an empty table gives an empty
result. A text longer than the limit is cut into pieces, none is dropped.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studylake.llm import tokens
from studylake.llm.common import staged

LIMIT = 2048
END_ID = 0
#: Rows of one length that a rank task handles, about; at least this many salts.
ROWS_PER_SALT, MIN_SALTS = 100_000, 256

_PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def pieces(docs: DataFrame, limit: int = LIMIT, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    path = tokenizer_path or tokens.default_path()
    end = np.array([END_ID], "<u4").tobytes()

    @F.pandas_udf(_PIECES)
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for ids in tokens.encoder(path).batch(texts.fillna("").tolist()):
            ids += end
            n = len(ids) // 4
            out.append([{"piece": k, "start": s, "length": min(limit, n - s),
                         "ids_crc32": zlib.crc32(ids[4 * s:4 * (s + limit)])}
                        for k, s in enumerate(range(0, n, limit))])
        return pd.Series(out, dtype=object)

    return docs.select("doc_id", F.explode(cut("text")).alias("p")).select("doc_id", "p.*")


@dataclass
class _Open:
    """Sequences with the same room left, as ranges of sequence numbers."""

    ranges: list[tuple[int, int]]

    def take(self, n: int) -> list[tuple[int, int]]:
        out = []
        while n > 0 and self.ranges:
            a, b = self.ranges.pop()
            if b - a > n:
                self.ranges.append((a + n, b))
                b = a + n
            out.append((a, b))
            n -= b - a
        return out

    def __len__(self) -> int:
        return sum(b - a for a, b in self.ranges)


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset): piece number
    ``first rank + i`` of that length goes to sequence ``first sequence + i``."""
    runs: list[tuple[int, int, int, int, int]] = []
    room: dict[int, _Open] = {}
    sequences = 0

    def put(length: int, rank: int, left: int, ranges: list[tuple[int, int]], free: int) -> int:
        """Fill each of the sequences with as many pieces of a length as fit."""
        fit = free // length
        for a, b in ranges:
            n = b - a
            full, rest = divmod(left, fit)
            full = min(full, n)
            if full:
                for j in range(fit):
                    runs.append((length, rank, full, a, limit - free + j * length))
                    rank += full
                left -= full * fit
                room.setdefault(free - fit * length, _Open([])).ranges.append((a, a + full))
            if full < n:  # the last pieces, in one sequence; what is behind stays as it was
                rest = left
                for j in range(rest):
                    runs.append((length, rank + j, 1, a + full, limit - free + j * length))
                rank, left = rank + rest, 0
                used = a + full + (1 if rest else 0)
                if rest:
                    room.setdefault(free - rest * length, _Open([])).ranges.append((a + full, used))
                if used < b:
                    room.setdefault(free, _Open([])).ranges.append((used, b))
        return left

    for length in sorted(counts, reverse=True):
        left, total = counts[length], counts[length]
        for free in sorted(r for r in room if r >= length):
            if not left:
                break
            fit = free // length
            found = room[free].take(-(-left // fit))
            left = put(length, total - left, left, found, free)
        if left:
            fresh = -(-left // (limit // length))
            left = put(length, total - left, left, [(sequences, sequences + fresh)], limit)
            sequences += fresh
        for r in [r for r, o in room.items() if not o.ranges or r == 0]:
            del room[r]
    return runs


def pack(docs: DataFrame, limit: int = LIMIT, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece with its place: sequence_id and offset."""
    cut = staged(pieces(docs, limit, tokenizer_path), "pieces")
    # one salted count serves the histogram and the ranks
    by_length = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(MIN_SALTS, sum(by_length.values()) // ROWS_PER_SALT)
    runs = plan(by_length, limit)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
               .select(F.col("length").alias("l"), F.col("salt").alias("s"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(within) - 1)
              .join(offsets, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
              .select(*cut.columns, (F.col("rank") + F.col("before")).alias("rank")))

    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    first = np.searchsorted(table[:, 0], np.arange(limit + 2))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.empty(len(length), np.int64)
        ls, rs = length.to_numpy(), rank.to_numpy()
        for one in np.unique(ls):
            a, b = first[one], first[one + 1]
            own = ls == one
            at[own] = a + np.searchsorted(table[a:b, 1], rs[own], side="right") - 1
        return pd.DataFrame({"sequence_id": table[at, 3] + rs - table[at, 1], "offset": table[at, 4]})

    return ranked.withColumn("slot", slot("length", "rank")).select(*cut.columns, "slot.sequence_id", "slot.offset")
