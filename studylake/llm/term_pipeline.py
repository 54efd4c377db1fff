"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to a few owners, documents to blocks of bounded size. One pass
over the documents writes the index: a row per block and owner with the postings
of the owner's terms (only terms that some item holds matter). Items travel in
bundles: a bundle is a group of items within a block, with a sparse accumulator
for each document that has scored. In every stage each bundle visits one owner,
another one in each stage, so all owners work all the time; the visit is a cogroup
of bundles and postings on (owner, block), and adds the integer contributions of
the owner's terms. After the last visit each block names its best documents for
each item, and the best of those are the result.

Exact pruning: an accumulator is dropped where, with all that the owners still to
come can add, it stays below ten others of its block that are sure of more.

Counts that the weights need (N, L and df) are summed from the index. A bundle and
a block's postings are the most that a task call holds. The items are a stated
query set; they and their terms are broadcast in rounds of bounded size.

Nulls and odd rows: a null or empty text has no terms and is not counted in N; an
item without terms, or one that no document matches, has no rows. Every row of
either table stands for itself, so repeated documents are ranked each, and
repeated items answered each. Equal scores rank by doc_id, null last. Texts of any
length are read in pieces cut between terms. Other columns are ignored, whatever
their names; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studylake.llm.common import staged

OWNERS = 3
TOP = 10
#: A block ends at so many documents, or at so many bytes of text.
BLOCK_DOCS, BLOCK_BYTES = 4096, 16 << 20
#: Items of a bundle, and bytes of item texts that one round broadcasts.
BUNDLE_ITEMS, ROUND_BYTES = 100, 64 << 20
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

#: Bytes of terms: digits, letters (lower-cased) and all of non-ASCII characters; others separate.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term (as UTF-8 bytes) in a whole text."""
    out: Counter = Counter()
    data = (text or "").encode().translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= PIECE else data.rfind(b" ", at, at + PIECE)
        if end <= at:  # a term longer than a piece
            end = data.find(b" ", at + PIECE)
            end = len(data) if end < 0 else end
        out.update(data[at:end].split())
        at = end + 1
    return out


def _narrow(a: np.ndarray) -> np.ndarray:
    """The same non-negative integers in the narrowest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


class _Block:
    """Documents of a block under construction."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: list[list[int]] = [[] for _ in range(OWNERS)]
        self.at: list[list[int]] = [[] for _ in range(OWNERS)]
        self.tf: list[list[int]] = [[] for _ in range(OWNERS)]

    def add(self, doc_id: int | None, text: str | None, numbers: dict[bytes, int]) -> None:
        counts = term_counts(text)
        place = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        self.bytes += len(text or "")
        for term in counts.keys() & numbers.keys():
            of = numbers[term]
            owner = of % OWNERS
            self.terms[owner].append(of)
            self.at[owner].append(place)
            self.tf[owner].append(counts[term])

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.bytes >= BLOCK_BYTES

    def rows(self) -> pa.RecordBatch:
        lengths = np.array(self.lengths, np.int64)
        docs = pickle.dumps((pa.array(self.ids, pa.int64()), _narrow(lengths)))
        directory, postings = [], []
        for o in range(OWNERS):
            terms = np.array(self.terms[o], np.int64)
            order = np.argsort(terms, kind="stable")
            own, counts = np.unique(terms, return_counts=True)
            directory.append(pickle.dumps((_narrow(own), _narrow(counts))))
            postings.append(pickle.dumps((_narrow(np.array(self.at[o], np.int64)[order]), _narrow(np.array(self.tf[o], np.int64)[order]))))
        first = [o == 0 for o in range(OWNERS)]
        return pa.RecordBatch.from_arrays([
            pa.array([self.number] * OWNERS, pa.int64()), pa.array(range(OWNERS), pa.int32()),
            pa.array([int((lengths > 0).sum()) if f else 0 for f in first], pa.int64()),
            pa.array([int(lengths.sum()) if f else 0 for f in first], pa.int64()),
            pa.array([docs] * OWNERS, pa.binary()), pa.array(directory, pa.binary()), pa.array(postings, pa.binary())],
            ["block", "owner", "docs_with_terms", "n_terms", "docs", "directory", "postings"])


INDEX = "block long, owner int, docs_with_terms long, n_terms long, docs binary, directory binary, postings binary"


def build_index(docs: DataFrame, numbers) -> DataFrame:
    """The staged index: one scan, no shuffle. ``numbers`` is a broadcast dict of
    the items' terms. A block's number holds its task and its place there."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        block = _Block(number)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                block.add(doc_id.as_py(), text.as_py(), numbers.value)
                if block.full():
                    yield block.rows()
                    number += 1
                    block = _Block(number)
        if block.ids:
            yield block.rows()

    return staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(index, INDEX), "term-index")


def document_frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """Documents holding each of the items' terms, summed in each task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                own, counts = pickle.loads(cell.as_py())
                df[own] += counts
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held], pa.int64())], ["term", "df"])

    out = np.zeros(terms, np.int64)
    for r in index.select("directory").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]  # one row for each of the items' terms
    return out


def _pack(scores: np.ndarray) -> bytes:
    """Accumulators as a bitmap of those above zero and the planes of their bytes."""
    flat = scores.ravel()
    held = flat > 0
    planes = flat[held].astype("<i8").view(np.uint8).reshape(-1, 8).T
    used = next((k for k in range(8, 0, -1) if planes[k - 1].any()), 0)
    return pickle.dumps((np.packbits(held), planes[:used].copy()))


def _unpack(cell: bytes, shape: tuple[int, int]) -> np.ndarray:
    bits, planes = pickle.loads(cell)
    flat = np.zeros(shape[0] * shape[1], np.int64)
    wide = np.zeros((8, planes.shape[1]), np.uint8)
    wide[:len(planes)] = planes
    flat[np.unpackbits(bits, count=len(flat)).astype(bool)] = np.ascontiguousarray(wide.T).view("<i8").ravel()
    return flat.reshape(shape)


def _prune(scores: np.ndarray, rest: np.ndarray, top: int) -> None:
    """Clear accumulators that cannot come under the block's best any more."""
    if scores.shape[1] <= top:
        return
    sure = np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]
    scores[scores + rest[:, None] < sure[:, None]] = 0


def contribution(w: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def rank(items: DataFrame, docs: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents."""
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    rounds = max(1, -(-size // ROUND_BYTES))
    out = None
    for r in range(rounds):
        part = items if rounds == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == r)
        rows = part.select(F.col("item_id").cast("long"), "text").collect()  # bounded by ROUND_BYTES, about
        found = _rank_round(spark, sorted(map(tuple, rows), key=lambda t: (t[0] is None, t[0] or 0, t[1] or "")), docs, top)
        out = found if out is None else out.unionByName(found)
    return out


def _rank_round(spark, items: list[tuple], docs: DataFrame, top: int) -> DataFrame:
    held = [sorted(term_counts(t)) for _, t in items]
    numbers = {t: i for i, t in enumerate(sorted({t for ts in held for t in ts}))}
    terms = [[numbers[t] for t in ts] for ts in held]
    index = build_index(docs, spark.sparkContext.broadcast(numbers))
    totals = index.agg(F.sum("docs_with_terms").alias("N"), F.sum("n_terms").alias("L")).first()
    big_n, big_l = totals["N"] or 0, totals["L"] or 0
    df = document_frequencies(index, len(numbers))
    weights = [math.floor(1000 * math.log((2 * big_n + 2) / (2 * int(d) + 1))) for d in df]

    # bundles: item i belongs to one of so many groups that each holds a bounded number, and groups start at every owner
    groups = OWNERS * max(1, -(-len(items) // (OWNERS * BUNDLE_ITEMS)))
    members = [list(range(g, len(items), groups)) for g in range(groups)]
    # owner and group → term → places of the items that hold it
    asked: dict[tuple[int, int], dict[int, list[int]]] = {}
    most = np.zeros((OWNERS, len(items)), np.int64)  # an owner's largest possible addition to an item
    for i, ts in enumerate(terms):
        for t in ts:
            asked.setdefault((t % OWNERS, i % groups), {}).setdefault(t, []).append(i // groups)
            most[t % OWNERS, i] += weights[t] * 1_000_000
    plan = spark.sparkContext.broadcast((asked, members, most, weights, [i for i, _ in items]))
    per_doc = 90 * big_n

    def visit(stage: int):
        last = stage == OWNERS - 1

        def add(bundles: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
            asked, members, most, weights, ids = plan.value
            cells = []
            if len(bundles) and len(blocks):
                block = blocks.iloc[0]
                owner = int(block["owner"])
                doc_ids, lengths = pickle.loads(block["docs"])
                own, counts = pickle.loads(block["directory"])
                at, tf = pickle.loads(block["postings"])
                n = lengths.astype(object if int(lengths.max()) * per_doc >= 1 << 63 else np.int64)
                m = (10 + n * per_doc // max(1, big_l)).astype(np.int64)
                ends = np.cumsum(counts.astype(np.int64))
                for group, packed in zip(bundles["grp"], bundles["scores"]):
                    shape = len(members[group]), len(doc_ids)
                    scores = np.zeros(shape, np.int64) if packed is None else _unpack(packed, shape)
                    wanted = asked.get((owner, group), {})
                    for term, a, b in zip(own.tolist(), (ends - counts).tolist(), ends.tolist()):
                        if term in wanted and weights[term]:
                            docs_of = at[a:b].astype(np.int64)
                            gain = contribution(weights[term], tf[a:b].astype(np.int64), m[docs_of])
                            for place in wanted[term]:
                                scores[place, docs_of] += gain
                    to_come = [(owner + s) % OWNERS for s in range(1, OWNERS - stage)]
                    rest = most[to_come][:, members[group]].sum(axis=0) if to_come else np.zeros(shape[0], np.int64)
                    _prune(scores, rest, top)
                    if not last:
                        cells.append((block["block"], group, _pack(scores)))
                        continue
                    by_id = np.array([(1 << 63) - 1 if d is None else d for d in doc_ids.to_pylist()], np.int64)
                    nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
                    for place, item in enumerate(members[group]):
                        scored = np.flatnonzero(scores[place])
                        best = scored[np.lexsort((by_id[scored], nulls[scored], -scores[place, scored]))[:top]]
                        cells += [(item, ids[item], None if nulls[d] else int(by_id[d]), int(scores[place, d])) for d in best]
            if last:
                out = pd.DataFrame(cells, columns=["item", "item_id", "doc_id", "score"])
                return out.astype({"item": "int64", "item_id": "Int64", "doc_id": "Int64", "score": "int64"})
            return pd.DataFrame(cells, columns=["block", "grp", "scores"])

        return add

    # every bundle starts empty at the owner of its group's number
    bundles = index.filter("owner = 0").select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(None).cast("binary").alias("scores"))
    for stage in range(OWNERS):
        at_owner = F.pmod(F.col("grp") + F.lit(stage), F.lit(OWNERS)).cast("int")
        schema = ("item long, item_id long, doc_id long, score long" if stage == OWNERS - 1
                  else "block long, grp int, scores binary")
        bundles = (bundles.withColumn("owner", at_owner).groupBy("owner", "block")
                   .cogroup(index.groupBy("owner", "block")).applyInPandas(visit(stage), schema))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (bundles.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
