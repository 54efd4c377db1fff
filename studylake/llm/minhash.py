"""MinHash near-dedup by tensored banding.

Two small collections of hashes are kept, each of ``GROUPS`` groups of
``EACH`` minhashes. A table key combines a group of the first collection with a
group of the second: GROUPS * GROUPS tables from 2 * GROUPS * EACH minhashes, in
place of GROUPS * GROUPS * 2 * EACH. Two documents meet in a table where both
groups agree, so in some table exactly where they agree on any group of each
collection.

1. Documents with the same word sequence are one class, whose smallest id
   stands for it.
2. A class that shares no group of either collection with another has no
   partner and drops out; only the others get table keys.
3. In each table cell, members are compared with the cell's leader (two
   leaders by different orders); links are confirmed on the full shingle sets,
   and components are formed.
4. Clusters of candidates that still hold more than one component are finished:
   the members outside the largest component are compared with all members of
   other components, by matrix products of shingle sets in bounded blocks that
   return links and no pairs. So no candidate pair is left out that could join
   two components, and thousands of near copies of one document that link with
   each other cost one comparison a member.

Every link is confirmed on the words themselves.

Nulls and odd rows: a null or blank text has an empty set and is linked with
nothing; a document with fewer words than a shingle has its whole sequence as
its one shingle. A doc_id is taken to be an id: repeated rows share their component,
and rows that repeat an id with other texts are compared by the greatest of
them. A null doc_id makes no link; its row shows the component of its copies,
if there are any, is not ``kept`` in the report and stays in ``keep``. Other
columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.llm import words as W
from studylake.llm.common import fresh, staged, text_of
from studylake.llm.components import components

GROUPS, EACH = 12, 3
HASHES = 2 * GROUPS * EACH
SEED = 99
#: Documents of a block in which whole sets are compared; characters of text in a task, about.
BLOCK, TASK_CHARS = 256, 8 << 20

_rng = np.random.default_rng(SEED)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)

_SKETCH = T.StructType([
    T.StructField("n_shingles", T.LongType()), T.StructField("c1", T.LongType()), T.StructField("c2", T.LongType()),
    T.StructField("sig", T.ArrayType(T.IntegerType()))])


def _lower(data: str) -> bytes:
    """UTF-8 bytes with A-Z in lower case."""
    return data.encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only


def _shingles(block: W.Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and their documents, ascending by document; short documents have one."""
    h, doc = W.windows(block, width)
    ok = doc >= 0
    h, doc = h[ok], doc[ok]
    short = np.flatnonzero((block.n_words > 0) & (block.n_words < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(block.n_words)])
        extra = np.array([_sequence(block.hashes[first[d]:first[d + 1]]) for d in short], np.uint64)
        h, doc = np.concatenate([h, extra]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return h, doc


def _sequence(h: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        out = np.uint64(len(h))
        for x in h:
            out = W.mix(np.array([out * np.uint64(0x9E3779B97F4A7C15) + x], np.uint64))[0]
    return out


def _contents(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each document's word sequence."""
    first = np.concatenate([[0], np.cumsum(block.n_words)])
    place = (np.arange(len(block.hashes)) - first[block.doc]).astype(np.uint64)
    out = []
    for salt in (np.uint64(3), np.uint64(5)):
        v = W.mix(block.hashes * (place * np.uint64(2) + salt) + place)
        total = np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])
        out.append(W.mix(total[first[1:]] - total[first[:-1]] + block.n_words.astype(np.uint64)))
    return out[0], out[1]


def sketch(texts: list[str], width: int) -> pd.DataFrame:
    """Set size, content hashes and minhashes of each text."""
    parts = []
    for block in W.blocks([_lower(t) for t in texts]):
        h, doc = _shingles(block, width)
        order = np.lexsort((h, doc))
        hs, ds = h[order], doc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
        hs, ds = hs[new], ds[new]
        n = np.bincount(ds, minlength=block.n_docs)
        full = np.flatnonzero(n)
        sig = np.zeros((block.n_docs, HASHES), np.int32)
        if len(full):
            starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
            for k in range(HASHES):
                low = np.minimum.reduceat(hs * _A[k] + _B[k], starts)
                sig[full, k] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32) ^ low.astype(np.uint32).view(np.int32)
        c1, c2 = _contents(block)
        parts.append(pd.DataFrame({"n_shingles": n, "c1": c1.view(np.int64), "c2": c2.view(np.int64), "sig": list(sig)}))
    if not parts:
        return pd.DataFrame({"n_shingles": [], "c1": [], "c2": [], "sig": []})
    return pd.concat(parts, ignore_index=True)


def _sketcher(width: int):
    @F.pandas_udf(_SKETCH)
    def run(texts: pd.Series) -> pd.DataFrame:
        return sketch(texts.fillna("").tolist(), width)

    return run


def _group_key(collection: int, i: int) -> Column:
    """A hash of group i of a collection."""
    at = (collection * GROUPS + i) * EACH
    return F.xxhash64(F.lit(collection * GROUPS + i), *[F.get("sig", F.lit(at + k)) for k in range(EACH)])


def _with_partner(classes: DataFrame) -> DataFrame:
    """Classes that share a group of each collection with some other class."""
    groups = F.array(*[F.struct(F.lit(c).alias("c"), _group_key(c, i).alias("g")) for c in (0, 1) for i in range(GROUPS)])
    rows = classes.select("id", F.explode(groups).alias("x")).select("id", "x.c", "x.g")
    # written first, so that the join below may split a hot group
    shared = staged(rows.groupBy("c", "g").agg(F.count("*").alias("n")).filter("n > 1").select("c", "g"), "minhash-groups")
    both = rows.join(shared, ["c", "g"]).groupBy("id").agg(F.countDistinct("c").alias("both")).filter("both = 2")
    return classes.join(both.select("id"), "id")


def _cells(classes: DataFrame, columns: list[str]) -> DataFrame:
    """One row per class and table: the table key."""
    first = F.array(*[_group_key(0, i) for i in range(GROUPS)])
    second = F.array(*[_group_key(1, i) for i in range(GROUPS)])
    keyed = classes.select(*columns, first.alias("first"), second.alias("second"))
    pairs = F.explode(F.flatten(F.transform("first", lambda a: F.transform("second", lambda b: F.xxhash64(a, b)))))
    return keyed.select(*columns, pairs.alias("key"))


def _similar(a: list[bytes], b: list[bytes], width: int, inter: int, union: int) -> bool:
    x, y = _set(a, width), _set(b, width)
    if not x or not y:
        return False
    both = len(x & y)
    return inter * both >= union * (len(x) + len(y) - both)


def _set(ws: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if not ws:
        return set()
    if len(ws) < width:
        return {tuple(ws)}
    return set(zip(*[ws[k:] for k in range(width)]))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough on their full shingle sets of words."""
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out, seen = [], {}
        for x, y in zip(left, right, strict=True):
            own = seen.get(y)
            if own is None:  # a leader meets many members in a row
                seen = {y: _lower(y).split()}
                own = seen[y]
            out.append(_similar(_lower(x).split(), own, width, 100, percent))
        return pd.Series(out, dtype=bool)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(similar("text_a", "text_b")).select("a", "b")


def _leaders(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of a member and a cell's leader: for each member the leader that it
    meets in most tables, by each of two orders; and all pairs of the first."""
    best, every = None, None
    for salt in (1, 2):
        lead = cells.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(salt), "id").alias("o"), "id")).alias("l"),
                                        F.count("*").alias("n")).filter("n > 1").select("key", F.col("l.id").alias("b"))
        lead = staged(lead, "minhash-leaders")
        met = (cells.select("key", F.col("id").alias("a")).join(lead, "key").filter("a <> b")
               .groupBy("a", "b").agg(F.count("*").alias("tables")))
        met = staged(met, "minhash-met")
        own = met.groupBy("a").agg(F.max(F.struct("tables", (-F.col("b")).alias("b"))).alias("m")).select("a", (-F.col("m.b")).alias("b"))
        best = own if best is None else best.unionByName(own)
        every = met.select("a", "b") if every is None else every
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), every


def _sets(texts: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, the text of each, and the size of each text's set."""
    found, owner = [], []
    for block in W.blocks([_lower(t) for t in texts]):
        h, doc = _shingles(block, width)
        found.append(h)
        owner.append(doc + block.first)
    h, doc = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, doc, np.bincount(doc, minlength=len(texts))


def _shared(x: tuple, y: tuple) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    common = np.intersect1d(x[0], y[0])
    out = np.zeros((len(x[2]), len(y[2])), np.float32)
    for at in range(0, len(common), 4096):  # slices of shingles keep the matrices small
        part = common[at:at + 4096]
        both = []
        for h, doc, n in (x, y):
            k = np.searchsorted(part, h)
            ok = (k < len(part)) & (part[np.minimum(k, len(part) - 1)] == h)
            m = np.zeros((len(n), len(part)), np.float32)
            m[doc[ok], k[ok]] = 1
            both.append(m)
        out += both[0] @ both[1].T
    return out


def _open_tasks(rows: DataFrame, texts: DataFrame) -> int:
    """Tasks for the blocks of open clusters, by the text that they get: each
    text once for every block that it meets."""
    times = F.col("out_blocks") + F.when(F.col("comp") != F.col("top"), F.col("blocks")).otherwise(0)
    chars = texts.select("id", F.length("text").cast("long").alias("chars"))
    total = rows.join(chars, "id").agg(F.sum(F.col("chars") * times)).first()[0] or 0
    return max(256, int(total) // TASK_CHARS)


def _remaining(every: DataFrame, labels: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components among documents that can have met in a cell.

    Whoever shares a cell is linked to its leader, so candidates lie within one
    component of the member-leader table. Where such a cluster holds several
    components of confirmed links, the documents outside the largest are compared
    with all others, by intersections of whole shingle sets in blocks of bounded
    size. Of the links of a document to one component, one is returned."""
    clusters = components(every).withColumnRenamed("component_id", "cluster")
    known = clusters.join(labels, "id", "left").select("id", "cluster", F.coalesce("component_id", "id").alias("comp"))
    known = staged(known, "minhash-known")
    sizes = known.groupBy("cluster", "comp").agg(F.count("*").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    several = (sizes.groupBy("cluster").agg(F.count("*").alias("comps"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"))
               .filter("comps > 1").select("cluster", F.col("top.comp").alias("top"), blocks(F.col("n")).alias("blocks"),
                                           blocks(F.col("n") - F.col("top.n")).alias("out_blocks")))
    rows = staged(known.join(staged(several, "minhash-open"), "cluster"), "minhash-open-rows")
    hash_ = F.xxhash64(F.lit(3), "id")
    left = rows.filter("comp <> top").select("id", "cluster", "comp", F.lit(True).alias("out"), F.pmod(hash_, "out_blocks").cast("int").alias("i"),
                                             F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    right = rows.select("id", "cluster", "comp", F.lit(False).alias("out"),
                        F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)).alias("i"), F.pmod(hash_, "blocks").cast("int").alias("j"))
    task = F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(_open_tasks(rows, texts))).cast("int")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, part in group.groupby(["cluster", "i", "j"], sort=False):
            x, y = part[part["out"]], part[~part["out"]]
            if not len(x) or not len(y):
                continue
            sx, sy = _sets(x["text"], width), _sets(y["text"], width)
            both = _shared(sx, sy).astype(np.int64)
            union = sx[2][:, None] + sy[2][None] - both
            comps = y["comp"].to_numpy()
            linked = (100 * both >= percent * union) & (both > 0) & (x["comp"].to_numpy()[:, None] != comps[None])
            ids_x, ids_y = x["id"].to_numpy(), y["id"].to_numpy()
            for r in np.flatnonzero(linked.any(1)):
                one = np.flatnonzero(linked[r])
                one = one[np.unique(comps[one], return_index=True)[1]]
                a += [ids_x[r]] * len(one)
                b += ids_y[one].tolist()
        return pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})

    both = left.unionByName(right).join(texts, "id").withColumn("task", task)
    found = both.groupBy("task").applyInPandas(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _clusters(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of all documents (doc_id, n_shingles, c1, c2) and the component
    of each content class (c1, c2, component_id)."""
    sketches = staged(docs.select("doc_id", _sketcher(width)("text").alias("s")).select("doc_id", "s.*"), "minhash-sketches")
    # copies: the smallest id stands for its class; the sketch is the same for all
    classes = (sketches.filter("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2")
               .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")))
    classes = staged(classes, "minhash-classes")
    # ids that several texts share join their classes
    near = staged(_with_partner(classes), "minhash-near")
    ids = near.select("id")
    texts = staged(docs.select(F.col("doc_id").alias("id"), text_of("text").alias("text")).join(ids, "id", "left_semi")
                   .groupBy("id").agg(F.max("text").alias("text")), "minhash-texts")
    cells = staged(_cells(near, ["id"]), "minhash-cells")
    best, every = _leaders(cells)
    links = staged(_confirmed(best, texts, width, percent), "minhash-links")
    labels = components(links)
    more = staged(_confirmed(_remaining(every, labels, texts, width, percent), texts, width, percent), "minhash-more")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    found = classes.join(labels, "id", "left").select("c1", "c2", F.coalesce("component_id", "id").alias("component_id"))
    return sketches, staged(found, "minhash-components")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept."""
    sketches, found = _clusters(docs.select("doc_id", "text"), width, percent)
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (sketches.select("doc_id", "n_shingles", "c1", "c2").join(found, ["c1", "c2"], "left")
            .select("doc_id", "n_shingles", F.coalesce(own, F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def keep(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: the smallest id. A null
    id stays. Rows that repeat an id all stay or all go with it."""
    drop, ident = near_duplicates(docs, width, percent).filter("doc_id is not null and not kept"), fresh("drop")
    drop = staged(drop.select(F.col("doc_id").alias(ident)).distinct(), "minhash-dropped")
    return docs.join(drop, docs["doc_id"] == drop[ident], "left_anti")
