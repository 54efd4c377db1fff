"""Embedding near-dedup by lattice hashing.

Each table projects a unit vector at random to two blocks of eight dimensions
and decodes each block to the nearest point of the E8 lattice; the two points
are the vector's home cell. A vector also probes the neighbouring cells that
are nearest to it. Two vectors are candidates where one's home cell is home to
the other or probed by it, in any table. In a cell, all that are at home there
are compared with each other and with the visitors, by matrix products of
blocks of bounded size, and the cosine is taken in double precision.

A link is counted in the first table and cell that can see it, which each cell
works out from the two vectors alone; so a cell reports counts and a spanning
set of links per vector, never the pairs of a large group.

Vectors with equal components are one class that stands for its copies. Vectors
of each length are hashed by projections of their own, and only vectors of one
length meet in a cell.

Nulls and odd rows: a null vector, one without components, of zero norm or with
null or non-finite components links with nothing; a null vec_id is carried
through and links with nothing; rows that repeat an id and vector count as
copies of each other; other columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.common import staged
from studylake.llm.components import components

TABLES, PROBES, SCALE, SEED = 18, 8, 0.65, 4
DIM, PARTS = 8, 2
#: Rows of a block in a cell's matrix products.
BLOCK = 512
#: Cell rows that one task call handles, about.
GROUP_ROWS = 4000


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of one, or all of one half with an even number below zero."""
    out = []
    for i, j in itertools.combinations(range(DIM), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(DIM)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=DIM):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


ROOTS = _roots()
_MIX = np.random.default_rng(SEED).integers(1, 2**62, PARTS * DIM, dtype=np.int64) * 2 + 1


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole entries of even sum."""
    near = np.rint(x)
    miss = x - near
    odd = (near.sum(1).astype(np.int64) & 1) == 1
    rows, worst = np.arange(len(x)), np.abs(miss).argmax(1)
    near[rows, worst] += np.where(odd, np.where(miss[rows, worst] >= 0, 1.0, -1.0), 0.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: whole or half-way entries, whichever is nearer."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def projections(dim: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim)).normal(0, SCALE, (TABLES, dim, PARTS * DIM))


@functools.lru_cache(maxsize=8)
def _matrix(dim: int) -> np.ndarray:
    return projections(dim)


def _cell(points: np.ndarray) -> np.ndarray:
    """A 64-bit name of lattice points (..., PARTS * DIM), exact in doubled coordinates."""
    with np.errstate(over="ignore"):
        h = (np.rint(points * 2).astype(np.int64) * _MIX).sum(-1)
        h ^= h >> 29
        h = h * np.int64(0x1B873593CC9E2D51 | 1)
        return h ^ (h >> 32)


def cells(unit: np.ndarray, table: int, matrix: np.ndarray) -> np.ndarray:
    """Home cell and then the probed cells of each vector in a table: (n, 1 + PROBES)."""
    y = unit @ matrix[table]
    near, cost = [], []
    for p in range(PARTS):
        part = y[:, p * DIM:(p + 1) * DIM]
        home = decode(part)
        # a neighbour's distance exceeds the home's by 2 - 2 <residual, root>
        extra = 2 - 2 * (part - home) @ ROOTS.T
        best = np.argpartition(extra, PROBES, axis=1)[:, :PROBES]
        by = np.take_along_axis(extra, best, 1)
        order = np.argsort(by, axis=1, kind="stable")
        best, by = np.take_along_axis(best, order, 1), np.take_along_axis(by, order, 1)
        near.append(np.concatenate([home[:, None], home[:, None] + ROOTS[best]], 1))
        cost.append(np.concatenate([np.zeros((len(y), 1)), by], 1))
    total = (cost[0][:, :, None] + cost[1][:, None, :]).reshape(len(y), -1)
    pick = np.argsort(total, axis=1, kind="stable")[:, :1 + PROBES]
    a, b = pick // (1 + PROBES), pick % (1 + PROBES)
    points = np.concatenate([np.take_along_axis(near[0], a[..., None], 1), np.take_along_axis(near[1], b[..., None], 1)], 2)
    return _cell(points)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _first_seen(codes: np.ndarray, table: int, cell: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether this table and cell are the ones that count the links i-j;
    codes: (n, tables, 1 + PROBES), home first."""
    ok = np.ones(len(i), bool)
    for t in range(table):
        a, b = codes[i, t], codes[j, t]
        ok &= ~((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1))
    a, b = codes[i, table], codes[j, table]
    # of two cells of one table, the smaller that sees the link
    at_a, at_b = (b == a[:, :1]).any(1), (a == b[:, :1]).any(1)
    low = np.where(at_a & at_b, np.minimum(a[:, 0], b[:, 0]), np.where(at_a, a[:, 0], b[:, 0]))
    return ok & (low == cell)


def _compare(table: int, cell: int, left: pd.DataFrame, right: pd.DataFrame, least: float,
             matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links between a block of a cell's rows and a block of those at home:
    (ids, copies linked, smallest id of their part)."""
    x, y = _unit(_stack(left["v"])), _unit(_stack(right["v"]))
    ids_x, ids_y = left["id"].to_numpy(), right["id"].to_numpy()
    hit = x @ y.T >= least
    home = left["home"].to_numpy()
    # of two at home, each pair once; a visitor meets all at home
    hit &= ~home[:, None] | (ids_x[:, None] < ids_y[None])
    i, j = np.nonzero(hit)
    if not len(i):
        return
    # the table and cell that count a link follow from its two vectors
    used, place = np.unique(np.concatenate([ids_x[i], ids_y[j]]), return_inverse=True)
    first = np.empty((len(used), x.shape[1]))
    first[place[:len(i)]], first[place[len(i):]] = x[i], y[j]
    codes = np.stack([cells(first, t, matrix) for t in range(table + 1)], 1)
    a, b = place[:len(i)], place[len(i):]
    mine = _first_seen(codes, table, cell, a, b)
    a, b = a[mine], b[mine]
    if not len(a):
        return
    copies_x, copies_y = left["copies"].to_numpy()[i[mine]], right["copies"].to_numpy()[j[mine]]
    n = np.bincount(a, weights=copies_y, minlength=len(used)) + np.bincount(b, weights=copies_x, minlength=len(used))
    low = np.arange(len(used))
    while True:  # smallest vertex of each part
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            break
        low = new
    some = np.flatnonzero(n > 0)
    yield used[some], n[some].astype(np.int64), used[low[some]]


def classes(vectors: DataFrame) -> DataFrame:
    """(id, v, copies): one row for each different usable vector, with the smallest id."""
    v = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
              & F.exists(v, lambda x: x != 0))
    rows = vectors.filter(F.coalesce(usable, F.lit(False))).select("vec_id", v.alias("v"))
    return rows.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))


def _shift(n: Column) -> Column:
    return F.ceil(n / BLOCK).cast("int")


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    found = staged(classes(vectors), "lattice-classes")

    @F.pandas_udf("array<bigint>")
    def places(vs: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vs), index=vs.index, dtype="object")
        for dim, own in vs.groupby(vs.map(len)):
            unit, matrix = _unit(_stack(own)), _matrix(int(dim))
            out[own.index] = pd.Series(list(np.concatenate([cells(unit, t, matrix) for t in range(TABLES)], 1)), index=own.index)
        return out

    # the length is part of a cell's key
    dim, per_table = F.size("v"), F.lit(1 + PROBES)
    seen = staged(found.select("id", dim.alias("dim"), F.posexplode(places("v")).alias("p", "cell")).select(
        "id", "dim", "cell", F.floor(F.col("p") / per_table).cast("int").alias("t"), (F.col("p") % per_table == 0).alias("home")), "lattice-cells")
    # cells where a vector at home has company, cut into blocks of bounded size
    busy = (seen.groupBy("dim", "t", "cell").agg(F.count("*").alias("n"), F.count_if("home").alias("n_home"))
            .filter("n_home > 0 and n > 1")
            .select("dim", "t", "cell", _shift(F.col("n")).alias("blocks"), _shift(F.col("n_home")).alias("home_blocks"), "n"))
    busy = staged(busy, "lattice-busy")
    total = busy.agg(F.sum(F.col("n") * F.col("home_blocks"))).first()[0] or 0
    groups = max(64, int(total) // GROUP_ROWS)
    own = F.pmod(F.xxhash64("id", "t"), F.col("blocks")).cast("int")
    there = F.pmod(F.xxhash64("id", "t"), F.col("home_blocks")).cast("int")
    rows = seen.join(busy, ["dim", "t", "cell"])
    # a row meets every block of those at home; one at home is met by every block of rows
    left = rows.select("id", "dim", "t", "cell", "home", F.lit(True).alias("left"), own.alias("i"),
                       F.explode(F.sequence(F.lit(0), F.col("home_blocks") - 1)).alias("j"))
    right = rows.filter("home").select("id", "dim", "t", "cell", "home", F.lit(False).alias("left"),
                                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), there.alias("j"))
    both = left.unionByName(right).join(found.withColumn("dim", dim), ["id", "dim"])
    task = F.pmod(F.xxhash64("dim", "t", "cell", "i", "j"), F.lit(groups)).cast("int")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (dim, t, cell, _, _), part in group.groupby(["dim", "t", "cell", "i", "j"], sort=False):
            x, y = part[part["left"]], part[~part["left"]]
            if len(x) and len(y):
                out += list(_compare(int(t), int(cell), x, y, least, _matrix(int(dim))))
        if not out:
            return pd.DataFrame({"id": [], "n": [], "low": []})
        return pd.DataFrame({"id": np.concatenate([o[0] for o in out]), "n": np.concatenate([o[1] for o in out]),
                             "low": np.concatenate([o[2] for o in out])})

    links = staged(both.withColumn("task", task).groupBy("task").applyInPandas(compare, "id long, n long, low long"), "lattice-links")
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    per_class = (found.join(counts, "id", "left").join(labels, "id", "left")
                 .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component_id", "id").alias("component_id")))
    per_class = staged(per_class, "lattice-result")
    rows = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("embedding").cast("array<double>")).alias("own"))
    out = rows.join(per_class, F.col("own") == F.col("v"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
