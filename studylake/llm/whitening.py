"""Embedding whitening by QDWH spectral divide-and-conquer.

Four passes, each a scan with sums per task:
1. The entries become longs, ``floor(1024 c) + 100000``; their number and exact
   sums per dimension come from Spark.
2. The covariance: products of centred vectors, summed per task as a matrix and
   merged by Spark in tiles of bounded size.
3. On this one matrix, whose order is the vectors' length, divide-and-conquer
   (``qdwh.py``) finds the leading components. They are broadcast, and every
   vector is projected and divided by the square root of the eigenvalue; the
   result is written once.
4. The covariance of what was written, against the identity.

Nulls and odd rows: a vector that is null, or holds null or non-finite entries or
ones whose long does not exist (``|1024 c|`` of 2^62 or more) is dropped. Vectors
of each length are fitted by themselves; one of length 0 has no component and so
no row. A component without variance (equal vectors, or a rank below the
components asked for) has ``whitened`` null, ``explained`` 0 and no part in
``identity_error``, which is 0 where none is left. ``deviation`` is null where it
does not fit in a long. A null vec_id is carried through, repeated rows are rows
of their own, other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.llm.common import staged
from studylake.llm.qdwh import EPS, leading

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows that are worked on at once.
BLOCK = 4096
#: Entries of a covariance tile, and lanes that the tasks' tiles are merged in first.
TILE, LANES = 1 << 17, 256


def longs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as longs), for every length and block of rows."""
    if not len(column):
        return
    offsets = column.offsets.to_numpy()
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    values = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        for own in np.array_split(rows, -(-len(rows) // BLOCK)):
            scaled = np.floor(SCALE * values[offsets[own][:, None] + np.arange(length)])
            fits = (np.abs(scaled) < 2.0**62).all(axis=1)  # false for NaN and infinity
            if fits.any():
                yield own[fits], scaled[fits].astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        for rows, x in longs(batch.column(0)):
            of = totals.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            of[0] += len(rows)
            safe = np.abs(x).max() < 1 << 48
            of[1] += (x.sum(axis=0) if safe else x.astype(object).sum(axis=0)).astype(object)
    for length, (n, total) in totals.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()),
            pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["length", "pos", "n", "total"])


def moments(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Length → (vectors, exact sums of their longs): one row for each dimension
    of each length reaches the driver."""
    parts = vectors.mapInArrow(_sums, "length int, pos int, n long, total decimal(38,0)")
    rows = parts.groupBy("length", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: (r["length"], r["pos"])):
        out.setdefault(r["length"], (r["n"], []))[1].append(int(r["total"]))
    return out


def covariances(vectors: DataFrame, fitted: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Length → covariance, centred before multiplying, divisor n."""
    means = vectors.sparkSession.sparkContext.broadcast(_means(fitted))
    tiles = {d: max(1, TILE // d) for d in fitted}  # rows of the matrix in a tile

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in longs(batch.column(0)):
                y = x - means.value[x.shape[1]]
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + y.T @ y
        lane = TaskContext.get().partitionId() % LANES
        for d, total in sums.items():
            for at in range(0, d, tiles[d]):
                yield pa.RecordBatch.from_arrays([
                    pa.array([d], pa.int32()), pa.array([at], pa.int32()), pa.array([lane], pa.int32()),
                    pa.array([total[at:at + tiles[d]].ravel()], pa.list_(pa.float64()))], ["length", "at", "lane", "products"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["products"].to_list()), axis=0)
        return pd.DataFrame({"length": group["length"][:1], "at": group["at"][:1], "lane": group["lane"][:1], "products": [total]})

    schema = "length int, at int, lane int, products array<double>"
    parts = vectors.mapInArrow(multiply, schema)
    merged = (parts.groupBy("length", "at", "lane").applyInPandas(merge, schema)
              .groupBy("length", "at").applyInPandas(merge, schema))
    out = {d: np.zeros((d, d)) for d in fitted}
    for r in merged.collect():  # one matrix for each length
        tile = np.array(r["products"]).reshape(-1, r["length"])
        out[r["length"]][r["at"]:r["at"] + len(tile)] = tile / fitted[r["length"]][0]
    return out


def _means(fitted: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    return {d: np.array([total / n for total in totals]) for d, (n, totals) in fitted.items()}


def deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` of each row, exact; None where it is no long."""
    reach = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, totals))
    if reach < 1 << 62:
        t = n * x - np.array(totals, np.int64)
        if int(np.abs(t).max()) ** 2 * x.shape[1] < 1 << 63:
            return (t * t).sum(axis=1).tolist()
    big = n * x.astype(object) - np.array(totals, object)
    return [v if v < 1 << 63 else None for v in (big * big).sum(axis=1)]


def components(covariance: np.ndarray, want: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(explained share, vectors as columns, divisors) of the leading components;
    a divisor of NaN where a component has no variance."""
    e, v = leading(covariance, want)
    trace = float(np.trace(covariance))
    live = e > len(covariance) * EPS * trace
    return np.where(live, e / (trace or 1.0), 0.0), v, np.sqrt(np.where(live, e, np.nan))


def whiten(table: DataFrame, want: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation,
    whitened, explained and identity_error."""
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = rows.select("embedding")
    fitted = moments(vectors)
    means, fits = _means(fitted), {d: components(c, want) for d, c in covariances(vectors, fitted).items()}
    plan = rows.sparkSession.sparkContext.broadcast((fitted, means, fits))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, means, fits = plan.value
        for batch in batches:
            for at, x in longs(batch.column(1)):
                d = x.shape[1]
                n, totals = fitted[d]
                explained, v, by = fits[d]
                z = ((x - means[d]) @ v / by)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)), pa.array([d] * len(at), pa.int32()), pa.array([n] * len(at), pa.int64()),
                    pa.array(deviations(x, n, totals), pa.int64()),
                    pa.array([[None if c != c else c for c in r] for r in z.tolist()], pa.list_(pa.float64())),
                    pa.array([explained.tolist()] * len(at), pa.list_(pa.float64()))],
                    ["vec_id", "length", "n", "deviation", "z", "shares"])

    doubles = T.ArrayType(T.DoubleType())
    schema = (T.StructType([rows.schema["vec_id"]]).add("length", T.IntegerType()).add("n", T.LongType())
              .add("deviation", T.LongType()).add("z", doubles).add("shares", doubles))
    white = staged(rows.mapInArrow(project, schema), "whitened")
    error = F.lit(None).cast("double")
    for d, worst in identity_errors(white, want).items():
        error = F.when(F.col("length") == d, F.lit(worst)).otherwise(error)
    each = white.select("vec_id", "length", "n", "deviation", F.posexplode(F.arrays_zip("z", "shares")).alias("pos", "of"))
    return each.select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation",
                       F.col("of.z").alias("whitened"), F.col("of.shares").alias("explained"), error.alias("identity_error"))


def identity_errors(white: DataFrame, want: int = COMPONENTS) -> dict[int, float]:
    """Length → largest absolute entry of the written columns' covariance minus
    the identity (Spark's covar_pop, which centres before it multiplies)."""
    z = [F.get("z", F.lit(i)) for i in range(want)]
    pairs = [F.abs(F.covar_pop(z[i], z[j]) - (1.0 if i == j else 0.0)) for i in range(want) for j in range(i, want)]
    worst = F.coalesce(F.greatest(*pairs, F.lit(0.0)), F.lit(0.0))
    return {r["length"]: r["worst"] for r in white.groupBy("length").agg(worst.alias("worst")).collect()}  # one row per length
