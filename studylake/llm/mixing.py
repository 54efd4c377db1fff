"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length per source. A source whose target is at
least its own size is taken whole once (or twice); what is left of the target
is a budget smaller than the source. Each length gives its proportional share
of documents to that budget, rounded down; longest lengths that still fit then
fill it up to a bounded rest, and a bounded-knapsack dynamic programme over the
remaining counts fits the rest. Where that misses the budget, as with few texts
as long as books, a larger programme chooses among long documents as well, after
the shares and without them, and the nearest fit counts. It is exact for budgets
up to EXACT words and over rounded lengths above. Documents
are then selected by length count, in the order of a seeded hash, so reruns
agree. Counts are salted by the same hash: a hot source and length never meet
in one task.

Nulls and odd rows: a null text has no words (nothing is taken from it); a null
source is a source of its own, the last; a null doc_id is carried through;
repeated rows count once each; other columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studylake.llm.common import SPACE_CLASS, fresh, staged, text_of

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
SEED = 20240229
#: The dynamic programme's budget, in words: at first, and where that leaves a rest.
KNAPSACK, EXACT = 1 << 16, 1 << 22
#: In the second, at least so many of the longest documents have room.
LONGEST = 16
ROWS_PER_SALT, MIN_SALTS = 100_000, 256


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> dict[str | None, float]:
    """Target of each source, given in order: shares by weight, capped at a
    multiple of the source, the excess shared again by weight."""
    weight = {s: float(weights[i % len(weights)]) for i, (s, _) in enumerate(sizes)}
    cap = {s: most * n for s, n in sizes}
    total = share * sum(n for _, n in sizes)
    out: dict[str | None, float] = {}
    free = [s for s, _ in sizes]
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > cap[s]]
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        out |= {s: cap[s] for s in over}
        free = [s for s in free if s not in over]
    return out


def _greedy(lengths: np.ndarray, left: np.ndarray, rest: int, stop: int) -> np.ndarray:
    """The longest documents that still fit, until at most ``stop`` words are left."""
    more = np.zeros(len(left), np.int64)
    for i in range(len(lengths) - 1, -1, -1):
        if rest <= stop:
            break
        more[i] = min((rest - stop) // int(lengths[i]), int(left[i]))
        rest -= int(more[i] * lengths[i])
    return more


def _knapsack(lengths: np.ndarray, left: np.ndarray, rest: int, cells: int) -> np.ndarray:
    """Bounded knapsack for ``rest`` words: exact where they are at most
    ``cells``, else over lengths rounded up to a coarser unit."""
    unit = max(1, -(-rest // cells))
    sizes, end = -(-lengths // unit), rest // unit
    more = np.zeros(len(left), np.int64)
    # first[s] is the item by which the sum s is first reached
    first = np.full(end + 1, -1, np.int32)
    first[0], high = 0, 0
    items: list[tuple[int, int, int]] = [(0, 0, 0)]
    for i in range(len(lengths) - 1, -1, -1):
        size = int(sizes[i])
        many, part = min(int(left[i]), end // size), 1
        while many > 0 and first[end] < 0:
            part = min(part, many)
            step = part * size
            high = min(high + step, end)  # no sum lies above
            if high >= step:
                new = np.flatnonzero((first[step:high + 1] < 0) & (first[:high + 1 - step] >= 0)) + step
                first[new] = len(items)
                items.append((i, part, step))
            many -= part
            part *= 2
        if first[end] >= 0:
            break
    at = int(np.flatnonzero(first >= 0)[-1])
    while at:
        i, part, step = items[first[at]]
        more[i] += part
        at -= step
    return more


def fit(lengths: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each length (ascending, above 0) come to at most
    the budget in words, and as near to it as can be: exactly where the budget
    is at most EXACT times the lengths' common divisor, or where the shares and
    the longest documents leave a rest that can be met to the word. Else it is
    the nearest of three fits that leave no length out."""
    total = int((lengths * counts).sum())
    budget = int(min(budget, total))
    if budget <= 0:
        return np.zeros(len(counts), np.int64)
    shares = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    common = int(np.gcd.reduce(lengths))
    lengths, budget = lengths // common, budget // common

    def rest(take: np.ndarray) -> int:
        return budget - int((lengths * take).sum())

    def small(take: np.ndarray) -> np.ndarray:
        take = take + _greedy(lengths, counts - take, rest(take), KNAPSACK)
        return take + _knapsack(lengths, counts - take, min(rest(take), KNAPSACK), KNAPSACK)

    def wide(take: np.ndarray) -> np.ndarray:
        # long documents must be free to be exchanged for each other
        if rest(take) > EXACT:
            take = take + _greedy(lengths, counts - take, rest(take), max(EXACT // 2, LONGEST * int(lengths[-1])))
        take = take + _knapsack(lengths, counts - take, rest(take), EXACT)
        return small(take) if rest(take) else take

    best = small(shares)
    for start in (shares, np.zeros(len(counts), np.int64)):
        if rest(best):
            other = wide(start)
            best = other if rest(other) < rest(best) else best
    return best


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """One source's histogram: copies that every document gets, and the number
    of documents of each length that get one more."""
    group = group.sort_values("size", kind="stable").reset_index(drop=True)
    size, n = group["size"].to_numpy(), group["n"].to_numpy()
    target, own = float(group["target"].iloc[0]), int(group["source_size"].iloc[0])
    whole = int(min(target // own, MOST)) if own else 0
    take, some = np.zeros(len(n), np.int64), size > 0
    if own:
        take[some] = fit(size[some], n[some], round(target - whole * own))
    return group.assign(whole=whole, more=take)[["source", "size", "source_size", "target", "whole", "more"]]


class _Names:
    """Columns that the operator adds; no input column has these names."""

    def __init__(self):
        for n in ("source", "size", "order", "salt", "rank", "copies", "total", "target"):
            setattr(self, n, fresh(n))


def _sized(docs: DataFrame, n: _Names, seed: int) -> DataFrame:
    """Adds the source as a key that is never null, the size in words and the seeded order."""
    size = F.regexp_count(text_of("text"), F.lit(f"[^{SPACE_CLASS}]+")).cast("long")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    return docs.withColumns({n.source: key, n.size: size, n.order: F.xxhash64(F.lit(seed), F.col("doc_id"))})


def _selected(rows: DataFrame, n: _Names) -> DataFrame:
    """Adds the copies of each row, its source's total and target."""
    histogram = staged(rows.groupBy(F.col(n.source).alias("source"), F.col(n.size).alias("size"))
                       .agg(F.count("*").alias("n")), "mix-histogram")
    sizes = (histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s"), F.sum("n").alias("n"))
             .collect())  # one row per source
    sizes.sort(key=lambda r: (r["source"] == "null", r["source"].encode()))
    goal = targets([(r["source"], r["s"]) for r in sizes])
    salts = max(MIN_SALTS, sum(r["n"] for r in sizes) // ROWS_PER_SALT)
    per_source = rows.sparkSession.createDataFrame(
        [(r["source"], r["s"], float(goal[r["source"]])) for r in sizes], "source string, source_size long, target double")
    plan = staged(histogram.join(per_source, "source").groupBy("source").applyInPandas(
        _plan, "source string, size long, source_size long, target double, whole int, more long"), "mix-plan")

    salted = rows.withColumn(n.salt, F.pmod(F.col(n.order), F.lit(salts)).cast("int"))
    # a row's turn comes after those of lower salts
    cells = salted.groupBy(F.col(n.source).alias("source"), F.col(n.size).alias("size"),
                           F.col(n.salt).alias("salt")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(plan, ["source", "size"])
    cells = cells.select(
        F.col("source").alias(n.source), F.col("size").alias(n.size), F.col("salt").alias(n.salt),
        F.col("source_size").alias(n.total), F.col("target").alias(n.target), F.col("whole").alias(n.copies),
        (F.col("more") - F.col("before")).alias(n.rank + "_need"))
    key = [n.source, n.size, n.salt]
    order = Window.partitionBy(*key).orderBy(n.order, "doc_id")
    return (salted.withColumn(n.rank, F.row_number().over(order)).join(cells, key)
            .withColumn(n.copies, F.col(n.copies) + (F.col(n.rank) <= F.col(n.rank + "_need")).cast("int")))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: its size, its source's size and target, and the
    words that the mix takes from it, repeats counted."""
    n = _Names()
    rows = staged(_sized(docs.select("doc_id", "source", "text"), n, seed).drop("text"), "mix-sizes")
    return _selected(rows, n).select(
        "doc_id", F.col(n.size).alias("size"), F.col(n.total).alias("source_size"), F.col(n.target).alias("target"),
        (F.col(n.size) * F.col(n.copies)).alias("taken"), "source")


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its
    columns. A document without words has nothing to take and is left out."""
    n = _Names()
    chosen = _selected(_sized(docs, n, seed), n).filter((F.col(n.copies) > 0) & (F.col(n.size) > 0))
    again = chosen.withColumn(n.rank, F.explode(F.sequence(F.lit(1), F.col(n.copies))))
    return again.select(*docs.columns)
