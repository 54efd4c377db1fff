"""Connected components of a link table, as DataFrame rounds.

Each round points every vertex at the smallest neighbour (or itself), and
replaces each link by the link between the two ends' pointers; links whose ends
meet vanish. Labels follow the pointers. A star is done in one round, a chain
in a logarithmic number of them. Nothing but the count of links left reaches
the driver, and each round's tables are written to the shared folder, so a lost
executor costs a task and not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake.llm.common import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) for every vertex of the links (a, b), a <> b: the
    smallest vertex that can be reached. Vertices without links have no row."""
    links = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
    labels = None
    while True:
        # the smallest neighbour of each vertex; partial aggregation keeps hubs narrow
        pointers = staged(_both_ways(links).groupBy("a").agg(F.min("b").alias("m"))
                          .select(F.col("a").alias("v"), F.least("a", "m").alias("m")), "cc-pointers")
        if labels is None:
            labels = pointers.select(F.col("v").alias("id"), F.col("m").alias("label"))
        else:
            labels = labels.join(pointers, F.col("label") == F.col("v"), "left").select(
                "id", F.coalesce("m", "label").alias("label"))
        labels = staged(labels, "cc-labels")
        moved = (links.join(pointers, F.col("a") == F.col("v")).select(F.col("m").alias("a"), "b")
                 .join(pointers, F.col("b") == F.col("v")).select("a", F.col("m").alias("b")).filter("a <> b"))
        links = staged(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
        if links.isEmpty():
            return labels.select("id", F.col("label").alias("component_id"))
