"""Connected components over tables, by contraction: no group and no label set passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component), component being the smallest id reachable; only ids that have a link.

    Each round every node points to its smallest neighbour, pointers are followed to their ends by doubling,
    and the links are carried over to the ends; links inside a tree vanish.  A round halves the nodes at
    least.  Minima are combined before the shuffle, and a tree with very many nodes is a hot join key on one
    side only, which Spark splits.  Each step is a written table of two numbers a row.
    """
    links = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    total = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = written(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("up")), "parents")
        while True:  # follow the pointers to their ends
            above = parent.select(F.col("id").alias("above"), F.col("up").alias("further"))
            step = parent.join(above, F.col("up") == F.col("above")).select("id", "further", (F.col("up") != F.col("further")).alias("moved"))
            step = written(step, "pointers")
            parent = step.select("id", F.col("further").alias("up"))
            if step.where("moved").isEmpty():
                break
        if total is None:
            total = parent
        else:
            here = parent.select(F.col("id").alias("was"), F.col("up").alias("now"))
            total = written(
                total.join(here, F.col("up") == F.col("was"), "left").select("id", F.coalesce("now", "up").alias("up")),
                "components",
            )
        ends = parent.select(F.col("id").alias("was"), F.col("up").alias("now"))
        links = links.join(ends, F.col("a") == F.col("was")).select(F.col("now").alias("a"), "b")
        links = links.join(ends, F.col("b") == F.col("was")).select("a", F.col("now").alias("b"))
        links = written(
            links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
        )
    if total is None:
        return edges.sparkSession.createDataFrame([], "id bigint, component bigint")
    return total.select("id", F.col("up").alias("component"))
