"""Connected components of a graph given by its edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import stage


def _towards_least(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: each node's neighbours move to the least node among it and them.

    ``large`` moves the neighbours above the node, otherwise those below move.
    The least is a grouped minimum joined back, so a node with very many
    neighbours is combined before the shuffle and split in the join.
    """
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:  # from the greater end
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
    return moved.filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of its component, for every node but that least one.

    ``edges`` has long columns a and b; order and repetition do not matter.
    Alternates large-star and small-star steps until nothing moves, a number of
    rounds that grows with the logarithm of the graph. Each round is written to
    the shared folder; only a count and a checksum come to the driver.
    """
    now = edges.select("a", "b").filter("a <> b")  # repeated edges fall together in the first round
    seen = None
    while True:
        now = stage(_towards_least(_towards_least(now, True), False).distinct(), "edges")
        r = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(r) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = tuple(r)
