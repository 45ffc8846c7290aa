"""Connected components by alternating stars, all of it in joins and aggregates.

Every step hangs the neighbours of a node under the smallest of them: first the larger neighbours,
then the smaller ones. Stars only move to smaller centres, so a fixed point is a set of stars whose
centres are the smallest nodes of their components. The number of steps grows with the logarithm
of a component's size. Minima are combined in the tasks before a shuffle and joined back, so a
centre with a third of all nodes is an ordinary skewed join, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import discard, stored


def _edges(frame: DataFrame) -> DataFrame:
    """Each edge (a, b) once, larger end first; loops go."""
    return (
        frame.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node under its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours under the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum that does not depend on their order."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to (node, root): every node of a link with the smallest node it can reach.

    Loops, repeated and reversed links are allowed; links with a null end are ignored, and
    nodes that have only loops are left out. No links give no rows. Ends are integers.
    """
    edges = stored(_edges(links.where("a is not null and b is not null")), "links")
    state = _state(edges)
    while state[0]:
        stars = stored(_edges(_small_star(_edges(_large_star(edges)))), "links")
        discard(edges)
        edges, before, state = stars, state, _state(stars)
        if state == before:
            break
    centres = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        centres.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
