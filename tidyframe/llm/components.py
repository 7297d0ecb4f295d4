"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    rows = both.join(least, "a")
    if large:  # neighbours above the node go to the least of its neighbourhood
        out = rows.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:      # node and lower neighbours go to the least of them
        out = rows.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> (node, component): every node of an edge with the least node
    it reaches.  Stops when a round changes nothing; a round's edges are never more
    than the last one's."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"),
                         F.sum(F.xxhash64("a", "b").cast("decimal(38)")).alias("x")).first()
        if mark == seen or not seen["n"]:
            break
        mark = seen
        edges = materialize(_star(_star(edges, True), False), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots).distinct()
