"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.workspace import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its least node.

    Each round points a node to its least neighbour, follows these pointers to
    their ends by doubling, and replaces every node by the end of its chain, so
    links that have become loops or repeats disappear. A node that others do
    not point to and that points to none has a lesser neighbour after one
    round, so two rounds at least halve the nodes that have links, and a round
    doubles as often as the logarithm of its longest chain. Every step is
    stored; tables that the next ones replace are removed.
    """
    spark = links.sparkSession
    edges, edges_at = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    names, names_at = stored(nodes.withColumn("component", F.col("node")), "components")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).filter("least < a")
        roots, roots_at = stored(least.select(F.col("a").alias("_from"), F.col("least").alias("_to")), "pointers")
        while True:
            doubled, doubled_at = stored(_doubled(roots), "pointers")
            done = doubled.filter("_moved").isEmpty()
            discard(spark, roots_at)
            roots, roots_at = doubled.drop("_moved"), doubled_at
            if done:
                break
        names, following = stored(_followed(names, "component", roots), "components")
        discard(spark, names_at)
        names_at = following
        # Stored before repeats go, so that both joins can be cut up where a node has very many links,
        # and links that have become the same one are combined before they are dealt by both ends.
        ends, ends_at = stored(_followed(_followed(edges, "a", roots), "b", roots).filter("a <> b"), "ends")
        left, following = stored(ends.distinct(), "links")
        for path in (edges_at, roots_at, ends_at):
            discard(spark, path)
        edges, edges_at = left, following
    return names


def _doubled(roots: DataFrame) -> DataFrame:
    """Each pointer moved on to where its end points, and whether that moved it."""
    onward = roots.select(F.col("_from").alias("_end"), F.col("_to").alias("_next"))
    joined = roots.join(onward, roots["_to"] == onward["_end"], "left")
    return joined.select("_from", F.coalesce("_next", "_to").alias("_to"), F.col("_next").isNotNull().alias("_moved"))


def _followed(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    joined = df.join(roots, df[column] == roots["_from"], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")
