"""Co-occurrence matrices of users or items as weighted edges, and the measures of such graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_pairs(rows: DataFrame, item: str, group: str, distinct: bool = True) -> DataFrame:
    """Pairs (left < right) of items that share a group, with the group. Repeats stay unless ``distinct``.

    The pairs are the result; a group of n items has n(n-1)/2 of them by definition.
    """
    rows = rows.where(F.col(item).isNotNull() & F.col(group).isNotNull()).select(item, group)
    rows = rows.distinct() if distinct else rows
    left = rows.select(F.col(item).alias("left_id"), F.col(group).alias("shared"))
    right = rows.select(F.col(item).alias("right_id"), F.col(group).alias("shared"))
    return left.join(right, "shared").where("right_id > left_id").select("left_id", "shared", "right_id")


def cross_pairs(left: DataFrame, right: DataFrame, item: str, group: str) -> DataFrame:
    """Pairs of an item of ``left`` and a greater one of ``right`` that share a group."""
    a = left.select(F.col(item).alias("left_id"), F.col(group).alias("shared")).distinct()
    b = right.select(F.col(item).alias("right_id"), F.col(group).alias("shared")).distinct()
    return a.join(b, "shared").where("right_id > left_id").select("left_id", "shared", "right_id")


def sparse_matrix(pairs: DataFrame) -> DataFrame:
    """Edges with the number of pairs as weight."""
    return pairs.groupBy("left_id", "right_id").agg(F.count("*").alias("weight"))


def square_matrix(edges: DataFrame) -> DataFrame:
    """Both directions of every edge."""
    return edges.union(edges.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "weight")).distinct()


def without(rows: DataFrame, key: str, excluded: DataFrame, excluded_key: str) -> DataFrame:
    return rows.join(excluded.select(F.col(excluded_key).alias(key)).distinct(), key, "left_anti")


def network(edges: DataFrame, least_weight: int) -> DataFrame:
    return edges.where(F.col("weight") >= least_weight)


def degrees(edges: DataFrame) -> DataFrame:
    """node, degree of an undirected edge list; counted before the shuffle."""
    ends = edges.select(F.explode(F.array("left_id", "right_id")).alias("node"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def density(edges: DataFrame) -> DataFrame:
    """Nodes, edges and the share of possible edges that exist.

    Where no edge is possible the share is what SQL's floating-point division by zero gives: NaN of a network without
    edges, infinite of one node that is joined to itself. Spark's own division would end the query there.
    """
    nodes = degrees(edges).agg(F.count("*").alias("n_nodes"), (F.coalesce(F.sum("degree"), F.lit(0)) / 2).cast("bigint").alias("n_edges"))
    possible = F.col("n_nodes") * (F.col("n_nodes") - 1)
    share = F.when(possible != 0, 2 * F.col("n_edges") / possible).otherwise(F.when(F.col("n_edges") > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
    return nodes.select("n_nodes", "n_edges", F.round(share, 6).alias("density"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Degree over the number of other nodes."""
    own = degrees(edges)
    return own.select("node", F.round(F.col("degree") / (own.agg(F.count("*")).scalar() - 1), 6).alias("centrality"))


def assortativity(edges: DataFrame) -> DataFrame:
    """Correlation of the degrees at both ends, over both directions of every edge."""
    own = degrees(edges)
    ends = edges.select("left_id", "right_id").join(own.select(F.col("node").alias("left_id"), F.col("degree").alias("l")), "left_id").join(own.select(F.col("node").alias("right_id"), F.col("degree").alias("r")), "right_id")
    both = ends.select(F.explode(F.array(F.struct(F.col("l").alias("x"), F.col("r").alias("y")), F.struct(F.col("r").alias("x"), F.col("l").alias("y")))).alias("e")).select("e.x", "e.y")
    return both.agg(F.round(F.corr("x", "y"), 6).alias("assortativity"))
