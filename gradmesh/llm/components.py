"""Connected components of a large edge table, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmesh.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node id in it) of every node of ``edges(a, b)``.

    Rounds of contraction: the larger end of an edge hooks onto its smallest neighbour, chains
    are shortened by two pointer jumps, edges are relabelled and those inside one component
    go. Every component but local minima hooks in a round, so rounds grow with the logarithm
    of the nodes. A round's tables are written to the shared folder; the rounds' maps, each
    no larger than the one before, are applied to the nodes at the end.
    """
    now = start = written(_tidy(edges), "edges")
    maps = []
    while not now.isEmpty():
        parent = written(now.groupBy("b").agg(F.min("a").alias("a")).select(F.col("b").alias("child"), F.col("a").alias("parent")), "parents")
        up = written(_jump(_jump(parent)), "parents")
        maps.append(up)
        now = written(_tidy(_mapped(_mapped(now, "a", up), "b", up)), "edges")
    labels = start.select("a").union(start.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    for up in maps:
        labels = _mapped(labels, "component", up)
    return written(labels, "labels")


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mapped(rows: DataFrame, column: str, up: DataFrame) -> DataFrame:
    """``rows`` with the values of one column replaced by their parents, if they have one."""
    to = up.select(F.col("child").alias("_child"), F.col("parent").alias("_parent"))
    return rows.join(to, rows[column] == to["_child"], "left").withColumn(column, F.coalesce("_parent", column)).drop("_child", "_parent")


def _jump(parent: DataFrame) -> DataFrame:
    return _mapped(parent, "parent", parent)
