"""Connected components by alternating star contractions, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import counted, fresh_path, remove, stored


def components(edges: DataFrame, left: str, right: str, most: int | None = None) -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node that is reachable.

    Each round first hangs the larger neighbours of every node on the smallest one it knows (large
    star), then the smaller ones (small star). Both are a minimum per node, combined before the
    shuffle, and an equi-join, which adaptive execution splits where a node has very many edges.
    The set of edges never grows; depth falls by about half a round. Rounds are written to the
    shared folder, both stars at once, in as few files as the edges fill, and the one before is
    deleted. ``most``: no fewer than the rows of ``edges``, if known. Edges with a null end and loops are left out,
    repeated edges count once, no edges give no rows. Nodes of any type with an order are taken.
    """
    spark = edges.sparkSession
    a, b = F.col(f"`{left}`"), F.col(f"`{right}`")
    state = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        a.isNotNull() & b.isNotNull() & (a != b)
    )
    path, before = fresh_path(spark, "star"), None
    state, n = counted(state.distinct(), path, most)
    mark = _mark(state)
    while mark[0]:
        new = fresh_path(spark, "star")
        state = stored(_small(_large(state)), path=new, most=n["rows"])
        remove(spark, path)
        path = new
        before, mark = mark, _mark(state)
        if mark == before:
            break
    roots = state.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(state: DataFrame) -> tuple[int, int]:
    """Equal for equal sets of edges."""
    row = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 31)).alias("h")).first()
    return row["n"], row["h"] or 0


def _large(state: DataFrame) -> DataFrame:
    both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(state: DataFrame) -> DataFrame:
    least = state.groupBy("u").agg(F.min("v").alias("m"))
    hung = state.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
