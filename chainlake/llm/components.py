"""Connected components of a link table, by stars that merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` longs): the smallest reachable.

    Each round ties every node's larger neighbours to its smallest neighbour, then
    the smaller ones, until nothing changes; the number of rounds grows with the
    logarithm of the longest chain. Rounds are written to the shared folder. A node
    with very many links is summed up in every task before it is shuffled, and its
    rows meet its minimum by an equi-join that adaptive execution may split.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = settle(toward_least(both, larger=True), "links")
        edges = settle(toward_least(edges, larger=False), "links")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def toward_least(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each node ``u`` to the least of them and itself.

    ``larger`` moves only neighbours above ``u``; without it, ``edges`` lead down
    alone, and ``u`` moves along with them.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = edges.join(least, "u")
    if larger:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        moved = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return moved.where("u <> v").distinct()
