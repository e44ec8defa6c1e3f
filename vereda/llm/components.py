"""Connected components by alternating star contraction."""

from pyspark.sql import DataFrame, functions as F

from vereda.session import park


def _both_ways(edges):
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _mark(edges):
    """Number and a hash of the edges, to see whether a round changed them."""
    found = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(found)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (u, v): the smallest node of its component.

    Each round hangs the larger neighbours of every node on its smallest one, then the
    smaller ones. Rounds are logarithmic in the number of nodes; each is written, so a lost
    executor repeats one round at most. A node with many neighbours is one row after the
    map-side minimum, and adaptive execution splits its rows in the join.
    """
    edges = park(
        edges.filter("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct(), "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        near = _both_ways(edges)
        smallest = near.groupBy("u").agg(F.min("v").alias("_m")).select(
            "u", F.least("u", "_m").alias("_m")
        )
        large = near.join(smallest, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("_m").alias("v")
        ).distinct()
        large = park(large, "large-star")
        smallest = large.groupBy("u").agg(F.min("v").alias("_m"))
        small = large.join(smallest, "u").filter("v <> _m").select(
            F.col("v").alias("u"), F.col("_m").alias("v")
        ).unionByName(smallest.select("u", F.col("_m").alias("v"))).distinct()
        edges = park(small, "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
