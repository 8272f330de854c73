"""Connected components of a graph that lives in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of the edges ``a``, ``b``.

    Alternating star contraction: one half-round hangs the larger neighbours of each node on its
    smallest neighbour, the next hangs each node and its smaller neighbours there, until nothing
    changes; the number of rounds grows with the logarithm of the longest path. Each half-round is
    stored, so the plan stays short and a lost executor costs one round. Sums by node are formed
    before the shuffle, and the joins are inner ones, whose heavy nodes adaptive execution splits.
    Loops, repeated edges and nulls are ignored; no edges give no rows.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stored(large.where("a <> b").distinct(), "links")
        least = links.groupBy("a").agg(F.min("b").alias("low"))
        small = links.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        links = stored(small.union(least.select("a", F.col("low").alias("b"))).distinct(), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _state(links: DataFrame) -> tuple:
    """Counts and a checksum that tell whether a half-round changed the edges."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
    return tuple(row)
