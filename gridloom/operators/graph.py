"""Connected parts of a graph given as edges, by alternating large and small stars.

Both steps are an aggregation and a join; a hub's rows meet only in joins, whose skewed
partitions the engine splits. Each round is a table in the shared folder, so lineage stays
short and a lost executor costs one round's tasks; the round before is deleted then. The number
of rounds grows with the logarithm of the longest path; ``most`` only guards against a fault.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.sources.scratch import discard, materialise


def _named(stars: DataFrame) -> DataFrame:
    """Leaves with their centre, and centres with themselves."""
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("part")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("part")).unionByName(centres)


def parts(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, part) for every node of edges (a, b); the part is its least node."""
    pairs = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    if pairs.isEmpty():
        return _named(pairs)
    state = None
    for _ in range(most):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        before, pairs = pairs, materialise(large.join(down, "u").select(ends.alias("e")).select("e.*").filter("u != v").distinct(), "edges")
        discard(before)
        now = tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            return _named(pairs)
        state = now
    raise RuntimeError(f"parts didn't settle in {most} rounds")
