"""Connected components of a graph that lives in tables, by alternating stars.

Each round rewires every vertex towards the smallest vertex it knows: first its larger neighbours,
then its smaller ones. The number of rounds grows with the logarithm of the longest path. A vertex
with very many neighbours is handled by joins that adaptive execution splits and by partial minima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    wired = both.filter("v > u").join(least, "u")
    return wired.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge leads from the larger to the smaller vertex."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    # A sum of small hashes: it cannot overflow, and two different edge sets hardly share it.
    mixed = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 32))
    row = edges.agg(F.count("*").alias("n"), F.sum(mixed).alias("mix")).first()
    return row["n"], row["mix"]


def components(edges: DataFrame) -> DataFrame:
    """vertex and component (its smallest vertex) of all vertices on an edge, from numbers u and v.

    Loops and repeated edges do no harm; edges with a null end are left out. Each round is written to
    the scratch folder, so a lost executor costs no earlier round; the driver sees two numbers.
    """
    ends = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, before = materialise(ends.distinct(), "edges"), None
    now = _state(edges)
    while now[0] and now != before:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionAll(roots)
