"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.plans.storage import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node of ``links``: root is the smallest node that links reach.

    Every round ties all neighbours of a node to the smallest of them, first the larger ones, then the
    smaller ones, until the links are stars; the number of rounds grows with the logarithm of the longest
    path. No list of neighbours is ever collected: minima are aggregated before the shuffle and joined
    back. Rounds are cut by tables in the shared folder, and a sum over the links tells when nothing
    changed. Links with NULL or to themselves are left out; an empty table gives an empty result.
    """
    edges = (
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    edges, before = stored(edges, "links"), None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        # The state is settled when the multiset of links no longer changes.
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties the larger neighbours of each node to the least of its neighbours and itself."""
    both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionAll(
        edges.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
    )
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
    larger = edges.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
    return larger.join(least, "n").select(F.col("m").alias("hi"), F.col("least").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    tied = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return (
        tied.unionAll(least.select("hi", F.col("least").alias("lo")))
        .filter(F.col("hi") != F.col("lo"))
        .distinct()
    )
