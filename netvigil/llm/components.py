"""Connected components of a table of links, by alternating large and small stars.

In a large-star step every vertex points its larger neighbours to the smallest
vertex it knows; in a small-star step it points its smaller neighbours and
itself there. The links end as one star per component, after a number of rounds
that grows with the logarithm of the longest path. Each round is two
aggregations and one join; a vertex with any number of links is merged map-side
and its join can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import kept

MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` go from the larger vertex ``a`` to the smaller ``b``."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    pointed = links.join(least, "a")
    moved = pointed.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex that has a link; ``links`` has columns ``a`` and ``b``, in any order.

    The component is named by its smallest vertex.
    """
    links = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(MOST_ROUNDS):
        links = kept(_small_star(_large_star(links)))
        after = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
