"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest one."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The minima are written first: the join then has an exchange on either side, which
    # lets adaptive execution split a node with very many neighbours.
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node move to the smallest one."""
    least = staged(links.groupBy("a").agg(F.min("b").alias("m")), "star")
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("b", "a")),
        ).first()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the smallest node that can be reached.

    Each round contracts stars (Kiveris et al., Connected Components in MapReduce and
    Beyond); the number of rounds grows with the logarithm of the longest path.  Links
    stay distributed; the driver sees three numbers a round.  Null ends and self links are ignored.
    """
    clean = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    clean = staged(clean, "links")
    before, mark = None, _mark(clean)
    while mark != before and mark[0]:
        clean = staged(_small_star(staged(_large_star(clean), "links")), "links")
        before, mark = mark, _mark(clean)
    stars = clean.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(clean.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
