"""Connected components of link tables, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, component): every node of a link with the smallest node it reaches.

    Each round sends every node to its smallest neighbour (or itself), jumps once along these pointers, and
    contracts the links; the number of links falls at least by half of the touched nodes per round.  Rounds are stored, so lineage stays
    short; nothing is collected.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = staged(links, "links")
    labels = staged(links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                    .withColumn("label", F.col("node")), "labels")
    while links.take(1):
        both = links.select("a", "b").union(links.select("b", "a"))
        to = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("label"), F.least("a", "p").alias("p"))
        to = staged(to, "pointers")
        jump = to.select(F.col("label").alias("p"), F.col("p").alias("pp"))
        to = staged(to.join(jump, "p", "left").select("label", F.coalesce("pp", "p").alias("to")), "pointers")
        labels = staged(labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        ends = [to.select(F.col("label").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab"]
        links = links.join(ends[0], "a").join(ends[1], "b").where("a_to <> b_to")
        links = staged(links.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
    return labels.select("node", F.col("label").alias("component"))


class Forest:
    """Union-find over 0..n-1 inside one task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def stars(self, nodes: list) -> list[tuple]:
        """(smallest node, other node) for every tree of two nodes or more."""
        least: dict = {}
        for i, x in enumerate(nodes):
            r = self.root(i)
            if r not in least or x < least[r]:
                least[r] = x
        return [(least[self.root(i)], x) for i, x in enumerate(nodes) if least[self.root(i)] != x]
