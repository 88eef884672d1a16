"""Connected components of links that stay distributed.

Each round sends every node to its smallest neighbour, shortens the chains this makes, relabels the links
and drops those that became loops. At least half of the nodes that still have links lose theirs in a
round, so the number of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.stages import stored


def _relabel(frame: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    renamed = labels.select(F.col("node").alias(column), F.col("root").alias("_root"))
    rest = [c for c in frame.columns if c != column]
    return frame.join(renamed, column, "left").select(*rest, F.coalesce("_root", column).alias(column))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the component's smallest node."""
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        parents = stored(lowest.select("node", F.least("node", "root").alias("root")), "parents")
        for _ in range(2):
            parents = _relabel(parents, "root", parents).select("node", "root")
        parents = stored(parents, "parents")
        rounds.append(parents)
        links = _relabel(_relabel(links, "a", parents), "b", parents)
        links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0]
    for later in rounds[1:]:
        found = _relabel(found, "root", later).select("node", "root")
    return stored(found, "components")
