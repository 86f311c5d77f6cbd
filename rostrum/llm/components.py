"""Connected components of a link table by alternating stars.

Large-star hangs a node's larger neighbours on its smallest neighbour,
small-star hangs its smaller neighbours and itself on the smallest; repeated
until nothing changes, every node hangs on the smallest node of its component
(a logarithmic number of rounds in practice). Links only: nodes without a link
aren't needed. Every step is a grouped minimum, combined before the shuffle, and a
join whose skewed keys Spark splits; no neighbour list is ever gathered in one
place. Each round is written to the shared folder, so lost executors cost one
round at most. As the links are counted each round, few links go to few files and
not to one for each partition of the shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land

FILES = 8            # of a round, if the shuffle has more partitions
LINKS = 1 << 17      # more files from FILES times as many links on, in proportion


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links (u > v), each node hung on the smallest of its neighbours and itself."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if large else links
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        hung = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionByName(least.select("u", F.col("m").alias("v")))
    return hung.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); the component is its smallest node."""
    links = (links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links, before = land(links, "links"), None
    while True:
        mark = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
        links = land(_stars(_stars(links, True), False).coalesce(max(FILES, mark[0] // LINKS)), "links")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
