"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014).

Each round replaces links by links to the smallest neighbour. Minima combine
before the shuffle and the join back to the links splits skewed keys, so a
vertex with very many links is no bottleneck. Rounds are logarithmic in the
number of vertices; each is a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from crownlake.llm.common import stored


def _least(links: DataFrame) -> DataFrame:
    """Of each vertex ``u`` the smallest of itself and its neighbours ``v``."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _marked(links: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """Distinct links stored, and their number and hash, counted by the write itself."""
    seen = Observation()
    links = links.where("u > v").distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
    return stored(links, name), seen.get


def components(links: DataFrame) -> DataFrame:
    """``vertex, label`` of every vertex in ``links`` (two long columns): label is the smallest vertex of its component."""
    a, b = links.columns
    edges, mark = _marked(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "links")
    before = {"n": 0}
    while mark["n"] and mark != before:
        before = mark
        # Large star: larger neighbours link to the smallest one. Small star: smaller neighbours do.
        both = _both(edges)
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_least(large), "u")
        star = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges, mark = _marked(star, "stars")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("label")).distinct()
    )


def joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the links that gave ``known`` and of more ``links``, both stored: labels stand for the links behind them."""
    if links.isEmpty():
        return known
    return stored(components(known.union(links)), "components")
