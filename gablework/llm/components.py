"""Connected components of a table of links, by alternating large and small stars.

Every round is a grouped minimum and a join; nothing is collected. A link table shrinks to stars whose
centre is the component's smallest node, in a number of rounds that grows with the logarithm of a
component's size. Rounds are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.shared import materialize

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node around: larger neighbours (large) or smaller ones (small star)."""
    around = links.select("u", "v").union(links.select(F.col("v"), F.col("u"))) if large else links.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(smallest, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of the links (u, v) with the smallest node it is connected to.

    Links may repeat and point both ways; a link of a node with itself is left out."""
    links = materialize(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        links = materialize(_star(_star(links, True), False), "links")
        new = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if tuple(new) == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct())
        state = tuple(new)
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
