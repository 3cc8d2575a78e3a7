"""Connected components of a link table, by rounds of large-star and small-star.

No component, and no node's neighbours, are ever gathered in one place: each round is a grouped
minimum (partial sums before the shuffle) and a join of tables that were written to the shared
folder, whose hot keys adaptive execution can split.  Rounds go on until all components are stars; their
number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Scratch


def _least(pairs: DataFrame) -> DataFrame:
    """For each node the least of itself and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))


def _star(pairs: DataFrame, kept: str, own: Scratch) -> DataFrame:
    """Neighbours that satisfy ``kept``, linked with the least of the node's neighbourhood."""
    joined = pairs.join(own.cut(_least(pairs)), F.col("u") == F.col("w"))
    return joined.filter(kept).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _are_stars(down: DataFrame) -> bool:
    """Does each node hang on one other, which hangs on none?  Rounds keep components together, so then they are found."""
    if not down.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return False
    return down.join(down.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty()


def components(links: DataFrame, own: Scratch) -> DataFrame:
    """``links`` has columns u, v of one ordered type; the result has (node, root) for each node in a link, root the least.

    It reads tables of ``own``; those of earlier rounds are deleted on the way.
    """
    with Scratch(own.spark) as rounds:
        down = rounds.cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
        while not _are_stars(down):
            both = rounds.cut(down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v"))))
            large = rounds.cut(_star(both, "v > u AND v != m", rounds).distinct())
            least = _least(large).select(F.col("w").alias("u"), F.col("m").alias("v"))
            down = rounds.cut(_star(large, "v != m", rounds).union(least).filter("u != v").distinct())
            rounds.clear(keep=1)
        return own.cut(down.select(F.col("u").alias("node"), F.col("v").alias("root")).union(down.select("v", "v").distinct()))
