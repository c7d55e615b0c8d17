"""Connected components of a table of links, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.session import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, root)`` for every id in ``links (a, b)``; root is the smallest id it reaches.

    Each id points to an id no larger than itself. A round lets every id and its parent take
    the smallest grandparent among the neighbours, then its own grandparent: the number of
    rounds grows with the logarithm of the longest path. Minima are taken before and after
    the shuffle, so an id with any number of neighbours is no single task's work, and joins
    have one row per id on one side. Rounds are written, a lost executor repeats one at most.

    Null ends are no links; repeated links and links of an id to itself change nothing; no
    links give no rows.
    """
    links = links.where("a is not null and b is not null and a <> b")
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    parents = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("root"))
    parents = materialize(parents, "roots")
    for _ in range(max_rounds):
        up = parents.select(F.col("id").alias("root"), F.col("root").alias("grand"))
        pointed = parents.join(up, "root")  # id, root, grand
        near = both.join(pointed.select(F.col("id").alias("b"), "grand"), "b")
        lowest = near.groupBy(F.col("a").alias("id")).agg(F.min("grand").alias("low"))
        hooked = pointed.join(lowest, "id", "left")
        low = F.least("grand", F.coalesce("low", "grand"))
        offers = (
            hooked.select("id", low.alias("root"), F.col("root").alias("was"))
            .union(hooked.select(F.col("root").alias("id"), low.alias("root"), F.lit(None).cast("long")))
        )
        found = offers.groupBy("id").agg(F.min("root").alias("root"), F.max("was").alias("was"))
        parents = materialize(found, "roots")
        if parents.where("root <> was").isEmpty():
            return parents.select("id", "root")
    raise RuntimeError(f"components not settled in {max_rounds} rounds")
