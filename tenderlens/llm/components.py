"""Connected components of links that are spread over a cluster."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.llm.common import drop_stored, stored


def _least(pairs: DataFrame) -> DataFrame:
    return stored(pairs.groupBy("a").agg(F.min("b").alias("least")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbours or itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select(F.col("a").alias("n"), F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, F.col("a") == F.col("n")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node, is linked to the least of the smaller ones."""
    down = links.where("a > b")
    least = _least(down).select(F.col("a").alias("n"), "least")
    moved = down.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a > b").union(least.select(F.col("n").alias("a"), F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes of links (a, b).

    Alternates the two star operations until nothing changes; every round is a table in the
    shared folder, and the one before is deleted.  Links to oneself, repeated and reversed ones
    do no harm; NULL nodes are left out; no links give no rows.
    """
    now = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a > b").distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("b", "a"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen, before = mark, now
        now = stored(_small_star(stored(_large_star(now).distinct())).distinct())
        drop_stored(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct().toDF("node", "root")
    )
