"""Connected components of a link table, by alternating star contractions.

Every round each node is linked to the smallest node it knows, first among
its larger neighbours and then among its smaller ones; the links turn into
stars around the smallest node of each component in a number of rounds that
grows with the logarithm of the size.  The smallest neighbour is an aggregate
joined back, so a node with very many links never meets in one task.  Rounds
are checkpointed in the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import ensure_checkpoint_dir


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    )).alias("l")).select("l.u", "l.v")


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = near.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(least, "u").select(F.explode(F.array(
        F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b"))
    )).alias("l")).select("l.a", "l.b")
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``links`` (a, b); the root is the component's smallest node."""
    ensure_checkpoint_dir(links.sparkSession)
    links = links.filter("a <> b").distinct().checkpoint()
    before = None
    while True:
        links = _small_star(_large_star(links)).checkpoint()
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
