"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.operators.staging import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the least node that can be reached. edges: a, b, of one type; null ends are left out.

    Large-star and small-star rounds in turn: every node's neighbours are hung on the least of them, first
    the larger ones, then the smaller. Depth falls by a constant factor a round, so a chain of n nodes takes
    about log(n) rounds; no round holds a node's neighbours together.
    """
    links = settled(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    alone = edges.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct()
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        links = settled(small, "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % (1 << 31))).first()
        if now == before:
            return alone.join(links.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        before = now
