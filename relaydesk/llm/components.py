"""Connected components of a graph by contraction, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaydesk.llm.common import meet, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``links`` with the least node it is connected to.

    Nodes are whole numbers. In each round every node joins the one of its
    neighbours, or itself, that comes first in an order drawn from a hash of the
    node and the round; nodes joined together become one, and links inside it
    vanish. So a constant part of the nodes goes in each round, also on long
    chains. Minima are taken in part before shuffling and joins on the ends of
    links are salted or broadcast, so a node with very many links is no hot key. Null ends
    and links of a node with itself are ignored.
    """
    spark = links.sparkSession
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").distinct()
    edges = written(edges, "links")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        turn = F.lit(len(maps))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min_by("v", F.xxhash64("v", turn)).alias("v"))
        mine, theirs = F.xxhash64("u", turn), F.xxhash64("v", turn)
        # where hashes tie the smaller node comes first for both ends
        ahead = (theirs < mine) | ((theirs == mine) & (F.col("v") < F.col("u")))
        step = written(near.select(F.col("u").alias("node"), F.when(ahead, F.col("v")).otherwise(F.col("u")).alias("to")), "step")
        maps.append(step)
        moved = step.where("node <> to")
        half = meet(edges.withColumnRenamed("u", "node"), moved, "node", F.col("v"), "left")
        half = half.select(F.coalesce("to", "node").alias("u"), F.col("v").alias("node"))
        whole = meet(half, moved, "node", F.col("u"), "left")
        whole = whole.select("u", F.coalesce("to", "node").alias("v")).where("u <> v")
        edges = written(whole.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    roots = maps[-1]
    for step in reversed(maps[:-1]):
        # where a node went in this round, and where that one ended
        ends = roots.select(F.col("node").alias("to"), F.col("to").alias("end"))
        roots = meet(step, ends, "to", F.col("node"), "left").select("node", F.coalesce("end", "to").alias("to"))
        roots = written(roots, "roots")
    least = written(roots.groupBy("to").agg(F.min("node").alias("component")), "least")
    return meet(roots, least, "to", F.col("node")).select("node", "component")
