"""Connected components of a link table, by alternating star contractions.

A large star points every greater neighbour of a node at the node's smallest neighbour, a
small star does the same for the smaller ones.  Links never grow in number, and after a
logarithmic number of rounds each component is a star around its smallest node.

The number of tasks that write follows from the number of links (one for every ``TASK_LINKS``),
since many rounds over few links would otherwise leave mostly empty files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import shared_dir

TASK_LINKS = 100_000

def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(e: DataFrame, tasks: int) -> DataFrame:
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = e.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).coalesce(tasks).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has a link to another; the component is its smallest node.

    Links with a null end and links of a node to itself are ignored, repeated ones count once; an
    empty table gives an empty result.  Each round's links are cut from their lineage by a checkpoint.
    """
    shared_dir(links.sparkSession)
    x, y = F.col(a), F.col(b)
    e = links.filter(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo"))
    e = e.distinct().checkpoint()
    before = None
    for _ in range(rounds):
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == before:
            break
        before = (state["n"], state["h"])
        few = max(1, -(-state["n"] // TASK_LINKS))
        e = _small_star(_large_star(e.coalesce(few)).coalesce(few), few).coalesce(few).checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
