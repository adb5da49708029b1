"""Reachability over a stored link table (K1) with the frontier anti-join (C4).

Breadth-first, one join per level. The edge table is dealt once by (source,
slot), where the slot is one of ``SLOTS`` hash values of the target, so the links
of a hub page lie in several partitions; the frontier, one row per page and slot,
goes to the edges and the edges stay where they lie. New targets are anti-joined against everything already reached
(C4), and the level is checkpointed to the cluster's checkpoint folder so
lineage stays one level deep and a lost executor does not replay the walk.
The loop runs ``max_depth`` times on the driver; only the plan is built
there, no rows are collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dealt, ensure_checkpoint_dir


#: Partitions over which the links of one page are spread at most.
SLOTS = 8


def adjacency(edges: DataFrame) -> DataFrame:
    """(src, slot, dst): distinct links, checkpointed as they are dealt by (src, slot)."""
    slot = F.pmod(F.xxhash64("dst"), F.lit(SLOTS)).cast("int")
    return dealt(edges.withColumn("slot", slot).select("src", "slot", "dst").distinct(), "src", "slot")


def frontier_step(frontier: DataFrame, edges: DataFrame, reached: DataFrame, slot: Sequence[str] = ()) -> DataFrame:
    """C4: targets of the frontier not reached yet, at depth + 1. ``slot`` names the slot
    column of ``edges`` where they come from ``adjacency``."""
    pages = frontier.select(F.col("url").alias("src"), "depth")
    for c in slot:
        pages = pages.withColumn(c, F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    nxt = pages.join(edges, ["src", *slot]).select(F.col("dst").alias("url"), (F.col("depth") + 1).alias("depth")).distinct()
    return nxt.join(reached.select("url"), "url", "left_anti")


def reachable(edges: DataFrame, seeds: Sequence[str] | DataFrame, max_depth: int = 2,
              src: str = "src", dst: str = "dst") -> DataFrame:
    """K1: every URL reachable from the seeds within ``max_depth`` links, once,
    at its least depth."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = adjacency(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")))
    if isinstance(seeds, DataFrame):
        start = seeds.select(F.col(seeds.columns[0]).alias("url"))
    else:
        start = spark.createDataFrame([(s,) for s in seeds], "url STRING")
    levels = [start.distinct().select("url", F.lit(0).alias("depth"))]
    for _ in range(max_depth):  # each level is written once and never rewritten
        reached = reduce(DataFrame.unionByName, levels)
        levels.append(frontier_step(levels[-1], e, reached, ["slot"]).checkpoint(eager=True))
    return reduce(DataFrame.unionByName, levels)
