"""Connected components of a link table, by alternating stars.

Each round lets every node point at the smallest node among its neighbours; the rounds
needed grow with the logarithm of the longest chain.  A node with very many links costs
no task more than its share: minima form with partial aggregates, and the join that
hands them back can be split by the adaptive engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .common import forest


def _local_forest(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        node, root = forest(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], ["high", "low"])
    del np


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    up = both.filter(F.col("v") > F.col("u"))
    return up.join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("high").agg(F.min("low").alias("m"))
    down = links.join(least, "high")
    moved = down.filter(F.col("low") > F.col("m")).select(F.col("low").alias("high"), F.col("m").alias("low"))
    kept = least.select("high", F.col("m").alias("low"))
    return moved.unionByName(kept).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` but the smallest of each component.

    ``links`` has two bigint columns of node numbers, in any order; loops and repeats do
    no harm, rows with a null are no links.  ``component`` is the component's smallest node.
    An empty table gives an empty table.
    """
    a, b = links.columns
    pairs = links.toDF("a", "b").filter("a <> b")
    ordered = pairs.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    now = written(ordered.mapInArrow(_local_forest, "high bigint, low bigint").distinct(), "links")
    before, digest = None, _digest(now)
    while digest != before and digest[0]:
        now = written(_small_star(_large_star(now)), "links")
        before, digest = digest, _digest(now)
    return now.select(F.col("high").alias("node"), F.col("low").alias("component"))
