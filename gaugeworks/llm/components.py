"""Connected components of a link table, by star contraction in Spark."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared


def components(links: DataFrame, shared: Shared, name: str = "star") -> DataFrame:
    """``links`` (a, b bigint) to (node, root): root is the smallest node that links reach.

    Each round joins every node to the smallest one next to it (large star), then its smaller
    neighbours to the smallest of them (small star); only minima are grouped, so a node with
    very many links is no list anywhere; rounds grow with the logarithm of the nodes. Each round's table is written to the shared folder
    under ``name``. Nodes without links are absent.
    """
    step = shared.keep(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .where("u < v")
        .distinct(),
        f"{name}-0",
    )
    for k in count(1):
        both = step.select("u", "v").union(step.select(F.col("v"), F.col("u")).toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = (
            both.join(least, "u").where("v > u").select(F.col("v"), F.col("m").alias("u"))
            .where("u < v").distinct()
        )
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(low, "v")
            .select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
            .select("e.v", "e.u").where("u < v").distinct()
        )
        step = shared.keep(small, f"{name}-{k}")
        shared.drop(f"{name}-{k - 1}")
        ends = step.select(F.col("v").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
            step.select("u", F.lit(0), F.lit(1)).distinct()
        )
        unsettled = ends.groupBy("node").agg(F.sum("below").alias("b"), F.max("above").alias("a"))
        if unsettled.where("b > 1 OR (b = 1 AND a = 1)").isEmpty():
            break
    return step.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        step.select(F.col("u"), F.col("u")).distinct()
    )
