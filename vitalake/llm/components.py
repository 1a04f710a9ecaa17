"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., 2014): a logarithmic number of joins, the
lineage cut by a checkpoint after each, nothing gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def stars(edges: DataFrame) -> DataFrame:
    """``(u, v)``: each linked node ``u`` above the smallest node ``v`` of its component."""
    checkpoint_dir(edges.sparkSession)  # registers a folder where none is set
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(least.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges
