"""Connected components of a link table by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Store a frame in the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round ties the larger neighbours of a node to its smallest one (large star) and then the
    smaller ones among each other (small star), which at least halves the height of every tree. A node
    with very many links is only ever aggregated and joined, never gathered. NULL nodes are left out.
    """
    pairs = written(
        links.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "links",
    )
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = _tied(both, larger=True)
        pairs = written(_tied(pairs, larger=False), "links")
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if state == before:
            break
        before = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _tied(pairs: DataFrame, larger: bool) -> DataFrame:
    """Give each neighbour the smallest node around ``a``, where ``pairs`` go from a to b."""
    least = pairs.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select(F.col("a").alias("hub"), F.least("a", "low").alias("low"))
    joined = pairs.join(least, pairs.a == least.hub)
    if larger:
        tied = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        tied = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        tied = tied.unionByName(least.where("hub <> low").select(
            F.col("hub").alias("a"), F.col("low").alias("b")
        ))
    return tied.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
