"""Shards of bounded size by extendible hashing.

A document's key is the first 60 bits of the md5 of its ``doc_id``. The directory begins with a single
bucket; a bucket with more bytes than the limit splits on the next bit, and no other does. Sizes come from
one aggregation per ``STEP`` bits, which after the first is over oversized buckets only. What cannot be split,
a single document or documents with one ``doc_id``, keeps a bucket of its own, marked ``oversized``.

NULL text has no bytes, NULL ``doc_id`` the key of the empty string. Rows may repeat. Only built-in
expressions are used, and documents are not shuffled unless there are directory pages beyond the first
that are too large to be broadcast by Spark's own measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.components import written

BITS = 60
STEP = 12


def hash_key(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def _page(sizes: DataFrame, low: int, limit: int) -> DataFrame:
    """Final buckets between depths ``low`` and ``low + STEP`` by the prefix of ``low + STEP`` bits."""
    high = low + STEP
    cells = written(
        sizes.groupBy(F.shiftrightunsigned("hash_key", BITS - high).alias("cell")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.min("hash_key").alias("a"), F.max("hash_key").alias("b")
        ),
        "cells",
    )
    depth = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    nodes = (
        cells.select("*", depth)
        .groupBy("depth", F.expr(f"shiftrightunsigned(cell, {high} - depth)").alias("prefix"))
        .agg(F.sum("n_bytes").alias("shard_bytes"), F.min("a").alias("a"), F.max("b").alias("b"))
        .where((F.col("shard_bytes") <= limit) | (F.col("a") == F.col("b")))
    )
    # The final bucket of a cell is the shallowest that needs no split.
    return (
        cells.select("cell", depth)
        .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {high} - depth)"))
        .join(nodes.drop("a", "b"), ["depth", "prefix"])
        .groupBy("cell")
        .agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("bucket"))
    )


def with_shards(docs: DataFrame, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with ``shard_depth, shard_prefix, shard_bytes, n_bytes, oversized``.

    Columns of ``docs`` with these names, or ``hash_key``, are replaced.
    """
    added = ("shard_depth", "shard_prefix", "shard_bytes", "n_bytes", "oversized", "hash_key")
    out = (
        docs.drop(*added)
        .withColumn("hash_key", hash_key(F.col("doc_id")))
        .withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    )
    sizes = out.select("hash_key", "n_bytes")
    found = None
    for low in range(0, BITS, STEP):
        page = written(_page(sizes, low, limit), "directory")
        name = f"__bucket{low}"
        cell = F.shiftrightunsigned("hash_key", BITS - low - STEP)
        named = page.select(F.col("cell").alias(f"{name}_cell"), F.col("bucket").alias(name))
        if low == 0:
            named = F.broadcast(named)  # at most 2**STEP rows
        out = out.join(named, cell == F.col(f"{name}_cell"), "left").drop(f"{name}_cell")
        found = F.col(name) if found is None else F.coalesce(found, F.col(name))
        placed = sizes.withColumn("cell", cell).join(page, "cell", "left_anti").drop("cell")
        if placed.isEmpty():
            break
        sizes = written(placed, "oversized")
    return out.select(
        *[c for c in docs.columns if c not in added],
        "n_bytes",
        found["depth"].cast("int").alias("shard_depth"),
        found["prefix"].alias("shard_prefix"),
        found["shard_bytes"].alias("shard_bytes"),
        (found["shard_bytes"] > limit).alias("oversized"),
    )


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Store the documents, a folder per shard; every shard is written by one task."""
    sharded = with_shards(docs, limit)
    sharded.repartition("shard_depth", "shard_prefix").write.partitionBy(
        "shard_depth", "shard_prefix"
    ).parquet(path)
