"""One document of each group of near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.components import written
from tripstrata.llm.jaccard import jaccard_components
from tripstrata.llm.private import free_name


def keep_one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each group of ``docs`` that are similar, directly or in chains.

    The row with the smallest ``doc_id`` stays, one without an id only where no other has one; among rows of
    one id any. Rows are told apart by a number of their own, not by ``doc_id``: rows that share an id and
    are not similar all stay, and copies without an id are reduced as well. Rows without words are similar to
    nothing and stay. The numbered rows are stored, so that they keep their numbers.
    """
    row = free_name(docs, "row_number")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = written(
        jaccard_components(numbered.select(F.col(row).alias("doc_id"), F.col(text).alias("text"))), "components"
    )
    group = found.select(F.col("doc_id").alias("number"), F.col("component_id").alias("group"))
    shared = written(
        group.join(group.where("number <> group").select("group").distinct(), "group"), "groups"
    )
    # Only rows of groups with several members are looked at; a hot group is reduced before it is shuffled.
    ids = numbered.select(F.col(row).alias("number"), F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "number")).alias("first")
    kept = ids.join(shared, "number").groupBy("group").agg(first).select(F.col("first.number").alias("number"))
    gone = shared.select("number").join(kept, "number", "left_anti")
    blank = ids.join(found.where("n_shingles = 0").select(F.col("doc_id").alias("number")), "number")
    blank = written(blank, "blank")
    one = blank.groupBy("id").agg(F.min("number").alias("number")).select("number")
    gone = gone.unionByName(blank.select("number").join(one, "number", "left_anti"))
    return numbered.join(gone, numbered[row] == gone["number"], "left_anti").select(*docs.columns)
