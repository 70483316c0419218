"""Positions of rows across partitions, without a group in one task.

A window function numbers a group's rows in the task that holds them all.
``numbered`` deals the rows by range of (group, order) instead, so a group
spans as many parts as its size asks for; each part's share of each group is
counted, and the counts of the parts before it are added as an offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import scratch_dir

_IN_PART = (1 << 33) - 1


def dealt(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` as a table dealt by range and sorted, with each row's part
    (``_part``) and place in it (``_at``)."""
    spark, keys = df.sparkSession, [group, *order]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .select("*", F.spark_partition_id().alias("_part"),
             F.monotonically_increasing_id().bitwiseAND(_IN_PART).alias("_at"))
     .write.parquet(path := scratch_dir(spark, "dealt")))
    return spark.read.parquet(path)


def numbered(df: DataFrame, group: str, order: Sequence[str], alias: str) -> DataFrame:
    """``df`` with ``alias``, the row's position (from 0) in its group by
    ``order``, nulls first. A null group is a group of its own; rows equal in
    group and order are numbered in any order and share a task."""
    table = dealt(df, group, order)
    parts = (table.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")))
    # a row per part and group: parts of one group in order, counts before each
    sofar = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.select("_group", "_of", (F.sum("_n").over(sofar) - F.col("_n") - F.col("_first")).alias("_shift"))
    here = table[group].eqNullSafe(parts["_group"]) & (table["_part"] == parts["_of"])
    return table.join(parts, here).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(alias))
