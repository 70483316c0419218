"""Connected components of an edge table, by alternating large and small stars.

Every round is two aggregations (minima, combined before the shuffle) and two
joins, whose large keys the adaptive planner splits; no neighbourhood is ever
gathered in one row. Rounds are written to the shared folder, which also cuts
the lineage; their number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keelson.session import scratch_dir


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) but the roots: the
    smallest node of its component. Loops and repeated edges change nothing."""
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        df.write.parquet(path := scratch_dir(spark, "stars"))
        df = spark.read.parquet(path)
        mark = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return df, tuple(mark)

    now, mark = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.select("a", F.col("m").alias("b")).unionByName(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        before = mark
        now, mark = written(small)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
