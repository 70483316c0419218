"""Counting the rows of an equi-join without producing them.

An inner equi-join on a low-cardinality key has about N^2/k rows; emitting
them is quadratic. Both operators here count instead:

* ``pair_count_join`` keeps the join but moves the aggregate below it (eager
  aggregation): each side is reduced to ``(key, count)`` with partial
  aggregation, the two small tables are joined, and ``sum(l_cnt * r_cnt)`` is
  the join's row count. It works for any two inputs, not only a self-join.
* ``pair_count`` is the self-join special case with no join at all:
  ``sum(cnt * cnt)``.

Null keys form a group but join nothing, so they are removed first. Products
are ``decimal(38,0)``: ``bigint`` overflows under ANSI from ~3.04e9 rows/key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DEC = "decimal(38,0)"


def _key_counts(df: DataFrame, key: str, alias: str) -> DataFrame:
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).cast(_DEC).alias(alias)))


def pair_count_join(left: DataFrame, key: str, right: DataFrame | None = None,
                    right_key: str | None = None,
                    alias: str = "pair_count") -> DataFrame:
    """Row count of ``left JOIN right ON left.key = right.key``.

    ``right`` defaults to ``left`` (the self-join). The join runs over the
    per-key counts, whose size is the number of distinct keys; Catalyst
    broadcasts them when its size estimate is under the threshold and
    shuffles otherwise, and for a self-join the second side reuses the first
    side's exchange.
    """
    counts = _key_counts(left, key, "_l_cnt").withColumnRenamed(key, "_k")
    if right is None:
        # self-join: both sides are the one count table (one scan, one shuffle)
        r_cnt = counts.select(F.col("_k").alias("_k2"), F.col("_l_cnt").alias("_r_cnt"))
    else:
        rk = right_key or key
        r_cnt = _key_counts(right, rk, "_r_cnt").withColumnRenamed(rk, "_k2")
    joined = counts.join(r_cnt, F.col("_k") == F.col("_k2"), how="inner")
    total = F.sum((F.col("_l_cnt") * F.col("_r_cnt")).cast(_DEC))
    return joined.agg(F.coalesce(total, F.lit(0).cast(_DEC)).cast(_DEC).alias(alias))


def pair_count(df: DataFrame, key: str, alias: str = "pair_count") -> DataFrame:
    """The self-join count as ``sum(cnt * cnt)`` over non-null keys;
    0 on empty input."""
    cnt = _key_counts(df, key, "_cnt")
    total = F.sum((F.col("_cnt") * F.col("_cnt")).cast(_DEC))
    return cnt.agg(F.coalesce(total, F.lit(0).cast(_DEC)).cast(_DEC).alias(alias))
