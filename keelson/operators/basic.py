"""Counts, grouped averages and sums, top-k and filtered counts
(A1-A7, O1-O4, P1-P4, F1, F12).

Every aggregate here is partial + final: Spark combines map-side before the
shuffle, so a key holding a third of the rows costs one partial row per task,
not a hot reducer. Top-k plans become ``TakeOrderedAndProject`` (a bounded
heap per task), never a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.decimal import limb_sums, limb_total, product_limb_sums, units


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _desc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def _asc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """A1: ``count(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of all columns under a fixed order."""
    return df.orderBy(*[_asc(c) for c in order_by]).limit(n)


def top_n(df: DataFrame, by: str, n: int = 10, tie: Sequence[str] = (),
          columns: Sequence[str] | None = None) -> DataFrame:
    """O1/O2: the ``n`` rows with the largest ``by`` (nulls last), ties
    broken by ``tie`` ascending so the answer is fixed."""
    out = df.select(*columns) if columns else df
    return out.orderBy(_desc(by), *[_asc(t) for t in tie]).limit(n)


def avg_by(df: DataFrame, key: str, val: str, digits: int = 2, n: int | None = 10,
           alias: str = "avg_value") -> DataFrame:
    """Rounded average per group, groups by key descending, limited."""
    out = df.groupBy(key).agg(F.round(F.avg(val), digits).alias(alias))
    out = out.orderBy(_desc(key))
    return out.limit(n) if n else out


def avg_of_avg(df: DataFrame, outer: str, inner: str, val: str, n: int | None = 10,
               alias: str = "avg_value") -> DataFrame:
    """A3: average of the per-(outer, inner) averages, per outer group,
    largest first. Not the plain average: every inner group weighs the same.
    Both levels aggregate partially; the inner result is small (groups)."""
    inner_avg = df.groupBy(outer, inner).agg(F.avg(val).alias("_inner_avg"))
    out = inner_avg.groupBy(outer).agg(F.avg("_inner_avg").alias(alias))
    out = out.orderBy(_desc(alias), _asc(outer))
    return out.limit(n) if n else out


def top_sum(df: DataFrame, key: str, val: str, k: int = 3,
            alias: str = "total") -> DataFrame:
    """A4: sum per group, top ``k`` groups (key ascending on ties)."""
    out = df.groupBy(key).agg(F.sum(val).alias(alias))
    return out.orderBy(_desc(alias), _asc(key)).limit(k)


def revenue_by(df: DataFrame, key: str, price: str, qty: str,
               alias: str = "revenue", exact: bool = True,
               decimals: tuple[int, int] = (3, 3), wide: bool = False) -> DataFrame:
    """A5/O3: revenue per group, all groups, largest first.

    With ``exact`` the products are whole units (``decimals`` of price and
    quantity together) and the sum is exact via long limbs
    (:func:`keelson.functions.decimal.limb_sums`), cast to double only at the
    end; float sums differ in the last digits between engines and between
    runs with different partitioning. A value with more decimals than stated
    is an error, and so is a product of over 9.2e18 units (9.2e12 at the default
    decimals) unless ``wide``, which sums those exactly too, at half the speed."""
    if not exact:
        out = df.groupBy(key).agg(F.sum(F.col(price) * F.col(qty)).alias(alias))
    else:
        a, b = units(price, decimals[0]), units(qty, decimals[1])
        limbs = product_limb_sums(a, b, "_rev") if wide else limb_sums(a * b, "_rev")
        out = df.groupBy(key).agg(*limbs) \
            .select(key, limb_total("_rev", sum(decimals)).cast("double").alias(alias))
    return out.orderBy(_desc(alias), _asc(key))


def top_revenue(df: DataFrame, key: str, price: str, qty: str, k: int = 10,
                alias: str = "revenue") -> DataFrame:
    """The ``k`` groups with the largest revenue."""
    return revenue_by(df, key, price, qty, alias).limit(k)


def match_count(df: DataFrame, key: str | Sequence[str], pred: Column | None = None,
                alias: str = "match_count") -> DataFrame:
    """Rows matching ``pred``, counted per key, largest first.

    Works on batch and streaming input (on a stream the sort needs complete
    mode). The filter sits before the aggregate so state holds matching keys
    only."""
    keys = _cols(key)
    src = df.filter(pred) if pred is not None else df
    out = src.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    return out.orderBy(_desc(alias), *[_asc(k) for k in keys])
