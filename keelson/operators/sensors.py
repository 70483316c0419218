"""Trailing-span reads and averages.

``as_of`` is always a parameter (a literal or a scalar-subquery column), never
a hidden ``now()``, so a rerun gives the same answer. The span predicate is a
plain comparison on the scan column, so it is pushed into the Parquet (or
JDBC) scan.

``pane_sums`` stores a sum and a count per small pane of time, refreshed by new
rows alone; ``trailing_from_panes`` answers a span from its whole panes and the
raw rows of the two panes at its edges, with the same result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.spans import span_us

_TOTAL = "decimal(38,6)"


def _as_col(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.datetime, _dt.date, str)):
        return F.lit(v)
    raise TypeError(f"as_of must be a Column, datetime or string, not {type(v)}")


def since(df: DataFrame, ts: str, as_of, span: str, key: str | None = None,
          key_value=None) -> DataFrame:
    """P10: rows with ``ts >= as_of - span`` (inclusive); optionally one key."""
    lower = _as_col(as_of) - F.expr(f"INTERVAL {span}")
    cond = F.col(ts) >= lower
    if key is not None and key_value is not None:
        cond = cond & (F.col(key) == F.lit(key_value))
    return df.filter(cond)


def trailing_avg(df: DataFrame, ts: str, val: str, as_of, span: str = "10 minutes",
                 key: str | None = None, key_value=None, digits: int | None = 2,
                 alias: str = "avg_value") -> DataFrame:
    """One row with the average of ``val`` over the trailing span and the
    number of rows it covers; the average is null when the span is empty."""
    a = F.avg(val)
    if digits is not None:
        a = F.round(a, digits)
    return since(df, ts, as_of, span, key, key_value).agg(
        a.alias(alias), F.count(F.lit(1)).alias("n_rows"))


def latest_value(df: DataFrame, ts: str):
    """``max(ts)`` resolved to a value (one partial-aggregated row reaches the
    driver). Passed as ``as_of`` it becomes a literal bound that Parquet
    pushdown uses to skip row groups (and files) outside the span; a
    subquery bound is only applied after the scan."""
    return df.agg(F.max(ts).alias("m")).first()["m"]


def pane_sums(df: DataFrame, ts: str, val: str, width: str = "1 minute", keys: tuple[str, ...] = ()) -> DataFrame:
    """(pane, *keys, n_rows, n_values, total): additive, so panes of new rows
    are added to stored ones. A value counts with six decimals, exactly summed."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    w = F.lit(span_us(width))
    pane = ((t - F.pmod(t, w)) / w).cast("bigint").alias("pane")
    return df.filter(F.col(ts).isNotNull()).groupBy(pane, *keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(val).alias("n_values"), F.sum(F.col(val).cast(_TOTAL)).alias("total"))


def merge_panes(panes: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Partials of the same pane added up."""
    return panes.groupBy("pane", *keys).agg(*(F.sum(c).alias(c) for c in ("n_rows", "n_values")),
                                            F.sum("total").cast(_TOTAL).alias("total"))


def trailing_from_panes(panes: DataFrame, raw: DataFrame, ts: str, val: str, as_of: _dt.datetime,
                        span: str = "10 minutes", width: str = "1 minute", digits: int | None = 2,
                        alias: str = "avg_value") -> DataFrame:
    """A8 over ``[as_of - span, as_of]`` from ``panes`` (partials are added up
    here) and ``raw``, of which only the edge panes' rows are read: ``as_of`` is
    a value, so both bounds reach the scan."""
    w = span_us(width)
    last = (as_of.replace(tzinfo=None) - _dt.datetime(1970, 1, 1)) // _dt.timedelta(microseconds=1)
    first = last - span_us(span)
    low, high = -(-first // w), (last + 1) // w          # panes low .. high - 1 are whole
    at = lambda us: F.lit(_dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)).cast(raw.schema[ts].dataType)
    t = F.col(ts)
    if low < high:
        edges = ((t >= at(first)) & (t < at(low * w))) | ((t >= at(high * w)) & (t <= at(last)))
    else:
        edges = (t >= at(first)) & (t <= at(last))
    whole = panes.filter((F.col("pane") >= low) & (F.col("pane") < high)).select("n_rows", "n_values", "total")
    rows = whole.unionByName(pane_sums(raw.filter(edges), ts, val, width).select("n_rows", "n_values", "total"))
    total, n = F.sum("total").cast("double"), F.sum("n_values")
    mean = F.when(n > 0, total / n)
    return rows.agg((mean if digits is None else F.round(mean, digits)).alias(alias),
                    F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
