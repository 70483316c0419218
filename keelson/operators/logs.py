"""Event-time log analytics, one code path for batch and streaming input
(T1-T3, P13, F6, F7, K7-K9).

``windowed_count`` is the crash-count operator: filter, optional watermark,
tumbling window per key, count, threshold. On a stream the watermark bounds
the state; on a batch it is skipped. The filter comes first, so only matching
rows reach the shuffle and the state store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.text import contains_ci
from keelson.functions.time import epoch_to_ts, event_time
from keelson.functions.json import parse_json_rows

# The log record as produced by the load generator.
LOG_SCHEMA = ("timestamp BIGINT, status STRING, severity STRING, source_ip STRING, "
              "user_id STRING, content STRING")


def parse_logs(raw: DataFrame, value_col: str = "value", schema: str = LOG_SCHEMA,
               unit: str = "ms", ts_field: str = "timestamp",
               out_col: str = "event_time") -> DataFrame:
    """Topic value bytes -> typed columns plus ``event_time``.

    Malformed records parse to a null struct and are dropped. ``unit`` is the
    epoch unit of ``ts_field`` (milliseconds for the generator's records).
    """
    parsed = parse_json_rows(raw, value_col, schema)
    return parsed.withColumn(out_col, epoch_to_ts(F.col(ts_field), unit))


def crash_filter(content: str = "content", severity: str = "severity",
                 term: str = "crash", levels: Sequence[str] = ("High", "Critical")) -> Column:
    """Case-blind ``term`` in content and severity in ``levels``."""
    return contains_ci(content, term) & F.col(severity).isin(*levels)


def windowed_count(df: DataFrame, ts: str, width: str = "10 seconds",
                   keys: Sequence[str] = ("user_id",), pred: Column | None = None,
                   watermark: str | None = None, min_count: int | None = 2,
                   alias: str = "crash_count", slide: str | None = None) -> DataFrame:
    """Rows per (tumbling window, keys) with count > ``min_count``.

    Output: ``window_start, window_end, *keys, <alias>``. On a stream pass a
    ``watermark`` (e.g. ``"30 seconds"``): in append mode each window is
    emitted once after the watermark passes its end; rows older than the
    watermark are dropped. The threshold filter after the aggregate is legal in
    append and update mode.
    """
    src = df.filter(pred) if pred is not None else df
    t = F.col(ts)
    if df.isStreaming or watermark:
        src = src.withColumn(ts, event_time(t))
        if watermark:
            src = src.withWatermark(ts, watermark)
    win = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = src.groupBy(win.alias("window"), *keys).agg(F.count(F.lit(1)).alias(alias))
    if min_count is not None:
        out = out.filter(F.col(alias) > min_count)
    return out.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *keys, alias)
