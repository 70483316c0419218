"""Continuous ingest of a JSON topic into a queryable append-only table.

Topic value -> ``from_json`` against a fixed schema -> event time from the
epoch field -> Parquet append, partitioned by day when asked. The checkpoint
makes it resume after a failure without loss or duplicates (file sink
commit log); ``maxRecordsPerFile`` plays the segment-size role and the
trigger interval the roll-over time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keelson.functions.json import parse_json_rows
from keelson.functions.time import epoch_to_ts


def parse_records(stream: DataFrame, schema: StructType | str, value_col: str = "value",
                  ts_field: str | None = "timestamp", unit: str = "ms",
                  ts_out: str | None = None) -> DataFrame:
    """Typed rows from JSON values; malformed records are dropped."""
    rows = parse_json_rows(stream, value_col, schema)
    if ts_field:
        rows = rows.withColumn(ts_out or ts_field, epoch_to_ts(F.col(ts_field), unit))
    return rows


def ingest_to_table(stream: DataFrame, schema: StructType | str, path: str, checkpoint: str,
                    value_col: str = "value", ts_field: str | None = "timestamp",
                    unit: str = "ms", ts_out: str | None = None,
                    partition_by: Sequence[str] = (), trigger: dict | None = None,
                    max_records_per_file: int | None = None):
    """Start the ingest query; returns the ``StreamingQuery``."""
    rows = parse_records(stream, schema, value_col, ts_field, unit, ts_out)
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path)
