"""Window counts that late rows repair.

A watermark closes windows; a row that arrives for a closed window is late. A
stateful aggregate drops it. Here each micro-batch (``foreachBatch``)

1. stores its raw rows by time slice (``raw``), and the late ones besides in a
   side table (``late``);
2. counts, from the raw rows, the windows that the watermark has passed since
   the batch before, and once more those that a late row belongs to;
3. writes these windows under its batch number (``windows``); a reader takes
   each window from the newest batch that wrote it.

Only the slices of windows that close or are repaired are read again (slices
are folders: a range of them for closing windows, a join with the late rows'
windows for repaired ones), and no other window is rewritten. The watermark is
the largest event time of the batches before, less ``delay``, as in a stateful
query; it is kept in a one-row table per batch. All tables are written with
overwrite under the batch number, the watermark last: a replayed batch gives
the same rows. Raw rows are kept for as long as late rows are to be repaired;
delete slices older than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keelson.functions.spans import span_us
from keelson.functions.time import event_time
from keelson.streaming.run import start

_START = -(1 << 62)


def keep_windows(stream: DataFrame, ts: str, out: str, checkpoint: str, width: str = "10 seconds",
                 keys: Sequence[str] = ("user_id",), pred: Column | None = None, delay: str = "30 seconds",
                 min_count: int | None = 2, alias: str = "crash_count", slice_width: str = "1 hour",
                 trigger: dict | None = None):
    """Start the stream; read its windows with :func:`read_windows` and its late
    rows with :func:`read_late`. Rows without a time are left out."""
    width_us, delay_us = span_us(width), span_us(delay)
    slice_us = max(width_us, span_us(slice_width))
    floor = lambda c, n: ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("bigint")

    def process(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = (batch if pred is None else batch.filter(pred)).withColumn("_t", F.unix_micros(event_time(F.col(ts))))
        rows = rows.filter(F.col("_t").isNotNull()).withColumn("_w", floor(F.col("_t"), width_us))
        rows = rows.withColumn("slice", floor(F.col("_w") * width_us, slice_us)).persist()
        try:
            seen = _START if n == 0 else spark.read.parquet(f"{out}/seen/batch_id={n - 1}").first()[0]
            newest = max(seen, rows.agg(F.max("_t")).first()[0] or _START)
            passed, passes = seen - delay_us, newest - delay_us
            rows.write.mode("overwrite").partitionBy("slice").parquet(f"{out}/raw/batch_id={n}")
            ends = (F.col("_w") + 1) * F.lit(width_us)
            late = rows.filter(ends <= passed)
            late.drop("_t", "_w", "slice").write.mode("overwrite").parquet(f"{out}/late/batch_id={n}")

            stored = StructType([*rows.schema.fields, StructField("batch_id", LongType())])
            held = spark.read.schema(stored).parquet(f"{out}/raw").filter(F.col("batch_id") <= n)
            between = F.col("slice").between(passed // slice_us - 1, passes // slice_us)
            closing = held.filter(between & (ends > passed) & (ends <= passes))
            touched = late.select("slice", "_w").distinct()
            again = held.join(touched, ["slice", "_w"], "left_semi").select(closing.columns)
            counts = closing.unionByName(again).groupBy("_w", *keys).agg(F.count(F.lit(1)).alias(alias))
            if min_count is not None:
                counts = counts.filter(F.col(alias) > min_count)
            at = lambda w: F.timestamp_micros(w * width_us)
            counts.select(at(F.col("_w")).alias("window_start"), at(F.col("_w") + 1).alias("window_end"), *keys, alias) \
                .write.mode("overwrite").parquet(f"{out}/windows/batch_id={n}")
            spark.createDataFrame([(newest,)], "newest bigint").write.mode("overwrite").parquet(f"{out}/seen/batch_id={n}")
        finally:
            rows.unpersist()

    return start(stream, "append", checkpoint=checkpoint, trigger=trigger or {"availableNow": True}, foreach_batch=process)


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """Every window as the newest batch that counted it left it."""
    stored = spark.read.parquet(f"{out}/windows")
    newest = stored.groupBy("window_start").agg(F.max("batch_id").alias("batch_id"))
    return stored.join(newest, ["window_start", "batch_id"], "left_semi").drop("batch_id")


def read_late(spark: SparkSession, out: str) -> DataFrame:
    """The rows that arrived behind the watermark."""
    return spark.read.parquet(f"{out}/late").drop("batch_id")
