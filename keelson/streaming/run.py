"""Run a streaming DataFrame to completion into a table and read it back
(K4, K6-K11).

Output goes through ``foreachBatch`` into ``<out>/batch_id=<n>``, one folder
per micro-batch written with overwrite, so a replay after a failure rewrites
the same folder (idempotent, exactly-once at the table level). The reader
then applies the output mode:

* ``append``   -- every row of every batch;
* ``update``   -- the latest row per key (``max_by`` on batch id, partial
                  aggregation, so a hot key is not a hot reducer);
* ``complete`` -- the rows of the last batch.

Nothing is collected on the driver; the result is an ordinary lazy scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keelson.session import scratch_dir


def start(df: DataFrame, mode: str = "append", fmt: str = "console",
          checkpoint: str | None = None, trigger: dict | None = None,
          options: dict | None = None, query_name: str | None = None,
          foreach_batch: Callable | None = None, path: str | None = None):
    """Start a streaming query.

    ``mode`` is append (K9), update (K7) or complete (K8); ``trigger`` e.g.
    ``{"processingTime": "10 seconds"}`` (K10) or ``{"availableNow": True}``;
    ``checkpoint`` makes it restart where it stopped (K11). A stream's state
    has as many partitions as ``spark.sql.shuffle.partitions`` says at its first
    start; a restarted query keeps the number recorded in its checkpoint.
    """
    w = df.writeStream.outputMode(mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()


def finish(query) -> None:
    """Wait for a query that ends by itself; raise what ended it otherwise."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def to_console(df: DataFrame, mode: str = "append", rows: int = 50,
               checkpoint: str | None = None, trigger: dict | None = None):
    """K4: untruncated console output, up to ``rows`` rows per batch."""
    return start(df, mode, "console", checkpoint, trigger,
                 {"truncate": "false", "numRows": str(rows)})


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: overwrite ``out/batch_id=<id>`` (replay-safe)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def run_to_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
                 keys: Sequence[str] = (), trigger: dict | None = None,
                 out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run ``df`` (a stream) until its input is consumed and return the
    result table under the semantics of ``mode``."""
    out = out or scratch_dir(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_dir(spark, f"{name}-ck")
    schema = df.schema
    # an empty marker batch fixes the schema even if the stream emits nothing
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{out}/batch_id=-1")
    q = start(df, mode, checkpoint=checkpoint, trigger=trigger or {"availableNow": True},
              foreach_batch=batch_writer(out))
    finish(q)
    full = StructType(list(schema.fields) + [StructField("batch_id", LongType())])
    table = spark.read.schema(full).parquet(out)
    return read_mode(table, mode, keys, [f.name for f in schema.fields])


def read_mode(table: DataFrame, mode: str, keys: Sequence[str],
              cols: Sequence[str]) -> DataFrame:
    if mode == "append":
        return table.select(*cols)
    if mode == "complete":
        last = table.agg(F.max("batch_id")).scalar()
        return table.filter(F.col("batch_id") == last).select(*cols)
    if mode == "update":
        if not keys:
            raise ValueError("update mode needs the key columns")
        rest = [c for c in cols if c not in keys]
        latest = table.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), "batch_id").alias("_row"))
        return latest.select(*keys, "_row.*").select(*cols)
    raise ValueError(f"unknown output mode {mode!r}")


def run_parts(spark: SparkSession, parts: Sequence[DataFrame], schema, build: Callable[[DataFrame], DataFrame],
              name: str, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """Feed ``parts`` to one stream, a micro-batch each: a part is added to the
    stream's input folder and the query is started again from its checkpoint,
    so its state is written, read back and continued (K11). The result table of
    all parts is returned; ``build`` makes the stream from its input."""
    stage, out, ck = (scratch_dir(spark, f"{name}-{x}") for x in ("in", "out", "ck"))
    for part in parts:
        part.write.mode("append").parquet(stage)
        table = run_to_table(spark, build(spark.readStream.schema(schema).parquet(stage)), name, mode, keys,
                             out=out, checkpoint=ck)
    return table


def route_alerts(stream: DataFrame, handler: Callable[[DataFrame, int], None],
                 checkpoint: str, trigger: dict | None = None):
    """K6: hand each micro-batch of alerts to ``handler(batch_df, batch_id)``
    (a Parquet/JDBC/topic writer). Handlers should overwrite by batch id so a
    replay does not duplicate."""
    return start(stream, "append", checkpoint=checkpoint, trigger=trigger,
                 foreach_batch=handler)


def fan_out(spark: SparkSession, source: Callable[[], DataFrame],
            consumers: dict[str, Callable[[DataFrame], DataFrame]], root: str,
            mode: str = "append", trigger: dict | None = None,
            wait: bool = True) -> dict[str, str]:
    """Independent consumers of one feed. Each consumer is its own
    streaming query over its own read of the source, with its own checkpoint
    (its consumer group and progress) and its own output table, so one can
    lag, fail or restart without touching the others. Returns the output
    folder per consumer."""
    outs, queries = {}, []
    for name, build in consumers.items():
        out = f"{root}/{name}/out"
        stream = build(source())
        spark.createDataFrame([], stream.schema).write.mode("overwrite") \
            .parquet(f"{out}/batch_id=-1")
        q = start(stream, mode, checkpoint=f"{root}/{name}/ck",
                  trigger=trigger or {"availableNow": True},
                  foreach_batch=batch_writer(out), query_name=None)
        outs[name] = out
        queries.append(q)
    if wait:
        for q in queries:
            finish(q)
    return outs


# ---- K6: ready-made per-batch writers for route_alerts / fan_out ----------

def topic_writer(servers, topic: str, key: str | None = None) -> Callable[[DataFrame, int], None]:
    """Alerts to a topic, keyed for per-key order. A replayed batch is sent
    again (at least once); consumers dedupe on the ``batch_id`` field added
    to each message."""
    from keelson.sources.topic import write_topic

    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic(batch.withColumn("batch_id", F.lit(batch_id)), servers, topic, key)
    return write


def jdbc_writer(url: str, table: str, props: dict | None = None,
                batchsize: int = 1000) -> Callable[[DataFrame, int], None]:
    """Alerts appended to a database table with a ``batch_id`` column; a
    replayed batch appends again (at least once), so the table should carry a
    unique key on the alert id, or readers take the latest ``batch_id``."""
    from keelson.sources.jdbc import append_jdbc

    def write(batch: DataFrame, batch_id: int) -> None:
        append_jdbc(batch.withColumn("batch_id", F.lit(batch_id)), url, table, props, batchsize)
    return write
