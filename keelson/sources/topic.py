"""Topics (S3-S5, K5) through Spark's Kafka source and sink.

The connector jar is supplied by the deployment (``--packages``); the option
maps are plain functions so they are checked without a broker. Each
consumer of a feed is its own streaming query with its own
``checkpointLocation``: that is its consumer group and its progress (S5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str | Sequence[str], topic: str, starting: str = "earliest",
                   ending: str | None = None, fail_on_loss: bool = False,
                   max_offsets: int | None = None, pattern: bool = False,
                   extra: dict | None = None) -> dict[str, str]:
    """Options of the Kafka source; ``max_offsets`` caps a micro-batch
    (which bounds per-key work in stateful operators)."""
    opts = {
        "kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
        ("subscribePattern" if pattern else "subscribe"): topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if ending is not None:
        opts["endingOffsets"] = ending
    if max_offsets is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    opts.update(extra or {})
    return opts


def read_topic_stream(spark: SparkSession, servers, topic: str, starting: str = "earliest",
                      fail_on_loss: bool = False, max_offsets: int | None = None,
                      extra: dict | None = None) -> DataFrame:
    """S3: ``key, value (binary), topic, partition, offset, timestamp, ...``;
    one task per topic partition. ``max_offsets``, where given, bounds a
    micro-batch, so that a replay from ``earliest`` proceeds in bounded steps."""
    opts = source_options(servers, topic, starting, None, fail_on_loss, max_offsets,
                          extra=extra)
    return spark.readStream.format("kafka").options(**opts).load()


def read_topic_batch(spark: SparkSession, servers, topic: str, starting: str = "earliest",
                     ending: str = "latest", extra: dict | None = None) -> DataFrame:
    """The topic from ``starting`` to ``ending`` as a bounded table."""
    opts = source_options(servers, topic, starting, ending, extra=extra)
    return spark.read.format("kafka").options(**opts).load()


def to_messages(df: DataFrame, key: str | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """K5: rows -> ``(key, value)`` messages, value = JSON of the columns.

    With a key, all messages of one key go to one partition, in order; without,
    the producer spreads them."""
    cols = list(columns) if columns else df.columns
    value = F.to_json(F.struct(*cols)).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def write_topic(df: DataFrame, servers, topic: str, key: str | None = None,
                checkpoint: str | None = None, trigger: dict | None = None):
    """K5: write messages to a topic, as a batch or (``df.isStreaming``) as a
    checkpointed stream; returns the query for streams."""
    msgs = to_messages(df, key)
    bootstrap = servers if isinstance(servers, str) else ",".join(servers)
    if df.isStreaming:
        w = (msgs.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("topic", topic).option("checkpointLocation", checkpoint))
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    msgs.write.format("kafka").option("kafka.bootstrap.servers", bootstrap) \
        .option("topic", topic).save()
    return None
