"""Operational reports.

* ``skew_report``: how unevenly rows spread over a key -- the question to ask
  before choosing salting, AQE skew-join or a chunked window.
* ``partition_report``: rows per physical partition of a DataFrame.
* ``heavy_keys``: the keys that hold at least a given share of all rows, found
  by a mergeable sketch and counted exactly; no shuffle holds every key.
* ``ProgressLog``: a listener that writes every progress event of a session's
  streams to a table as it comes, however many batches a query runs.
* ``progress_report``: a streaming query's per-batch progress (input and
  processing rates, batch time, state size, rows dropped by the watermark) as
  rows; it reads the query's own small progress log, not data, and that log
  holds the last 100 batches.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def skew_report(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """One row: keys, rows, min/avg/max rows per key, ``max / avg`` and the
    share of all rows held by the largest key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("_n").alias("n_rows"),
        F.min("_n").alias("min_rows"),
        F.max("_n").alias("max_rows"),
        F.round(F.avg("_n"), digits).alias("avg_rows"),
        F.round(F.max("_n") / F.avg("_n"), digits).alias("skew_ratio"),
        F.round(F.max("_n") / F.sum("_n"), digits).alias("top_share"),
    )


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per physical partition (after whatever exchange ``df`` ends with)."""
    return df.groupBy(F.spark_partition_id().alias("partition")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """(``key``, n_rows, share): every key with at least ``share`` of all rows.

    A frequent-items sketch (one small table of counters a task, merged) names
    at most ``1 / share`` candidates, among them every key that heavy; a second
    pass, filtered to them, counts exactly. Null is a key like any other."""
    if not 1e-4 <= share <= 1:
        raise ValueError("share lies between 0.0001 and 1")
    # a little under the share, as the sketch answers for keys above it
    named = df.select(key).freqItems([key], max(1e-4, share * 0.99)).first()[0]
    some = F.col(key).isin([k for k in named if k is not None]) | F.col(key).isNull()
    total = df.count()
    return (df.filter(some).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") >= F.lit(share) * total)
            .select(key, "n_rows", (F.col("n_rows") / F.lit(total)).alias("share")))


_PROGRESS_SCHEMA = ("batch_id bigint, num_input_rows bigint, input_rows_per_second double, "
                    "processed_rows_per_second double, trigger_ms bigint, "
                    "state_rows bigint, dropped_by_watermark bigint")


def progress_report(spark: SparkSession, query) -> DataFrame:
    """``query.recentProgress`` as a DataFrame, one row per micro-batch."""
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], _PROGRESS_SCHEMA)


def _progress_row(p) -> tuple:
    ops = p.get("stateOperators") or []
    return (int(p.get("batchId", -1)), int(p.get("numInputRows", 0)),
            float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0),
            int((p.get("durationMs") or {}).get("triggerExecution", 0)),
            int(sum(o.get("numRowsTotal", 0) for o in ops)),
            int(sum(o.get("numRowsDroppedByWatermark", 0) for o in ops)))


class ProgressLog(StreamingQueryListener):
    """Every progress event as a JSON file of one row under ``path``, in a
    folder per run of a query (``run_id=<id>``). Events come in the order of a
    query's batches, some time after them; ``wait`` returns once a run's last one
    is written. Use ``with ProgressLog(spark, path) as log:`` around the queries."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        names = [x.split()[0] for x in _PROGRESS_SCHEMA.split(", ")]
        self._write(f"run_id={p['runId']}/{p['batchId']}-{p['timestamp'].replace(':', '')}.json", dict(zip(names, _progress_row(p))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query, seconds: float = 60) -> None:
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"run {query.runId} has not reported its end")

    def _write(self, name: str, row: dict) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        try:
            out.write(json.dumps(row).encode())
        finally:
            out.close()

    def read(self) -> DataFrame:
        """All events so far, with the run they belong to."""
        return self.spark.read.schema(_PROGRESS_SCHEMA + ", run_id string").json(self.path)
