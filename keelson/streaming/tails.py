"""Per-user history kept as a small table between micro-batches (T4, T5,
JVM-side).

The rules need little history per user: the velocity the events of the last
``span``, the profile the last ``depth`` valid amounts. Instead of Python state
per user, each micro-batch (``foreachBatch``):

1. reads the history table that the previous batch left,
2. unions it with the new rows and runs the batch operator of
   :mod:`keelson.operators.fraud` (JVM windows, split per (user, time chunk)
   when a user is hot),
3. writes the new rows' results (``_kind=out``) and the next history
   (``_kind=tail``) under ``batch_id=<n>`` with overwrite, and deletes the
   history before the previous one.

A replayed batch reads the same previous history and rewrites the same folder,
so the output is exactly once. A missing history is an error: only batch 0
starts without one.

The velocity's history is cut by one time for all users: the newest event time
seen less ``lateness`` and ``span``. Users who stop leave it, so its size
follows the event rate. An event that arrives more than ``lateness`` behind the
newest may find its history gone. The profile's history holds at most ``depth``
rows per user, whatever their age, as the rule asks; it is kept in buckets by a
hash of the user, and a batch reads and rewrites only the buckets of its own
users. A bucket's newest folder counts; what it replaced goes when the next
batch begins, so a batch that runs again finds what it read the first time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keelson.functions.spans import span_us
from keelson.operators.fraud import flag_outliers, profile, velocity
from keelson.streaming.run import start


def _path(out: str, batch_id: int, kind: str) -> str:
    return f"{out}/batch_id={batch_id}/_kind={kind}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _run(stream: DataFrame, out: str, checkpoint: str, trigger: dict | None,
         step: Callable[[DataFrame], tuple[DataFrame, DataFrame]]):
    """``step`` takes the history and the new rows (marked by ``_tail``) and
    gives the scored rows and the next history."""
    schema = stream.schema

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        both = batch.withColumn("_tail", F.lit(False))
        if batch_id:
            before = spark.read.schema(schema).parquet(_path(out, batch_id - 1, "tail"))
            both = both.unionByName(before.withColumn("_tail", F.lit(True)))
        both = both.persist()      # read by the sizing, the scoring and the history
        try:
            scored, tail = step(both)
            scored.filter(~F.col("_tail")).drop("_tail").write.mode("overwrite").parquet(_path(out, batch_id, "out"))
            tail.select(*schema.names).write.mode("overwrite").parquet(_path(out, batch_id, "tail"))
        finally:
            both.unpersist()
        if batch_id > 1:
            _delete(spark, _path(out, batch_id - 2, "tail"))

    return start(stream, "append", checkpoint=checkpoint,
                 trigger=trigger or {"availableNow": True}, foreach_batch=process)


def velocity_batches(stream: DataFrame, user: str, ts: str, id_col: str, out: str,
                     checkpoint: str, span: str = "60 seconds", amount: str | None = None,
                     alias: str = "velocity", trigger: dict | None = None,
                     lateness: str = "1 hour", max_group_rows: int = 2_000_000):
    """Start the T4 stream; results land in ``out/batch_id=*/_kind=out``.

    Returns the ``StreamingQuery``; read results with :func:`read_results`."""
    keep = span_us(span) + span_us(lateness)
    t = F.unix_micros(F.col(ts).cast("timestamp"))

    def step(both: DataFrame) -> tuple[DataFrame, DataFrame]:
        valid = F.col(ts).isNotNull() if amount is None else F.col(ts).isNotNull() & F.col(amount).isNotNull()
        newest = both.filter(valid).agg(F.max(t)).first()[0]
        scored = velocity(both, user, ts, id_col, span, amount=amount, alias=alias, max_group_rows=max_group_rows)
        return scored, both.filter(valid & (t >= F.lit((newest or 0) - keep)))

    return _run(stream, out, checkpoint, trigger, step)


def _folders(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


class _Buckets:
    """A history in ``<path>/batch_id=<n>/bucket=<b>`` folders, of which each
    bucket's newest counts; there are at most two a bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets

    def number(self, user: str) -> Column:
        return F.pmod(F.xxhash64(user), F.lit(self.buckets)).cast("int")

    def newest(self, batch_id: int) -> dict[int, int]:
        """The batch that last wrote each bucket before ``batch_id``; folders
        that were replaced before then are deleted."""
        found: dict[int, int] = {}
        batches = [int(n[9:]) for n in _folders(self.spark, self.path) if n.startswith("batch_id=")]
        for n in sorted(n for n in batches if n < batch_id):
            held = [int(x[7:]) for x in _folders(self.spark, f"{self.path}/batch_id={n}") if x.startswith("bucket=")]
            for b in held:
                if b in found:
                    _delete(self.spark, f"{self.path}/batch_id={found[b]}/bucket={b}")
                found[b] = n
        for n in {*batches} - {*found.values()}:
            if n < batch_id:
                _delete(self.spark, f"{self.path}/batch_id={n}")
        return found

    def read(self, touched: list[int], batch_id: int) -> DataFrame | None:
        newest = self.newest(batch_id)
        places = [f"{self.path}/batch_id={newest[b]}/bucket={b}" for b in touched if b in newest]
        return self.spark.read.schema(self.schema).parquet(*places) if places else None

    def write(self, rows: DataFrame, user: str, batch_id: int) -> None:
        (rows.select(*self.schema.names).withColumn("bucket", self.number(user)).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch_id={batch_id}"))


def profile_batches(stream: DataFrame, user: str, ts: str, id_col: str, amount: str, out: str,
                    checkpoint: str, depth: int = 50, min_n: int = 3, ratio: float = 3.0,
                    floor: float = 500.0, trigger: dict | None = None, max_group_rows: int = 2_000_000,
                    buckets: int = 16):
    """Start the T5 stream (ratio rule); results as for :func:`velocity_batches`.

    Batches must arrive in time order per user. The history has ``buckets``
    buckets; their number must stay the same for a checkpoint's life, and is
    to be chosen so that one holds what a task can sort."""
    schema = stream.schema

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        history = _Buckets(spark, f"{out}/history", schema, buckets)
        if batch_id and f"batch_id={batch_id - 1}" not in _folders(spark, out):
            raise ValueError(f"{out} does not hold batch {batch_id - 1}: its history is lost")
        both = batch.withColumn("_tail", F.lit(False))
        touched = [r[0] for r in batch.select(history.number(user)).distinct().collect()]     # ``buckets`` at most
        before = history.read(sorted(touched), batch_id)
        if before is not None:
            both = both.unionByName(before.withColumn("_tail", F.lit(True)))
        both = both.persist()
        try:
            scored = flag_outliers(profile(both, user, ts, id_col, amount, depth=depth, max_group_rows=max_group_rows),
                                   amount, ratio=ratio, floor=floor, min_n=min_n)
            scored.filter(~F.col("_tail")).drop("_tail").write.mode("overwrite").parquet(_path(out, batch_id, "out"))
            newest = Window.partitionBy(user).orderBy(F.col(ts).desc(), F.col(id_col).desc())
            # a rank below a constant: Spark keeps the first ``depth`` rows per user before the shuffle
            last = (both.filter(F.col(amount).isNotNull()).withColumn("_rank", F.row_number().over(newest))
                    .filter(F.col("_rank") <= depth))
            history.write(last, user, batch_id)
        finally:
            both.unpersist()

    return start(stream, "append", checkpoint=checkpoint,
                 trigger=trigger or {"availableNow": True}, foreach_batch=process)


def read_results(spark: SparkSession, out: str) -> DataFrame:
    """The results of all batches (the histories excluded)."""
    return (spark.read.option("basePath", out).parquet(f"{out}/batch_id=*/_kind=out")
            .drop("_kind", "batch_id"))
