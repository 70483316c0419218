"""Precomputed answers for repeated queries.

* summary: additive per-key counts kept as one partial per micro-batch
  (``batch_id``-keyed, overwritten on replay) and summed on read; a refresh
  touches only the new rows.
* segmented summary: the same partials merged in size classes as they come
  (:mod:`keelson.operators.segments`), so a read sums few of them however many
  batches there were.
* cube: counts over every combination of the chosen dimensions in one pass
  (``cube`` expands each row once per grouping set, then partial-aggregates),
  with ``grouping_id`` telling which dimensions a row rolls up.
* stored cube: chosen levels kept as tables of additive partials, each made
  from the smallest stored level that covers it; a question is answered from
  the smallest level that covers its dimensions and its filters.
* token index: (token, doc) pairs of a text column, hash-bucketed by token
  into folders and sorted inside each; a search reads the terms' buckets
  only, with an ``In`` filter on the token pushed into the scan. Fed by a
  stream, each micro-batch writes a segment of the index, and segments merge
  in size classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from keelson.functions.text import tokens
from keelson.operators.segments import Segments


# ---- A10: summary table -------------------------------------------------

def build_summary(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    """Per-key row counts of ``df`` (one partial)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def merge_summary(path: str, batch: DataFrame, batch_id: int, keys: Sequence[str],
                  alias: str = "n") -> None:
    """Add the counts of one batch of new rows: written under
    ``path/batch_id=<id>`` with overwrite, so replaying a batch is harmless."""
    build_summary(batch, keys, alias).write.mode("overwrite") \
        .parquet(f"{path}/batch_id={batch_id}")


def read_summary(spark: SparkSession, path: str, keys: Sequence[str],
                 alias: str = "n") -> DataFrame:
    """The current summary: partials summed per key."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.sum(alias).alias(alias))


def segmented_summary(spark: SparkSession, path: str, keys: Sequence[str], alias: str = "n",
                      fan: int = 4) -> Segments:
    """A summary whose partials merge ``fan`` by ``fan``; feed it with :func:`add_to_summary`."""
    return Segments(spark, path, fan, merge=lambda rows: rows.groupBy(*keys).agg(F.sum(alias).alias(alias)))


def add_to_summary(summary: Segments, batch: DataFrame, batch_id: int, keys: Sequence[str], alias: str = "n") -> None:
    """Add the counts of one batch of new rows (a ``foreachBatch`` body)."""
    summary.add(build_summary(batch, keys, alias), batch_id)


def read_segmented_summary(summary: Segments, keys: Sequence[str], alias: str = "n") -> DataFrame:
    """The current summary: the few live partials summed per key."""
    return summary.read().groupBy(*keys).agg(F.sum(alias).alias(alias))


# ---- A11: dimension cube ------------------------------------------------

def cube_counts(df: DataFrame, dims: Sequence[str], alias: str = "n",
                measures: Sequence[Column] = ()) -> DataFrame:
    """Counts for every subset of ``dims``; ``level`` is ``grouping_id()``
    (bit set = dimension rolled up, first dimension most significant)."""
    return df.cube(*dims).agg(F.count(F.lit(1)).alias(alias), *measures,
                              F.grouping_id().alias("level"))


def cube_level(cube: DataFrame, dims: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The rows of ``cube`` that answer a query grouped by ``keep`` only."""
    level = 0
    for i, d in enumerate(dims):
        if d not in keep:
            level |= 1 << (len(dims) - 1 - i)
    return cube.filter(F.col("level") == level).select(*keep, *[c for c in cube.columns
                                                              if c not in dims and c != "level"])


class StoredCube:
    """Levels of a cube kept as tables, and questions sent to the smallest that fits.

    ``levels`` are the stored combinations of dimensions; the first must hold
    all of them. ``measures`` maps names to columns to be summed; the row count
    ``n`` is always kept. All partials are additive, so any level is made from,
    and any question answered by, a level with more dimensions. Null is a value
    of a dimension like any other."""

    def __init__(self, spark: SparkSession, path: str, levels: Sequence[Sequence[str]], measures: Sequence[str] = ()):
        self.spark, self.path = spark, path
        self.levels = [tuple(x) for x in levels]
        if any(set(x) - set(self.levels[0]) for x in self.levels):
            raise ValueError("the first level must hold all dimensions")
        self.measures = ["n", *measures]
        self.rows: dict[tuple[str, ...], int] = {}

    def _place(self, level: tuple[str, ...]) -> str:
        return f"{self.path}/by_{'_'.join(level) or 'nothing'}"

    def _sums(self, rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.groupBy(*by).agg(*(F.sum(m).alias(m) for m in self.measures))

    def build(self, df: DataFrame) -> StoredCube:
        """Store all levels: the first from ``df``, the others (largest first)
        from the smallest level stored by then that covers them."""
        source = df.withColumn("n", F.lit(1).cast("bigint"))
        for level in sorted(self.levels, key=lambda x: (x != self.levels[0], -len(x))):
            if self.rows:
                source = self.table(self.choose(level))
            self._sums(source, level).write.mode("overwrite").parquet(self._place(level))
            self.rows[level] = self.table(level).count()
        return self

    def table(self, level: tuple[str, ...]) -> DataFrame:
        return self.spark.read.parquet(self._place(level))

    def choose(self, dims: Sequence[str]) -> tuple[str, ...]:
        """The stored level of fewest rows that holds ``dims``."""
        fits = [x for x in self.rows if set(dims) <= set(x)]
        if not fits:
            raise ValueError(f"no stored level holds {sorted(set(dims))}")
        return min(fits, key=lambda x: (self.rows[x], len(x), x))

    def ask(self, by: Sequence[str] = (), where: dict[str, object] | None = None) -> DataFrame:
        """The measures per ``by``, of the rows whose dimensions have the values of ``where``."""
        where = where or {}
        found = self.table(self.choose([*by, *where]))
        for dim, value in where.items():
            found = found.filter(F.col(dim).eqNullSafe(F.lit(value)))
        return self._sums(found, by)


# ---- P16: token index ---------------------------------------------------

def build_token_index(df: DataFrame, id_col: str, text: str,
                      extra: Sequence[str] = ()) -> DataFrame:
    """(token, id) for every distinct word of every text, whole texts."""
    return df.select(F.explode(tokens(text)).alias("token"), id_col, *extra)


def token_bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


#: Rows of an index that a task gathers before it packs them by token.
PACKED_ROWS = 500_000


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows to one row for each token of every ``PACKED_ROWS`` rows, its other columns as lists."""
    def pack(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        others = [c for c in table.column_names if c != "token"]
        found = table.group_by("token", use_threads=False).aggregate([(c, "list") for c in others])
        return found.select(["token", *(f"{c}_list" for c in others)]).rename_columns(["token", *others]).to_batches(max_chunksize=10_000)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= PACKED_ROWS:
            yield from pack(held)
            held, rows = [], 0
    if rows:
        yield from pack(held)


def write_token_index(index: DataFrame, path: str, buckets: int = 16) -> None:
    """Hash-bucket the index by token into ``bucket=<b>`` folders, sorted by
    token inside each file: a lookup reads one folder (partition pruning)
    and, in it, only the row groups whose token range holds the term.
    Hashing needs no sampling pass over the data, unlike range partitioning.

    Tasks pack their rows by token before the shuffle, so a word travels once
    for many rows, and unpack them after it. A common word can hold a large
    share of all (token, id) rows, so the shuffle is a ``rebalance`` on the
    bucket: AQE splits a skewed bucket over several tasks (several files in its
    folder) and merges small ones."""
    others = [f for f in index.schema.fields if f.name != "token"]
    lists = StructType([StructField("token", StringType()), *(StructField(f.name, ArrayType(f.dataType)) for f in others)])
    packed = index.select("token", *(f"`{f.name}`" for f in others)).mapInArrow(_packed, lists)
    rows = (packed.withColumn("bucket", token_bucket(F.col("token"), buckets)).hint("rebalance", buckets, "bucket")
            .select("bucket", "token", F.explode(F.arrays_zip(*(F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(others)))).alias("row"))
            .select("token", *(F.col(f"row.c{k}").alias(f.name) for k, f in enumerate(others)), "bucket"))
    rows.select(*index.columns, "bucket").sortWithinPartitions("bucket", "token", *(f"`{f.name}`" for f in others)) \
        .write.mode("overwrite").partitionBy("bucket").parquet(path, compression="zstd")


def search_tokens(index: DataFrame, terms: Sequence[str], id_col: str,
                  mode: str = "any", buckets: int = 16) -> DataFrame:
    """Ids whose text holds the whole word(s): ``any`` term or ``all`` terms.

    The term list is the caller's (small) input. Each term's bucket is a
    constant Catalyst folds, so only those folders are listed and read; the
    ``In`` filter on ``token`` is pushed into the Parquet scan."""
    wanted = sorted({t.lower() for t in terms})
    hits = index
    if "bucket" in index.columns:
        hits = hits.filter(F.col("bucket").isin(
            *[token_bucket(F.lit(t), buckets) for t in wanted]))
    hits = hits.filter(F.col("token").isin(wanted))
    if mode == "any":
        return hits.select(id_col).distinct()
    if mode == "all":
        return (hits.groupBy(id_col).agg(F.countDistinct("token").alias("_k"))
                .filter(F.col("_k") == len(wanted)).select(id_col))
    raise ValueError("mode is 'any' or 'all'")


def index_segments(spark: SparkSession, path: str, schema: str, buckets: int = 16, fan: int = 4) -> Segments:
    """A token index that grows by batches: each is indexed into a segment of
    its own, hash-bucketed like a whole index; older segments are not touched
    until ``fan`` of one size class merge into the next. ``schema`` is that of
    the index (``token string, <id> ...``). Search it with :func:`search_tokens`
    over ``read()``: in each segment only the terms' buckets are read."""
    return Segments(spark, path, fan, write=lambda rows, to: write_token_index(rows, to, buckets),
                    merge=lambda rows: rows.drop("bucket"), schema=f"{schema}, bucket int")


def add_to_index(index: Segments, batch: DataFrame, batch_id: int, id_col: str, text: str) -> None:
    """Index one batch of new rows (a ``foreachBatch`` body)."""
    index.add(build_token_index(batch, id_col, text), batch_id)
