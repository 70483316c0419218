"""File tables: Parquet scans, typed CSV loads, views and table writes
(S2, S8, K1, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, key: str | None = None,
           min_partitions: int | None = None) -> DataFrame:
    """Rebalance input that arrives in fewer partitions than there are cores
    (a file written as one huge row group cannot be split), ahead of
    CPU-heavy row work (parsing, tokenising). Input already split at least
    that finely -- any large table of many files -- is returned as is, so no
    shuffle is added at scale. Rows are hashed on ``key`` (a unique column;
    all columns when absent), which is deterministic under task retries and
    needs no sort."""
    if df.isStreaming:
        return df
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, *([key] if key else df.columns))


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """The same table as a streaming file source: a file, or a folder of part
    files, at the table's path. A path without the table is an error.

    The two limits bound a micro-batch when a backlog is replayed (a file is
    never split), which bounds the rows one key brings to a stateful operator
    per batch.
    """
    r = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    # as a pattern (of one match) the path may be a file; a plain one has to be a folder
    path = table_path(sf_dir, name)
    return r.parquet(f"{path[:-1]}[{path[-1]}]")


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def load_csv(spark: SparkSession, path: str, schema: StructType | str,
             id_col: str | None = None, strict: bool = False) -> DataFrame:
    """Headered CSV to typed rows.

    Columns bind by position, like a bulk ``COPY``: the file header is skipped,
    not matched. A malformed number becomes null (PERMISSIVE) unless
    ``strict``, which fails the job instead. ``id_col`` adds a generated
    unique key (not dense, not ordered across files).
    """
    df = (spark.read.option("header", True)
          .option("mode", "FAILFAST" if strict else "PERMISSIVE")
          .option("enforceSchema", True)
          .schema(schema).csv(path))
    if id_col:
        df = df.select(F.monotonically_increasing_id().alias(id_col), "*")
    return df


def save_table(df: DataFrame, path_or_name: str, mode: str = "overwrite",
               partition_by: list[str] | None = None, as_table: bool = False,
               fmt: str = "parquet") -> None:
    """K2: create or replace a typed table (a path, or a catalog table)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        w.saveAsTable(path_or_name)
    else:
        w.save(path_or_name)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV writer (the inverse of :func:`load_csv`)."""
    df.write.mode(mode).option("header", True).csv(path)


def show(df: DataFrame, n: int = 20) -> None:
    """K1: print rows untruncated."""
    df.show(n, truncate=False)
