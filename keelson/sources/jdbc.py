"""Database tables over JDBC.

The driver jar is supplied by the deployment. A plain ``spark.read.jdbc``
reads the whole table through one task; ``read_table_jdbc`` splits it into
``parts`` range predicates on a numeric ``key`` so each task reads a slice,
and filters on the result are pushed into the database's WHERE clause.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators.sensors import since


def read_options(url: str, table: str, props: dict | None = None, key: str | None = None,
                 bounds: tuple | None = None, parts: int | None = None,
                 fetchsize: int = 10000) -> dict[str, str]:
    """The option map of a (partitioned) JDBC scan."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    opts.update({k: str(v) for k, v in (props or {}).items()})
    if key and parts and parts > 1:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds (see key_bounds)")
        opts.update({"partitionColumn": key, "lowerBound": str(bounds[0]),
                     "upperBound": str(bounds[1]), "numPartitions": str(parts)})
    return opts


def key_bounds(spark: SparkSession, url: str, table: str, key: str,
               props: dict | None = None) -> tuple:
    """min/max of ``key`` computed by the database (one row comes back)."""
    q = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) b"
    row = spark.read.format("jdbc").options(**read_options(url, q, props)).load().first()
    return (row["lo"], row["hi"])


def read_table_jdbc(spark: SparkSession, url: str, table: str, props: dict | None = None,
                    key: str | None = None, bounds: tuple | None = None,
                    parts: int | None = None, fetchsize: int = 10000) -> DataFrame:
    """Scan a table, split into ``parts`` key ranges when ``key`` is given."""
    if key and parts and parts > 1 and bounds is None:
        bounds = key_bounds(spark, url, table, key, props)
    opts = read_options(url, table, props, key, bounds, parts, fetchsize)
    return spark.read.format("jdbc").options(**opts).load()


def read_since(spark: SparkSession, url: str, table: str, ts_col: str, as_of, span: str,
               props: dict | None = None, key: str | None = None, key_value=None,
               **scan) -> DataFrame:
    """The rows of the trailing span; the predicate runs in the database."""
    return since(read_table_jdbc(spark, url, table, props, **scan), ts_col, as_of, span,
                 key, key_value)


def append_jdbc(df: DataFrame, url: str, table: str, props: dict | None = None,
                batchsize: int = 1000, parts: int | None = None) -> None:
    """K3: append rows in ``batchsize`` inserts per round trip; ``parts``
    bounds the number of concurrent connections."""
    out = df.coalesce(parts) if parts else df
    w = out.write.format("jdbc").mode("append").option("url", url) \
        .option("dbtable", table).option("batchsize", str(batchsize))
    for k, v in (props or {}).items():
        w = w.option(k, str(v))
    w.save()
