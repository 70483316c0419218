"""Batch queries over the driver tables, one per operator id.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables; the SQL beside it in :mod:`keelson.plans.oracle` is the
independent DuckDB form of the same question.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import LongType

from keelson.functions.json import parse_json
from keelson.functions.text import contains_ci, contains_cs
from keelson.operators import basic, fraud, logs, pairs, precompute, report, sensors
from keelson.session import scratch_dir
from keelson.sources.changes import after_schema, change_events, read_changes
from keelson.sources.tables import load_csv, read_table, register, save_table, spread, table_path, write_csv


def row_count(spark: SparkSession, d: str) -> DataFrame:
    return basic.row_count(read_table(spark, d, "lineitem"))


def head_ordered(spark: SparkSession, d: str) -> DataFrame:
    return basic.head(read_table(spark, d, "nation"), 10, ["n_nationkey"])


def avg_by_group(spark: SparkSession, d: str) -> DataFrame:
    return basic.avg_by(read_table(spark, d, "orders"), "o_orderpriority",
                        "o_totalprice", digits=2, n=10, alias="avg_totalprice")


def nested_avg(spark: SparkSession, d: str) -> DataFrame:
    return basic.avg_of_avg(read_table(spark, d, "customer"), "c_nationkey",
                            "c_mktsegment", "c_acctbal", n=10, alias="avg_acctbal")


def top_n_rows(spark: SparkSession, d: str) -> DataFrame:
    return basic.top_n(read_table(spark, d, "orders"), "o_totalprice", 10, tie=["o_orderkey"])


def top_one(spark: SparkSession, d: str) -> DataFrame:
    return basic.top_n(read_table(spark, d, "part"), "p_retailprice", 1, tie=["p_partkey"])


def top_sum(spark: SparkSession, d: str) -> DataFrame:
    return basic.top_sum(read_table(spark, d, "lineitem"), "l_suppkey", "l_quantity", k=3,
                         alias="total_quantity")


def revenue_by(spark: SparkSession, d: str) -> DataFrame:
    return basic.revenue_by(read_table(spark, d, "lineitem"), "l_returnflag",
                            "l_extendedprice", "l_quantity", alias="total_revenue")


def top_revenue(spark: SparkSession, d: str) -> DataFrame:
    out = basic.top_revenue(read_table(spark, d, "lineitem"), "l_suppkey",
                            "l_extendedprice", "l_quantity", k=10, alias="total_spent")
    return out.withColumnRenamed("l_suppkey", "supplier")  # P3


def pair_count_join(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_count_join(read_table(spark, d, "customer"), "c_nationkey")


def pair_count(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_count(read_table(spark, d, "customer"), "c_nationkey")


def match_count_like(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    pred = contains_cs("text", "the") & (F.col("lang") == "en")
    return basic.match_count(docs, "source", pred)


def match_count_ci(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    pred = contains_ci("text", "Ein") & F.col("lang").isin("de", "fr")
    return basic.match_count(docs, "source", pred)


def json_avg(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    k = parse_json("props", "k INT").getField("k")
    return (ev.select("event_type", k.alias("k"))
            .groupBy("event_type").agg(F.avg("k").alias("avg_k"), F.count("k").alias("n_k")))


def trailing_avg(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    as_of = sensors.latest_value(ev, "ts")
    return sensors.trailing_avg(ev, "ts", "value", F.lit(as_of).cast("timestamp_ntz"), "1 day")


def profile_outlier(spark: SparkSession, d: str, max_group_rows: int = 2_000_000) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    prof = fraud.profile(ev, "user_id", "ts", "event_id", "value", depth=50, max_group_rows=max_group_rows)
    out = fraud.flag_outliers(prof, "value", rule="ratio", ratio=3.0, floor=50.0, min_n=3)
    return out.select("event_id", "user_id", "ts", "value", "prior_n",
                      F.col("prior_sum").cast("double").alias("prior_sum"),
                      F.round("prior_stdev", 4).alias("prior_stdev"), "is_outlier")


def velocity_score(spark: SparkSession, d: str, max_group_rows: int = 2_000_000) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    v = fraud.velocity(ev, "user_id", "ts", "event_id", span="1 hour", amount="value",
                       max_group_rows=max_group_rows)
    out = fraud.fraud_score(v, "value", max_velocity=5, max_amount=400.0)
    return out.select("event_id", "user_id", "ts", "velocity", "score", "alert")


def profile_chunked(spark: SparkSession, d: str) -> DataFrame:
    """W1-W3 as for a table of hot users: over 8 rows make a user large."""
    return profile_outlier(spark, d, max_group_rows=8)


def velocity_chunked(spark: SparkSession, d: str) -> DataFrame:
    """W4/W5 as for a table of hot users."""
    return velocity_score(spark, d, max_group_rows=8)


def velocity_burst(spark: SparkSession, d: str) -> DataFrame:
    """W4 where a span covers nearly all of a user's events: 30 days, users of over 8 rows split."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return fraud.velocity(ev, "user_id", "ts", "event_id", span="30 days", max_group_rows=8).select(
        "event_id", "user_id", "ts", "velocity")


def window_counts(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    out = logs.windowed_count(ev, "ts", "1 day", keys=["user_id"],
                              pred=F.col("event_type") == "error", min_count=1,
                              alias="error_count")
    return out


def cdc_decode(spark: SparkSession, d: str) -> DataFrame:
    """Orders replayed as change events (both envelopes,
    base64 and bare-number amounts), then decoded back to typed rows."""
    o = spread(read_table(spark, d, "orders"), "o_orderkey").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"), "o_orderstatus")
    feed = change_events(o, ["id", "user_id", "amount"], "amount",
                         wrapped=F.col("o_orderstatus") != "F",
                         bare_number=F.col("o_orderstatus") == "P")
    sch = after_schema([("id", LongType()), ("user_id", LongType()), ("amount", "variant")])
    return read_changes(feed, sch, decimals=["amount"])


def cube_counts(spark: SparkSession, d: str) -> DataFrame:
    """Order counts over every combination of status and priority."""
    return precompute.cube_counts(read_table(spark, d, "orders"),
                                  ["o_orderstatus", "o_orderpriority"])


def cube_route(spark: SparkSession, d: str) -> DataFrame:
    """Four stored levels of an orders cube; questions of two, one (with a
    filter) and no dimensions, each answered by the smallest level that covers it."""
    orders = read_table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.date_trunc("month", "o_orderdate").alias("month"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    cube = precompute.StoredCube(spark, scratch_dir(spark, "stored-cube"),
                                 [("status", "priority", "month"), ("status", "priority"), ("priority",), ()], ["total"])
    cube.build(orders)
    asked = {"two": cube.ask(["status", "priority"]), "one": cube.ask(["priority"], {"status": "F"}), "none": cube.ask()}
    parts = [found.select(F.lit(name).alias("question"), *(F.col(c) if c in found.columns else F.lit(None).cast("string").alias(c)
                                                           for c in ("status", "priority")),
                          "n", F.col("total").cast("double").alias("total")) for name, found in asked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_INDEXES: dict[tuple[str, str], str] = {}


def _listing(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of a table's files, and a hash of their names, sizes and times."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = files.agg(F.count(F.lit(1)).alias("n"),
                      F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash")).first()
    return found["n"], found["hash"]


def token_index(spark: SparkSession, d: str, buckets: int | None = None) -> tuple[DataFrame, int]:
    """The word index over all documents, and its number of buckets (by
    default the session's shuffle partitions, which grow with the data). It is
    built once per application and table, and read by every later search; a table
    whose files have changed is another one."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = (spark.sparkContext.applicationId, f"{d}#{n}#{_listing(spark, table_path(d, 'documents'))}")
    if key not in _INDEXES:
        path = scratch_dir(spark, "token-index")
        docs = spread(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id")
        precompute.write_token_index(precompute.build_token_index(docs, "doc_id", "text"), path, buckets=n)
        _INDEXES[key] = path
    return spark.read.parquet(_INDEXES[key]), n


def token_search(spark: SparkSession, d: str) -> DataFrame:
    """Whole-word lookup through the token index (hash-bucketed by token)."""
    index, n = token_index(spark, d)
    return precompute.search_tokens(index, ["the"], "doc_id", buckets=n)


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Customer written as headered CSV and bulk-loaded back typed."""
    cust = read_table(spark, d, "customer")
    path = scratch_dir(spark, "customer-csv")
    write_csv(cust, path)
    return load_csv(spark, path, cust.schema, strict=True)


def skew_report(spark: SparkSession, d: str) -> DataFrame:
    """How unevenly lineitem rows spread over suppliers."""
    return report.skew_report(read_table(spark, d, "lineitem"), "l_suppkey")


def skew_top_keys(spark: SparkSession, d: str) -> DataFrame:
    """The customers of at least 0.1 % of all orders, by sketch and exact recount."""
    return report.heavy_keys(read_table(spark, d, "orders"), "o_custkey", 0.001).select("o_custkey", "n_rows")


def profile_sigma(spark: SparkSession, d: str) -> DataFrame:
    """W2/W3 sigma rule: amount above mean + 3 sample deviations of the
    previous up to 50 amounts (and above 50), with at least 3 of them."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    prof = fraud.profile(ev, "user_id", "ts", "event_id", "value", depth=50)
    out = fraud.flag_outliers(prof, "value", rule="sigma", k=3.0, floor=50.0, min_n=3)
    return out.select("event_id", "user_id", "ts", "value", "is_outlier")


def trailing_avg_key(spark: SparkSession, d: str) -> DataFrame:
    """P10/A8 with a key: purchases only, trailing 3 days."""
    ev = read_table(spark, d, "events")
    as_of = sensors.latest_value(ev, "ts")
    return sensors.trailing_avg(ev, "ts", "value", F.lit(as_of).cast("timestamp_ntz"),
                                "3 days", key="event_type", key_value="purchase")


def cube_level(spark: SparkSession, d: str) -> DataFrame:
    """A11 lookup: a one-dimension question answered from the cube."""
    dims = ["o_orderstatus", "o_orderpriority"]
    cube = precompute.cube_counts(read_table(spark, d, "orders"), dims)
    return precompute.cube_level(cube, dims, ["o_orderpriority"])


def token_search_all(spark: SparkSession, d: str) -> DataFrame:
    """P16 with two terms, documents holding both whole words."""
    index, n = token_index(spark, d)
    return precompute.search_tokens(index, ["the", "of"], "doc_id", mode="all", buckets=n)


def join_count(spark: SparkSession, d: str) -> DataFrame:
    """J1 across two tables: rows of customer JOIN supplier ON nation."""
    return pairs.pair_count_join(read_table(spark, d, "customer"), "c_nationkey",
                                 read_table(spark, d, "supplier"), "s_nationkey")


def velocity_alerts_day(spark: SparkSession, d: str) -> DataFrame:
    """W4/W5/P14 over a one-day span, where both score branches fire."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    v = fraud.velocity(ev, "user_id", "ts", "event_id", span="1 day", amount="value")
    out = fraud.fraud_score(v, "value", max_velocity=5, max_amount=100.0)
    return out.select("event_id", "user_id", "ts", "velocity", "score", "alert")


def sql_view_revenue(spark: SparkSession, d: str) -> DataFrame:
    """The revenue question asked in SQL over a registered view."""
    register(read_table(spark, d, "lineitem"), "keelson_lineitem")
    return spark.sql("""
        SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(8,2))) AS DOUBLE)
                   AS revenue, count(*) AS n_rows
        FROM keelson_lineitem GROUP BY l_returnflag""")


def save_table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K2: orders written as a typed, partitioned table and read back."""
    path = scratch_dir(spark, "orders-table")
    orders = read_table(spark, d, "orders")
    save_table(orders, path, partition_by=["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path).select(orders.columns)
