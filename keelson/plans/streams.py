"""Streaming queries over the driver tables: the ``events`` table is read as
a file stream (its file is the micro-batch input), run to completion with an
``availableNow`` trigger into the scratch folder, and read back as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.time import to_ntz
from keelson.operators import basic, logs, precompute, sensors
from keelson.operators.fraud import flag_outliers, fraud_score
from keelson.operators.report import ProgressLog, progress_report
from keelson.operators.segments import Segments
from keelson.session import scratch_dir
from keelson.sources.tables import read_table, stream_table
from keelson.streaming import repair, run, stateful, tails, timed


def window_counts_stream(spark: SparkSession, d: str) -> DataFrame:
    """Error events per user per day, through a watermarked
    stream in update mode; the table keeps each window's last update."""
    ev = stream_table(spark, d, "events")
    agg = logs.windowed_count(ev, "ts", "1 day", keys=["user_id"],
                              pred=F.col("event_type") == "error",
                              watermark="30 seconds", min_count=1, alias="error_count")
    keys = ["window_start", "window_end", "user_id"]
    out = run.run_to_table(spark, agg, "window_counts_stream", "update", keys=keys)
    return out.select(to_ntz("window_start").alias("window_start"),
                      to_ntz("window_end").alias("window_end"), "user_id", "error_count")


def running_counts_stream(spark: SparkSession, d: str) -> DataFrame:
    """Running count of error events per user, complete mode,
    sorted."""
    ev = stream_table(spark, d, "events")
    agg = basic.match_count(ev, "user_id", F.col("event_type") == "error",
                            alias="match_count")
    return run.run_to_table(spark, agg, "running_counts_stream", "complete")


def profile_stream(spark: SparkSession, d: str) -> DataFrame:
    """T5: the spending profile as per-user stream state."""
    ev = stream_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    prof = stateful.profile_stream(ev, "user_id", "ts", "event_id", "value",
                                   depth=50, min_n=3, ratio=3.0, floor=50.0)
    return _profiled(run.run_to_table(spark, prof, "profile_stream", "append"))


def velocity_stream(spark: SparkSession, d: str) -> DataFrame:
    """T4: the velocity count as per-user stream state, then the score."""
    ev = stream_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    vel = stateful.velocity_stream(ev, "user_id", "ts", "event_id", span="1 hour",
                                   amount="value", watermark="1 hour")
    return _scored(run.run_to_table(spark, vel, "velocity_stream", "append"))


def _scored(out: DataFrame) -> DataFrame:
    out = fraud_score(out, "value", max_velocity=5, max_amount=400.0)
    return out.select("event_id", "user_id", to_ntz("ts").alias("ts"), "velocity", "score", "alert")


def _profiled(out: DataFrame) -> DataFrame:
    return out.select("event_id", "user_id", "ts", "value", "prior_n", "prior_sum",
                      F.round("prior_stdev", 4).alias("prior_stdev"), "is_outlier")


def _by_time(df: DataFrame, ts: str, parts: int = 4) -> list[DataFrame]:
    """The table in ``parts`` pieces of equal time span, in order; every row in one."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi = df.agg(F.min(t), F.max(t)).first()
    step = ((hi or 0) - (lo or 0)) // parts + 1
    part = F.coalesce(F.floor((t - F.lit(lo or 0)) / F.lit(step)), F.lit(0))
    return [df.filter(part == k) for k in range(parts)]


def profile_stream_batches(spark: SparkSession, d: str) -> DataFrame:
    """T5 over four micro-batches in time order, the stream started again from
    its checkpoint for each: every history is read back from state (K11)."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    build = lambda s: stateful.profile_stream(s, "user_id", "ts", "event_id", "value", depth=50, min_n=3,
                                              ratio=3.0, floor=50.0)
    return _profiled(run.run_parts(spark, _by_time(ev, "ts"), ev.schema, build, "profile_batches"))


def velocity_stream_batches(spark: SparkSession, d: str) -> DataFrame:
    """T4 over four micro-batches, as :func:`profile_stream_batches`."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    build = lambda s: stateful.velocity_stream(s, "user_id", "ts", "event_id", span="1 hour",
                                               amount="value", watermark="1 hour")
    return _scored(run.run_parts(spark, _by_time(ev, "ts"), ev.schema, build, "velocity_batches"))


def summary_merge(spark: SparkSession, d: str) -> DataFrame:
    """A10/K6: event counts per type kept as a summary that each micro-batch
    of new rows refreshes (four batches: each task stages four files, split by
    a hash of the id, and a batch takes as many files as there were tasks)."""
    stage = scratch_dir(spark, "summary-stage")
    ev = read_table(spark, d, "events")
    (ev.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4)))
     .write.partitionBy("part").parquet(stage))
    files = len(spark.read.parquet(stage).inputFiles())
    src = (spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", max(1, files // 4)).parquet(stage))
    path = scratch_dir(spark, "summary")
    keys = ["event_type"]
    q = run.route_alerts(src, lambda b, i: precompute.merge_summary(path, b, i, keys),
                         checkpoint=scratch_dir(spark, "summary-ck"),
                         trigger={"availableNow": True})
    run.finish(q)
    return precompute.read_summary(spark, path, keys)


def _closed(ev: DataFrame) -> list[DataFrame]:
    """Four parts in time order, and a last record of no user, long after all others, that moves the watermark past them."""
    end = ev.agg((F.max("ts") + F.expr("interval 10 days")).alias("ts"))
    last = end.select(*(F.col("ts") if f.name == "ts" else F.lit(0 if f.name in ("event_id", "value") else None)
                        .cast(f.dataType).alias(f.name) for f in ev.schema.fields))
    return [*_by_time(ev, "ts"), last]


def velocity_state_list(spark: SparkSession, d: str) -> DataFrame:
    """T4/W5 with event-time timers and list state, over four micro-batches restarted from the checkpoint."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    build = lambda s: timed.velocity_events(s, "user_id", "ts", "event_id", "value", span="1 hour",
                                            delay="1 hour", slice_width="1 day")
    with timed.state_store(spark):
        rows = run.run_parts(spark, _closed(ev), ev.schema, build, "velocity_state")
    out = fraud_score(rows, "value", max_velocity=5, max_amount=400.0)
    return out.select("event_id", "user_id", "ts", "velocity", "score", "alert")


def profile_state_list(spark: SparkSession, d: str) -> DataFrame:
    """T5/W3 with event-time timers and list state, as :func:`velocity_state_list`."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    build = lambda s: timed.profile_events(s, "user_id", "ts", "event_id", "value", depth=50, delay="1 hour",
                                           slice_width="1 day")
    with timed.state_store(spark):
        rows = run.run_parts(spark, _closed(ev), ev.schema, build, "profile_state")
    out = flag_outliers(rows, "value", rule="ratio", ratio=3.0, floor=50.0, min_n=3)
    return out.select("event_id", "user_id", "ts", F.col("value").cast("double").alias("value"), "prior_n",
                      F.col("prior_sum").cast("double").alias("prior_sum"), "is_outlier")


def _in_batches(spark: SparkSession, df: DataFrame, id_col: str, batches: int, name: str) -> DataFrame:
    """``df`` staged as files and streamed back in about ``batches`` micro-batches,
    rows dealt by a hash of their id."""
    stage = scratch_dir(spark, name)
    df.withColumn("part", F.pmod(F.xxhash64(id_col), F.lit(batches))).write.partitionBy("part").parquet(stage)
    files = len(spark.read.parquet(stage).inputFiles())
    return (spark.readStream.schema(df.schema).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max(1, files // batches)).parquet(stage))


def summary_compacted(spark: SparkSession, d: str) -> DataFrame:
    """A10: the summary over nine or more batches, its partials merged two by two as they come."""
    keys = ["event_type"]
    summary = precompute.segmented_summary(spark, scratch_dir(spark, "segmented-summary"), keys, fan=2)
    src = _in_batches(spark, read_table(spark, d, "events"), "event_id", 9, "segmented-stage")
    run.finish(run.route_alerts(src, lambda b, i: precompute.add_to_summary(summary, b, i, keys),
                                checkpoint=scratch_dir(spark, "segmented-ck"), trigger={"availableNow": True}))
    return precompute.read_segmented_summary(summary, keys)


def trailing_avg_panes(spark: SparkSession, d: str) -> DataFrame:
    """The trailing day from panes of an hour, which a stream of about
    four batches adds to, and the raw rows of the two edge panes."""
    ev = read_table(spark, d, "events")
    panes = Segments(spark, scratch_dir(spark, "panes"), merge=sensors.merge_panes)
    src = _in_batches(spark, ev.select("event_id", "ts", "value"), "event_id", 4, "panes-stage")
    run.finish(run.route_alerts(src, lambda b, i: panes.add(sensors.pane_sums(b, "ts", "value", "1 hour"), i),
                                checkpoint=scratch_dir(spark, "panes-ck"), trigger={"availableNow": True}))
    return sensors.trailing_from_panes(panes.read(), ev, "ts", "value", sensors.latest_value(ev, "ts"), "1 day", "1 hour")


def progress_log(spark: SparkSession, d: str) -> DataFrame:
    """A stream's batches as its listener wrote them down: input rows in all."""
    ev = read_table(spark, d, "events").select("event_id", "ts")
    with ProgressLog(spark, scratch_dir(spark, "progress-log")) as log:
        q = run.start(_in_batches(spark, ev, "event_id", 4, "progress-log-in"), checkpoint=scratch_dir(spark, "progress-log-ck"),
                      trigger={"availableNow": True}, foreach_batch=run.batch_writer(scratch_dir(spark, "progress-log-out")))
        run.finish(q)
        log.wait(q)
        return log.read().agg(F.sum("num_input_rows").alias("input_rows"))


def token_search_stream(spark: SparkSession, d: str) -> DataFrame:
    """The word index kept up by the stream of documents itself, a
    segment a batch (about four), three of which merge; then the search."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = precompute.index_segments(spark, scratch_dir(spark, "index-segments"), "token string, doc_id bigint",
                                      buckets=buckets, fan=3)
    src = _in_batches(spark, docs, "doc_id", 4, "index-stage")
    run.finish(run.route_alerts(src, lambda b, i: precompute.add_to_index(index, b, i, "doc_id", "text"),
                                checkpoint=scratch_dir(spark, "index-ck"), trigger={"availableNow": True}))
    return precompute.search_tokens(index.read(), ["the"], "doc_id", buckets=buckets)


def late_repair(spark: SparkSession, d: str) -> DataFrame:
    """Daily error counts per user of all closed days, where every seventh
    event arrives after all others: its window has been stored by then and is
    counted again from the raw rows."""
    ev = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    late = F.col("event_id") % 7 == 0
    stage, out, ck = (scratch_dir(spark, f"repair-{x}") for x in ("in", "out", "ck"))
    for part in [*_by_time(ev.filter(~late), "ts"), ev.filter(late)]:
        part.write.mode("append").parquet(stage)
        run.finish(repair.keep_windows(spark.readStream.schema(ev.schema).parquet(stage), "ts", out, ck, "1 day",
                                       ["user_id"], F.col("event_type") == "error", "30 seconds", 1, "error_count", "1 day"))
    return repair.read_windows(spark, out).select(
        to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"), "user_id", "error_count")


def ingest_table(spark: SparkSession, d: str) -> DataFrame:
    """Events replayed as JSON records (epoch-microsecond time, as
    a topic would carry them), ingested by a checkpointed stream into an
    append-only Parquet table, which is then queried."""
    from keelson.sources.ingest import ingest_to_table
    ev = read_table(spark, d, "events")
    stage = scratch_dir(spark, "ingest-stage")
    rec = F.to_json(F.struct("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
                             "user_id", "event_type", "value", "props"))
    ev.select(rec.alias("value")).write.text(stage)
    schema = ("event_id BIGINT, ts BIGINT, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING")
    path = scratch_dir(spark, "ingest-table")
    q = ingest_to_table(spark.readStream.text(stage), schema, path,
                        scratch_dir(spark, "ingest-ck"), ts_field="ts", unit="us")
    run.finish(q)
    table = spark.read.parquet(path)
    return table.select("event_id", to_ntz("ts").alias("ts"), "user_id", "event_type",
                        "value", "props")


# ---- change feed -> fraud agents -> alerts (S5, S6, F8, T4, T5, K6) ------

_FEED_AFTER = [("id", "bigint"), ("user_id", "bigint"), ("amount", "variant"),
               ("created_at", "bigint")]


def _stage_order_feed(spark: SparkSession, d: str) -> str:
    """Orders replayed as change events (payload envelope, base64 amounts,
    creation time in epoch microseconds), one JSON record per line."""
    from keelson.sources.changes import change_events
    from keelson.sources.tables import spread
    o = spread(read_table(spark, d, "orders"), "o_orderkey").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("created_at"))
    stage = scratch_dir(spark, "order-feed")
    change_events(o, ["id", "user_id", "amount", "created_at"], "amount").write.text(stage)
    return stage


def _feed_reader(spark: SparkSession, stage: str):
    from pyspark.sql.types import LongType
    from keelson.functions.time import epoch_to_ts
    from keelson.sources.changes import after_schema, read_changes
    sch = after_schema([(n, LongType() if t == "bigint" else t) for n, t in _FEED_AFTER])

    def read() -> DataFrame:
        # the agents take inserts and snapshot reads as new transactions
        rows = read_changes(spark.readStream.text(stage), sch, decimals=["amount"],
                            ops=("c", "r"))
        return rows.withColumn("created_at", epoch_to_ts(F.col("created_at"), "us"))
    return read


def _velocity_agent(rows: DataFrame) -> DataFrame:
    vel = stateful.velocity_stream(rows.select("id", "user_id", "amount", "created_at"),
                                   "user_id", "created_at", "id", span="30 days",
                                   amount="amount", watermark="30 days")
    scored = fraud_score(vel, "amount", max_velocity=1, max_amount=400000.0)
    return scored.filter("alert").select("id", "user_id", "amount", "velocity", "score")


def _profile_agent(rows: DataFrame) -> DataFrame:
    prof = stateful.profile_stream(rows.select("id", "user_id", "amount", "created_at"),
                                   "user_id", "created_at", "id", "amount",
                                   depth=50, min_n=3, ratio=3.0, floor=500.0, stdev=False)
    return prof.filter("is_outlier").select("id", "user_id", "amount", "prior_n", "prior_sum")


def cdc_velocity_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The velocity agent as a stream over the change feed
    of orders; alerts where the customer placed another order within 30 days
    and the amount exceeds 400000. The 30-day window state is a tail table
    between micro-batches (JVM windows, no Python per customer)."""
    stage = _stage_order_feed(spark, d)
    rows = _feed_reader(spark, stage)().select("id", "user_id", "amount", "created_at")
    out = scratch_dir(spark, "velocity-tails")
    q = tails.velocity_batches(rows, "user_id", "created_at", "id", out,
                               scratch_dir(spark, "velocity-tails-ck"), span="30 days",
                               amount="amount")
    run.finish(q)
    scored = fraud_score(tails.read_results(spark, out), "amount", max_velocity=1,
                         max_amount=400000.0)
    return scored.filter("alert").select("id", "user_id", "amount", "velocity", "score")


def cdc_profile_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The spending-profile agent over the same feed;
    alerts where an order exceeds 3x the customer's mean of up to 50
    previous orders and 500. The histories are a table between micro-batches."""
    stage = _stage_order_feed(spark, d)
    rows = _feed_reader(spark, stage)().select("id", "user_id", "amount", "created_at")
    out = scratch_dir(spark, "profile-tails")
    run.finish(tails.profile_batches(rows, "user_id", "created_at", "id", "amount", out,
                                     scratch_dir(spark, "profile-tails-ck"), depth=50, min_n=3, ratio=3.0, floor=500.0))
    return tails.read_results(spark, out).filter("is_outlier").select(
        "id", "user_id", "amount", "prior_n", F.col("prior_sum").cast("double").alias("prior_sum"))


def cdc_agents_both(spark: SparkSession, d: str) -> DataFrame:
    """Both agents, with Python state per user, as independent consumers of
    one staged feed; their alerts side by side."""
    stage = _stage_order_feed(spark, d)
    root = scratch_dir(spark, "agents")
    agents = {"velocity": _velocity_agent, "profile": _profile_agent}
    outs = run.fan_out(spark, _feed_reader(spark, stage), agents, root)
    found = [spark.read.parquet(path).select(F.lit(name).alias("agent"), "id", "user_id", "amount")
             for name, path in outs.items()]
    return found[0].unionByName(found[1])


def cdc_undecodable(spark: SparkSession, d: str) -> DataFrame:
    """the feed with every fifth amount damaged (foreign characters, no
    bytes, a length that is none of base64): those rows arrive with a null
    amount, the others with theirs."""
    from keelson.sources.changes import after_schema, change_events, read_changes
    from pyspark.sql.types import LongType
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    feed = change_events(o, ["id", "amount"], "amount")
    order = F.get_json_object("value", "$.payload.after.id").cast("bigint")
    damaged = F.regexp_replace("value", '"amount":"[^"]*"', F.concat(
        F.lit('"amount":"'), F.element_at(F.array(*map(F.lit, ("!!!", "", "AMN", "AM NQ"))), (order % 4 + 1).cast("int")), F.lit('"')))
    feed = feed.select(F.when(order % 5 == 0, damaged).otherwise(F.col("value")).alias("value"))
    schema = after_schema([("id", LongType()), ("amount", "variant")])
    return read_changes(feed, schema, decimals=["amount"]).select("id", "amount")


def crash_windows_append(spark: SparkSession, d: str) -> DataFrame:
    """Crash counts over JSON log records in append mode:
    each daily window of a user once, after the watermark passed its end.

    The records are events in time order (four batches, epoch milliseconds),
    with malformed, empty and null values between them, and, after all others,
    crash records of the first day, which are late and do not count."""
    ev = read_table(spark, d, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    content = F.when(F.col("event_type") == "error", "App CRASH: core dumped").otherwise("fine")
    record = lambda at: F.to_json(F.struct(
        at.alias("timestamp"), F.lit("x").alias("status"),
        F.when(F.col("event_id") % 2 == 0, "High").otherwise("Critical").alias("severity"), F.lit("10.0.0.1").alias("source_ip"),
        F.concat(F.lit("user_"), "user_id").alias("user_id"), content.alias("content")))
    first = ev.agg(F.min(ms)).first()[0]
    noise = F.array(F.lit("{not json"), F.lit(""), F.lit(None).cast("string"))
    parts = [p.select(F.explode(F.when(F.col("event_id") % 10 == 0, F.array_insert(noise, 1, record(ms)))
                                .otherwise(F.array(record(ms)))).alias("value")) for p in _by_time(ev, "ts")]
    late = ev.filter("event_type = 'error'").select(record(F.lit(first)).alias("value"))

    def build(raw: DataFrame) -> DataFrame:
        return logs.windowed_count(logs.parse_logs(raw, unit="ms"), "event_time", "1 day", ["user_id"],
                                   pred=logs.crash_filter(), watermark="30 seconds", min_count=1)

    out = run.run_parts(spark, [*parts, late], "value string", build, "crash_windows")
    return out.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
                      "user_id", "crash_count")


def restart_stream(spark: SparkSession, d: str) -> DataFrame:
    """Running counts in update mode, the query stopped and started
    again from its checkpoint three times; each key's last update."""
    ev = read_table(spark, d, "events").select("event_id", "ts", "event_type")
    build = lambda s: s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return run.run_parts(spark, _by_time(ev, "ts"), ev.schema, build, "restart", "update", ["event_type"])


def progress_rows(spark: SparkSession, d: str) -> DataFrame:
    """A stream's own report over four batches: how many took rows, and how many rows."""
    ev = read_table(spark, d, "events").select("event_id", "ts")
    stage, out, ck = (scratch_dir(spark, f"progress-{x}") for x in ("in", "out", "ck"))
    reports = []
    for part in _by_time(ev, "ts"):
        part.write.mode("append").parquet(stage)
        q = run.start(spark.readStream.schema(ev.schema).parquet(stage), checkpoint=ck, trigger={"availableNow": True},
                      foreach_batch=run.batch_writer(out))
        run.finish(q)
        reports.append(progress_report(spark, q))
    rows = reports[0]
    for r in reports[1:]:
        rows = rows.unionByName(r)
    return rows.filter("num_input_rows > 0").agg(F.count(F.lit(1)).alias("batches"),
                                                 F.sum("num_input_rows").alias("input_rows"))


def velocity_stream_tails(spark: SparkSession, d: str) -> DataFrame:
    """T4 as a tail table between micro-batches (JVM windows), then W5."""
    ev = stream_table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    out = scratch_dir(spark, "velocity-tails-ev")
    q = tails.velocity_batches(ev, "user_id", "ts", "event_id", out,
                               scratch_dir(spark, "velocity-tails-ev-ck"), span="1 hour",
                               amount="value")
    run.finish(q)
    return _scored(tails.read_results(spark, out))
