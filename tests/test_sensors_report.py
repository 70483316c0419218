import datetime as dt

from pyspark.sql import functions as F

from keelson.operators import report, sensors
from keelson.streaming import run

T = dt.datetime(2024, 5, 1, 12, 0, 0)


def _readings(spark):
    rows = [("sensor_1", T - dt.timedelta(minutes=10), 20.0),          # exactly on the bound
            ("sensor_1", T - dt.timedelta(minutes=10, microseconds=1), 99.0),  # just outside
            ("sensor_1", T - dt.timedelta(minutes=3), 24.5),
            ("sensor_2", T - dt.timedelta(minutes=1), 30.0)]
    return spark.createDataFrame(rows, "sensor_id string, recorded_at timestamp_ntz, temperature double")


def test_trailing_avg_inclusive_bound_and_key(spark):
    df = _readings(spark)
    as_of = F.lit(T).cast("timestamp_ntz")
    r = sensors.trailing_avg(df, "recorded_at", "temperature", as_of, "10 minutes").first()
    assert (r.avg_value, r.n_rows) == (round((20.0 + 24.5 + 30.0) / 3, 2), 3)
    r = sensors.trailing_avg(df, "recorded_at", "temperature", as_of, "10 minutes",
                             key="sensor_id", key_value="sensor_1").first()
    assert (r.avg_value, r.n_rows) == (22.25, 2)


def test_trailing_avg_empty_span_is_null(spark):
    df = _readings(spark)
    later = F.lit(T + dt.timedelta(hours=1)).cast("timestamp_ntz")
    r = sensors.trailing_avg(df, "recorded_at", "temperature", later, "10 minutes").first()
    assert r.avg_value is None and r.n_rows == 0


def test_latest_value_literal_bound_is_pushed(spark, tmp):
    path = f"{tmp}/readings"
    _readings(spark).write.parquet(path)
    df = spark.read.parquet(path)
    as_of = sensors.latest_value(df, "recorded_at")
    q = sensors.trailing_avg(df, "recorded_at", "temperature",
                             F.lit(as_of).cast("timestamp_ntz"), "10 minutes")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(recorded_at" in plan


def test_skew_and_partition_reports(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 6 + [2, 3, 4]], "k int")
    r = report.skew_report(df, "k").first()
    assert (r.n_keys, r.n_rows, r.min_rows, r.max_rows) == (4, 9, 1, 6)
    assert r.skew_ratio == round(6 / 2.25, 6) and r.top_share == round(6 / 9, 6)
    parts = report.partition_report(df.repartition(3)).collect()
    assert sum(p.n_rows for p in parts) == 9 and len(parts) <= 3


def test_console_sink_runs(spark, tmp, capfd):
    src = f"{tmp}/in"
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(src)
    stream = spark.readStream.schema("id int, v string").parquet(src)
    q = run.to_console(stream, mode="append", rows=50, checkpoint=f"{tmp}/ck",
                       trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def test_panes_answer_like_raw_rows(spark):
    import random
    rnd = random.Random(3)
    rows = [(T - dt.timedelta(microseconds=rnd.randrange(4 * 3600 * 10**6)), rnd.choice([None, rnd.randrange(1000) / 10])) for _ in range(800)]
    rows += [(T, 1.0), (T - dt.timedelta(minutes=90), 2.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    halves = [sensors.pane_sums(df.filter((F.col("v") > 50) | F.col("v").isNull()), "ts", "v"), sensors.pane_sums(df.filter("v <= 50"), "ts", "v")]
    panes = sensors.merge_panes(halves[0].unionByName(halves[1]))
    for span in ("90 minutes", "61 seconds", "10 seconds", "3 hours"):
        for as_of in (T, T - dt.timedelta(seconds=17, microseconds=5), T - dt.timedelta(days=3)):
            upto = df.filter(F.col("ts") <= F.lit(as_of))
            want = sensors.trailing_avg(upto, "ts", "v", F.lit(as_of).cast("timestamp_ntz"), span).first()
            got = sensors.trailing_from_panes(halves[0].unionByName(halves[1]), df, "ts", "v", as_of, span).first()
            assert (got.avg_value, got.n_rows) == (want.avg_value, want.n_rows)
    assert panes.count() == panes.select("pane").distinct().count()


def test_only_edge_panes_are_read_raw(spark, tmp):
    rows = [(T - dt.timedelta(seconds=s), float(s)) for s in range(0, 7200, 5)]
    spark.createDataFrame(rows, "ts timestamp_ntz, v double").write.parquet(f"{tmp}/raw")
    raw = spark.read.parquet(f"{tmp}/raw")
    panes = sensors.pane_sums(raw, "ts", "v")
    empty = panes.limit(0)
    as_of = T - dt.timedelta(seconds=30)
    edges = sensors.trailing_from_panes(empty, raw, "ts", "v", as_of, "1 hour")
    assert edges.first().n_rows == 7 + 6          # 11:59:00 to 11:59:30, and 10:59:30 to 10:59:55
    assert "GreaterThanOrEqual(ts" in edges._jdf.queryExecution().executedPlan().toString()
    assert sensors.trailing_from_panes(panes, raw, "ts", "v", as_of, "1 hour").first().n_rows == 721


def test_heavy_keys_are_complete_and_exact(spark):
    import random
    rnd = random.Random(6)
    rows = [("hot",)] * 3000 + [(None,)] * 1000 + [("edge",)] * 100 + [(f"k{rnd.randrange(4000)}",) for _ in range(5900)]
    df = spark.createDataFrame(rows, "k string").repartition(6)
    got = {r.k: (r.n_rows, r.share) for r in report.heavy_keys(df, "k", 0.01).collect()}
    assert got == {"hot": (3000, 0.3), None: (1000, 0.1), "edge": (100, 0.01)}
    assert report.heavy_keys(df.limit(0), "k", 0.01).collect() == []


def test_every_batch_is_in_the_progress_log(spark, tmp):
    """Over 120 batches, of which the query itself keeps the last 100."""
    spark.range(0, 120, 1, 120).write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    with report.ProgressLog(spark, f"{tmp}/log") as log:
        q = run.start(stream, checkpoint=f"{tmp}/ck", trigger={"availableNow": True}, foreach_batch=lambda b, i: b.count())
        run.finish(q)
        log.wait(q)
    rows = log.read().filter("num_input_rows > 0").collect()
    assert len(q.recentProgress) <= 100 < len(rows)
    files = spark.read.parquet(f"{tmp}/in").inputFiles()
    assert len({r.batch_id for r in rows}) == len(rows) == len(files) and sum(r.num_input_rows for r in rows) == 120
    assert {r.run_id for r in rows} == {str(q.runId)}
