import datetime as dt
import json
import os
import random
from decimal import Decimal

from pyspark.sql import functions as F

from keelson.operators import fraud, logs
from keelson.streaming import run, stateful
from keelson.operators.report import progress_report

T0 = dt.datetime(2026, 1, 20, 8, 53, 50)
MS0 = 1768899230000  # T0 in epoch milliseconds (UTC)


def _log(ms, user="user_1", severity="High", content="App CRASH"):
    return json.dumps({"timestamp": ms, "status": "x", "severity": severity,
                       "source_ip": "10.0.0.1", "user_id": user, "content": content})


def _feed(spark, folder, batches, start=0):
    """Write each batch as its own file, in order (one micro-batch each)."""
    for i, lines in enumerate(batches, start):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.mode("append").text(os.path.join(folder, f"b{i:03d}"))


def _crash_stream(spark, folder):
    raw = spark.readStream.option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").text(folder)
    parsed = logs.parse_logs(raw, unit="ms")
    return logs.windowed_count(parsed, "event_time", "10 seconds", ["user_id"],
                               pred=logs.crash_filter(), watermark="30 seconds", min_count=2)


def test_parse_and_filter_rules(spark):
    lines = [_log(MS0), _log(MS0 + 9999), _log(MS0 + 10000), _log(MS0, severity="high"),
             _log(MS0, content="all fine"), "{not json", _log(MS0, severity="Critical")]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = logs.parse_logs(df)
    assert parsed.count() == 6  # malformed record dropped
    out = logs.windowed_count(parsed, "event_time", "10 seconds", ["user_id"],
                              pred=logs.crash_filter(), min_count=None).collect()
    got = {(r.window_start.replace(tzinfo=None), r.crash_count) for r in out}
    assert got == {(T0, 3), (T0 + dt.timedelta(seconds=10), 1)}
    # threshold: only counts above 2
    out = logs.windowed_count(parsed, "event_time", "10 seconds", ["user_id"],
                              pred=logs.crash_filter(), min_count=2).collect()
    assert [r.crash_count for r in out] == [3]


def test_late_rows_and_restart(spark, tmp):
    src, out, ck = (os.path.join(tmp, x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    b0 = [_log(MS0 + k * 1000, "u1") for k in range(3)]           # 3 in [:50, :00)
    b1 = [_log(MS0 + 100_000, "u2")] * 3                           # moves watermark to +70 s
    b2 = [_log(MS0 + 101_000, "u3")]                               # spacer batch
    b3 = [_log(MS0 + 2_000, "u1"), _log(MS0 + 75_000, "u4")] * 3  # late (dropped) + on time
    _feed(spark, src, [b0, b1, b2])
    q = run.start(_crash_stream(spark, src), "update", checkpoint=ck,
                  trigger={"availableNow": True}, foreach_batch=run.batch_writer(out))
    q.awaitTermination()
    # restart from the checkpoint with one more file: only the new file is read
    _feed(spark, src, [b3], start=3)
    q = run.start(_crash_stream(spark, src), "update", checkpoint=ck,
                  trigger={"availableNow": True}, foreach_batch=run.batch_writer(out))
    q.awaitTermination()
    # the late rows are dropped after partial aggregation: one combined row
    dropped = sum(r.dropped_by_watermark for r in progress_report(spark, q).collect())
    assert dropped == 1
    table = spark.read.parquet(out)
    res = run.read_mode(table, "update", ["window_start", "user_id"],
                        ["window_start", "window_end", "user_id", "crash_count"]).collect()
    got = {(r.user_id, r.crash_count) for r in res}
    assert got == {("u1", 3), ("u2", 3), ("u4", 3)}


def _tx(seed=11, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(0, 3600, 5))
        a = None if rnd.random() < 0.05 else Decimal(rnd.choice(["10.00", "50.00", "400.00",
                                                                 "4000.01", "900.00"]))
        rows.append((i, rnd.choice([1, 2, 3]), t, a))
    return rows


def test_stateful_streams_equal_batch(spark, tmp):
    rows = sorted(_tx(), key=lambda r: r[2])
    schema = "id long, user long, ts timestamp_ntz, amount decimal(10,2)"
    src = os.path.join(tmp, "tx")
    for k in range(4):  # four ordered batches
        part = rows[k * 100:(k + 1) * 100]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    prof = stateful.profile_stream(stream, "user", "ts", "id", "amount", depth=5, floor=500.0)
    got = run.run_to_table(spark, prof, "t-prof", "append",
                           out=os.path.join(tmp, "o1"), checkpoint=os.path.join(tmp, "c1"))
    batch = fraud.flag_outliers(fraud.profile(spark.createDataFrame(rows, schema), "user", "ts",
                                              "id", "amount", depth=5, chunk="10 minutes"),
                                "amount", floor=500.0)
    g = {r.id: (r.prior_n, r.prior_sum, r.is_outlier) for r in got.collect()}
    b = {r.id: (r.prior_n, None if r.prior_sum is None else float(r.prior_sum), r.is_outlier)
         for r in batch.collect()}
    assert g == b
    vel = stateful.velocity_stream(stream, "user", "ts", "id", "60 seconds", amount="amount")
    got = run.run_to_table(spark, vel, "t-vel", "append",
                           out=os.path.join(tmp, "o2"), checkpoint=os.path.join(tmp, "c2"))
    want = fraud.velocity(spark.createDataFrame(rows, schema), "user", "ts", "id",
                          "60 seconds", amount="amount")
    assert {r.id: r.velocity for r in got.collect()} == {r.id: r.velocity for r in want.collect()}


def test_complete_mode_running_count(spark, tmp):
    from keelson.operators.basic import match_count
    src = os.path.join(tmp, "logs")
    os.makedirs(src)
    _feed(spark, src, [[_log(MS0, "a", content="vulnerability found")] * 2,
                       [_log(MS0, "b", content="Vulnerability"), _log(MS0, "a", content="x")]])
    raw = spark.readStream.option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").text(src)
    parsed = logs.parse_logs(raw)
    agg = match_count(parsed, "source_ip", F.lower("content").contains("vulnerability")
                      & (F.col("severity") == "High"))
    res = run.run_to_table(spark, agg, "t-complete", "complete",
                           out=os.path.join(tmp, "o"), checkpoint=os.path.join(tmp, "c"))
    assert [(r.source_ip, r.match_count) for r in res.collect()] == [("10.0.0.1", 3)]


def test_fan_out_independent_consumers(spark, tmp):
    src = os.path.join(tmp, "feed")
    os.makedirs(src)
    _feed(spark, src, [[_log(MS0, "a"), _log(MS0, "b", content="ok")], [_log(MS0, "a")]])

    def source():
        return logs.parse_logs(spark.readStream.option("recursiveFileLookup", "true")
                               .option("maxFilesPerTrigger", 1).text(src))

    consumers = {"crashes": lambda s: s.filter(logs.crash_filter()).select("user_id"),
                 "nothing": lambda s: s.filter("false").select("user_id")}
    outs = run.fan_out(spark, source, consumers, os.path.join(tmp, "agents"))
    crashes = spark.read.parquet(outs["crashes"]).select("user_id").collect()
    assert sorted(r.user_id for r in crashes) == ["a", "a"]
    assert spark.read.parquet(outs["nothing"]).count() == 0
    # each consumer keeps its own progress
    assert os.path.isdir(os.path.join(tmp, "agents", "crashes", "ck", "offsets"))
    assert os.path.isdir(os.path.join(tmp, "agents", "nothing", "ck", "offsets"))


def test_velocity_state_expires_with_watermark(spark, tmp):
    schema = "id long, user long, ts timestamp, amount decimal(10,2)"
    t0 = dt.datetime(2024, 1, 1)
    batches = [[(1, 1, t0, Decimal("1")), (2, 2, t0, Decimal("1"))],
               [(3, 1, t0 + dt.timedelta(seconds=30), Decimal("1"))],
               [(4, 1, t0 + dt.timedelta(minutes=10), Decimal("1"))],
               [(5, 1, t0 + dt.timedelta(minutes=11), Decimal("1"))]]
    src = os.path.join(tmp, "v")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    vel = stateful.velocity_stream(stream, "user", "ts", "id", "60 seconds",
                                   amount="amount", watermark="10 seconds")
    q = run.start(vel, "append", checkpoint=os.path.join(tmp, "ck"),
                  trigger={"availableNow": True},
                  foreach_batch=run.batch_writer(os.path.join(tmp, "out")))
    q.awaitTermination()
    got = {r.id: r.velocity for r in spark.read.parquet(os.path.join(tmp, "out")).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 1, 5: 2}
    states = [r.state_rows for r in progress_report(spark, q).collect()]
    # user 2's state is gone once the watermark passed its last event + span
    assert states[0] == 2 and min(states[2:]) == 1


def test_velocity_tail_table_equals_batch(spark, tmp):
    from keelson.streaming import tails
    rows = sorted(_tx(seed=21), key=lambda r: r[2])
    schema = "id long, user long, ts timestamp_ntz, amount decimal(10,2)"
    src = os.path.join(tmp, "tx")
    for k in range(4):  # four ordered micro-batches
        part = rows[k * 100:(k + 1) * 100]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    out = os.path.join(tmp, "out")
    q = tails.velocity_batches(stream, "user", "ts", "id", out, os.path.join(tmp, "ck"),
                               span="60 seconds", amount="amount")
    q.awaitTermination()
    assert len(q.recentProgress) >= 4
    got = {r.id: r.velocity for r in tails.read_results(spark, out).collect()}
    want = fraud.velocity(spark.createDataFrame(rows, schema), "user", "ts", "id",
                          "60 seconds", amount="amount")
    assert got == {r.id: r.velocity for r in want.collect()}


def test_state_partitions_follow_the_session(spark, tmp):
    src = os.path.join(tmp, "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string").write.parquet(src)
    stream = spark.readStream.schema("id int, k string").parquet(src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        q = run.start(stream.groupBy("k").count(), "complete", checkpoint=os.path.join(tmp, "ck"),
                      trigger={"availableNow": True},
                      foreach_batch=run.batch_writer(os.path.join(tmp, "out")))
        run.finish(q)
        assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _disjoint(spark, src, batches=5):
    """Batches of different users, 100 days apart."""
    schema = "id long, user long, ts timestamp, amount decimal(10,2)"
    for k in range(batches):
        rows = [(100 * k + i, 100 * k + i, T0 + dt.timedelta(days=100 * k, seconds=i), Decimal("1")) for i in range(100)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


def test_velocity_tail_stays_bounded(spark, tmp):
    from keelson.streaming import tails
    out = os.path.join(tmp, "out")
    run.finish(tails.velocity_batches(_disjoint(spark, os.path.join(tmp, "in")), "user", "ts", "id", out, os.path.join(tmp, "ck")))
    folders = sorted(x for x in os.listdir(out) if x.startswith("batch_id="))
    tails_left = [x for x in folders if os.path.isdir(os.path.join(out, x, "_kind=tail"))]
    assert len(folders) == 5 and tails_left == folders[-2:]
    assert [spark.read.parquet(os.path.join(out, x, "_kind=tail")).count() for x in tails_left] == [100, 100]
    assert tails.read_results(spark, out).count() == 500


def test_lost_tail_is_an_error(spark, tmp):
    from keelson.streaming import tails
    import pytest
    import shutil
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    run.finish(tails.velocity_batches(_disjoint(spark, src, 2), "user", "ts", "id", out, ck))
    shutil.rmtree(os.path.join(out, "batch_id=1", "_kind=tail"))
    spark.createDataFrame([(9, 9, T0, Decimal("1"))], "id long, user long, ts timestamp, amount decimal(10,2)").write.parquet(os.path.join(src, "p9"))
    stream = spark.readStream.schema("id long, user long, ts timestamp, amount decimal(10,2)").option("recursiveFileLookup", "true").parquet(src)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|STREAM_FAILED"):
        run.finish(tails.velocity_batches(stream, "user", "ts", "id", out, ck))


def test_profile_history_table_equals_batch(spark, tmp):
    from keelson.streaming import tails
    rows = sorted(_tx(seed=31), key=lambda r: r[2])
    schema = "id long, user long, ts timestamp_ntz, amount decimal(10,2)"
    src, out = os.path.join(tmp, "tx"), os.path.join(tmp, "out")
    for k in range(4):
        spark.createDataFrame(rows[k * 100:(k + 1) * 100], schema).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    q = tails.profile_batches(stream, "user", "ts", "id", "amount", out, os.path.join(tmp, "ck"), depth=5, max_group_rows=40)
    run.finish(q)
    assert len(q.recentProgress) >= 4
    want = fraud.flag_outliers(fraud.profile(spark.createDataFrame(rows, schema), "user", "ts", "id", "amount", depth=5), "amount")
    got = {r.id: (r.prior_n, r.prior_sum, r.is_outlier) for r in tails.read_results(spark, out).collect()}
    assert got == {r.id: (r.prior_n, r.prior_sum, r.is_outlier) for r in want.collect()}


def test_past_due_user_with_only_an_undecodable_amount(spark, tmp):
    """The user's timer is behind the watermark when the next row comes: the state goes, the query lives."""
    schema = "id long, user long, ts timestamp, amount decimal(10,2)"
    late = T0 + dt.timedelta(hours=5)
    batches = [[(1, 1, T0, Decimal("1"))], [(2, 2, late, Decimal("1"))], [(3, 1, late, None)], [(4, 1, late, Decimal("1"))]]
    src = os.path.join(tmp, "in")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    vel = stateful.velocity_stream(stream, "user", "ts", "id", "60 seconds", amount="amount", watermark="10 seconds")
    got = run.run_to_table(spark, vel, "past-due", "append", out=os.path.join(tmp, "o"), checkpoint=os.path.join(tmp, "c"))
    assert {r.id: r.velocity for r in got.collect()} == {1: 1, 2: 1, 3: None, 4: 1}


def test_streams_read_files_and_folders_alike(spark, tmp):
    import pytest
    from keelson.sources.tables import stream_table
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(3).write.parquet(os.path.join(tmp, "events.parquet"))
    counts = [run.run_to_table(spark, stream_table(spark, d, "events"), f"read{k}", out=os.path.join(tmp, f"o{k}"),
                               checkpoint=os.path.join(tmp, f"c{k}")).count()
              for k, d in enumerate(("/root/testdata/sf0.001", tmp))]
    assert counts == [ev.count()] * 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stream_table(spark, tmp, "orders")


def test_parts_are_batches_with_state(spark, tmp):
    """Four parts: each is a batch of its own, and the later ones find rows in the state."""
    from keelson.plans import streams
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "ts", "value")
    parts = streams._by_time(ev, "ts")
    assert sum(p.count() for p in parts) == ev.count() and all(p.count() for p in parts)
    rows = []
    stage, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    for part in parts:
        part.write.mode("append").parquet(stage)
        s = spark.readStream.schema(ev.schema).parquet(stage)
        q = run.start(stateful.profile_stream(s, "user_id", "ts", "event_id", "value"), checkpoint=ck,
                      trigger={"availableNow": True}, foreach_batch=run.batch_writer(out))
        run.finish(q)
        rows += [r for r in progress_report(spark, q).collect() if r.num_input_rows]
    assert len(rows) == 4 and rows[0].state_rows > 0
    assert all(r.num_input_rows < ev.count() for r in rows)


def test_a_batch_rewrites_only_the_buckets_of_its_users(spark, tmp):
    """T5: three batches, the second of one user, the third of two."""
    from keelson.streaming import tails
    kind, src, out, ck = "id long, user long, ts timestamp_ntz, amount decimal(10,2)", *(os.path.join(tmp, x) for x in ("in", "out", "ck"))
    t0 = dt.datetime(2024, 1, 1)
    parts = [[(i, i % 40, t0 + dt.timedelta(seconds=i), Decimal(i + 1)) for i in range(200)],
             [(300, 7, t0 + dt.timedelta(hours=1), Decimal(5000))],
             [(400 + i, i, t0 + dt.timedelta(hours=2), Decimal(9000)) for i in (7, 8)]]

    def feed():
        stream = spark.readStream.schema(kind).parquet(src)
        run.finish(tails.profile_batches(stream, "user", "ts", "id", "amount", out, ck, depth=5, buckets=8))

    def written(n):
        return sorted(x for x in os.listdir(f"{out}/history/batch_id={n}") if x.startswith("bucket="))

    for k, part in enumerate(parts):
        spark.createDataFrame(part, kind).write.mode("append").parquet(src)
        feed()
        if k == 1:
            assert len(written(0)) == 8 and len(written(1)) == 1
    assert len(written(2)) <= 2
    got = {r.id: (r.prior_n, r.prior_sum, r.is_outlier) for r in tails.read_results(spark, out).collect()}
    history = {}
    for i, u, _, a in [r for p in parts for r in p]:
        h = history.setdefault(u, [])[-5:]
        assert got[i] == (len(h), sum(h) if h else None, len(h) >= 3 and a * len(h) > 3 * sum(h) and a > 500)
        history[u].append(a)
    held = sorted(x for n in os.listdir(f"{out}/history") if n.startswith("batch_id=") for x in written(int(n[9:])))
    assert len(held) <= 16


def test_users_share_states_in_buckets(spark, tmp):
    """Six users to a bucket: far fewer states than users, and whole numbers beyond 2^53 beside nulls stay as they are."""
    kind, src = "id long, user long, ts timestamp, amount decimal(10,2), extra long", os.path.join(tmp, "in")
    big = 2 ** 60
    t0 = dt.datetime(2024, 1, 1)
    parts = [[(big + 100 * k + u, big + u if u else None, t0 + dt.timedelta(seconds=20 * k), Decimal(10 + u + k) if u % 7 else None,
               None if u == 5 else big + u) for u in range(90)] for k in range(3)]
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    for name, build in (("v", lambda s: stateful.velocity_stream(s, "user", "ts", "id", "30 seconds", amount="amount",
                                                                 watermark="1 hour", buckets=15)),
                        ("p", lambda s: stateful.profile_stream(s, "user", "ts", "id", "amount", depth=2, buckets=15))):
        out = os.path.join(tmp, name)
        q = run.start(build(stream), checkpoint=f"{out}-ck", trigger={"availableNow": True}, foreach_batch=run.batch_writer(out))
        run.finish(q)
        assert all(r.state_rows <= 15 for r in progress_report(spark, q).collect())
        got = {r.id: r for r in spark.read.parquet(out).collect()}
        for k, rows in enumerate(parts):
            for u, (i, user, _, amount, extra) in enumerate(rows):
                r = got.pop(i)
                assert (r.user, r.amount, r.extra) == (user, amount, extra)
                before = [] if amount is None else [10 + u + x for x in range(max(0, k - 2), k)]
                if name == "v":
                    assert r.velocity == (None if amount is None else min(k, 1) + 1)
                else:
                    assert (r.prior_n, r.prior_sum) == (len(before), sum(before) if before else None)
        assert not got


def test_rows_without_a_time_stay_or_come_last():
    """User 0's other rows are in order, user 1's are not."""
    import numpy as np
    t, ids, codes = np.array([5, 9, 0, 7, 3, 0]), np.arange(6), np.array([0, 1, 0, 0, 1, 1])
    no_t, no_id = np.array([0, 0, 1, 0, 0, 1], dtype=bool), np.zeros(6, dtype=bool)
    assert stateful._in_order(t, no_t, ids, no_id, codes).tolist() == [0, 2, 3, 4, 1, 5]
    assert stateful._in_order(t, no_id, ids, no_id, codes).tolist() == [2, 0, 3, 5, 4, 1]
