"""Event-time rules with list and map state."""
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from keelson.streaming import run, timed

T0 = dt.datetime(2024, 1, 1)
KIND = "id long, user long, ts timestamp_ntz, amount decimal(10,2)"


def _rows(n=240, seed=3):
    """A user of half the rows, a null user, equal times, null times and amounts."""
    rnd = random.Random(seed)
    rows = [(i, 7 if i % 2 else rnd.choice([1, 2, None]), T0 + dt.timedelta(seconds=5 * rnd.randrange(300)),
             Decimal(rnd.randrange(100, 90000)) / 100) for i in range(n)]
    return rows + [(1000, 1, None, Decimal(1)), (1001, 7, T0, None)]


def _parts(rows):
    """Three parts by time; in each, rows arrive in any order and some of the next minute come early."""
    out = [[], [], []]
    for r in rows:
        s = (r[2] - T0).total_seconds() if r[2] else 0
        out[min(2, int(max(0, s - 50 * (r[0] % 2)) // 500))].append(r)
    for part in out:
        random.Random(5).shuffle(part)
    return [*out, [(0, None, T0 + dt.timedelta(days=1), Decimal(0))], [(0, None, T0 + dt.timedelta(days=2), Decimal(0))]]


def _stream(spark, parts, build, name):
    frames = [spark.createDataFrame(p, KIND).repartition(2) for p in parts]
    with timed.state_store(spark):
        return run.run_parts(spark, frames, KIND, build, name).collect()


def test_velocity_is_exact_whatever_the_order_within_the_delay(spark):
    rows = _rows()
    got = _stream(spark, _parts(rows), lambda s: timed.velocity_events(s, "user", "ts", "id", "amount", "2 minutes", "2 minutes"), "v")
    held = [r for r in rows if r[2] is not None and r[3] is not None]
    want = {r[0]: sum(1 for x in held if x[1] == r[1] and r[2] - dt.timedelta(minutes=2) <= x[2] and (x[2], x[0]) <= (r[2], r[0]))
            for r in held}
    assert {r["id"]: r["velocity"] for r in got if r["ts"] < T0 + dt.timedelta(hours=1)} == want
    assert {(r["id"], r["user"], r["ts"], r["amount"]) for r in got if r["ts"] < T0 + dt.timedelta(hours=1)} == set(held)


def test_profile_is_exact_whatever_the_order_within_the_delay(spark):
    rows = _rows(seed=4)
    got = _stream(spark, _parts(rows), lambda s: timed.profile_events(s, "user", "ts", "id", "amount", 5, "2 minutes"), "p")
    history, want = {}, {}
    for r in sorted((r for r in rows if r[2] is not None and r[3] is not None), key=lambda r: (r[2], r[0])):
        h = history.setdefault(r[1], [])
        want[r[0]] = (len(h[-5:]), sum(h[-5:]) if h else None)
        h.append(r[3])
    assert {r["id"]: (r["prior_n"], r["prior_sum"]) for r in got if r["ts"] < T0 + dt.timedelta(hours=1)} == want


def test_state_empties_once_the_span_is_over(spark, tmp):
    """Rows of the state store while the users are there, and after the watermark has left them."""
    parts = [[(i, i % 20, T0 + dt.timedelta(seconds=i), Decimal(1)) for i in range(200)],
             [(0, None, T0 + dt.timedelta(days=1), Decimal(0))], [(0, None, T0 + dt.timedelta(days=2), Decimal(0))]]
    sizes = []
    for k, part in enumerate(parts):
        spark.createDataFrame(part, KIND).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema(KIND).parquet(f"{tmp}/in")
        with timed.state_store(spark):
            q = run.start(timed.velocity_events(stream, "user", "ts", "id", "amount"), checkpoint=f"{tmp}/ck",
                          trigger={"availableNow": True}, foreach_batch=run.batch_writer(f"{tmp}/out{k}"))
            run.finish(q)
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sizes[0] > 40 and sizes[-1] < 10      # the closing record alone


def test_late_rows_are_dropped_and_the_session_keeps_its_store(spark):
    before = spark.conf.get(timed.STORE[0])
    parts = [[(1, 1, T0, Decimal(1))], [(2, 1, T0 + dt.timedelta(days=1), Decimal(1))], [(3, 1, T0 + dt.timedelta(seconds=1), Decimal(1))],
             [(4, 1, T0 + dt.timedelta(days=2), Decimal(1))], [(5, 1, T0 + dt.timedelta(days=3), Decimal(1))]]
    got = _stream(spark, parts, lambda s: timed.velocity_events(s, "user", "ts", "id", "amount"), "late")
    assert {r["id"]: r["velocity"] for r in got if r["id"] < 4} == {1: 1, 2: 1}
    assert spark.conf.get(timed.STORE[0]) == before


def test_state_follows_buckets_and_not_users(spark, tmp):
    """3000 users of an event each, numbers beyond 2^53 with a null among them."""
    base = 2 ** 60
    rows = [(i, base + i if i else None, T0 + dt.timedelta(milliseconds=i), Decimal(1)) for i in range(3000)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(KIND).parquet(f"{tmp}/in")
    with timed.state_store(spark):
        q = run.start(timed.velocity_events(stream, "user", "ts", "id", "amount"), checkpoint=f"{tmp}/ck",
                      trigger={"availableNow": True}, foreach_batch=run.batch_writer(f"{tmp}/out"))
        run.finish(q)
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6 * timed.BUCKETS
        spark.createDataFrame([(-1, None, T0 + dt.timedelta(days=1), Decimal(1))], KIND).write.mode("append").parquet(f"{tmp}/in")
        run.finish(run.start(timed.velocity_events(spark.readStream.schema(KIND).parquet(f"{tmp}/in"), "user", "ts", "id", "amount"),
                             checkpoint=f"{tmp}/ck", trigger={"availableNow": True}, foreach_batch=run.batch_writer(f"{tmp}/out")))
    got = spark.read.parquet(f"{tmp}/out").collect()
    assert len(got) == len(rows)
    assert {(r["id"], r["user"], r["velocity"]) for r in got} == {(r[0], r[1], 1) for r in rows}


def test_several_portions_of_slices_give_the_same(spark, monkeypatch):
    """Slices taken a few rows at a time, in order."""
    handle = timed._Sliced._portions

    class Held:
        def __init__(self, rows):
            self.rows = rows

        def getValue(self, k):
            return self.rows[k]

        def removeKey(self, k):
            del self.rows[k]

    keys = [(s, p) for s in range(4) for p in range(3)]
    sliced = timed._Sliced(1000)
    sliced.waiting = Held({k: ([str(k)] * 2, b"", b"", b"") for k in keys})
    monkeypatch.setattr(timed, "AT_ONCE", 5)
    found = list(handle(sliced, keys))
    assert [x[0][0] for part in found for x in part] == [str(k) for k in keys]
    assert len(found) == 4 and not sliced.waiting.rows
